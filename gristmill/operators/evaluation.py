"""Per-question evaluation of retrieval patterns, and means with intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import (
    CONTEXT_TEMPLATE, SYSTEM_MESSAGE, USER_MESSAGE, fill_template, words)

# Accepted metric names and the normal quantile of a 95 % interval.
PATTERN_METRICS = ("faithfulness", "answer_correctness", "context_correctness")
DEFAULT_METRIC = "faithfulness"
Z = {0.9: 1.6448536269514722, 0.95: 1.959963984540054, 0.99: 2.5758293035489004}


def require_metric(name: str | None) -> str:
    name = name or DEFAULT_METRIC
    if name not in PATTERN_METRICS:
        raise ValueError(f"optimization metric must be one of {sorted(PATTERN_METRICS)}; "
                         f"got {name!r}")
    return name


def zip_contexts(texts: Column, ids: Column) -> Column:
    """Contexts with their document ids by position, up to the shorter list."""
    n = F.least(F.size(texts), F.size(ids))
    return F.when(n > 0, F.zip_with(
        F.slice(texts, F.lit(1), n), F.slice(ids, F.lit(1), n),
        lambda t, i: F.struct(t.alias("text"), i.alias("document_id"))))


def attach_scores(evaluations: DataFrame, scores: DataFrame,
                  question_id: str = "question_id") -> DataFrame:
    """Add a map of the scores each question has; ``scores`` is (question, metric, value)."""
    maps = scores.groupBy(question_id).agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct("metric", "value")))).alias("scores"))
    empty = F.create_map().cast("map<string,double>")
    return evaluations.join(maps, question_id, "left").withColumn(
        "scores", F.coalesce("scores", empty))


def build_evaluation(benchmark: DataFrame, answers: DataFrame,
                     question_id: str = "question_id") -> DataFrame:
    """Benchmark questions with their answers, joined by id, never by position."""
    return benchmark.join(answers, question_id, "inner")


def pattern_results(patterns: DataFrame, evaluations: DataFrame,
                    pattern_id: str = "pattern_id") -> DataFrame:
    """Every pattern with its evaluation rows; a pattern without any keeps one empty row.

    An inner join plus the rest: in an outer join the many rows of one pattern
    could not be split among tasks.
    """
    found = patterns.join(evaluations, pattern_id)
    without = patterns.join(evaluations.select(pattern_id).distinct(), pattern_id, "left_anti")
    return found.unionByName(without, allowMissingColumns=True)


def mark_relevant(hits: DataFrame, truth: DataFrame, question_id: str, doc: str) -> DataFrame:
    """Flag hits whose document is correct for the question."""
    correct = truth.select(question_id, doc).distinct().withColumn("relevant", F.lit(True))
    return hits.join(correct, [question_id, doc], "left").withColumn(
        "relevant", F.coalesce("relevant", F.lit(False)))


def gather_contexts(hits: DataFrame, by: Sequence[str], doc: str, text: str) -> DataFrame:
    """One row per question (and pattern) with its ranked contexts.

    Each list holds at most the k hits of the search.
    """
    entry = F.struct("rank", F.col(text).alias("text"), F.col(doc).alias("document_id"),
                     "relevant")
    return hits.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("contexts"))


def reciprocal_rank(contexts: Column) -> Column:
    place = F.array_position(F.transform(contexts, lambda c: c["relevant"]), True)
    return F.when(place > 0, 1.0 / place).otherwise(0.0)


def word_recall(answer: Column, correct: Column) -> Column:
    """Best share of a correct answer's distinct words found in the answer."""
    have = F.array_distinct(words(answer))

    def share(text: Column) -> Column:
        want = F.array_distinct(words(text))
        return F.when(F.size(want) > 0, F.size(F.array_intersect(want, have)) / F.size(want)
                      ).otherwise(0.0)

    return F.coalesce(F.array_max(F.transform(correct, share)), F.lit(0.0))


def word_precision(answer: Column, contexts: Column) -> Column:
    """Share of the answer's distinct words found in the retrieved text."""
    said = F.array_distinct(words(answer))
    seen = F.array_distinct(words(F.array_join(F.transform(contexts, lambda c: c["text"]), " ")))
    return F.coalesce(F.when(F.size(said) > 0, F.size(F.array_intersect(said, seen))
                             / F.size(said)), F.lit(0.0))


def rag_metrics(evaluations: DataFrame) -> DataFrame:
    """Add the three scores to rows of (answer, correct_answers, contexts)."""
    answer = F.coalesce("answer", F.lit(""))
    return evaluations.withColumns({
        "faithfulness": word_precision(answer, F.col("contexts")),
        "answer_correctness": word_recall(answer, F.col("correct_answers")),
        "context_correctness": F.coalesce(reciprocal_rank(F.col("contexts")), F.lit(0.0))})


def mean_ci(df: DataFrame, group: Sequence[str], value: str = "value",
            level: float = 0.95) -> DataFrame:
    """Mean with a normal-approximation interval, built from mergeable sums."""
    half = Z[level] * F.coalesce(F.stddev_samp(value), F.lit(0.0)) / F.sqrt(F.count(value))
    return df.groupBy(*group).agg(
        F.avg(value).alias("mean"), (F.avg(value) - half).alias("ci_low"),
        (F.avg(value) + half).alias("ci_high"), F.count(value).alias("n"))


def build_prompts(questions: DataFrame, contexts: DataFrame, by: str, question: str,
                  context_template: str = CONTEXT_TEMPLATE, user_message: str = USER_MESSAGE,
                  system_message: str = SYSTEM_MESSAGE) -> DataFrame:
    """System and user prompt per question: each context through its template,
    joined by line ends, then placed with the question in the user message."""
    filled = F.transform(F.col("contexts"), lambda c: fill_template(
        context_template, {"document": c["text"]}))
    joined = F.coalesce(F.array_join(filled, "\n"), F.lit(""))
    return questions.join(contexts, by, "left").select(
        by, F.lit(system_message).alias("system_prompt"),
        fill_template(user_message, {"reference_documents": joined,
                                     "question": F.col(question)}).alias("user_prompt"))
