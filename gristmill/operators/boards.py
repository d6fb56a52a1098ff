"""Model leaderboards, metric maps and run metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators.ranking import global_rank

# Task prefix, skipped bookkeeping keys, accuracy key marks.
HOLDOUT_TASK = "custom_holdout_eval"
HOLDOUT_PREFIX = "holdout"
SKIPPED_KEYS = ("display_name", "store_session_info")
ACCURACY_MARKS = ("_acc,", "_acc_norm,")
NOT_ACCURACY = "stderr"


def leaderboard(df: DataFrame, metric: str, name: str, higher_is_better: bool = True) -> DataFrame:
    """Rank rows by a metric from 1, best first, missing values last, ties by name."""
    value = F.col(metric).cast("double")
    ordered = df.withColumn("_missing", value.isNull()).withColumn(
        "_order", F.coalesce(-value if higher_is_better else value, F.lit(0.0)))
    return global_rank(ordered, ["_missing", "_order", name]).drop("_missing", "_order")


def top_n(df: DataFrame, metric: str, name: str, n: int,
          higher_is_better: bool = True) -> DataFrame:
    direction = F.desc_nulls_last if higher_is_better else F.asc_nulls_last
    return df.orderBy(direction(metric), name).limit(n)


def best_row(ranked: DataFrame) -> DataFrame:
    return ranked.filter(F.col("rank") == 1)


def model_board(models: DataFrame, metrics: DataFrame, key: str, uri: str) -> DataFrame:
    """Models with their metrics and the paths of what belongs to each."""
    root = F.concat_ws("/", F.regexp_replace(F.col(uri), "/+$", ""), F.col(key))
    return models.join(metrics, key).withColumns({
        "notebook": F.concat_ws("/", root, F.lit("notebooks/automl_predictor_notebook.ipynb")),
        "predictor": F.concat_ws("/", root, F.lit("predictor/predictor.pkl"))})


def metrics_long(df: DataFrame, entity: str, json: str) -> DataFrame:
    """One row per numeric entry of a JSON metrics object; texts are no numbers."""
    entries = F.explode(F.from_json(F.col(json), "map<string,variant>")).alias("metric", "_entry")
    rows = df.select(entity, entries).filter(_is_number(F.col("_entry")))
    return rows.withColumn("value", F.try_variant_get("_entry", "$", "double")).drop("_entry")


def _is_number(entry: Column) -> Column:
    return F.coalesce(F.schema_of_variant(entry).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"),
                      F.lit(False))


def flatten_metrics(df: DataFrame, results: str) -> DataFrame:
    """Long metric rows from evaluator results ``{task: {alias, name: number}}``.

    Keys are ``prefix_name`` with spaces and slashes as underscores; numbers
    only, true and false counting as 1 and 0.  A text is no number, whatever it says.
    """
    others = [c for c in df.columns if c != results]
    tasks = df.select(*others, F.explode(F.from_json(
        F.col(results), "map<string,map<string,variant>>")).alias("task", "_metrics"))
    alias = F.try_variant_get(F.col("_metrics")["alias"], "$", "string")
    prefix = F.when(F.col("task") == HOLDOUT_TASK, HOLDOUT_PREFIX).otherwise(
        F.coalesce(alias, F.col("task")))
    rows = tasks.select(*others, "task", prefix.alias("_prefix"),
                        F.explode("_metrics").alias("_name", "_entry"))
    entry = F.col("_entry")
    number = F.when(F.schema_of_variant(entry) == "BOOLEAN", F.try_variant_get(
        entry, "$", "boolean").cast("double")).when(
        _is_number(entry), F.try_variant_get(entry, "$", "double"))
    key = F.translate(F.concat_ws("_", "_prefix", "_name"), " /", "__")
    return rows.withColumn("value", number).filter(
        (F.col("_name") != "alias") & F.col("value").isNotNull()).select(
        *others, "task", key.alias("metric"), "value")


def evaluation_facts(metrics: DataFrame, run: str, seconds: DataFrame | None = None) -> DataFrame:
    """What an evaluation tells of itself besides its scores, one row per run.

    ``metrics`` are rows of :func:`flatten_metrics` with a run; ``seconds`` is
    (run, duration).  Counted are the tasks; custom data ran if one of them is
    the hold-out task, whose rows are then not a benchmark task.
    """
    custom = F.coalesce(F.max(F.col("task") == HOLDOUT_TASK), F.lit(False))
    names = F.array_sort(F.collect_set(F.when(F.col("task") != HOLDOUT_TASK, F.col("task"))))
    facts = metrics.groupBy(run).agg(
        F.count_distinct("task").alias("tasks_count"), custom.cast("int").alias("custom_eval_enabled"),
        F.array_join(names, ",").alias("benchmark_tasks"))
    if seconds is None:
        return facts
    return facts.join(seconds.select(run, F.round("duration", 2).alias("duration_seconds")), run,
                      "left")


def merge_run_metadata(training: DataFrame, evaluation: DataFrame, run: str,
                       extra: dict[str, str] | None = None,
                       facts: DataFrame | None = None) -> DataFrame:
    """One record per run: prefixed training and evaluation metrics as text.

    Inputs are (run, metric, value) rows; ``extra`` adds entries such as the
    base model or pipeline name to every run, also to one without other entries.
    ``facts`` has a row per run whose other columns, where not null, become
    evaluation entries of that run.
    """
    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.filter(~F.col("metric").isin(*SKIPPED_KEYS)).select(
            run, F.concat(F.lit(prefix), "metric").alias("key"),
            F.col("value").cast("string").alias("value"))

    merged = side(training, "training_").unionByName(side(evaluation, "eval_"))
    runs = training.select(run).union(evaluation.select(run))
    if facts is not None:
        entries = [c for c in facts.columns if c != run]
        merged = merged.unionByName(side(facts.select(run, *[
            F.col(c).cast("string").alias(c) for c in entries]).unpivot(
            [run], entries, "metric", "value").filter("value is not null"), "eval_"))
        runs = runs.union(facts.select(run))
    if extra:
        added = F.explode(F.create_map(*[F.lit(x) for pair in extra.items() for x in pair]))
        runs = runs.distinct()
        merged = merged.unionByName(runs.select(run, added.alias("key", "value")))
    return merged


def best_metric(evaluation: DataFrame, run: str, order: str) -> DataFrame:
    """Best accuracy metric per run; text counts as 0, the first in ``order`` wins ties."""
    wanted = F.lit(False)
    for mark in ACCURACY_MARKS:
        wanted = wanted | F.contains(F.col("metric"), F.lit(mark))
    rows = evaluation.filter(wanted & ~F.contains(F.col("metric"), F.lit(NOT_ACCURACY)))
    score = F.coalesce(F.col("value").try_cast("double"), F.lit(0.0))
    top = F.max_by(F.struct("metric", "value"), F.struct(score, -F.col(order)))
    return rows.groupBy(run).agg(top.alias("_top")).select(
        run, F.col("_top.metric").alias("eval_best_metric"),
        F.col("_top.value").cast("string").alias("eval_best_score"))


def metric_columns(present: Sequence[str], first: str, preferred: Sequence[str]) -> list[str]:
    """Column order: the chosen metric, the preferred ones, then the rest as seen."""
    ordered = [m for m in preferred if m in present]
    ordered += [m for m in present if m not in ordered]
    return sorted(ordered, key=lambda m: m != first)


def number_text(value: Column, digits: int = 4) -> Column:
    """Fixed decimals, rounded from the exact binary value (``format_string`` rounds half up)."""
    return F.call_function("format_number", value, F.lit("0." + "0" * digits))
