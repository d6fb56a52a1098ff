"""Configuration sweep: every way to cut, embed, search and rank in one run."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.once import computed_once
from gristmill.functions.text import fixed_pieces, recursive_pieces, repeat_ends
from gristmill.operators import evaluation, retrieval
from gristmill.operators.boards import top_n
from gristmill.operators.sampling import QUESTION_COUNT, QUESTION_SEED, subset
from gristmill.session import cut_lineage

# Configurations per run and options kept by preselection.
MAX_PATTERNS = 8
TOP_GENERATION = 3
TOP_EMBEDDING = 2


# Search modes, rankers, and the defaults of a pattern.
SEARCH_MODES = ("lexical", "vector", "hybrid")
RANKERS = ("rrf", "weighted")
DEFAULTS = {"chunking_method": ["recursive"], "chunk_size": [2048], "chunk_overlap": [256],
            "number_of_chunks": [5], "search_mode": ["lexical"], "ranker_strategy": ["rrf"],
            "ranker_k": [retrieval.RRF_K], "ranker_alpha": [retrieval.ALPHA],
            "embedding_dimension": [retrieval.DIMENSION]}
HIT_DOCUMENTS = 100_000   # ids of documents with hits that are broadcast; more of them are joined
FUSION_DEPTH = 20         # hits of each list that a hybrid pattern merges, at least its result count


@dataclass(frozen=True)
class Config:
    """One pattern: how documents are cut, and how many chunks are retrieved in which way."""

    pattern_id: int
    chunking_method: str
    chunk_size: int
    chunk_overlap: int
    number_of_chunks: int
    search_mode: str = "lexical"
    ranker_strategy: str | None = None
    ranker_k: int | None = None
    ranker_alpha: float | None = None
    embedding_dimension: int | None = None

    @property
    def chunking(self) -> tuple[str, int, int]:
        return self.chunking_method, self.chunk_size, self.chunk_overlap

    def settled(self) -> Config:
        """Without the settings that its search mode does not use."""
        if self.search_mode not in SEARCH_MODES:
            raise ValueError(f"unknown search mode {self.search_mode!r}; one of {SEARCH_MODES}")
        if self.search_mode != "hybrid":
            plain = replace(self, ranker_strategy=None, ranker_k=None, ranker_alpha=None)
            return replace(plain, embedding_dimension=None) if self.search_mode == "lexical" else plain
        if self.ranker_strategy not in RANKERS:
            raise ValueError(f"unknown ranker {self.ranker_strategy!r}; one of {RANKERS}")
        unused = "ranker_alpha" if self.ranker_strategy == "rrf" else "ranker_k"
        return replace(self, **{unused: None})


def search_space(values: Mapping[str, Sequence],
                 max_patterns: int | None = None) -> list[Config]:
    """All different combinations of the listed values, in order.

    Parameters lists, not data: they are combined on the driver.  Combinations
    that differ only in settings without effect are one pattern.  With
    ``max_patterns`` (usually ``MAX_PATTERNS``) a larger space is an error.
    """
    unknown = set(values) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown parameters {sorted(unknown)}")
    grid = itertools.product(*[values.get(name, default) for name, default in DEFAULTS.items()])
    points = dict.fromkeys(Config(0, *point).settled() for point in grid)
    found = [replace(point, pattern_id=i) for i, point in enumerate(points)]
    if max_patterns is not None and len(found) > max_patterns:
        raise ValueError(f"{len(found)} patterns are more than {max_patterns}")
    return found


def _pieces(text, method: str, size: int, overlap: int):
    if method == "fixed":
        return fixed_pieces(text, size, overlap)
    if method != "recursive":
        raise ValueError(f"unknown chunking method {method!r}")
    return recursive_pieces(text, size - overlap)


def chunk_all(documents: DataFrame, cuts: Sequence[tuple[str, int, int]], doc: str,
              text: str) -> DataFrame:
    """Chunks of every setting from one read of the documents: (setting, doc, chunk_no, text)."""
    pieces = computed_once(documents.select(doc, text), "_all", F.array(
        *[_pieces(F.col(text), *c) for c in cuts])).drop(text)
    by_setting = pieces.select(doc, F.posexplode("_all").alias("setting", "_pieces"))
    overlaps = F.array(*[F.lit(overlap if method == "recursive" else 0)
                         for method, _, overlap in cuts])
    if any(method == "recursive" and overlap for method, _, overlap in cuts):
        overlap = F.get(overlaps, F.col("setting"))
        by_setting = by_setting.withColumn("_pieces", F.when(overlap > 0, repeat_ends(
            F.col("_pieces"), overlap)).otherwise(F.col("_pieces")))
    return by_setting.select("setting", doc, F.posexplode("_pieces").alias("chunk_no",
                                                                           "chunk_text"))


def _lists(questions: DataFrame, chunks: DataFrame, configs: Sequence[Config], cuts: Sequence,
           item: str, question: str, doc: str, embed: Callable, depth: int) -> DataFrame:
    """Hit lists that the patterns need: (list, setting, item, doc, chunk_no, score, rank).

    ``list`` is -1 for lexical hits, else the number of the embedding.  All
    embeddings of all settings are one vector index with their number as group.
    """
    key = [doc, "chunk_no"]

    def wanted(modes):
        return max([0, *(max(c.number_of_chunks, depth if c.search_mode == "hybrid" else 0)
                         for c in configs if c.search_mode in modes)])

    parts = []
    if k := wanted(("lexical", "hybrid")):
        hits = retrieval.bm25(questions, chunks, k, item, question, key, "chunk_text",
                              group="setting")
        parts.append(hits.select(F.lit(-1).alias("list"), "setting", item, *key, "score", "rank"))
    if k := wanted(("vector", "hybrid")):
        sizes, many = dimensions(configs), len(cuts)
        indexes, asked = [], []
        for number, size in enumerate(sizes):
            place = (F.lit(number * many) + F.col("setting")).cast("int").alias("place")
            indexes.append(embed(chunks, "chunk_text", "embedding", size).select(
                *key, place, "embedding"))
            every = F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("setting")
            asked.append(embed(questions.select(item, question, every), question, "embedding",
                               size).select(item, place, "embedding"))
        hits = retrieval.search(_all(asked), _all(indexes), k, query_id=item, item_id=key,
                                group="place")
        parts.append(hits.select(F.floor(F.col("place") / many).cast("int").alias("list"),
                                 (F.col("place") % many).alias("setting"), item, *key, "score",
                                 "rank"))
    return _all(parts)


def _all(frames: Sequence[DataFrame]) -> DataFrame:
    first = frames[0]
    for other in frames[1:]:
        first = first.unionByName(other)
    return first


def dimensions(configs: Sequence[Config]) -> list[int]:
    """The embeddings in use, by which vector lists are numbered."""
    return sorted({c.embedding_dimension for c in configs if c.embedding_dimension is not None})


def _ranked(lists: DataFrame, configs: Sequence[Config], cuts: Sequence, item: str, doc: str,
            depth: int) -> DataFrame:
    """The hits of every pattern: (pattern_id, setting, item, doc, chunk_no, rank).

    A hybrid pattern adds up its two lists, ``rrf`` by 1 / (k + rank), ``weighted``
    by alpha times the vector score and 1 - alpha times the lexical score, each
    scaled to 0..1 within its list; other patterns take their list as it is.
    """
    sizes = dimensions(configs)
    uses = [(c.pattern_id, cuts.index(c.chunking), c.number_of_chunks, which, c.ranker_k,
             None if c.ranker_alpha is None else share(c.ranker_alpha),
             max(c.number_of_chunks, depth) if c.search_mode == "hybrid" else c.number_of_chunks,
             c.ranker_strategy)
            for c in configs
            for which, share, modes in (
                (-1, lambda alpha: 1.0 - alpha, ("lexical", "hybrid")),
                (sizes.index(c.embedding_dimension) if c.embedding_dimension is not None else -2,
                 float, ("vector", "hybrid")))
            if c.search_mode in modes]
    table = lists.sparkSession.createDataFrame(
        uses, "pattern_id int, setting int, k int, list int, ranker_k int, share double, deep int,"
              " ranker string")
    used = lists.join(F.broadcast(table), ["list", "setting"]).filter("rank <= deep")
    per = Window.partitionBy("pattern_id", "list", item)
    low, high = F.min("score").over(per), F.max("score").over(per)
    scaled = F.when(high > low, (F.col("score") - low) / (high - low)).otherwise(1.0)
    value = F.when(F.col("ranker") == "rrf", 1.0 / (F.col("ranker_k") + F.col("rank"))).when(
        F.col("ranker") == "weighted", F.col("share") * scaled).otherwise(F.col("score"))
    merged = used.withColumn("value", value).groupBy(
        "pattern_id", "setting", "k", item, doc, "chunk_no").agg(
        F.round(F.sum("value"), retrieval.SCORE_DIGITS).alias("score"))
    most = max(c.number_of_chunks for c in configs)
    return retrieval.rank_hits(merged, ["pattern_id", item], [doc, "chunk_no"], most).filter(
        "rank <= k").drop("k", "score")


def sweep(questions: DataFrame, documents: DataFrame, truth: DataFrame, configs: Sequence[Config],
          item: str = "item_id", question: str = "text", doc: str = "doc_id",
          text: str = "text", answers: str | None = None, embed: Callable = retrieval.embed,
          depth: int = FUSION_DEPTH) -> DataFrame:
    """One row per pattern and question with contexts, answer and the three scores.

    All chunk settings are one index with the setting as a column, searched in
    a single pass by words and in one by vectors; patterns share the hit lists.
    ``answers`` names the column with a question's correct answers (an array of
    texts); without it the question is its own answer.  ``embed(frame, text,
    out, dimension)`` makes the vectors.  A hybrid pattern merges the best
    ``depth`` hits of both lists.  The answer is the best context, as no text
    generator is part of this.
    """
    cuts = list(dict.fromkeys(c.chunking for c in configs))
    chunks = chunk_all(documents, cuts, doc, text)
    if any(c.search_mode != "lexical" for c in configs) and any(
            c.search_mode != "vector" for c in configs):
        chunks = cut_lineage(chunks)        # read by both searches
    lists = _lists(questions, chunks, configs, cuts, item, question, doc, embed, depth)
    hits = _ranked(lists, configs, cuts, item, doc, depth)
    # The few hits are kept, matched back to their documents and cut again, so
    # chunk text never goes through the search.
    hits = cut_lineage(evaluation.mark_relevant(hits, truth, item, doc))
    found = hits.select(doc).distinct()
    few = found.limit(HIT_DOCUMENTS + 1).count() <= HIT_DOCUMENTS
    hit_docs = documents.join(F.broadcast(found) if few else found, doc, "left_semi")
    hit_text = chunk_all(hit_docs, cuts, doc, text)
    by_pattern = hits.join(hit_text, ["setting", doc, "chunk_no"])
    contexts = evaluation.gather_contexts(by_pattern, ["pattern_id", item], doc, "chunk_text")
    every = F.explode(F.array(*[F.lit(c.pattern_id) for c in configs])).alias("pattern_id")
    correct = F.col(answers) if answers else F.array(F.col(question))
    asked = questions.select(item, F.col(question).alias("question"),
                             correct.alias("correct_answers"), every)
    rows = asked.join(contexts, ["pattern_id", item], "left").withColumn(
        "answer", F.get("contexts", F.lit(0))["text"])
    return evaluation.rag_metrics(rows)


def score_rows(evaluated: DataFrame, metrics=evaluation.PATTERN_METRICS) -> DataFrame:
    """Long scores: (pattern_id, item, metric, value)."""
    others = [c for c in evaluated.columns if c not in metrics]
    return evaluated.unpivot([c for c in others if c in ("pattern_id", "item_id")],
                             list(metrics), "metric", "value")


def pattern_scores(evaluated: DataFrame, configs: Sequence[Config], optimise: str) -> DataFrame:
    """One row per pattern: settings, the scores of each metric and the final score."""
    metric = evaluation.require_metric(optimise)
    stats = evaluation.mean_ci(score_rows(evaluated), ["pattern_id", "metric"])
    wide = stats.groupBy("pattern_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(
            "metric", F.struct("mean", "ci_low", "ci_high"))))).alias("scores"))
    settings = evaluated.sparkSession.createDataFrame(
        [(c.pattern_id, f"pattern_{c.pattern_id}", c.pattern_id, len(configs), c.chunking_method,
          c.chunk_size, c.chunk_overlap, c.number_of_chunks, c.search_mode, c.ranker_strategy,
          c.ranker_k, c.ranker_alpha, c.embedding_dimension) for c in configs],
        "pattern_id int, name string, iteration int, max_combinations int, chunking_method string,"
        " chunk_size int, chunk_overlap int, number_of_chunks int, search_mode string,"
        " ranker_strategy string, ranker_k int, ranker_alpha double, embedding_dimension int")
    return wide.join(F.broadcast(settings), "pattern_id").withColumn(
        "final_score", F.col("scores")[metric]["mean"])


def preselect(questions: DataFrame, documents: DataFrame, truth: DataFrame,
              configs: Sequence[Config], option: str, keep: int,
              metric: str = evaluation.DEFAULT_METRIC, item: str = "item_id",
              sample_size: int = QUESTION_COUNT) -> DataFrame:
    """Best ``keep`` values of one option, by mean score on ``sample_size`` questions."""
    sample = subset(questions, sample_size, item, QUESTION_SEED)
    evaluated = sweep(sample, documents, truth, configs, item)
    table = evaluated.sparkSession.createDataFrame(
        [(c.pattern_id, getattr(c, option)) for c in configs], ["pattern_id", option])
    scored = evaluated.join(F.broadcast(table), "pattern_id").groupBy(option).agg(
        F.avg(evaluation.require_metric(metric)).alias("score"))
    return top_n(scored, "score", option, keep)
