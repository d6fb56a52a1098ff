"""Embedding, exact top-k search (vector and lexical), hybrid ranking.

Both searches are a grid: questions in bounded blocks, the index in bounded
slabs.  A cell scores its items against its questions with numpy and keeps k
hits per question; only those go on.  The index is read once, however many
questions there are.  Lexical search runs over an inverted index that can be
stored: postings by slab, so the postings of a frequent word are spread over
all slabs, and only those of asked words reach a cell.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gristmill.functions.text import words
from gristmill.session import collect_bounded, scratch_path

# Defaults of embedding and search.
DIMENSION = 768
TOP_K = 5
METRICS = ("cosine", "euclidean")
BM25_K1 = 1.2
BM25_B = 0.75
RRF_K = 60
ALPHA = 0.5

QUERY_BLOCK = 16_384          # questions of a cell, and numbers in them
QUERY_BLOCK_NUMBERS = 4_000_000
SLAB_NUMBERS = 16_000_000     # numbers of the index in a cell
CELLS_PER_CORE = 3            # cells of a grid, at least
LEXICAL_BLOCK = 256
LEXICAL_SLAB = 8192           # chunks of a slab of postings
KNOWN_TERMS = 100_000         # asked words sent to the tasks that make postings
STEP_CELLS = 4_000_000        # cells of one dense score matrix
VECTOR_CELLS = 500_000        # the same for vectors, so that it stays in the cache
HITS_WAITING = 1_000_000      # hits that wait to be cut to the k best
DENSE_SHARE = 512             # a word in more than 1 of so many cells is scored densely
DENSE_WORDS = 256             # such words of one matrix product
SCORE_DIGITS = 6              # scores are compared and returned at this precision


def _hashed(df: DataFrame, text: str, dim: int) -> DataFrame:
    """Word counts by hash, as a sparse vector of unit length in ``_unit``."""
    counted = HashingTF(numFeatures=dim, inputCol="_words", outputCol="_counts").transform(
        df.withColumn("_words", words(F.coalesce(F.col(text), F.lit("")))))
    return Normalizer(inputCol="_counts", outputCol="_unit").transform(counted).drop(
        "_words", "_counts")


def embed(df: DataFrame, text: str = "text", out: str = "embedding",
          dim: int = DIMENSION) -> DataFrame:
    """Hashed word counts of unit length: no shuffle, no vocabulary to collect."""
    return _hashed(df, text, dim).withColumn(out, vector_to_array("_unit", "float32")).drop("_unit")


def embed_sparse(df: DataFrame, text: str = "text", dim: int = DIMENSION) -> DataFrame:
    """The same as ``places`` and ``weights`` that are not zero, for any width."""
    parts = F.from_json(F.to_json(F.struct(F.col("_unit").alias("v"))),
                        "v struct<indices: array<int>, values: array<double>>")
    return _hashed(df, text, dim).withColumn("_parts", parts["v"]).withColumns({
        "places": F.col("_parts.indices"), "weights": F.col("_parts.values")}).drop("_unit", "_parts")


class _Best:
    """The k best hits per question so far; ties go to the smaller item id."""

    def __init__(self, k: int, questions: int):
        self.k = k
        self.floor = np.full(questions, -np.inf)
        self.question = np.empty(0, np.int64)
        self.score = np.empty(0)
        self.items: list[np.ndarray] | None = None
        self.waiting: list[tuple] = []      # hits that are not yet cut to k
        self.held = 0

    def add(self, scores: np.ndarray, first_question: int, items: list[np.ndarray],
            positive: bool, value: Callable | None = None, least: Callable | None = None) -> None:
        """Scores of some items (rows) against a run of questions (columns).

        Where ``scores`` only have the order of the real ones in each column,
        ``value(scores, rows, columns)`` gives these and ``least(real)`` for each
        column a score that no cell with ``real`` or more is below.
        """
        span = slice(first_question, first_question + scores.shape[1])
        floor = self.floor[span]
        if not np.isfinite(scores.sum()):
            self._add_odd(scores if value is None else value(scores, *np.indices(
                scores.shape)), first_question, items, positive)
            return
        if len(scores) > self.k and (floor == -np.inf).any():
            at = _kth_at_least(scores, self.k)
            known = scores[at, np.arange(len(at))] if value is None else value(
                scores, at, np.arange(len(at)))
            floor = np.maximum(floor, known)
        # Unrounded scores this far below may still round to the same number.
        floor = floor - 2 * 10.0 ** -SCORE_DIGITS - 1e-9 * np.abs(floor)
        cells = np.flatnonzero(scores >= (floor if least is None else least(floor)))
        if not len(cells):
            return
        rows, columns = np.divmod(cells, scores.shape[1])
        score = np.round(scores[rows, columns] if value is None else value(
            scores, rows, columns), SCORE_DIGITS)
        if positive:
            rows, columns, score = rows[score > 0], columns[score > 0], score[score > 0]
        self.waiting.append((columns + first_question, score, [values[rows] for values in items]))
        self.held += len(rows)
        if self.held > HITS_WAITING:
            self.cut()

    def _add_odd(self, scores, first_question, items, positive) -> None:
        """The same where some scores are no numbers, which are no hits."""
        scores = np.round(scores, SCORE_DIGITS)
        wanted = scores >= self.floor[first_question:first_question + scores.shape[1]]
        if positive:
            wanted &= scores > 0
        if len(scores) > self.k:
            kth = np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k]
            wanted &= scores >= kth
        rows, columns = np.nonzero(wanted)
        if len(rows):
            self.waiting.append((columns + first_question, scores[rows, columns],
                                 [values[rows] for values in items]))
            self.cut()

    def cut(self) -> None:
        """Keep the k best; needed before the hits are read."""
        if not self.waiting:
            return
        self.question = np.concatenate([self.question, *(w[0] for w in self.waiting)])
        self.score = np.concatenate([self.score, *(w[1] for w in self.waiting)])
        lists = [w[2] for w in self.waiting]
        if self.items is not None:
            lists.insert(0, self.items)
        self.items = [np.concatenate(values) for values in zip(*lists, strict=True)]
        self.waiting, self.held = [], 0
        order = np.lexsort((*reversed(self.items), -self.score, self.question))
        question = self.question[order]
        starts = np.flatnonzero(np.diff(question, prepend=-1))
        place = np.arange(len(question)) - np.repeat(starts, np.diff(np.r_[starts, len(question)]))
        order = order[place < self.k]
        self.question, self.score = self.question[order], self.score[order]
        self.items = [values[order] for values in self.items]
        last = place[place < self.k] == self.k - 1
        self.floor[self.question[last]] = self.score[last]


def _kth_at_least(scores: np.ndarray, k: int) -> np.ndarray:
    """For each column a row that k rows, itself included, are as good as or better than.

    It is the k-th best of the best rows of blocks.
    """
    starts = np.arange(0, len(scores), max(1, len(scores) // (4 * k)))
    best = np.maximum.reduceat(scores, starts, axis=0)
    block = np.argpartition(best, len(best) - k, axis=0)[len(best) - k]
    columns = np.arange(scores.shape[1])
    found, wanted = starts[block], best[block, columns]
    for step in range(1, int(np.diff(np.append(starts, len(scores))).max())):
        at = np.minimum(starts[block] + step, np.append(starts[1:], len(scores))[block] - 1)
        found = np.where(scores[at, columns] == wanted, at, found)
    return found


def _ids(columns: Sequence) -> list[np.ndarray]:
    arrays = [column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array)
              else column.to_numpy() for column in columns]
    return [a.astype(str) if a.dtype == object else a for a in arrays]


class _Hits:
    """Schema of hits and Arrow rows of it."""

    def __init__(self, queries: DataFrame, index: DataFrame, query_id: str,
                 item_id: Sequence[str], group: str | None = None):
        fields = [queries.schema[query_id], *(index.schema[c] for c in item_id)]
        kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
        if group:
            kinds.insert(1, f"`{group}` int")
        self.schema = ", ".join([*kinds, "score double"])
        self.group = group
        self.names = [query_id, *([group] if group else []), *item_id, "score"]
        self.types = [to_arrow_type(f.dataType) for f in fields]

    def rows(self, best: _Best, questions: pa.Array, group: int = 0) -> pa.Table:
        """The hits so far; ``questions`` are the ids by question number."""
        best.cut()
        n = len(best.question)
        items = best.items or [np.empty(0)] * (len(self.types) - 1)
        columns = [questions.take(pa.array(best.question)).cast(self.types[0])]
        if self.group:
            columns.append(pa.array(np.full(n, group), pa.int32()))
        columns += [pa.array(values.tolist(), kind)
                    for values, kind in zip(items, self.types[1:])]
        return pa.table([*columns, pa.array(best.score)], self.names)


def rank_hits(hits: DataFrame, by: Sequence[str], item_id: Sequence[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), *item_id)
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(
        len(column), -1)


def _unit_rows(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt((vectors ** 2).sum(1, keepdims=True))
    return vectors / np.where(length == 0, 1, length)


def _score_vectors(best: _Best, items: Sequence, vectors, asked: np.ndarray, metric: str) -> None:
    """Add an index part to the hits, in steps of a bounded score matrix."""
    step, ids = max(1, STEP_CELLS // max(asked.shape)), _ids(items)
    wide = max(1, VECTOR_CELLS // step)
    lengths = (asked ** 2).sum(1)
    for start in range(0, len(vectors), step):
        part = _prepared(vectors.slice(start, step), metric)
        own = [values[start:start + step] for values in ids]
        square = (part ** 2).sum(1)
        for first in range(0, len(asked), wide):
            some = slice(first, first + wide)
            if metric == "cosine":
                best.add(part @ asked[some].T, first, own, False)
                continue
            double, length = 2 * part @ asked[some].T, lengths[some]

            def value(_, rows, columns):
                return -np.sqrt(np.maximum(
                    square[rows] + length[columns] - double[rows, columns], 0))

            def least(real):
                return length - real ** 2 - 1e-9 * (length + square.max())

            # The question's square less that of the distance.
            best.add(double - square[:, None], first, own, False, value, least)


def search(queries: DataFrame, index: DataFrame, k: int = TOP_K, metric: str = "cosine",
           query_id: str = "query_id", item_id: str | Sequence[str] = "doc_id",
           query_vector: str = "embedding", item_vector: str = "embedding",
           skip_self: bool = False, group: str | None = None) -> DataFrame:
    """Exact k best items per question: (question, item, score, rank).

    Cosine similarity, or minus the euclidean distance.  ``skip_self`` leaves
    out the item whose id is the question's.  With ``group`` (an integer column
    of both sides) a question is compared with the items of its group only, and
    every group has hits of its own.  One block of questions is sent to the tasks
    that read the index; more of them meet the index in the cells of a grid.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; one of {METRICS}")
    item_id = [item_id] if isinstance(item_id, str) else list(item_id)
    place = (F.col(group) if group else F.lit(0)).cast("int").alias("_g")
    asked = queries.select(F.col(query_id), F.col(query_vector).alias("_v"), place).filter(
        F.col("_v").isNotNull())
    narrow = index.select(*item_id, F.col(item_vector).alias("_v"), place).filter(
        F.col("_v").isNotNull())
    facts = asked.agg(F.count("*").alias("n"), F.sum(F.size("_v")).alias("numbers")).first()
    blocks = max(1, -(-facts["n"] // QUERY_BLOCK), -(-(facts["numbers"] or 0) // QUERY_BLOCK_NUMBERS))
    hits = _Hits(queries, index, query_id, item_id, group)
    # k + 1 per cell before the self hit is dropped leaves k true candidates.
    wanted = k + 1 if skip_self else k
    found = _scan(asked, narrow, wanted, metric, hits) if blocks == 1 else _grid(
        asked, narrow, wanted, metric, hits, blocks)
    if skip_self:
        found = found.filter(F.col(query_id) != F.col(item_id[0]))
    return rank_hits(found, [query_id, *([group] if group else [])], item_id, k)


def _prepared(vectors, metric: str) -> np.ndarray:
    matrix = _matrix(vectors)
    return _unit_rows(matrix) if metric == "cosine" else matrix


def _scan(asked: DataFrame, index: DataFrame, k: int, metric: str, hits: _Hits) -> DataFrame:
    """One bounded block of questions against every batch of the index."""
    block = asked.toArrow()
    ids, groups = block.column(0).combine_chunks(), block.column(2).to_numpy()
    own = {int(g): np.flatnonzero(groups == g) for g in np.unique(groups)}
    shared = index.sparkSession.sparkContext.broadcast({
        g: (ids.take(pa.array(rows)), _prepared(block.column(1).take(pa.array(rows)), metric))
        for g, rows in own.items()})

    def run(batches):
        best = {g: _Best(k, len(ids)) for g, (ids, _) in shared.value.items()}
        for batch in batches:
            place = batch.column(batch.num_columns - 1).to_numpy()
            for g in np.intersect1d(place, list(best)).tolist():
                part = batch if len(best) == 1 and (place == g).all() else batch.filter(
                    pa.array(place == g))
                _score_vectors(best[g], part.columns[:-2], part.column(part.num_columns - 2),
                               shared.value[g][1], metric)
        for g, found in best.items():
            yield from hits.rows(found, shared.value[g][0], g).to_batches()

    return index.mapInArrow(run, hits.schema)


def _grid(asked: DataFrame, index: DataFrame, k: int, metric: str, hits: _Hits,
          blocks: int) -> DataFrame:
    """Cells of question blocks and index slabs; the index is read once and dealt by blocks."""
    numbers = index.agg(F.sum(F.size("_v"))).first()[0] or 0
    cells = CELLS_PER_CORE * index.sparkSession.sparkContext.defaultParallelism
    slabs = max(1, -(-numbers // SLAB_NUMBERS), -(-cells // blocks))
    cell = ["_g", "_block", "_slab"]
    query_id, items = asked.columns[0], index.columns[:-2]
    left = index.withColumn("_slab", F.pmod(F.xxhash64(*items), F.lit(slabs)).cast("int")).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("_block", F.pmod(F.xxhash64(query_id), F.lit(blocks)).cast(
        "int")).withColumn("_slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        best = _Best(k, right.num_rows)
        ids = right.column(0).combine_chunks()
        if left.num_rows and right.num_rows:
            _score_vectors(best, left.columns[:len(items)], left.column(len(items)),
                           _prepared(right.column(1), metric), metric)
            return hits.rows(best, ids, left.column("_g")[0].as_py())
        return hits.rows(best, ids)

    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(meet, hits.schema)


@dataclass(frozen=True)
class LexicalIndex:
    """A stored inverted index: postings of every word by slab, and the items of each slab."""

    stored: DataFrame
    chunks: DataFrame
    item_id: tuple[str, ...]
    group: str | None = None

    @property
    def postings(self) -> DataFrame:
        """``_g, slab, term, rows, tf, len``: rows of the slab that hold a word."""
        return self.stored.filter("term is not null").select(
            "_g", "slab", "term", "rows", "tf", "len")

    @property
    def slabs(self) -> DataFrame:
        """``_g, slab, items, n, total``: items by row number, chunks and words."""
        return self.stored.filter("term is null").select("_g", "slab", "items", "n", "total")


def lexical_index(chunks: DataFrame, item_id: str | Sequence[str] = "doc_id", text: str = "text",
                  group: str | None = None, path: str | None = None,
                  only: list[str] | None = None) -> LexicalIndex:
    """Make and store the postings of all chunks in one pass, without a shuffle.

    With ``group`` (an integer column) every group is an index of its own.
    ``only`` keeps the postings of these words; chunk counts and lengths always
    cover all words.  ``path`` is a folder of the shared one by default.
    """
    item_id = (item_id,) if isinstance(item_id, str) else tuple(item_id)
    place = (F.col(group) if group else F.lit(0)).cast("int").alias("_g")
    narrow = chunks.select(*item_id, F.lower(F.col(text)).alias("_text"), place)
    fields = [chunks.schema[c] for c in item_id]
    struct = pa.struct([(f"i{i}", to_arrow_type(f.dataType)) for i, f in enumerate(fields)])
    kinds = ", ".join(f"i{i}: {f.dataType.simpleString()}" for i, f in enumerate(fields))
    known = pa.array(sorted(only), pa.string()) if only is not None else None
    width = len(item_id)

    def run(batches):
        for batch in batches:
            groups = batch.column(width + 1).to_numpy()
            for g in np.unique(groups).tolist():
                rows = np.flatnonzero(groups == g)
                for start in range(0, len(rows), LEXICAL_SLAB):
                    part = batch.take(pa.array(rows[start:start + LEXICAL_SLAB]))
                    yield from slab(part, g)

    def slab(part, g):
        ids = _ids(part.columns[:width])
        part = part.take(pa.array(np.lexsort(tuple(reversed(ids)))))
        # The same white space as in ``words``; only at the ends of a text it leaves empty words.
        lists = pc.utf8_split_whitespace(part.column(width))
        held = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        flat, row = lists.flatten(), np.repeat(np.arange(len(part)), held)
        empty = pc.equal(flat, "").to_numpy(zero_copy_only=False)
        lengths = held - np.bincount(row[empty], minlength=len(part))
        keep = ~empty if known is None else pc.is_in(flat, value_set=known).to_numpy(
            zero_copy_only=False)
        coded, row = flat.filter(pa.array(keep)).dictionary_encode(), row[keep]
        code = coded.indices.to_numpy()
        cells, times = np.unique(code.astype(np.int64) * len(part) + row, return_counts=True)
        code, row = cells // max(1, len(part)), cells % max(1, len(part))
        first = np.flatnonzero(np.diff(code, prepend=-1))
        offsets = pa.array(np.append(first, len(code)).astype(np.int32))
        n, name = len(first), uuid.uuid4().hex
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32)))
                 for x in (row, times, lengths[row])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, g, np.int32)), pa.array([name] * n, pa.string()),
             coded.dictionary.take(pa.array(code[first])).cast(pa.string()), *lists,
             pa.nulls(n, pa.list_(struct)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
            names)
        items = pa.StructArray.from_arrays(
            [c.cast(f.type) for c, f in zip(part.columns[:width], struct)], [f.name for f in struct])
        yield pa.RecordBatch.from_arrays(
            [pa.array([g], pa.int32()), pa.array([name]), pa.nulls(1, pa.string()),
             *[pa.nulls(1, pa.list_(pa.int32()))] * 3,
             pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items),
             pa.array([len(part)]), pa.array([int(lengths.sum())])], names)

    names = ["_g", "slab", "term", "rows", "tf", "len", "items", "n", "total"]
    path = path or scratch_path(chunks.sparkSession, "postings")
    narrow.mapInArrow(run, "_g int, slab string, term string, rows array<int>, tf array<int>, "
                           f"len array<int>, items array<struct<{kinds}>>, n long, total long"
                      ).write.parquet(path)
    return LexicalIndex(chunks.sparkSession.read.parquet(path), chunks, item_id, group)


def bm25(queries: DataFrame, chunks: DataFrame, k: int = TOP_K, query_id: str = "query_id",
         query_text: str = "text", item_id: str | Sequence[str] = "doc_id",
         text: str = "text", k1: float = BM25_K1, b: float = BM25_B,
         group: str | None = None) -> DataFrame:
    """Exact k best chunks per question by BM25 over distinct question words.

    With ``group`` (an integer column) every group is an index of its own, and
    all are searched together.  The postings are made for this search: of the
    asked words where these are few, else of all words.
    """
    asked = queries.select(F.explode(F.array_distinct(words(F.col(query_text)))).alias("w")).distinct()
    few = collect_bounded(asked, KNOWN_TERMS)
    index = lexical_index(chunks, item_id, text, group,
                          only=None if few is None else [row["w"] for row in few])
    return search_postings(queries, index, k, query_id, query_text, k1, b)


def search_postings(queries: DataFrame, index: LexicalIndex, k: int = TOP_K,
                    query_id: str = "query_id", query_text: str = "text", k1: float = BM25_K1,
                    b: float = BM25_B) -> DataFrame:
    """The search of :func:`bm25` over a stored index.

    Asked words meet the postings in one join; its rows are whole posting lists
    of a slab with whole lists of questions, and a cell of a slab and a block of
    questions adds them up.
    """
    asked = queries.select(F.col(query_id).alias("_q"), F.array_distinct(
        words(F.col(query_text))).alias("_w")).filter(F.size("_w") > 0)
    blocks = max(1, -(-asked.count() // LEXICAL_BLOCK))
    block = F.pmod(F.xxhash64("_q"), F.lit(blocks)).cast("int").alias("block")
    terms = asked.select("_q", block, F.explode("_w").alias("term")).groupBy("term", "block").agg(
        F.collect_list("_q").alias("questions"))        # at most a block of them
    postings = index.postings
    stats = index.slabs.groupBy("_g").agg(F.sum("n").alias("n"), (
        F.sum("total") / F.sum("n")).alias("mean"))
    counted = postings.join(terms.select("term").distinct(), "term", "left_semi").groupBy(
        "_g", "term").agg(F.sum(F.size("rows")).alias("df"))
    rarity = counted.join(stats, "_g").select(
        "_g", "term", "mean", F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias(
            "rarity"))
    matched = postings.join(terms, "term").join(rarity, ["_g", "term"]).select(
        "_g", "slab", "block", "rows", "tf", "len", "questions", "rarity", "mean")
    slabs = index.slabs.select(F.col("_g").alias("g"), F.col("slab").alias("s"), "items", F.explode(
        F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    hits = _Hits(queries, index.chunks, query_id, index.item_id, index.group)

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return hits.rows(_Best(k, 0), pa.array([], hits.types[0]))
        lists = {c: left.column(c).combine_chunks() for c in ("rows", "tf", "len", "questions")}
        ids = lists["questions"].flatten().dictionary_encode()
        items = right.column("items").combine_chunks().flatten()
        scores = _add_postings(lists, ids.indices.to_numpy(), left.column("rarity").to_numpy(),
                               left.column("mean").to_numpy(), (len(items), len(ids.dictionary)),
                               k1, b)
        best = _Best(k, len(ids.dictionary))
        best.add(scores, 0, _ids(items.flatten()), True)
        return hits.rows(best, ids.dictionary, left.column("_g")[0].as_py())

    found = matched.groupBy("_g", "slab", "block").cogroup(slabs.groupBy("g", "s", "b")).applyInArrow(
        add_up, hits.schema)
    return rank_hits(found, [query_id, *([index.group] if index.group else [])], index.item_id, k)


def _add_postings(lists: dict[str, pa.Array], question: np.ndarray, rarity: np.ndarray,
                  mean: np.ndarray, shape: tuple[int, int], k1: float, b: float) -> np.ndarray:
    """Scores of all rows and questions of a cell from its posting lists."""
    row, tf, length = (lists[c].flatten().to_numpy() for c in ("rows", "tf", "len"))
    held = pc.list_value_length(lists["rows"]).to_numpy().astype(np.int64)
    asking = pc.list_value_length(lists["questions"]).to_numpy().astype(np.int64)
    term = np.repeat(np.arange(len(held)), held)
    weight = rarity[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / np.maximum(
        mean[term], 1e-300)))
    dense = np.flatnonzero(held * asking * DENSE_SHARE > shape[0] * shape[1])
    scores = np.zeros(shape)
    for first in range(0, len(dense), DENSE_WORDS):     # frequent words: matrix products
        some = dense[first:first + DENSE_WORDS]
        column = np.full(len(held), -1)
        column[some] = np.arange(len(some))
        has = column[term] >= 0
        left = np.zeros((shape[0], len(some)))
        left[row[has], column[term[has]]] = weight[has]
        right = np.zeros((len(some), shape[1]))
        who = np.repeat(column, asking)
        right[who[who >= 0], question[who >= 0]] = 1
        scores += left @ right
    rare = held * asking
    rare[dense] = 0
    first_row, first_question = np.cumsum(held) - held, np.cumsum(asking) - asking
    for part in _runs_of(rare, STEP_CELLS):     # the others: one pair after the other
        of = np.repeat(part, rare[part])
        within = np.arange(len(of)) - np.repeat(np.cumsum(rare[part]) - rare[part], rare[part])
        at = first_row[of] + within // asking[of]
        cells = row[at] * np.int64(shape[1]) + question[first_question[of] + within % asking[of]]
        scores += np.bincount(cells, weight[at], shape[0] * shape[1]).reshape(shape)
    return scores


def _runs_of(sizes: np.ndarray, limit: int) -> list[np.ndarray]:
    """Consecutive places with non-zero sizes, each run with about ``limit`` in total."""
    places = np.flatnonzero(sizes)
    if not len(places):
        return []
    upto = np.cumsum(sizes[places]) - sizes[places]
    return np.split(places, np.flatnonzero(np.diff(upto // limit)) + 1)


def hybrid(vector_hits: DataFrame, lexical_hits: DataFrame, strategy: str = "rrf",
           query_id: str = "query_id", item_id: str | Sequence[str] = "doc_id",
           ranker_k: int = RRF_K, alpha: float = ALPHA, k: int = TOP_K) -> DataFrame:
    """Merge two hit lists: ``rrf`` = sum of 1/(k + rank), ``weighted`` = alpha
    times the vector score plus 1 - alpha times the lexical score, each scaled
    to 0..1 within its question."""
    item_id = [item_id] if isinstance(item_id, str) else list(item_id)
    key = [query_id, *item_id]

    def side(hits, name, share):
        if strategy == "rrf":
            value = 1.0 / (ranker_k + F.col("rank"))
        elif strategy == "weighted":
            per = Window.partitionBy(query_id)
            low, high = F.min("score").over(per), F.max("score").over(per)
            value = share * F.when(high > low, (F.col("score") - low) / (high - low)).otherwise(1.0)
        else:
            raise ValueError(f"unknown ranker strategy {strategy!r}")
        return hits.select(*key, value.alias(name))

    merged = side(vector_hits, "_a", alpha).join(side(lexical_hits, "_b", 1 - alpha), key, "full")
    scored = merged.select(*key, F.round(F.coalesce("_a", F.lit(0.0)) + F.coalesce(
        "_b", F.lit(0.0)), SCORE_DIGITS).alias("score"))
    return rank_hits(scored, [query_id], item_id, k)


def index_folder(path: str, collection: str, source: str, batch: str) -> str:
    """Where one batch of one source is stored; every writer uses this layout."""
    return f"{path}/collection={collection}/source={source}/batch={batch}"


def append_index(chunks: DataFrame, path: str, collection: str) -> None:
    """Add chunk vectors to a named collection, creating it when missing."""
    chunks.write.parquet(index_folder(path, collection, "append", uuid.uuid4().hex))


def read_index(spark, path: str, collection: str) -> DataFrame:
    """All chunk vectors of a collection, whoever wrote them."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/collection={collection}")
    return rows.drop("collection", "source", "batch")
