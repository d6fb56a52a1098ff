"""Near copies among vectors by a forest of random-projection trees.

1. Equal vectors are one class; from here on only classes are compared.
2. Each tree splits the classes again and again along random directions.  A
   split lies where few vectors are near, between the quartiles; vectors within
   a margin of it go to both sides, so that near ones rarely part.  The upper
   levels, which deal the vectors to tasks, have splits from a bounded sample;
   the lower levels are grown in the task from its own vectors.  A part that no
   direction can split without copying half of it stays whole.
3. Vectors of a leaf are compared with a slack for their 16-bit form.  A leaf
   sends the edges that keep its linked vectors connected, not all pairs.
4. Connected candidates meet once more: all pairs of a group are compared with
   cosines in double precision, links are counted and the groups become exact.

Cells and groups above ``BLOCK`` vectors are dealt to pairs of blocks, so no
task gets more than ``2 * BLOCK`` vectors, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.batches import hashed_sample, spread
from gristmill.llm.components import components, mark_likely
from gristmill.llm.registry import query
from gristmill.session import scratch_path, shuffle_width

LEAST = 0.95
TREES = 8
BLOCK = 4096              # vectors of a block, and wanted for a cell
LEAF = 256
SAMPLE = 1 << 16          # vectors that the upper splits are learnt from
SAMPLE_VALUES = 1 << 23   # and numbers in them
MAX_DEPTH = 14
UPPER, LOWER = 0.25, 0.5  # margins, as parts of how far linked vectors differ along a direction
SLACK = 0.002             # more than 16-bit numbers can change a cosine
SEED = 20


def _usable(vector: str) -> Column:
    """Non-empty, finite and not zero throughout."""
    whole = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and unit vectors for each number of dimensions in a list column."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.cumsum(lengths) - lengths
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        vectors = values[first[rows][:, None] + np.arange(size)]
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        yield rows, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def margin(share: float, size: int, least: float) -> float:
    """Half the width of the zone that goes to both sides of a split."""
    return share * float(np.sqrt(max(0.0, 2 - 2 * least) / size))


def split_at(values: np.ndarray, width: float) -> float:
    """Between the quartiles, where fewest values lie within ``width``; NaN if half do."""
    ordered = np.sort(values)
    n = len(ordered)
    middle = ordered[np.linspace(n // 4, min(n - 1, 3 * n // 4), 33).astype(np.int64)]
    near = np.searchsorted(ordered, middle + width) - np.searchsorted(ordered, middle - width)
    # Of equally good places the one nearest to the median.
    best = np.lexsort((np.abs(np.arange(33) - 16), near))[0]
    return float(middle[best]) if near[best] <= n // 2 else float("nan")


class Forest:
    """Upper levels of all trees: a direction for each level, a split for each node."""

    def __init__(self, sample: np.ndarray, depth: int, least: float, trees: int):
        self.size, self.depth, self.trees = sample.shape[1], depth, trees
        self.width = margin(UPPER, self.size, least)
        draw = np.random.default_rng(SEED)
        directions = draw.normal(size=(trees, max(1, depth), self.size))
        self.directions = directions / np.linalg.norm(directions, axis=2, keepdims=True)
        self.splits = np.full((trees, 2 << depth), np.nan)
        for tree in range(trees):
            heights = sample @ self.directions[tree].T
            members = {1: np.arange(len(sample))}
            for level in range(depth):
                below = {}
                for node, rows in members.items():
                    if len(rows) < 8:
                        continue
                    values = heights[rows, level]
                    at = self.splits[tree, node] = split_at(values, self.width)
                    if at == at:
                        below[2 * node] = rows[values < at + self.width]
                        below[2 * node + 1] = rows[values >= at - self.width]
                members = below

    def cells(self, tree: int, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows, some of them repeatedly, and the node where each ends."""
        heights = vectors @ self.directions[tree].T
        rows, nodes = np.arange(len(vectors)), np.ones(len(vectors), np.int64)
        ended = []
        for level in range(self.depth):
            at = self.splits[tree, nodes]
            stay = np.isnan(at)
            ended.append((rows[stay], nodes[stay]))
            rows, nodes, at = rows[~stay], nodes[~stay], at[~stay]
            above = heights[rows, level] - at
            left, right = above < self.width, above >= -self.width
            rows = np.concatenate([rows[left], rows[right]])
            nodes = np.concatenate([2 * nodes[left], 2 * nodes[right] + 1])
        ended.append((rows, nodes))
        return tuple(np.concatenate(parts) for parts in zip(*ended))


def leaves(vectors: np.ndarray, width: float, seed: int) -> Iterator[np.ndarray]:
    """Lower levels of a tree: rows of each leaf."""
    draw = np.random.default_rng(seed)
    open_parts = [np.arange(len(vectors))]
    while open_parts:
        rows = open_parts.pop()
        if len(rows) <= LEAF:
            yield rows
            continue
        direction = draw.normal(size=vectors.shape[1]).astype(vectors.dtype)
        values = vectors[rows] @ (direction / np.linalg.norm(direction))
        at = split_at(values, width)
        if at != at:
            yield rows
            continue
        open_parts += [rows[values < at + width], rows[values >= at - width]]


def linked(left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Which rows of two matrices have at least this product, in strips."""
    found = np.zeros((len(left), len(right)), bool)
    for row in range(0, len(left), 512):
        found[row:row + 512] = left[row:row + 512] @ right.T >= least
    return found


def connected(near: np.ndarray) -> np.ndarray:
    """Label of each row of a symmetric matrix: its first connected row."""
    label = np.arange(len(near))
    waiting = near.sum(axis=1) > near.diagonal()
    while waiting.any():
        first = int(waiting.argmax())
        reached = np.zeros(len(near), bool)
        edge = reached.copy()
        edge[first] = True
        while edge.any():
            reached |= edge
            edge = near[edge].any(axis=0) & ~reached
        label[reached] = first
        waiting &= ~reached
    return label


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary column of equally long rows."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    data = np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(), len(rows),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _rows_of(column: pa.ChunkedArray, kind) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _cells(forest: Forest, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and cell numbers in every tree; other dimensions have a cell of their own a tree."""
    size = vectors.shape[1]
    for tree in range(forest.trees):
        if size == forest.size:
            rows, nodes = forest.cells(tree, vectors)
            yield rows, nodes * forest.trees + tree
        else:
            yield np.arange(len(vectors)), np.full(len(vectors), -(size * forest.trees + tree))


def _candidates(classes: DataFrame, forest: Forest, least: float) -> DataFrame:
    """Edges ``(a, b)`` that connect the near vectors of every leaf of every tree."""
    def count(batches):
        for batch in batches:
            for _, vectors in unit_vectors(batch.column(0)):
                for _, cells in _cells(forest, vectors):
                    cell, n = np.unique(cells, return_counts=True)
                    yield pa.RecordBatch.from_pydict({"cell": cell, "n": n})

    counted = spread(classes.select("vector")).mapInArrow(count, "cell long, n long").groupBy(
        "cell").agg(F.sum("n").alias("n")).filter(F.col("n") > 2 * BLOCK)
    # As many cells at most as all trees have nodes, and one a tree for each dimension.
    large = {r.cell: -(-r.n // BLOCK) for r in counted.collect()}

    def deal(batches):
        for batch in batches:
            number = batch.column(0).to_numpy()
            for places, vectors in unit_vectors(batch.column(1)):
                stored = vectors.astype(np.float16)
                for rows, cells in _cells(forest, vectors):
                    yield from dealt(number[places][rows], stored[rows], cells)

    def dealt(number, stored, cells):
        blocks = np.ones(len(cells), np.int64)
        for cell in large.keys() & set(cells.tolist()):
            blocks[cells == cell] = large[cell]
        own = _mixed(number) % blocks
        for count in np.unique(blocks):
            rows = np.flatnonzero(blocks == count)
            for other in range(count):
                if count > 1:       # pairs of a block meet with every other block
                    rows = np.flatnonzero((blocks == count) & (own != other))
                i, j = np.minimum(own[rows], other), np.maximum(own[rows], other)
                yield pa.RecordBatch.from_pydict({
                    "cell": cells[rows], "i": i, "j": j, "node": number[rows],
                    "unit": _binary(stored[rows])})

    def compare(table: pa.Table) -> pa.Table:
        number = table.column("node").to_numpy()
        vectors = _rows_of(table.column("unit"), np.float16).astype(np.float32)
        seed = [abs(int(table.column(name)[0].as_py())) for name in ("cell", "i", "j")]
        first, second = [], []
        order = np.argsort(number)
        number, vectors = number[order], vectors[order]
        for rows in leaves(vectors, margin(LOWER, vectors.shape[1], least), seed):
            rows = np.sort(rows)
            label = connected(linked(vectors[rows], vectors[rows], least - SLACK))
            other = np.flatnonzero(label != np.arange(len(rows)))
            first.append(number[rows[label[other]]])
            second.append(number[rows[other]])
        return pa.table({"a": np.concatenate(first), "b": np.concatenate(second)})

    return spread(classes.select("node", "vector")).mapInArrow(
        deal, "cell long, i long, j long, node long, unit binary").repartition(
        shuffle_width(classes.sparkSession), "cell", "i", "j").groupBy(
        "cell", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def _mixed(number: np.ndarray) -> np.ndarray:
    """Numbers spread over the positive range."""
    return ((number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(
        np.int64)


def _exact(members: DataFrame, least: float) -> DataFrame:
    """``node, links, root, whole``: members of candidate groups after comparing all their pairs.

    ``links`` counts vectors linked in this part of the group, ``root`` is a
    vector connected to it; both are final where ``whole`` holds.
    """
    sizes = members.groupBy("id").agg(F.count("*").alias("size")).withColumnRenamed("id", "_id")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    number = F.when(F.col("size") <= BLOCK, F.pmod(F.xxhash64("id"), F.lit(4096))).otherwise(
        F.col("id"))
    own = F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("blocks")).cast("int")
    dealt = members.join(sizes, F.col("id") == F.col("_id")).withColumn("blocks", blocks)
    dealt = dealt.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        (F.col("blocks") == 1).alias("whole"), number.alias("number"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "id", "node", "n", "vector")

    def compare(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.lexsort((table.column("node").to_numpy(), ids))
        table, ids = table.take(pa.array(order)), ids[order]
        whole, out = table.column("whole")[0].as_py(), []
        edges = np.flatnonzero(np.diff(ids)) + 1
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)]):
            part = table.slice(low, high - low)
            node, n, own = (part.column(c).to_numpy() for c in ("node", "n", "own"))
            _, vectors = next(unit_vectors(part.column("vector").combine_chunks()))
            near = linked(vectors, vectors, least)
            np.fill_diagonal(near, False)
            if part.column("i")[0].as_py() != part.column("j")[0].as_py():
                near &= own[:, None] != own[None, :]
            out.append((node, near @ n,
                        node[connected(near)]))
        node, links, root = (np.concatenate(x) for x in zip(*out))
        return pa.table({"node": node, "links": links, "root": root,
                         "whole": np.full(len(node), whole)})

    return dealt.groupBy("whole", "number", "i", "j").applyInArrow(
        compare, "node long, links long, root long, whole boolean")


def _fitted(classes: DataFrame, least: float, trees: int) -> Forest | None:
    """A forest for the most frequent dimension, from a bounded sample of its vectors."""
    dims = classes.groupBy(F.size("vector").alias("size")).count().orderBy(
        F.desc("count"), "size").first()
    if dims is None:
        return None
    rows = max(1, min(SAMPLE, SAMPLE_VALUES // dims["size"]))
    picked = hashed_sample(classes.filter(F.size("vector") == dims["size"]).select(
        "node", "vector"), "node", rows).select("vector").toArrow()
    _, sample = next(unit_vectors(picked.column(0).combine_chunks()))
    depth = int(np.ceil(np.log2(max(1, dims["count"] / BLOCK))))
    return Forest(sample, min(depth, MAX_DEPTH), least, trees)


def link_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 least: float = LEAST, trees: int = TREES) -> DataFrame:
    """Vectors with a cosine of at least ``least``: ``key, n_links, component_id, kept``.

    ``n_links`` counts the other rows that a row is linked with, ``component_id``
    is the smallest key reachable by links, ``kept`` marks the row with that key.
    No link is below ``least``; with eight trees over millions of vectors about
    one link in a hundred that is just at ``least`` is missed, closer ones hardly
    ever (``tests/llm`` measure it).  Vectors that are null, empty, zero or hold
    null or non-finite numbers, and rows without a key, link with nothing;
    vectors of different lengths are never linked.  Each row has its own result,
    so rows that repeat a key count as several vectors.  Other columns are not
    returned.  Empty tables give no rows.
    """
    spark = table.sparkSession
    given = table.select(F.col(key).alias("key"), F.col(vector).alias("vector")).withColumn(
        "usable", _usable("vector") & F.col("key").isNotNull())
    stored = scratch_path(spark, "vectors")
    given.filter("usable").groupBy("vector").agg(
        F.min("key").alias("least"), F.count("*").alias("n")).withColumn(
        "node", F.monotonically_increasing_id()).write.parquet(stored)
    classes = spark.read.parquet(stored)
    alone = given.filter("not usable").select("key", F.lit(0).cast("long").alias("n_links"),
                                              F.col("key").alias("component_id"))
    forest = _fitted(classes, least, trees)
    found = alone
    if forest is not None:
        groups = components(_candidates(classes, forest, least))
        members = groups.join(classes, groups["id"] == classes["node"]).select(
            F.col("component").alias("id"), "node", "n", "vector")
        kept = scratch_path(spark, "links")
        _exact(members, least).write.parquet(kept)
        found = _answers(given, classes, spark.read.parquet(kept)).unionByName(alone)
    same = F.coalesce(F.col("key") == F.col("component_id"), F.lit(False))
    return found.select(F.col("key").alias(key), "n_links", "component_id", same.alias("kept"))


def _answers(given: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of the usable vectors from the links of their classes."""
    open_links = links.filter("not whole").filter("root != node")
    roots = links.filter("whole").select("node", "root")
    if not open_links.isEmpty():
        roots = roots.unionByName(components(open_links.select(
            F.col("node").alias("a"), F.col("root").alias("b"))).select(
            F.col("id").alias("node"), F.col("component").alias("root")))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("node", "least").join(roots, "node")
    heads = named.groupBy("root").agg(F.min("least").alias("head"))
    results = classes.drop("vector").join(counted, "node", "left").join(
        named.join(heads, "root").select("node", "head"), "node", "left").select(
        "node", "least", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("head", "least").alias("component_id"))
    single = results.filter("n = 1").select(F.col("least").alias("key"), "n_links", "component_id")
    several = classes.filter("n > 1").select("node", "vector").join(
        results.select("node", "n_links", "component_id"), "node").drop("node")
    usable = given.filter("usable").select("key", "vector")
    copies = mark_likely(usable, several.select("vector"), "vector").filter("_likely")
    return single.unionByName(copies.join(several, "vector").select(
        "key", "n_links", "component_id"))


@query("op13_projection_forest")
def projection_forest(table):
    return link_vectors(table("embeddings"))
