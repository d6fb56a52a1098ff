"""Connected components by alternating star contraction; marks for ids in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.session import cut_lineage

ROUNDS = 60
MARK_BITS = 1 << 23       # broadcast as at most 131,072 words of 64 bits


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` -> ``(id, component)`` with the smallest id of each component.

    Every round sends each node's neighbours to its smallest neighbour, first
    for larger neighbours and then for smaller ones.  The number of rounds
    grows with the logarithm of the longest path; each round is written to the
    shared folder.  A node with very many neighbours only takes part in sums
    and joins by key, so it is never gathered.  Empty edges give no rows;
    loops and repeated edges are allowed.
    """
    both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
        F.col("a") != F.col("b")).distinct()
    current, before = cut_lineage(both), None
    for _ in range(ROUNDS):
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast(
            "decimal(38,0)")).alias("sum")).first()
        if state["n"] == 0 or tuple(state) == before:
            break
        before = tuple(state)
        current = cut_lineage(_small_star(_large_star(current)))
    else:
        raise RuntimeError("components did not settle")
    heads = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(heads)


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour."""
    ways = edges.union(edges.select("b", "a"))
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return ways.filter(F.col("b") > F.col("a")).join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter(F.col("b") != F.col("m")).select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.union(own).distinct()


def mark_likely(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Add ``_likely``: false where the key is certainly not in ``ids``.

    The ids are hashed into a bit table of fixed size, so wide rows that a join
    would drop need not be shuffled.  A full table only marks more rows.
    """
    cell = F.pmod(F.xxhash64(F.col(key)), F.lit(MARK_BITS))
    table = ids.select(cell.alias("_cell")).groupBy(F.shiftright("_cell", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_cell & 63 as int))")).alias("_bits"))
    placed = df.withColumn("_cell", cell).withColumn("_at", F.shiftright("_cell", 6))
    found = placed.join(F.broadcast(table), F.col("_at") == F.col("_word"), "left")
    bit = F.expr("getbit(_bits, cast(_cell & 63 as int)) = 1")
    return found.withColumn("_likely", F.coalesce(bit, F.lit(False))).drop(
        "_cell", "_at", "_word", "_bits")
