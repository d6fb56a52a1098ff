"""Mixing sources to target weights by Pfair scheduling.

A source's documents are cut into blocks.  With target share w, its block i is
released at slot ``floor(i / w)`` and due by slot ``ceil((i + 1) / w)``; taking
the earliest deadline among the released blocks keeps every source within one
block of its share at every slot.  Shares are exact fractions of the weights.
The driver makes the order in ranges of slots; where the common denominator of
the shares is small, the order repeats after as many slots and one period is
enough.  Documents are placed by a join with the ranges.  When a source runs
out the others continue by their shares among themselves, so all documents are
placed.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import count, islice

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm.registry import query
from gristmill.operators.ranking import running_sum
from gristmill.session import scratch_path

BLOCK_DOCS = 16
PERIOD = 1000             # common denominators up to this: one period is made and repeated
RANGE = 1 << 16           # slots of a range, and blocks of a schedule row at most
BROADCAST_BLOCKS = 1 << 20    # schedules of more blocks are stored and joined by block
MAX_SOURCES = 500         # bounds the phases: each starts all remaining sources anew
POWER = 0.5               # default weight of a source: its row count to this power


def slot_order(whole: list[int]) -> Iterator[int]:
    """Place in ``whole`` of the source of each slot, without end: earliest deadline first."""
    total = sum(whole)
    waiting: list = []
    ready = [(-(-total // w), at, 0) for at, w in enumerate(whole)]
    heapq.heapify(ready)
    for slot in count():
        while waiting and waiting[0][0] <= slot:
            heapq.heappush(ready, heapq.heappop(waiting)[1])
        due, at, i = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a block missed its deadline")
        yield at
        i, w = i + 1, whole[at]
        heapq.heappush(waiting, (i * total // w, (-(-(i + 1) * total // w), at, i)))


def _pieces(row: tuple) -> Iterator[tuple]:
    """The row cut at whole periods into rows of a bounded number of blocks."""
    s, first, until, base, per, period, places = row
    periods = max(1, RANGE // per)
    for k, start in enumerate(range(first, until, periods * per)):
        yield (s, start, min(until, start + periods * per), base + k * periods * period, per,
               period, places)


def schedule(blocks: Mapping, weights: Mapping) -> Iterator[tuple]:
    """Rows ``(source, first, until, base, per_period, period, places)``.

    Block j of a source, ``first <= j < until``, takes slot
    ``base + (j - first) // per_period * period + places[(j - first) % per_period]``.
    A new phase starts each time a source has run out.  Rows are made one range
    of slots at a time; the order goes on from range to range.
    """
    left = {s: b for s, b in blocks.items() if b > 0}
    exact = {s: Fraction(weights[s]) for s in left}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    done = dict.fromkeys(left, 0)
    base = 0
    while left:
        names = sorted(left, key=lambda s: (s is not None, str(s)))
        whole = [int(exact[s] * scale) for s in names]
        shared = math.gcd(*whole)
        whole = [w // shared for w in whole]
        repeats = sum(whole) <= PERIOD
        order = slot_order(whole)
        while len(left) == len(names):
            period = sum(whole) if repeats else min(RANGE, sum(left.values()))
            made = np.fromiter(islice(order, period), np.int64, period)
            places = {s: np.flatnonzero(made == at).tolist() for at, s in enumerate(names)}
            # Slots until the first source has run out, or the range ends.
            length = min([(b - 1) // len(p) * period + p[(b - 1) % len(p)] + 1
                          for s, b in left.items()
                          if (p := places[s]) and (repeats or b <= len(p))], default=period)
            for s in names:
                own = places[s]
                used = length // period * len(own) + int(
                    np.searchsorted(own, length % period, "left"))
                if used:
                    yield from _pieces((s, done[s], done[s] + used, base, len(own), period, own))
                done[s] += used
                left[s] -= used
                if not left[s]:
                    del left[s]
            base += length


def _stored(spark: SparkSession, rows: Iterator[tuple], blocks: int,
            schema: str) -> tuple[DataFrame, bool]:
    """The schedule as a table; a long one is written while it is made."""
    if blocks <= BROADCAST_BLOCKS:
        return spark.createDataFrame(list(rows), schema), False
    path = scratch_path(spark, "schedule")
    held, size = [], 0

    def write():
        spark.createDataFrame(held, schema).write.mode("append").parquet(path)

    for row in rows:
        held.append(row)
        size += len(row[6])
        if size >= BROADCAST_BLOCKS:
            write()
            held, size = [], 0
    if held:
        write()
    return spark.read.parquet(path), True


def interleave(docs: DataFrame, weights: Mapping | None = None, key: str = "doc_id",
               source: str = "source", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Add ``block``, ``slot`` and ``offset``: the order is by slot, then offset.

    ``weights`` maps sources to positive target weights; sources it leaves out
    are an error.  By default a source weighs its row count to the power 0.5.
    Inside a source, documents come in order of a hash of the id.  A null
    source is a source like the others; repeated rows of an id share one place.
    Empty input gives no rows.  Added columns replace columns of the same name.
    """
    docs = docs.drop("block", "slot", "offset")
    spark = docs.sparkSession
    narrow = docs.select(F.col(source).alias("_s"), F.col(key).alias("_k")).groupBy(
        "_s", "_k").agg(F.count("*").alias("_copies"))
    sizes = narrow.groupBy("_s").agg(F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    n = {r["_s"]: r["n"] for r in sizes}
    if weights is None:
        weights = {s: x ** POWER for s, x in n.items()}
    if missing := [s for s in n if not weights.get(s, 0) > 0]:
        raise ValueError(f"sources without a positive weight: {missing[:5]}")
    blocks = {s: -(-x // block_docs) for s, x in n.items()}
    kind = docs.schema[source].dataType.simpleString()
    rows = schedule(blocks, weights)
    table, stored = _stored(spark, rows, sum(blocks.values()), (
        f"_source {kind}, _first long, _until long, _base long, _per long, _period long, "
        "_places array<int>"))
    ranked = running_sum(narrow.withColumn("_h", F.xxhash64(F.col("_k").cast("string"))),
                         ["_h", "_k"], F.lit(1).cast("long"), "_s", "_rank")
    ranked = ranked.withColumn("block", F.floor((F.col("_rank") - 1) / block_docs))
    own = F.col("_s").eqNullSafe(F.col("_source"))

    def slot(block):
        inside = block - F.col("_first")
        step = F.floor(inside / F.col("_per")) * F.col("_period")
        place = F.element_at("_places", (inside % F.col("_per") + 1).cast("int"))
        return (F.col("_base") + step + place).alias("slot")

    if stored:
        each = table.withColumn("_block", F.explode(F.sequence("_first", F.col("_until") - 1)))
        placed = ranked.join(each.select("_source", "_block", slot(F.col("_block"))),
                             own & (F.col("block") == F.col("_block")))
        at = F.col("slot")
    else:
        placed = ranked.join(F.broadcast(table), own & (F.col("block") >= F.col("_first"))
                             & (F.col("block") < F.col("_until")))
        at = slot(F.col("block"))
    placed = placed.select("_s", "_k", "block", at,
                           ((F.col("_rank") - 1) % block_docs).alias("offset"))
    return docs.join(placed, F.col(key).eqNullSafe(F.col("_k"))
                     & F.col(source).eqNullSafe(F.col("_s"))).drop("_s", "_k")


@query("op9_mix_sources")
def op9(table):
    """Place of every document in the mixture of its sources."""
    return interleave(table("documents").select("doc_id", "source"))
