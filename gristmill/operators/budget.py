"""The walk that keeps every file that still fits, without walking on the driver.

Sizes fall into power-of-two classes.  With R bytes left and R in class j, a
file of a smaller class always fits and one of a larger class never does; one of
class j may fit, and then what is left falls below class j.  So the walk is a
few phases, one per class that R passes through: in a phase all smaller files
are kept, until they or one file of class j bring R down to a lower class.

Files are dealt to key ranges once.  Of each range one task tells, for every
class, the bytes of its files, and the smallest R at which a file of the class
fits behind the smaller files before it.  From these the driver knows the range
in which a phase ends; only such a range is walked file by file, in one task.
There are as many of them as classes at most, whatever the sizes and their
order.  The result is one condition on order and size for each phase.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import frexp, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.operators.ranking import after, up_to
from gristmill.session import cut_lineage, shuffle_width

ZERO = -2_000             # class of empty files, below that of any number
LARGEST = 2_000


def size_class(value: float) -> int:
    """The power of two above a size; sizes of one class are less than a factor 2 apart."""
    return frexp(value)[1] if value > 0 else ZERO


def _classes(sizes: np.ndarray) -> np.ndarray:
    return np.where(sizes > 0, np.frexp(sizes.astype(np.float64))[1], ZERO)


def bound(number: int) -> float:
    """All sizes of smaller classes are below it."""
    return 2.0 ** (number - 1) if number > ZERO else 0.0


def summary(sizes: np.ndarray) -> list[tuple[int, float, float]]:
    """``(class, bytes, least)`` of a range in walk order.

    ``least`` is the smallest number of bytes left at the begin of the range with
    which a file of the class fits after all files of smaller classes before it.
    """
    classes, out = _classes(sizes), []
    for number in np.unique(classes).tolist():
        own = classes == number
        before = np.cumsum(np.where(classes < number, sizes, 0))
        out.append((number, sizes[own].sum().item(), (sizes + before)[own].min().item()))
    return out


def steps(sizes: np.ndarray, left) -> tuple[list[tuple[int, int, bool]], float]:
    """Walk a range: ``(place, class, alone)`` where what is left falls to another class.

    Up to ``place`` the files below the class before are kept, and the file there
    also if it is ``alone`` of that class.  Also returns the bytes left at the end.
    """
    classes, out, at = _classes(sizes), [], 0
    while at < len(sizes):
        now = size_class(left)
        small = np.where(classes[at:] < now, sizes[at:], 0)
        used = np.cumsum(small)
        falls = left - used < bound(now) if now > ZERO else np.zeros(len(small), bool)
        fits = (classes[at:] == now) & (sizes[at:] > 0) & (sizes[at:] <= left - used)
        ends = np.flatnonzero(falls | fits)
        if not len(ends):
            return out, left - used[-1].item()
        end = ends[0].item()
        alone = bool(fits[end])
        left -= used[end].item() + (sizes[at + end].item() if alone else 0)
        at += end + 1
        out.append((at - 1, size_class(left), alone))
    return out, left


def walked(files: DataFrame, cap, order: Sequence[str], size: str) -> Column:
    """Condition on ``order`` and ``size`` for the files that the walk keeps.

    ``order`` must identify rows and ``size`` must not be negative; files with
    a null size are not kept.
    """
    whole = isinstance(files.schema[size].dataType, T.IntegralType)
    left = int(cap // 1) if whole and abs(cap) < inf else cap
    number, kept = F.col(size), F.lit(False)
    if left < 0:
        return kept
    placed = cut_lineage(files.select(*order, size).filter(number.isNotNull()).repartitionByRange(
        shuffle_width(files.sparkSession), *order).withColumn("_pid", F.spark_partition_id()))
    kind = "long" if whole else "double"
    told = placed.groupBy("_pid").applyInArrow(
        _summaries(order, size), f"_pid int, class int, bytes {kind}, least {kind}").collect()
    ranges: dict[int, dict] = {}
    for row in told:
        ranges.setdefault(row["_pid"], {})[row["class"]] = row
    begin = None
    for pid in sorted(ranges):
        own, now = ranges[pid], size_class(left)
        used = sum(row["bytes"] for number_, row in own.items() if number_ < now)
        same = own.get(now)
        if left - used >= bound(now) and not (now > ZERO and same and left >= same["least"]):
            left -= used
            continue
        part = placed.filter(F.col("_pid") == pid)
        for row in sorted(part.groupBy("_pid").applyInArrow(
                _ends(order, size, left), _ends_schema(placed, order, kind)).collect(),
                key=lambda row: row["step"]):
            if row["class"] is None:
                left = row["left"]
                continue
            kept |= _below(begin, row, order) & (number < bound(now) if now > ZERO else number <= 0)
            if row["alone"]:
                kept |= up_to(order, row) & ~_before(order, row)
            begin, now = row, row["class"]
    now = size_class(left)
    rest = number < bound(now) if now > ZERO else number <= 0
    return kept | (rest if begin is None else rest & after(order, begin))


def _before(order: Sequence[str], row) -> Column:
    return F.struct(*[F.col(c) for c in order]) < F.struct(*[F.lit(row[c]).alias(c) for c in order])


def _below(begin, end, order: Sequence[str]) -> Column:
    return up_to(order, end) if begin is None else after(order, begin) & up_to(order, end)


def _ordered(table: pa.Table, order: Sequence[str]) -> pa.Table:
    return table.sort_by([(c, "ascending") for c in order])


def _summaries(order: Sequence[str], size: str):
    def run(table: pa.Table) -> pa.Table:
        rows = summary(_ordered(table, order).column(size).to_numpy())
        classes, used, least = zip(*rows)
        return pa.table({"_pid": pa.array([table.column("_pid")[0].as_py()] * len(rows), pa.int32()),
                         "class": pa.array(classes, pa.int32()), "bytes": used, "least": least})

    return run


def _ends_schema(placed: DataFrame, order: Sequence[str], kind: str) -> str:
    columns = ", ".join(f"`{c}` {placed.schema[c].dataType.simpleString()}" for c in order)
    return f"step int, class int, alone boolean, left {kind}, {columns}"


def _ends(order: Sequence[str], size: str, left):
    def run(table: pa.Table) -> pa.Table:
        table = _ordered(table, order)
        found, rest = steps(table.column(size).to_numpy(), left)
        # The last row tells what is left; its place does not matter.
        rows = table.select(list(order)).take(pa.array([*(f[0] for f in found), 0]))
        n = len(found)
        return pa.table({"step": pa.array(range(n + 1), pa.int32()),
                         "class": pa.array([*(f[1] for f in found), None], pa.int32()),
                         "alone": pa.array([*(f[2] for f in found), False]),
                         "left": pa.array([None] * n + [rest]),
                         **{c: rows.column(c) for c in order}})

    return run
