"""Samples within a byte budget, exact-size subsets, per-group limits, batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.operators.budget import walked
from gristmill.operators.checks import require_columns
from gristmill.operators.ranking import (
    global_rank, pick_by_hash, prefix_end, running_sum, up_to)

# Default limits and seeds.
TABLE_BUDGET_BYTES = 1024 ** 3
SAMPLE_SEED = 42
QUESTION_SEED = 17
QUESTION_COUNT = 5
INDEX_BATCH = 20

WINDOW_LIMIT = 1_000          # rows per group that Spark cuts inside each task


def row_bytes(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Size of a row: bytes of every column's text form, null counts 0."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
             for c in (columns or df.columns)]
    total = sizes[0].cast("long")
    for size in sizes[1:]:
        total = total + size
    return total


def drop_null_label(df: DataFrame, label: str) -> DataFrame:
    require_columns(df, [label])
    return df.dropna(subset=[label])


def default_method(task: str) -> str:
    return "stratified" if task in ("binary", "multiclass") else "random"


def sample_budget(df: DataFrame, key: str | Sequence[str],
                  budget_bytes: int = TABLE_BUDGET_BYTES, method: str | None = None,
                  label: str | None = None, task: str = "regression",
                  order: str | Sequence[str] | None = None, seed: int = SAMPLE_SEED,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Keep at most about ``budget_bytes`` of a table.

    ``first_n_rows`` keeps the longest prefix in ``order`` (the first row
    always), ``random`` a uniform share of budget/bytes, ``stratified`` the
    same share inside every label value after dropping null labels.
    """
    method = method or default_method(task)
    if method == "stratified":
        if label is None:
            raise ValueError("a label column is needed for stratified sampling")
        df = drop_null_label(df, label)
    size = row_bytes(df, columns)
    if method == "first_n_rows":
        return _first_rows(df, [key] if isinstance(key, str) else list(key), order, size,
                           budget_bytes)
    if method not in ("stratified", "random"):
        raise ValueError(f"unknown sampling method {method!r}")
    total = df.agg(F.sum(size)).first()[0] or 0
    if total <= budget_bytes:
        return df
    share = budget_bytes / total
    picked = pick_by_hash(df, key, lambda n: F.bround(F.lit(share) * n).cast("long"), seed,
                          strata=label if method == "stratified" else None)
    return picked.filter("picked").drop("picked")


def _first_rows(df, key, order, size, budget):
    order = [order] if isinstance(order, str) else list(order or key)
    sized = df.select(*order, size.alias("_bytes"))
    end, _, complete = prefix_end(sized, order, "_bytes", budget)
    if complete:
        return df
    if end is None:
        return df.orderBy(*order).limit(1)
    return df.filter(up_to(order, end))


def subset(df: DataFrame, k: int, key: str | Sequence[str], seed: int = SAMPLE_SEED) -> DataFrame:
    """Exactly ``k`` rows in hashed-key order; 0 means all."""
    if not k or k <= 0:
        return df
    return pick_by_hash(df, key, k, seed).filter("picked").drop("picked")


def limit_per_group(df: DataFrame, group: str, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows of each group, -1 for all.

    Up to ``WINDOW_LIMIT`` rows a window that cuts each group before the shuffle;
    beyond, ranks by range partitions, so that a hot group is spread.  There
    ``group`` and ``order`` must identify rows.
    """
    if n == -1:
        return df
    if n > WINDOW_LIMIT:
        return global_rank(df, list(order), group, out="_rn").filter(F.col("_rn") <= n).drop("_rn")
    ranked = df.withColumn(
        "_rn", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col("_rn") <= n).drop("_rn")


def batch_stats(df: DataFrame, key: str, chunks: str, size: int = INDEX_BATCH) -> DataFrame:
    """Documents in key order cut into batches; chunks per batch and so far.

    ``size`` 0 means one batch.
    """
    if size > 0:
        ranked = global_rank(df.select(key, chunks), key, out="_rank")
        numbered = ranked.withColumn("batch", F.floor((F.col("_rank") - 1) / size) + 1)
    else:
        numbered = df.select(chunks, F.lit(1).cast("long").alias("batch"))
    batches = numbered.groupBy("batch").agg(
        F.count("*").alias("documents"), F.sum(chunks).alias("chunks"))
    return running_sum(batches, "batch", "chunks", out="chunks_so_far")


def select_within_budget(files: DataFrame, cap_bytes: float | None, order: str | Sequence[str],
                         size: str = "size_bytes", priority: str | None = None,
                         mode: str = "skip") -> DataFrame:
    """Walk files in order and keep those that still fit under the cap.

    Rows with a true ``priority`` come first.  ``mode='skip'`` passes over a
    file that would overflow and goes on (``operators/budget.py`` has the way);
    ``mode='prefix'`` stops there.  Either way the result is one filter over
    ``files``.  ``order`` must identify rows; a file without a size is not kept
    unless there is no cap.
    """
    if cap_bytes is None:
        return files
    order = [order] if isinstance(order, str) else list(order)
    if priority:
        files = files.withColumn("_late", ~F.coalesce(F.col(priority), F.lit(False)))
        order = ["_late", *order]
    extra = ["_late"] if priority else []
    if mode == "skip":
        return files.filter(walked(files, cap_bytes, order, size)).drop(*extra)
    end, _, complete = prefix_end(files.select(*order, size), order, size, cap_bytes)
    if complete:
        return files.drop(*extra)
    return files.filter(up_to(order, end) if end is not None else F.lit(False)).drop(*extra)


def mark_priority(files: DataFrame, ids: DataFrame, key: Column, id_col: str,
                  flag: str = "named") -> DataFrame:
    """Flag files whose key is among ``ids``; ``key`` maps a file to its id."""
    known = ids.select(F.col(id_col).alias("_id")).dropna().distinct()
    return files.join(known, key == F.col("_id"), "left").withColumn(
        flag, F.col("_id").isNotNull()).drop("_id")


def manifest(files: DataFrame, bucket: str, prefix: str, key: str = "key",
             size: str = "size_bytes") -> DataFrame:
    """Totals of a selection: the summary half of a document listing."""
    return files.agg(
        F.lit(bucket).alias("bucket"), F.lit(prefix).alias("prefix"),
        F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("total_size_bytes"),
        F.count(key).alias("count"))
