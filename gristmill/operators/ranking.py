"""Global order without a single task: exact-size picks, prefixes, running sums.

``Window.orderBy`` without a partition moves every row to one task.  The
functions here reach the same results from bounded summaries:

* ``pick_by_hash``: exactly k rows by hashed key.  Counts per hash prefix find
  the prefix that holds the k-th row, one sort of that prefix finds its hash,
  and the pick is then a plain comparison on the row itself: the table is
  neither sorted nor joined nor shuffled.
* ``prefix_end``: the last row of the longest prefix within a budget, found by
  narrowing key ranges.
* ``running_sum`` / ``global_rank``: range partitions, made permanent by a
  checkpoint, then partition totals plus a window inside each partition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.session import collect_bounded, cut_lineage, shuffle_width

PREFIX_HEX = 4            # 65,536 hash prefixes
ABOVE_ALL_HASHES = "g"    # sorts after every hex digest
SORT_ROWS = 100_000       # a key range up to this size is sorted by one task
JOIN_SALTS = 16


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def key_hash(key: str | Sequence[str], seed: int) -> Column:
    """md5 of ``seed:key``: the reproducible random order used everywhere."""
    parts = [F.col(c).cast("string") for c in _names(key)]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))


def pick_by_hash(df: DataFrame, key: str | Sequence[str],
                 quota: int | Callable[[Column], Column] | DataFrame,
                 seed: int = 42, strata: str | None = None,
                 flag: str = "picked") -> DataFrame:
    """Add a boolean ``flag`` that is true for exactly the quota of rows.

    The picked rows are the first ones in ``key_hash`` order, per value of
    ``strata`` when given.  ``quota`` is a number, a function from the row
    count column to a count column, or a frame ``(strata, quota)``.  ``key``
    must identify rows; copies of one key at the cut are an error.
    """
    digest = key_hash(key, seed)
    stratum = F.col(strata) if strata else F.lit("all")
    narrow = df.select(stratum.alias("_s"), digest.alias("_h"))
    counts = narrow.groupBy("_s", F.substring("_h", 1, PREFIX_HEX).alias("_b")).agg(
        F.count("*").alias("_n"))
    whole = Window.partitionBy("_s")
    counts = counts.withColumn("_total", F.sum("_n").over(whole)).withColumn(
        "_upto", F.sum("_n").over(
            whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    if isinstance(quota, DataFrame):
        per_stratum = quota.select(F.col(strata).alias("_qs"), F.col("quota").alias("_k"))
        counts = counts.join(per_stratum, F.col("_s").eqNullSafe(F.col("_qs"))).drop("_qs")
    elif callable(quota):
        counts = counts.withColumn("_k", quota(F.col("_total")))
    else:
        counts = counts.withColumn("_k", F.lit(quota))
    # One row per stratum: the prefix in which its quota is reached.
    reached = counts.filter((F.col("_k") > F.col("_upto") - F.col("_n"))
                            & (F.least("_k", "_total") <= F.col("_upto"))).select(
        "_s", "_b", F.when(F.col("_k") >= F.col("_total"), None).otherwise(
            F.col("_k") - F.col("_upto") + F.col("_n")).cast("long").alias("_need"))

    edges = collect_bounded(reached)
    if edges is None:
        return _mark_many_strata(df, cut_lineage(reached), digest, stratum, flag)
    return _mark_few_strata(df, narrow, edges, reached.schema, digest, strata, flag)


def _hash_at_need(rows: DataFrame) -> DataFrame:
    """Rows of the edge prefixes -> one hash per stratum, ties counted."""
    ordered = Window.partitionBy("_s").orderBy("_h")
    upto = Window.partitionBy("_s").orderBy("_h").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("_rn", F.row_number().over(ordered))
            .withColumn("_through", F.count("*").over(upto))
            .filter(F.col("_rn") == F.col("_need"))
            .select("_s", F.col("_h").alias("_cut"),
                    (F.col("_through") == F.col("_need")).alias("_exact")))


def _mark_few_strata(df, narrow, edges, schema, digest, strata, flag):
    spark = df.sparkSession
    cuts = {row["_s"]: ABOVE_ALL_HASHES for row in edges if row["_need"] is None}
    partial = [row for row in edges if row["_need"] is not None]
    if partial:
        edge = F.broadcast(spark.createDataFrame(partial, schema)).withColumnsRenamed(
            {"_s": "_es", "_b": "_eb"})
        rows = narrow.join(edge, F.col("_s").eqNullSafe(F.col("_es"))
                           & (F.substring("_h", 1, PREFIX_HEX) == F.col("_eb")))
        for row in _hash_at_need(rows).collect():
            if not row["_exact"]:
                raise ValueError("key does not identify rows: copies at the cut")
            cuts[row["_s"]] = row["_cut"]
    if not strata:
        cut = next(iter(cuts.values()), None)
        return df.withColumn(flag, digest <= F.lit(cut) if cut else F.lit(False))
    table = spark.createDataFrame(
        list(cuts.items()) or [], f"_cs {schema['_s'].dataType.simpleString()}, _cut string")
    joined = df.join(F.broadcast(table), F.col(strata).eqNullSafe(F.col("_cs")), "left")
    return joined.withColumn(flag, F.coalesce(digest <= F.col("_cut"), F.lit(False))).drop(
        "_cs", "_cut")


def _mark_many_strata(df, reached, digest, stratum, flag):
    """Too many strata to broadcast: join on (stratum, salt), hot strata spread."""
    salt = F.pmod(F.xxhash64(digest), F.lit(JOIN_SALTS))
    tagged = df.withColumn("_ts", stratum).withColumn("_salt", salt)
    spread = reached.withColumnsRenamed({"_s": "_es", "_b": "_eb"}).withColumn(
        "_esalt", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))))
    match = (F.col("_ts").eqNullSafe(F.col("_es"))) & (F.col("_salt") == F.col("_esalt"))
    rows = tagged.select("_ts", "_salt", digest.alias("_h")).join(
        spread.filter(F.col("_need").isNotNull()), match).filter(
        F.substring("_h", 1, PREFIX_HEX) == F.col("_eb")).select(
        F.col("_ts").alias("_s"), "_h", "_need")
    found = _hash_at_need(rows).select(
        "_s", F.when(F.col("_exact"), F.col("_cut")).otherwise(
            F.raise_error(F.lit("key does not identify rows: copies at the cut"))).alias("_cut"))
    whole = reached.filter(F.col("_need").isNull()).select(
        "_s", F.lit(ABOVE_ALL_HASHES).alias("_cut"))
    cuts = cut_lineage(found.unionByName(whole)).withColumnRenamed("_s", "_es").withColumn(
        "_esalt", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))))
    return tagged.join(cuts, match, "left").withColumn(
        flag, F.coalesce(digest <= F.col("_cut"), F.lit(False))).drop(
        "_ts", "_salt", "_es", "_esalt", "_cut")


def _tuple(order: Sequence[str], values=None) -> Column:
    if values is None:
        return F.struct(*[F.col(c) for c in order])
    return F.struct(*[F.lit(values[c]).alias(c) for c in order])


def up_to(order: Sequence[str], row) -> Column:
    """Rows at or before ``row`` in ascending order; a scan predicate."""
    first = F.col(order[0]) <= F.lit(row[order[0]])
    return first if len(order) == 1 else first & (_tuple(order) <= _tuple(order, row))


def after(order: Sequence[str], row) -> Column:
    if len(order) == 1:
        return F.col(order[0]) > F.lit(row[order[0]])
    return (F.col(order[0]) >= F.lit(row[order[0]])) & (_tuple(order) > _tuple(order, row))


def _from(order: Sequence[str], row) -> Column:
    if len(order) == 1:
        return F.col(order[0]) >= F.lit(row[order[0]])
    return (F.col(order[0]) >= F.lit(row[order[0]])) & (_tuple(order) >= _tuple(order, row))


def range_summary(df: DataFrame, order: Sequence[str], value: str) -> list:
    """Ordered key ranges with first key, last key, row count and value sum.

    One row per range partition reaches the driver.  The ranges of one call
    are consistent with each other, so no partitioning has to be kept.
    """
    parts = df.repartitionByRange(shuffle_width(df.sparkSession), *order).withColumn(
        "_pid", F.spark_partition_id())
    rows = parts.groupBy("_pid").agg(
        F.min(_tuple(order)).alias("lo"), F.max(_tuple(order)).alias("hi"),
        F.count("*").alias("n"), F.sum(value).alias("total")).collect()
    return sorted(rows, key=lambda r: r["_pid"])


def prefix_end(df: DataFrame, order: str | Sequence[str], value: str, budget: float,
               n: int | None = None):
    """Last key of the longest prefix whose ``value`` sum stays within budget.

    Returns ``(row, sum, complete)``; ``row`` is None when not even the first
    row fits, ``complete`` is true when everything fits.  ``order`` must end
    in a unique key and ``value`` must not be negative.  The range that holds
    the end is narrowed until one task can sort it; ``n`` is the number of
    rows where the caller knows it.
    """
    order = _names(order)
    active = df.select(*order, value)
    end, used, previous = None, 0, None
    while n is None or n > SORT_ROWS:
        edge = None
        for part in range_summary(active, order, value):
            if used + part["total"] > budget:
                edge = part
                break
            end, used = part["hi"], used + part["total"]
        if edge is None:
            return end, used, previous is None
        active = active.filter(_from(order, edge["lo"]) & up_to(order, edge["hi"]))
        if (edge["lo"], edge["hi"]) == previous:
            raise ValueError("the order does not identify rows")
        previous, n = (edge["lo"], edge["hi"]), edge["n"]
    running = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = F.col("_cum") <= F.lit(budget - used)
    inside = active.withColumn("_cum", F.sum(value).over(running)).agg(
        F.max(F.when(fits, _tuple(order))).alias("end"),
        F.max(F.when(fits, F.col("_cum"))).alias("used"),
        F.count_if(~fits).alias("over")).first()
    if inside["end"] is not None:
        end, used = inside["end"], used + inside["used"]
    return end, used, previous is None and inside["over"] == 0


def running_sum(df: DataFrame, order: str | Sequence[str], value: Column | str,
                group: str | Sequence[str] = (), out: str = "running") -> DataFrame:
    """Add the running sum of ``value`` in ``order``, restarting per ``group``.

    A group may span any number of partitions, so one hot group is spread like
    the rest.  ``group`` plus ``order`` must identify rows.  All columns of
    ``df`` are carried through one checkpoint: pass narrow frames.
    """
    group, order = _names(group), _names(order)
    amount = F.col(value) if isinstance(value, str) else value
    placed = cut_lineage(
        df.withColumn("_value", amount)
        .repartitionByRange(shuffle_width(df.sparkSession), *group, *order)
        .withColumn("_pid", F.spark_partition_id()))
    part = ["_pid", *group]
    totals = placed.groupBy(*part).agg(F.sum("_value").alias("_sum"))
    # At most one row per partition and group piece; per group one row per partition.
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1) if group else Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(*part, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    offsets = offsets.withColumnsRenamed({c: f"_o{c}" for c in part})
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumn("_inside", F.sum("_value").over(inside))
    same = [F.col(c).eqNullSafe(F.col(f"_o{c}")) for c in part]
    matched = local.join(offsets if group else F.broadcast(offsets), same)
    return matched.withColumn(out, F.col("_before") + F.col("_inside")).drop(
        "_value", "_inside", "_before", *part[:1], *[f"_o{c}" for c in part])


def global_rank(df: DataFrame, order: str | Sequence[str], group: str | Sequence[str] = (),
                out: str = "rank") -> DataFrame:
    """Row number in ``order`` (ascending), restarting per ``group``."""
    return running_sum(df, order, F.lit(1).cast("long"), group, out)
