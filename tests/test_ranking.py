import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gristmill.operators import ranking


def by_hash(keys, seed):
    return sorted(keys, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())


def numbers(spark, n, groups=3):
    return spark.range(n).select(F.col("id"), (F.col("id") % groups).alias("g"),
                                 (F.col("id") * 7 % 11).alias("v")).repartition(5)


@pytest.mark.parametrize("k", [0, 1, 137, 999, 1000, 2000])
def test_pick_takes_first_hashes(spark, k):
    picked = ranking.pick_by_hash(numbers(spark, 1000), "id", k, seed=3).filter("picked")
    assert {r["id"] for r in picked.collect()} == set(by_hash(range(1000), 3)[:k])


def test_pick_per_stratum_with_function(spark):
    df = numbers(spark, 500)
    picked = ranking.pick_by_hash(df, "id", lambda n: F.floor(n / 4), strata="g")
    got = {r["id"] for r in picked.filter("picked").collect()}
    want = set()
    for g in range(3):
        keys = [i for i in range(500) if i % 3 == g]
        want |= set(by_hash(keys, 42)[:len(keys) // 4])
    assert got == want
    assert picked.count() == 500


def test_pick_with_many_strata_is_the_same(spark, monkeypatch):
    df = numbers(spark, 400, 40)
    few = ranking.pick_by_hash(df, "id", 3, strata="g").filter("picked")
    want = {r["id"] for r in few.collect()}
    monkeypatch.setattr(ranking, "collect_bounded", lambda frame, limit=0: None)
    many = ranking.pick_by_hash(df, "id", 3, strata="g")
    assert many.count() == 400 and many.columns == few.columns
    assert {r["id"] for r in many.filter("picked").collect()} == want
    whole = ranking.pick_by_hash(df, "id", 10, strata="g").filter("picked")
    assert whole.count() == 400


def test_pick_null_stratum_is_a_stratum(spark):
    df = numbers(spark, 100).withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    picked = ranking.pick_by_hash(df, "id", 5, strata="g").filter("picked")
    assert picked.filter("g is null").count() == 5


def test_pick_rejects_copies_at_the_cut(spark):
    df = spark.createDataFrame([(1,), (1,), (1,)], "id long")
    with pytest.raises(ValueError, match="does not identify"):
        ranking.pick_by_hash(df, "id", 2)


def test_a_hot_stratum_keeps_its_quota(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2000, "hot").otherwise(
        F.col("id").cast("string")).alias("g"))
    picked = ranking.pick_by_hash(df, "id", lambda n: F.ceil(n / 10), strata="g")
    counts = picked.filter("picked").groupBy("g").count().filter("g = 'hot'").first()
    assert counts["count"] == 200


@pytest.mark.parametrize("sort_rows", [5, 100_000])
@pytest.mark.parametrize("budget", [0, 1, 500, 2400, 10 ** 6])
def test_prefix_end(spark, monkeypatch, sort_rows, budget):
    monkeypatch.setattr(ranking, "SORT_ROWS", sort_rows)
    df = numbers(spark, 500)
    values = [i * 7 % 11 for i in range(500)]
    end, used, complete = ranking.prefix_end(df, "id", "v", budget)
    total, last = 0, None
    for i, v in enumerate(values):
        if total + v > budget:
            break
        total, last = total + v, i
    assert (end["id"] if end else None, used, complete) == (last, total, last == 499)


def test_prefix_end_needs_a_unique_order(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SORT_ROWS", 5)
    df = spark.createDataFrame([(1, 1)] * 20, "k long, v long")
    with pytest.raises(ValueError, match="does not identify"):
        ranking.prefix_end(df, "k", "v", 10)


def test_running_sum_and_rank(spark):
    df = numbers(spark, 300)
    rows = {r["id"]: r["s"] for r in ranking.running_sum(df, "id", "v", out="s").collect()}
    total = 0
    for i in range(300):
        total += i * 7 % 11
        assert rows[i] == total
    ranks = ranking.global_rank(df, ["v", "id"], out="r").collect()
    order = sorted(range(300), key=lambda i: (i * 7 % 11, i))
    assert {r["id"]: r["r"] for r in ranks} == {k: n + 1 for n, k in enumerate(order)}


def test_rank_per_group_spans_partitions(spark):
    df = spark.range(400).select("id", F.when(F.col("id") < 300, "hot").otherwise("cold")
                                 .alias("g")).repartition(6)
    ranked = ranking.global_rank(df, "id", "g")
    assert set(ranked.columns) == {"id", "g", "rank"}
    got = {r["id"]: r["rank"] for r in ranked.collect()}
    assert got == {i: i + 1 if i < 300 else i - 299 for i in range(400)}


def test_order_predicates(spark):
    rows = [(a, b) for a in range(5) for b in range(4)]
    df = spark.createDataFrame(rows, "a int, b int")
    cut = df.filter("a = 2 and b = 1").first()
    low = {tuple(r) for r in df.filter(ranking.up_to(["a", "b"], cut)).collect()}
    high = {tuple(r) for r in df.filter(ranking.after(["a", "b"], cut)).collect()}
    assert low == {r for r in rows if r <= (2, 1)} and high == {r for r in rows if r > (2, 1)}


def test_hashes_do_not_depend_on_partitions(spark):
    random.seed(1)
    df = numbers(spark, 200)
    one = ranking.pick_by_hash(df.coalesce(1), "id", 50).filter("picked")
    two = ranking.pick_by_hash(df.repartition(13), "id", 50).filter("picked")
    assert {r["id"] for r in one.collect()} == {r["id"] for r in two.collect()}
