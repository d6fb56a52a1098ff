import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gristmill.operators import budget, sampling, splits


def walk(sizes, cap, first=()):
    order = [i for i in range(len(sizes)) if i in first] + [
        i for i in range(len(sizes)) if i not in first]
    used, kept = 0, set()
    for i in order:
        if used + sizes[i] <= cap:
            used += sizes[i]
            kept.add(i)
    return kept


def files(spark, sizes, first=()):
    return spark.createDataFrame([(i, s, i in first) for i, s in enumerate(sizes)],
                                 "key int, size_bytes long, named boolean").repartition(4)


def kept_keys(df):
    return {r["key"] for r in df.collect()}


def test_budget_walk_by_hand(spark):
    sizes = [5, 9, 3, 2, 1]
    got = sampling.select_within_budget(files(spark, sizes), 10, "key")
    assert kept_keys(got) == {0, 2, 3}
    got = sampling.select_within_budget(files(spark, sizes, {1}), 10, "key", priority="named")
    assert kept_keys(got) == {1, 4}
    assert got.columns == ["key", "size_bytes", "named"]


@pytest.mark.parametrize("seed", range(4))
def test_budget_walk_by_classes_equals_the_walk(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 5, 50, 500]) * rng.randint(1, 9) for _ in range(200)]
    first = set(rng.sample(range(200), 10))
    cap = rng.choice([0, 3, 1 << 9, rng.randint(1, sum(sizes)), sum(sizes) + 0.5])
    got = sampling.select_within_budget(files(spark, sizes, first), cap, "key", priority="named")
    assert kept_keys(got) == walk(sizes, cap, first)


def test_steps_of_a_range_equal_the_walk():
    rng = random.Random(7)
    for _ in range(300):
        sizes = [rng.choice([0, 1, 2, 3, 4, 7, 8, 9, 60]) * rng.choice([1, 1, 16]) for _ in range(30)]
        cap = rng.randint(0, sum(sizes) + 3)
        found, left = budget.steps(np.array(sizes), cap)
        kept, now, start = set(), budget.size_class(cap), 0
        for end, later, alone in [*found, (len(sizes) - 1, None, False)]:
            limit = budget.bound(now)
            kept |= {i for i in range(start, end + 1) if sizes[i] < limit or sizes[i] == 0}
            kept |= {end} if alone else set()
            now, start = later, end + 1
        assert kept == walk(sizes, cap) and left == cap - sum(sizes[i] for i in kept)


def test_jobs_of_a_budget_walk_do_not_follow_the_sizes(spark):
    """Alternating small and large files: an overflow after every file, yet few jobs."""
    sizes = [s for i in range(400) for s in (1, 100_000 - i)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("walk", "walk")
    got = sampling.select_within_budget(files(spark, sizes), 100_000, "key")
    jobs = len(tracker.getJobIdsForGroup("walk"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert kept_keys(got) == walk(sizes, 100_000) and len(walk(sizes, 100_000)) > 300
    assert jobs < 15
    fractions = files(spark, sizes).withColumn("size_bytes", F.col("size_bytes") / 8)
    assert kept_keys(sampling.select_within_budget(fractions, 12_500, "key")) == walk(sizes, 100_000)


def test_budget_without_cap_and_prefix(spark):
    df = files(spark, [5, 9, 3])
    assert sampling.select_within_budget(df, None, "key").count() == 3
    assert kept_keys(sampling.select_within_budget(df, 10, "key", mode="prefix")) == {0}
    assert sampling.select_within_budget(df, 4, "key", mode="prefix").count() == 0
    assert sampling.select_within_budget(df, 17, "key", mode="prefix").count() == 3


def test_default_method_follows_the_task():
    assert sampling.default_method("regression") == "random"
    assert sampling.default_method("binary") == sampling.default_method("multiclass") \
        == "stratified"


def table(spark, rows=9):
    return spark.createDataFrame([(i, i * 2, "ABC"[i % 3]) for i in range(rows)],
                                 "feature1 int, feature2 int, target string")


def test_small_tables_stay_whole(spark):
    df = table(spark)
    assert sampling.sample_budget(df, "feature1").count() == 9
    got = sampling.sample_budget(df, "feature1", label="target", task="multiclass")
    assert {r["target"] for r in got.collect()} == set("ABC") and got.count() == 9
    assert sampling.sample_budget(df, "feature1", method="first_n_rows").count() == 9


def test_null_labels_go_before_stratifying(spark):
    df = spark.createDataFrame([(1, "A"), (2, None), (3, "B"), (4, "B")], "f1 int, target string")
    got = sampling.sample_budget(df, "f1", method="stratified", label="target")
    assert got.filter("target is null").count() == 0 and got.count() == 3


def test_stratified_needs_a_known_label(spark):
    with pytest.raises(ValueError, match="label"):
        sampling.sample_budget(table(spark), "feature1", method="stratified")
    with pytest.raises(ValueError, match="label.*available"):
        sampling.sample_budget(table(spark), "feature1", method="stratified", label="label")
    with pytest.raises(ValueError, match="unknown sampling"):
        sampling.sample_budget(table(spark), "feature1", method="best")


def test_over_budget_keeps_shares(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 < 8, "a").otherwise("b").alias("y"))
    size = df.agg(F.sum(sampling.row_bytes(df))).first()[0]
    got = sampling.sample_budget(df, "id", size // 4, label="y", task="binary")
    counts = {r["y"]: r["count"] for r in got.groupBy("y").count().collect()}
    assert abs(counts["a"] - 200) <= 1 and abs(counts["b"] - 50) <= 1
    again = sampling.sample_budget(df, "id", size // 4, label="y", task="binary")
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in again.collect())
    random_rows = sampling.sample_budget(df, "id", size // 4)
    assert abs(random_rows.count() - 250) <= 1


def test_first_row_is_always_kept(spark):
    df = table(spark)
    got = sampling.sample_budget(df, "feature1", 1, method="first_n_rows")
    assert [r["feature1"] for r in got.collect()] == [0]


def test_multi_chunk_table(spark):
    df = spark.range(15_000).select("id", (F.col("id") * 2).alias("col2"))
    assert sampling.sample_budget(df, "id").count() == 15_000


def test_subset(spark):
    df = spark.range(50)
    assert sampling.subset(df, 0, "id").count() == 50
    assert sampling.subset(df, 7, "id").count() == 7
    assert sampling.subset(df, 70, "id").count() == 50


def test_limit_per_group(spark):
    df = table(spark)
    assert sampling.limit_per_group(df, "target", 2, ["feature1"]).count() == 6
    assert sampling.limit_per_group(df, "target", -1, ["feature1"]).count() == 9


def test_batches(spark):
    df = spark.range(45).select("id", F.lit(2).cast("long").alias("chunks"))
    rows = {r["batch"]: r for r in sampling.batch_stats(df, "id", "chunks").collect()}
    assert [(rows[b]["documents"], rows[b]["chunks_so_far"]) for b in (1, 2, 3)] == [
        (20, 40), (20, 80), (5, 90)]
    one = sampling.batch_stats(df, "id", "chunks", 0).collect()
    assert len(one) == 1 and one[0]["chunks"] == 90


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 80), ratio=st.sampled_from([0.5, 0.7, 0.8, 0.9]))
def test_splits_are_disjoint_complete_and_exact(spark, n, ratio):
    train, held = splits.train_eval_split(spark.range(n), ratio, "id")
    a, b = {r["id"] for r in train.collect()}, {r["id"] for r in held.collect()}
    assert not a & b and a | b == set(range(n)) and len(b) == splits.part_size(1 - ratio, n)


def test_full_ratio_gives_an_empty_eval(spark):
    train, held = splits.train_eval_split(table(spark), 1.0, "feature1")
    assert train.count() == 9 and held.count() == 0 and held.columns == train.columns


def test_part_size_ignores_float_dust():
    assert splits.part_size(1 - 0.9, 100) == 10 and splits.part_size(0.3, 10) == 3
    assert splits.part_size(0.3, 11) == 4


def test_stratified_split_quotas(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 70, "x").when(
        F.col("id") < 95, "y").otherwise("z").alias("c"))
    quotas = {r["c"]: r["quota"] for r in splits.class_quotas(df, "c", 0.3).collect()}
    assert quotas == {"x": 21, "y": 8, "z": 1} and sum(quotas.values()) == 30
    train, test = splits.train_test_split(df, "c", "multiclass", 0.3, "id")
    assert test.count() == 30 and train.count() == 70 and test.columns[-1] == "c"


def test_quotas_of_many_classes_and_a_null_class(spark):
    df = spark.range(300).select("id", (F.col("id") % 30).alias("c"))
    got = {r["c"]: r["quota"] for r in splits.class_quotas(df, "c", 0.25).collect()}
    assert sum(got.values()) == 75 and set(got.values()) == {2, 3}
    assert [got[c] for c in range(30)] == [3] * 15 + [2] * 15
    tied = spark.createDataFrame([(i, [None, "a"][i % 2]) for i in range(10)], "id int, c string")
    quotas = {r["c"]: r["quota"] for r in splits.class_quotas(tied, "c", 0.5).collect()}
    assert quotas == {None: 3, "a": 2}
    _, test = splits.train_test_split(tied, "c", "multiclass", 0.5, "id")
    assert test.count() == 5


def test_split_errors(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, c string")
    with pytest.raises(ValueError, match="one row"):
        splits.train_test_split(df, "c", "binary", 0.5, "id")
    with pytest.raises(ValueError, match="task type"):
        splits.train_test_split(df, "c", "ranking", 0.5, "id")
    with pytest.raises(ValueError, match="available"):
        splits.train_test_split(df, "d", "regression", 0.5, "id")
    assert splits.train_test_split(df, "c", "binary", 0.5, "id", stratify=False)[1].count() == 2


def test_sample_row_and_metadata(spark):
    df = spark.createDataFrame([(2, None), (1, 2)], "a int, b int")
    assert splits.sample_row_json(df, ["a"]).first()[0] == '[{"a":1,"b":2}]'
    assert splits.sample_row_json(df, ["a"], drop=["b"]).first()[0] == '[{"a":1}]'
    meta = splits.split_metadata(df, df.limit(0), "x", 1.0).collect()
    assert [(r["split"], r["num_examples"]) for r in meta] == [("train", 2), ("eval", 0)]


def test_folds(spark):
    rows = splits.assign_folds(spark.range(2000), "id").collect()
    assert {r["fold"] for r in rows} == {0, 1}
    assert abs(sum(r["in_holdout"] for r in rows) / 2000 - 0.2) < 0.04


def test_choose_split(spark):
    def names(*have):
        df = spark.createDataFrame([(n, 1) for n in have], "split string, v int")
        return {r["split"] for r in splits.choose_split(df).collect()}

    assert names("test", "train_gen", "train_sft") == {"train_sft"}
    assert names("train", "train_sft") == {"train"}
    assert names("valid", "test") == {"test"}


def test_limit_of_many_rows_per_group(spark, monkeypatch):
    df = spark.range(400).select("id", F.when(F.col("id") < 300, "hot").otherwise("cold").alias("g"))
    few = sorted(r["id"] for r in sampling.limit_per_group(df, "g", 50, ["id"]).collect())
    monkeypatch.setattr(sampling, "WINDOW_LIMIT", 10)
    ranked = sampling.limit_per_group(df, "g", 50, ["id"])
    assert sorted(r["id"] for r in ranked.collect()) == few and ranked.columns == df.columns
