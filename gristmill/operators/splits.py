"""Reproducible train/evaluation splits and fold assignment."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators.checks import require_columns, require_task
from gristmill.operators.ranking import global_rank, key_hash, pick_by_hash
from gristmill.session import cut_lineage

# Default ratios and seed.
TRAIN_RATIO = 0.9
PROMPT_TRAIN_RATIO = 0.8
TEST_SIZE = 0.3
SPLIT_SEED = 42
FOLDS = 2
HOLDOUT = 0.2


def part_size(share: float, n: int) -> int:
    """Rows of the smaller part: share of n rounded up, after removing float dust."""
    return math.ceil(round(share * n, 9))


def _part_size(share: float, n: Column) -> Column:
    return F.ceil(F.round(F.lit(share) * n, 9))


def mark_eval(df: DataFrame, ratio: float, key: str | Sequence[str], seed: int = SPLIT_SEED,
              flag: str = "in_eval") -> DataFrame:
    """Flag the evaluation rows of a ratio split; a ratio of 1 or more flags none."""
    if ratio >= 1.0:
        return df.withColumn(flag, F.lit(False))
    return pick_by_hash(df, key, lambda n: _part_size(1 - ratio, n), seed, flag=flag)


def train_eval_split(df: DataFrame, ratio: float = TRAIN_RATIO, key: str | Sequence[str] = "id",
                     seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """(train, eval).  With a ratio of 1 or more eval is empty, same columns."""
    if ratio >= 1.0:
        return df, df.limit(0)
    marked = mark_eval(df, ratio, key, seed)
    return (marked.filter(~F.col("in_eval")).drop("in_eval"),
            marked.filter("in_eval").drop("in_eval"))


def split_metadata(train: DataFrame, evaluation: DataFrame, uri: str, ratio: float) -> DataFrame:
    def record(part: DataFrame, name: str) -> DataFrame:
        return part.agg(F.lit(uri).alias("dataset_uri"), F.count("*").alias("num_examples"),
                        F.lit(name).alias("split"), F.lit(ratio).alias("train_split_ratio"))

    return record(train, "train").unionByName(record(evaluation, "eval"))


def class_quotas(df: DataFrame, label: str, test_size: float) -> DataFrame:
    """(label, quota): class shares of the test rows by largest remainder.

    The quotas add up to the global test count; ties go to the smaller label,
    and a null label is a class before all others.
    """
    counts = cut_lineage(df.groupBy(label).agg(F.count("*").alias("n")))
    facts = counts.agg(F.sum("n").alias("total"), F.min("n").alias("least"),
                       F.count("*").alias("classes")).first()
    total = facts["total"] or 0
    wanted = part_size(test_size, total)
    if not total:
        return counts.select(label, F.col("n").alias("quota"))
    _check_classes(facts["classes"], facts["least"], wanted, total)
    share = F.round(F.lit(float(wanted)) * F.col("n") / F.lit(total), 9)
    parts = counts.withColumn("_base", F.floor(share)).withColumn(
        "_minus_rest", F.round(F.col("_base") - share, 9))
    extra = wanted - parts.agg(F.sum("_base")).first()[0]
    ranked = global_rank(parts, ["_minus_rest", label], out="_rank")
    return ranked.select(label, (F.col("_base") + (F.col("_rank") <= extra).cast("long")
                                 ).alias("quota"))


def _check_classes(classes: int, least: int, test_rows: int, total: int) -> None:
    if least < 2:
        raise ValueError("a class with one row cannot be stratified")
    if min(test_rows, total - test_rows) < classes:
        raise ValueError("fewer rows in one part than classes")


def mark_test(df: DataFrame, label: str, task: str = "regression", test_size: float = TEST_SIZE,
              key: str | Sequence[str] = "id", seed: int = SPLIT_SEED, stratify: bool = True,
              flag: str = "in_test") -> DataFrame:
    """Flag test rows; classification keeps class proportions unless told not to."""
    require_task(task)
    require_columns(df, [label])
    if task == "regression" or not stratify:
        return pick_by_hash(df, key, lambda n: _part_size(test_size, n), seed, flag=flag)
    return pick_by_hash(df, key, class_quotas(df, label, test_size), seed, strata=label, flag=flag)


def train_test_split(df: DataFrame, label: str, task: str = "regression",
                     test_size: float = TEST_SIZE, key: str | Sequence[str] = "id",
                     seed: int = SPLIT_SEED, stratify: bool = True) -> tuple[DataFrame, DataFrame]:
    marked = mark_test(df, label, task, test_size, key, seed, stratify)
    return (label_last(marked.filter(~F.col("in_test")).drop("in_test"), label),
            label_last(marked.filter("in_test").drop("in_test"), label))


def label_last(df: DataFrame, label: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != label], label)


def sample_row_json(df: DataFrame, order: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """The first row as a JSON array with one record."""
    kept = [c for c in df.columns if c not in drop]
    return df.orderBy(*order).limit(1).select(
        F.to_json(F.array(F.struct(*kept)), {"ignoreNullFields": "false"}).alias("sample_row"))


def assign_folds(df: DataFrame, key: str | Sequence[str], folds: int = FOLDS,
                 holdout: float = HOLDOUT, seed: int = SPLIT_SEED) -> DataFrame:
    """Add ``fold`` and ``in_holdout`` from two independent hashes of the key."""
    def number(s: int) -> Column:
        return F.conv(F.substring(key_hash(key, s), 1, 8), 16, 10).cast("long")

    return df.withColumn("fold", F.pmod(number(seed), F.lit(folds))).withColumn(
        "in_holdout", number(seed + 1) < F.lit(int(holdout * 2 ** 32)))


def choose_split(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows of the preferred split: train, train_sft, train_gen, training, else the first name."""
    # Order of preference.
    preferred = ("train", "train_sft", "train_gen", "training")
    place = F.lit(len(preferred))
    for number, name in reversed(list(enumerate(preferred))):
        place = F.when(F.col(split_col) == name, number).otherwise(place)
    best = df.agg(F.min(F.struct(place.alias("place"), F.col(split_col).alias("name")))
                  .alias("best")).first()["best"]
    if best is None:
        raise ValueError("no splits found")
    return df.filter(F.col(split_col) == best["name"])
