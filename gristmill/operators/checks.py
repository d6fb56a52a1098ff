"""Argument and row checks: columns, chat format, freshness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators.ranking import global_rank

# Accepted names, limits and thresholds.
CHAT_ROLES = ("system", "user", "assistant", "function", "tool")
TASKS = ("binary", "multiclass", "regression")
INGEST_CHECK_ROWS = 100
HOLDOUT_CHECK_ROWS = 10
HOLDOUT_ERRORS = 5
FRESH_DAYS = 270
STALE_DAYS = 360
DATE_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ssXX", "yyyy-MM-dd HH:mm:ssXXX",
                "yyyy-MM-dd'T'HH:mm:ssXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd")


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found; available columns: {df.columns}")


def require_task(task: str) -> None:
    if task not in TASKS:
        raise ValueError(f"invalid task type {task!r}; must be one of {', '.join(TASKS)}")


def chat_violations(df: DataFrame, item: str = "conv_id", turn: str = "turn",
                    role: str = "role", content: str = "text") -> DataFrame:
    """First fault of every faulty conversation, from one row per message.

    An assistant message may have null content, as function calls do.  Only faulty rows are shuffled, reduced to one per conversation on the way.
    """
    lost = F.col(content).isNull() & (F.col(role) != "assistant")
    fault = (F.when(F.col(role).isNull() | lost, "missing role or content")
             .when(~F.col(role).isin(*CHAT_ROLES), "invalid role"))
    return (df.withColumn("_fault", fault).filter(F.col("_fault").isNotNull())
            .groupBy(item)
            .agg(F.min(F.struct(F.col(turn).alias("turn"), F.col("_fault").alias("fault"),
                                F.col(role).alias("role"))).alias("_first"))
            .select(item, "_first.*"))


def messages_long(df: DataFrame, item: str) -> DataFrame:
    """One row per message from a ``messages`` (else ``conversations``) array."""
    field = next((c for c in ("messages", "conversations") if c in df.columns), None)
    if field is None:
        raise ValueError(f"missing 'messages' or 'conversations' field; found {df.columns}")
    return df.select(item, F.posexplode(field).alias("turn", "_m")).select(
        item, "turn", F.col("_m.role").alias("role"), F.col("_m.content").alias("text"))


def validate_chat(df: DataFrame, item: str, limit: int = INGEST_CHECK_ROWS,
                  full: bool = True) -> DataFrame:
    """Check an array-form chat dataset; the first fault is an error.

    ``full=False`` checks only the first ``limit`` items in ``item`` order.
    """
    if df.isEmpty():
        raise ValueError("dataset is empty")
    checked = df if full else df.orderBy(item).limit(limit)
    empty = checked.filter(F.col("messages" if "messages" in df.columns else "conversations")
                           .isNull()).select(item) if {"messages", "conversations"} & set(
        df.columns) else None
    faults = chat_violations(messages_long(checked, item), item)
    first = faults.orderBy(item, "turn").limit(1).collect()
    lost = empty.orderBy(item).limit(1).collect()
    if lost and (not first or lost[0][item] <= first[0][item]):
        raise ValueError(f"item {lost[0][item]}: messages must be a list")
    if first:
        row = first[0]
        raise ValueError(f"item {row[item]}, message {row['turn']}: {row['fault']} "
                         f"(role {row['role']!r}); roles are {', '.join(CHAT_ROLES)}")
    return df


def holdout_errors(df: DataFrame, item: str = "conv_id", turn: str = "turn",
                   role: str = "role", content: str = "text") -> DataFrame:
    """One row per conversation with its first evaluation-format error, or null."""
    def first_text(name: str) -> Column:
        return F.min_by(F.coalesce(F.col(content), F.lit("")),
                        F.when(F.col(role) == name, F.col(turn)))

    parts = df.groupBy(item).agg(F.count("*").alias("messages"),
                                 first_text("user").alias("_user"),
                                 first_text("assistant").alias("_assistant"))
    error = (F.when(F.col("messages") < 2, "fewer than 2 messages")
             .when(F.coalesce("_user", F.lit("")) == "", "no user message")
             .when(F.coalesce("_assistant", F.lit("")) == "", "no assistant message"))
    return parts.select(item, "messages", error.alias("error"))


def validate_holdout(df: DataFrame, limit: int | None = None,
                     item: str = "conv_id") -> tuple[bool, int, list[str]]:
    """(passes, valid items, first errors): passes when one item is valid.

    All items are checked; ``limit`` (the usual prefix is
    ``HOLDOUT_CHECK_ROWS``) checks only the first in ``item`` order.
    """
    checked = df
    if limit is not None:
        checked = df.join(df.select(item).distinct().orderBy(item).limit(limit), item, "left_semi")
    errors = holdout_errors(checked, item)
    valid = errors.agg(F.count_if(F.col("error").isNull())).first()[0]
    report = [f"{row[item]}: {row['error']}" for row in errors.filter("error is not null")
              .orderBy(item).limit(HOLDOUT_ERRORS).collect()]
    return valid > 0, valid, report


def parse_date(text: Column) -> Column:
    """Timestamp from the accepted formats, null when none fits."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in DATE_FORMATS])


def freshness(df: DataFrame, verified: Column, now: Column, fresh_days: int = FRESH_DAYS,
              stale_days: int = STALE_DAYS) -> DataFrame:
    """Add whole-day age and category; a missing date is stale with age 0."""
    seconds = F.unix_timestamp(now) - F.unix_timestamp(verified)
    age = F.floor(seconds / 86400).cast("long")
    category = (F.when(age.isNull(), "stale").when(age < fresh_days, "fresh")
                .when(age < stale_days, "warning").otherwise("stale"))
    return df.withColumn("age_days", F.coalesce(age, F.lit(0).cast("long"))).withColumn(
        "category", category)


def freshness_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(F.count("*").alias("n"))


def freshness_report(df: DataFrame) -> DataFrame:
    """Report order: stale, warning, fresh, oldest first."""
    place = F.when(F.col("category") == "stale", 0).when(F.col("category") == "warning", 1
                                                         ).otherwise(2)
    return df.orderBy(place, F.desc("age_days"))


def freshness_listing(df: DataFrame, key: str) -> DataFrame:
    """The report order as a column ``place``, for tables that one sort cannot hold."""
    group = F.when(F.col("category") == "stale", 0).when(F.col("category") == "warning", 1
                                                         ).otherwise(2)
    ordered = df.select(key, "age_days", "category", group.alias("_group"),
                        (-F.col("age_days")).alias("_old"))
    return global_rank(ordered, ["_group", "_old", key], out="place").drop("_group", "_old")
