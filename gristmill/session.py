"""Session helpers: construction, the shared folder, bounded collects."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Row, SparkSession

# Rows the driver may hold for one summary (class counts, leaderboard names,
# query blocks).  Larger summaries take a distributed way.
DRIVER_ROWS = 10_000


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "gristmill", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a session inside one process (``local`` or ``local[...]``) without that
    setting gets a temporary folder; any other session without it is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="gristmill-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: partitions and their rows are fixed from here on."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def collect_bounded(df: DataFrame, limit: int = DRIVER_ROWS) -> list[Row] | None:
    """All rows if there are at most ``limit``, else None."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
