"""Writers: tables, records, manifests, evaluation results."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"     # folder of rows without a value, as in Spark


def local_folder(path: str) -> str | None:
    """The plain name of a folder on a file system that is mounted, else None."""
    parts = urlsplit(path)
    return unquote(parts.path) if parts.scheme == "file" and not parts.netloc else None


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                single_file: bool = False) -> None:
    """Parquet, or CSV with header.  ``single_file`` gathers a small result in one part."""
    out = df.coalesce(1) if single_file else df
    if fmt == "csv":
        out.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    elif fmt == "parquet":
        out.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unsupported table format {fmt!r}")


def write_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, nulls written out."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_manifest(files: DataFrame, totals: DataFrame, path: str) -> None:
    """The document list as rows and its totals as one JSON record.

    The list stays distributed: it is as long as the corpus.
    """
    files.write.parquet(f"{path}/documents")
    totals.coalesce(1).write.json(f"{path}/summary")


def write_evaluations(df: DataFrame, path: str, pattern: str = "pattern") -> None:
    """Evaluation rows as JSON, one folder per pattern.

    Every task writes its own rows, so a large pattern has several writers.
    """
    df.withColumn("_folder", F.col(pattern)).write.partitionBy("_folder").json(path)


def write_folders(df: DataFrame, path: str, key: str, text: str, width: int) -> None:
    """A text file for each key, ``key=value/part-0.txt``, one line a row; null is an empty line.

    ``key`` is a whole number.  On a mounted file system the tasks write the files
    themselves, as a committer of Spark takes some 40 ms for each; a file is renamed
    when it is whole, so a repeated task leaves the same files.
    """
    folder = local_folder(path)
    if folder is None:
        df.select(key, text).repartition(width, key).write.partitionBy(key).text(path)
        return
    os.makedirs(folder)
    name = F.concat(F.lit(f"{key}="), F.coalesce(F.col(key).cast("string"), F.lit(NO_VALUE)))
    lines = df.select(name.alias("folder"), F.concat(
        F.coalesce(F.col(text), F.lit("")), F.lit("\n")).alias("line"))
    files = lines.repartition(width, "folder").groupBy("folder").agg(
        F.array_join(F.collect_list("line"), "").alias("text"))

    def write(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = os.path.join(folder, name)
                os.makedirs(own, exist_ok=True)
                draft = os.path.join(own, f".{uuid.uuid4().hex}")
                with open(draft, "wb") as out:
                    out.write(content.encode())
                os.replace(draft, os.path.join(own, "part-0.txt"))
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    files.mapInArrow(write, "n long").agg(F.sum("n")).collect()
