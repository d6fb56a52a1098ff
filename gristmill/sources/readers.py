"""Readers: tables, records, documents, benchmarks, patterns, model metrics."""

from __future__ import annotations

import glob
import os
import re
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.text import document_id
from gristmill.sources.quoted import read_quoted
from gristmill.sources.writers import local_folder

# Accepted document types.
DOCUMENT_SUFFIXES = (".pdf", ".docx", ".pptx", ".md", ".html", ".txt")
FILES_AT_ONCE = 256           # small files, and their bytes, of one batch
FILE_BYTES_AT_ONCE = 4 << 20


def read_table(spark: SparkSession, path: str, fmt: str = "csv",
               schema: T.StructType | str | None = None, one_line_rows: bool = False) -> DataFrame:
    """CSV with header or parquet.  A CSV without a schema is inferred from all
    its rows; unreadable input is an error, never a partial table.

    Quoted cells may hold line ends, and large files are read in parts all the
    same (``sources/quoted.py``); quotes must be doubled inside a cell, and a
    cell with quotes must be quoted.  ``one_line_rows`` says that no cell holds
    a line end, which saves a pass over the quotes.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt != "csv":
        raise ValueError(f"tables are csv or parquet, not {fmt!r}")
    if not one_line_rows:
        return read_quoted(spark, path, schema)
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("escape", '"')
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_records(spark: SparkSession, path: str,
                 schema: T.StructType | str | None = None) -> DataFrame:
    """JSON or JSONL or parquet records, chosen by the path's suffix."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if not path.endswith((".json", ".jsonl")):
        raise ValueError(f"records end in .json, .jsonl or .parquet, unlike {path!r}")
    reader = spark.read.option("mode", "FAILFAST").option("multiLine", path.endswith(".json"))
    return (reader.schema(schema) if schema else reader).json(path)


def list_documents(spark: SparkSession, path: str,
                   suffixes: Sequence[str] = DOCUMENT_SUFFIXES) -> DataFrame:
    """(key, size_bytes) of supported files below a folder, content not read.

    Suffixes are matched as written; no supported file is an error.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        F.col("path").alias("key"), F.col("length").alias("size_bytes"))
    wanted = F.lit(False)
    for suffix in suffixes:
        wanted = wanted | F.endswith("key", F.lit(suffix))
    found = files.filter(wanted)
    if found.isEmpty():
        raise ValueError("no supported documents found")
    return found


def load_text_documents(spark: SparkSession, path: str, on_bad: str = "replace") -> DataFrame:
    """(document_id, text): one row per file, undecodable bytes replaced or an error."""
    raw = spark.read.text(path, wholetext=True).select(
        document_id(F.col("_metadata.file_name")).alias("document_id"), F.col("value").alias("text"))
    if on_bad == "replace":
        return raw.withColumn("text", F.make_valid_utf8("text"))
    if on_bad == "error":
        return raw.withColumn("text", F.validate_utf8("text"))
    raise ValueError(f"on_bad must be 'replace' or 'error', not {on_bad!r}")


def load_benchmark(spark: SparkSession, path: str) -> DataFrame:
    """Questions of a JSON array file; the id is the position in the array, from 0.

    A benchmark is one file, so one task reads it.  Other text than an array of
    objects is an error or gives no question; a missing field is null.
    """
    if not path.endswith(".json"):
        raise ValueError(f"a benchmark is one .json file, unlike {path!r}")
    try:
        files = spark.read.text(path, wholetext=True)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"benchmark not found: {path}") from error
        raise
    # A variant keeps the order of the array, and its position is the id.
    entries = files.select(F.parse_json("value").alias("whole")).lateralJoin(
        spark.tvf.variant_explode(F.col("whole").outer())).select("pos", "value")
    return entries.select(
        F.variant_get("value", "$.question", "string").alias("question"),
        F.variant_get("value", "$.correct_answers", "array<string>").alias("correct_answers"),
        F.variant_get("value", "$.correct_answer_document_ids", "array<string>").alias(
            "correct_answer_document_ids"), F.col("pos").cast("long").alias("question_id"))


def _matching(folder: str, file: str, share: int, shares: int) -> Iterator[tuple[str, str]]:
    """``(sub-directory, path)`` of the matching files in every ``shares``-th sub-directory."""
    with os.scandir(folder) as entries:
        for entry in entries:
            if zlib.crc32(os.fsencode(entry.name)) % shares == share and entry.is_dir():
                for path in sorted(glob.glob(os.path.join(glob.escape(entry.path), file))):
                    if os.path.isfile(path) and not os.path.basename(path).startswith(("_", ".")):
                        yield entry.name, path


def _json_files(spark: SparkSession, root: str, file: str, name: str, out: str) -> DataFrame:
    """Whole files ``file`` of all sub-directories of ``root``, with the directory's name.

    On a mounted file system each task looks through its share of the directories:
    the driver neither lists nor holds them.
    """
    folder = local_folder(root)
    if folder is not None and not re.search(r"[\[\]{}\\?*]", folder) and not re.search(
            r"[\[\]{}\\]", file) and os.path.isdir(folder) and next(
            _matching(folder, file, 0, 1), None):
        shares = 4 * spark.sparkContext.defaultParallelism

        def read(batches):
            for batch in batches:
                for share in batch.column(0).to_pylist():
                    names, texts, size = [], [], 0
                    for directory, path in _matching(folder, file, share, shares):
                        with open(path, "rb") as content:
                            texts.append(content.read())
                        names.append(directory)
                        size += len(texts[-1])
                        if len(texts) >= FILES_AT_ONCE or size >= FILE_BYTES_AT_ONCE:
                            yield rows(names, texts)
                            names, texts, size = [], [], 0
                    yield rows(names, texts)

        def rows(names, texts):
            return pa.RecordBatch.from_pydict({
                name: pa.array(names, pa.string()), out: pa.array(texts, pa.binary())})

        found = spark.range(0, shares, 1, shares).mapInArrow(read, f"`{name}` string, `{out}` binary")
        return found.withColumn(out, F.col(out).cast("string"))
    # Paths come as URIs; a plus sign in a name is no space.
    parts = F.split(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")), "/")
    return spark.read.text(f"{root}/*/{file}", wholetext=True).select(
        F.url_decode(F.element_at(parts, -2 - file.count("/"))).alias(name),
        F.col("value").alias(out))


def load_patterns(spark: SparkSession, root: str, file: str = "pattern.json") -> DataFrame:
    """(directory, pattern JSON) of every sub-directory that has a pattern file."""
    return _json_files(spark, root, file, "directory", "pattern")


def load_model_metrics(spark: SparkSession, root: str,
                       file: str = "metrics/metrics.json") -> DataFrame:
    """(model, metrics JSON) of every model below ``root``."""
    return _json_files(spark, root, file, "model", "metrics")
