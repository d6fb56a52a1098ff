"""CSV with line ends inside quoted cells, read in parts.

A line ends a record when the quotes up to it, from the begin of the file, are
even in number.  Files are read as lines, in splits like any text.  One pass
adds up the quotes of each split; their running parity tells which splits begin
inside a cell, and from then on every split finds its own records.  What a split
holds of a record that began before it, or that ends behind it, are fragments,
two a split at most, which are put together by file and place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD, HEADER, HEAD, MIDDLE, TAIL = range(5)
LINES_AT_ONCE = 256           # lines of a batch that are Python objects at a time
OPTIONS = {"escape": '"', "mode": "FAILFAST"}

# The kinds that cells may have, the first that fits all of a column, as the CSV reader infers them.
KINDS = (("int", r"^[+-]?\d{1,10}$"), ("bigint", r"^[+-]?\d{1,19}$"),
         ("double", r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|NaN|Inf(inity)?)\s*$"),
         ("date", r"^\d{4}-\d{2}-\d{2}$"), ("timestamp", r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}.*$"),
         ("boolean", "(?i)^(true|false)$"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def _split_sums(lines: DataFrame) -> DataFrame:
    """``file, block, inside, open``: whether a split begins, and ends, inside a cell."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    sums = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    upto = F.sum("odd").over(Window.partitionBy("file").orderBy("block"))
    return sums.select("file", "block", ((upto - F.col("odd")) % 2 == 1).alias("inside"),
                       (upto % 2 == 1).alias("open"))


class _Split:
    """Records of one split, batch by batch."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block, self.inside = file, block, inside
        self.first = block == 0 and not inside     # the header is still to come
        self.begun, self.waiting = not inside, []  # lines of the record that is open

    def add(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        odd = pc.count_substring(values, '"').to_numpy() % 2
        ends = np.flatnonzero((np.cumsum(odd) + (len(self.waiting) > 0 or not self.begun)) % 2 == 0)
        if not len(ends):
            self.waiting += values.to_pylist()
            return
        if not self.waiting and self.begun and len(ends) == len(values):
            records = values
        else:
            texts, begins = values.to_pylist(), [0, *(ends[:-1] + 1).tolist()]
            records = ["\n".join(texts[a:b + 1]) for a, b in zip(begins, ends.tolist())]
            records[0] = "\n".join([*self.waiting, records[0]])
            records = pa.array(records, pa.string())
        self.waiting = values.slice(int(ends[-1]) + 1).to_pylist()
        kinds = np.full(len(records), RECORD, np.int8)
        if not self.begun:
            kinds[0], self.begun = HEAD, True
        elif self.first:
            kinds[0], self.first = HEADER, False
        yield self.rows(records, kinds)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            kind = TAIL if self.begun else MIDDLE
            yield self.rows(pa.array(["\n".join(self.waiting)]), np.array([kind], np.int8))

    def rows(self, records: pa.Array, kinds: np.ndarray) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_pydict({
            "record": records, "kind": kinds, "file": pa.array([self.file] * n, pa.string()),
            "block": np.full(n, self.block, np.int64)})


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row a record, ``record``, without headers and empty lines.

    The driver holds the splits that begin inside a quoted cell: at most one
    entry for each part of ``spark.sql.files.maxPartitionBytes``.
    """
    lines = _lines(spark, path)
    sums = _split_sums(lines).filter("inside or open").collect()
    inside = {(row["file"], row["block"]) for row in sums if row["inside"]}

    def run(batches):
        split = None
        for batch in (whole.slice(start, LINES_AT_ONCE) for whole in batches
                      for start in range(0, whole.num_rows, LINES_AT_ONCE)):
            batch = batch.set_column(0, "value", pc.utf8_rtrim(batch.column(0), "\r"))
            files, blocks = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            cuts = np.flatnonzero(np.append(True, (blocks[1:] != blocks[:-1]) | np.array(
                [a != b for a, b in zip(files[1:], files)], bool))) if len(files) else []
            for low, high in zip(cuts, [*cuts[1:], len(files)]):
                where = (files[low], int(blocks[low]))
                if split is None or (split.file, split.block) != where:
                    if split:
                        yield from split.rest()
                    split = _Split(*where, where in inside)
                yield from split.add(batch.column(0).slice(low, high - low))
        if split:
            yield from split.rest()

    found = lines.mapInArrow(run, "record string, kind byte, file string, block long")
    whole = found.filter((F.col("kind") == RECORD) & (F.col("record") != "")).select("record")
    if not sums:
        return whole
    parts = found.filter(F.col("kind") > HEADER)
    in_order = Window.partitionBy("file").orderBy("block", "kind")
    number = F.sum((F.col("kind") == TAIL).cast("int")).over(in_order)
    joined = parts.withColumn("number", number).groupBy("file", "number").agg(F.array_sort(
        F.collect_list(F.struct("block", "kind", "record"))).alias("parts"))
    return whole.unionByName(joined.select(F.array_join(F.transform(
        "parts", lambda part: part["record"]), "\n").alias("record")))


def _inferred(cells: DataFrame) -> str:
    """Kind of each column from all its cells, in one pass."""
    facts = []
    for i, name in enumerate(cells.columns):
        cell = F.col(f"`{name}`")
        for kind, shape in KINDS:
            fits = F.rlike(cell, F.lit(shape)) & cell.try_cast(kind).isNotNull()
            facts.append(F.bool_and(fits).alias(f"{i}.{kind}"))
    row = cells.agg(*facts).first().asDict()
    return ", ".join(
        f"`{name}` " + next((kind for kind, _ in KINDS if row[f"{i}.{kind}"]), "string")
        for i, name in enumerate(cells.columns))


def read_quoted(spark: SparkSession, path: str, schema: T.StructType | str | None) -> DataFrame:
    """The table of all records; without a schema the kinds follow from all cells."""
    rows = records(spark, path)

    def cells(kinds: str) -> Column:
        return F.from_csv("record", kinds, OPTIONS).alias("cells")

    if schema is None:
        names = spark.read.option("header", True).option("multiLine", True).option(
            "escape", '"').csv(path).columns
        texts = ", ".join(f"`{name}` string" for name in names)
        schema = _inferred(rows.select(cells(texts)).select("cells.*"))
    elif not isinstance(schema, str):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return rows.select(cells(schema)).select("cells.*")
