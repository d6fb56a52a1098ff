"""Incremental indexing: new document files become chunk vectors, each file once."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators.documents import chunk
from gristmill.operators.retrieval import DIMENSION, embed, index_folder
from gristmill.operators.sampling import INDEX_BATCH

TOTALS = "documents long, chunks long, documents_so_far long, chunks_so_far long"


def _totals_folder(path: str, collection: str, source: str, batch: str) -> str:
    """Beside the collection, in a folder that readers of the index pass over."""
    return index_folder(f"{path}/_totals", collection, source, batch)


def _store(collection: str, source: str, path: str, doc: str, text: str, method: str, size: int,
           overlap: int, dim: int):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, index_folder(path, collection, source, str(batch_id))
        chunks = chunk(batch, doc, text, method, size, overlap)
        vectors = embed(chunks, "chunk_text", "embedding", dim)
        # A replayed batch replaces its own folder, so rows never double; batch
        # numbers count per source, so sources don't replace each other.
        vectors.write.mode("overwrite").parquet(folder)
        # The totals of a batch are those of the batch before it and its own rows: a
        # replay makes the same row again, and the collection is never read.
        own = spark.read.schema(vectors.schema).parquet(folder).agg(
            F.count_distinct(doc).alias("documents"), F.count("*").alias("chunks")).first()
        before = (0, 0)
        if batch_id:
            before = spark.read.schema(TOTALS).parquet(_totals_folder(
                path, collection, source, str(batch_id - 1))).first()[2:]
        row = (own["documents"], own["chunks"], before[0] + own["documents"],
               before[1] + own["chunks"])
        spark.createDataFrame([row], TOTALS).coalesce(1).write.mode("overwrite").parquet(
            _totals_folder(path, collection, source, str(batch_id)))

    return write


def run_index(stream: DataFrame, path: str, checkpoint: str, collection: str = "default",
              doc: str = "doc_id", text: str = "text", method: str = "recursive",
              size: int = 1024, overlap: int = 0, dim: int = DIMENSION) -> None:
    """Process everything available, then stop; a second run takes only new files.

    Several streams may fill one collection: each is a source of its own, named
    by its checkpoint folder.
    """
    source = "stream-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    stream.writeStream.foreachBatch(
        _store(collection, source, path, doc, text, method, size, overlap, dim)).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def document_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                    batch_files: int = INDEX_BATCH) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option(
        "maxFilesPerTrigger", batch_files).load(path)


def index_progress(spark: SparkSession, path: str, collection: str) -> DataFrame:
    """Documents and chunks of every batch of each source, and so far, as its stream kept them."""
    folder = f"{path}/_totals"
    return spark.read.option("basePath", folder).schema(
        TOTALS + ", source string, batch long").parquet(f"{folder}/collection={collection}").select(
        "source", "batch", *[part.split()[0] for part in TOTALS.split(", ")])
