"""Documents: chunking and text extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.once import computed_once
from gristmill.functions.text import fixed_pieces, html_to_text, recursive_pieces, repeat_ends

# Default chunk sizes and overlaps by use.
INDEX_CHUNK = (1024, 0)
PATTERN_CHUNK = (2048, 256)
NOTEBOOK_CHUNK = (512, 50)


def chunk(df: DataFrame, doc: str = "doc_id", text: str = "text", method: str = "recursive",
          size: int = INDEX_CHUNK[0], overlap: int = INDEX_CHUNK[1],
          keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per chunk: document, number from 0, start (fixed only), text."""
    if method not in ("fixed", "recursive"):
        raise ValueError(f"unknown chunking method {method!r}")
    pieces = fixed_pieces(F.col(text), size, overlap) if method == "fixed" else \
        recursive_pieces(F.col(text), size - overlap)     # leaves room for the overlap
    cut = computed_once(df, "_pieces", pieces).select(doc, *keep, "_pieces")
    if method == "recursive" and overlap:
        cut = cut.withColumn("_pieces", repeat_ends(F.col("_pieces"), overlap))
    out = cut.select(doc, *keep, F.posexplode("_pieces").alias("chunk_no", "chunk_text"))
    if method == "fixed":
        out = out.withColumn("start", F.col("chunk_no").cast("long") * (size - overlap))
    return out


def extract_text(df: DataFrame, content: str = "html", fmt: str = "html") -> DataFrame:
    """Add ``text`` and ``failed``; a document that yields no text counts as failed."""
    if fmt == "html":
        text = html_to_text(F.col(content))
    elif fmt in ("txt", "md"):
        text = F.col(content)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return df.withColumn("text", text).withColumn(
        "failed", F.coalesce(F.col("text") == "", F.lit(True)))


def extraction_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(~F.col("failed")).alias("processed"),
                  F.count_if("failed").alias("errors"))
