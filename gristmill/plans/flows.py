"""The operators put together: chat ingest, table preparation, document indexing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.operators import checks, documents, retrieval, sampling, splits


def ingest_chat(items: DataFrame, key: str | Sequence[str], subset_count: int = 0,
                ratio: float = splits.TRAIN_RATIO) -> tuple[DataFrame, DataFrame]:
    """Subset, then check, then split: (train, eval) of a chat dataset."""
    chosen = sampling.subset(items, subset_count, key)
    first = key if isinstance(key, str) else key[0]
    return splits.train_eval_split(checks.validate_chat(chosen, first), ratio, key)


def prepare_table(df: DataFrame, key: str | Sequence[str], label: str, task: str,
                  budget_bytes: int = sampling.TABLE_BUDGET_BYTES,
                  test_size: float = splits.TEST_SIZE) -> tuple[DataFrame, DataFrame]:
    """Sample to the budget by the task's method, then split: (train, test)."""
    kept = sampling.sample_budget(df, key, budget_bytes, label=label, task=task)
    return splits.train_test_split(kept, label, task, test_size, key)


def index_documents(pages: DataFrame, doc: str, content: str, cap_bytes: float | None,
                    size: int = documents.INDEX_CHUNK[0], overlap: int = documents.INDEX_CHUNK[1],
                    dim: int = retrieval.DIMENSION) -> DataFrame:
    """Select within the budget, extract text, chunk and embed: one row per chunk.

    Documents that yield no text are left out, as they have no chunk.
    """
    sizes = pages.select(doc, F.octet_length(content).cast("long").alias("size_bytes"))
    chosen = sampling.select_within_budget(sizes, cap_bytes, doc)
    texts = documents.extract_text(pages.join(chosen.select(doc), doc, "left_semi"), content)
    chunks = documents.chunk(texts.filter(~F.col("failed")), doc, "text", "recursive", size, overlap)
    return retrieval.embed(chunks, "chunk_text", dim=dim)
