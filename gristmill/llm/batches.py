"""Arrow batches of texts inside tasks: bounded chunks, word hashes, output batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20     # text handled at once by the numpy steps
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = [np.cumprod(np.full(64, _MULTIPLIER))]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]],
                schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch; it yields dicts of columns in ``schema`` order."""
    def run(batches):
        for batch in batches:
            for columns in fn(batch):
                yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(run, schema)


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than cores, spread over all of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def hashed_sample(df: DataFrame, key: str, size: int) -> DataFrame:
    """At most ``size`` rows, the first in order of a hash of the key.

    A hash bound leaves little more than the sample before it is ordered, so
    what the tasks send does not grow with their number.
    """
    total = df.count()
    order = F.xxhash64(F.col(key).cast("string"))
    if total > 2 * size:
        df = df.filter(F.pmod(order, F.lit(1 << 30)) < int(1.5 * size / total * (1 << 30)))
    return df.orderBy(order, key).limit(size)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with at most ``limit`` bytes, one text at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _factors(n: int) -> np.ndarray:
    if len(_FACTORS[0]) < n:
        _FACTORS[0] = np.cumprod(np.full(max(n, 2 * len(_FACTORS[0])), _MULTIPLIER))
    return _FACTORS[0]


def _segment_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions of the words of one byte buffer."""
    inside = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    flags = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(flags == 1), np.flatnonzero(flags == -1)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    values = (buf[inside].astype(np.uint64) + np.uint64(1)) * _factors(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, firsts)), starts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of lower-cased texts, and offsets per text.

    Words are runs of bytes other than space and 0x09-0x0D.  Text ``i`` has
    the hashes ``offsets[i]:offsets[i + 1]``.
    """
    joined = b" ".join(texts) + b" "
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    buf = np.frombuffer(joined, np.uint8)
    hashes, starts, at = [], [], 0
    while at < len(buf):
        end = min(at + CHUNK_BYTES, len(buf))
        if end < len(buf):      # cut at a space; a longer word stays whole
            cut = max(joined.rfind(b" ", at, end), joined.rfind(b"\n", at, end))
            end = cut + 1 if cut >= at else joined.find(b" ", end) + 1
        part, begin = _segment_hashes(buf[at:end])
        hashes.append(part)
        starts.append(begin + at)
        at = end
    words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    where = np.concatenate(starts) if starts else np.empty(0, np.int64)
    return words, np.searchsorted(where, bounds)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)
