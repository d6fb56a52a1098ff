"""Runs of repeated words in each text, by dyadic square catchers.

Words are appended one after the other.  Whenever ``B = 2^k`` of them complete
a block, a catcher starts at its end ``b``.  It watches the periods ``p`` from
``B`` to ``2B - 1`` and compares the suffix that begins at ``b`` with the words
``p`` earlier; each appended word lets the periods that it contradicts go.  A
period that lives for as long as a square of the wanted power has to reaches it.
Any stretch of ``(power - 1) * p`` words that equal those ``p`` earlier holds a
block end at most ``B - 1`` words after its begin, so no square is missed, and
the catcher at the first such end is the one that reports it.  Reported squares
are extended both ways to runs; squares with the same ends are one run, whose
period is the smallest.

Catchers of one level advance together, a word at a time in numpy over all
texts of a batch; after ``STEPS`` words the few living ones compare the rest of
their suffixes by fingerprints (polynomials modulo two 31-bit primes, words by
exact number).  Every level costs a few operations a word, also for a text that
is one word repeated, so a text of n words takes O(n log^2 n).  Texts are
handled whole and by themselves: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.once import computed_once
from gristmill.llm.batches import byte_texts, chunks, map_batches, spread
from gristmill.llm.registry import query

POWER, MIN_WORDS = 4, 6
STEPS = 16                # words that catchers compare one by one
PAIRS = 1 << 20           # catchers times periods handled at once
PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_213_456_789, 987_654_323)
RUN = "struct<start: bigint, length: bigint, period: bigint>"
WORD = "[^\\x20\\x09-\\x0D]+"


class Suffixes:
    """Equality of stretches of one sequence of word numbers."""

    def __init__(self, ids: np.ndarray):
        self._sums, self._powers = [], []
        for prime, base in zip(map(np.uint64, PRIMES), map(np.uint64, BASES)):
            powers = np.ones(len(ids) + 1, np.uint64)
            done, factor = 1, base
            while done < len(powers):
                step = min(done, len(powers) - done)
                powers[done:done + step] = powers[:step] * factor % prime
                done, factor = done + step, factor * factor % prime
            terms = (ids + 1).astype(np.uint64) * powers[:-1] % prime
            self._sums.append(np.concatenate([[np.uint64(0)], np.cumsum(terms)]) % prime)
            self._powers.append(powers)

    def equal(self, early: np.ndarray, late: np.ndarray, length: np.ndarray) -> np.ndarray:
        same = np.ones(len(early), bool)
        for prime, sums, powers in zip(map(np.uint64, PRIMES), self._sums, self._powers):
            left = (sums[early + length] + prime - sums[early]) * powers[late - early] % prime
            same &= left == (sums[late + length] + prime - sums[late]) % prime
        return same

    def common(self, early: np.ndarray, late: np.ndarray, most: np.ndarray,
               sign: int) -> np.ndarray:
        """Longest equal stretches, at most ``most``: from the places on, or before them."""
        least, limit = np.zeros(len(early), np.int64), most.astype(np.int64)
        while (least < limit).any():
            middle = (least + limit + 1) // 2
            back = middle if sign < 0 else 0
            same = self.equal(early - back, late - back, middle)
            least, limit = np.where(same, middle, least), np.where(same, limit, middle - 1)
        return least


def squares(ids: np.ndarray, longest: int, power: int) -> tuple[np.ndarray, ...]:
    """``(start, end, period)`` of all stretches of ``power`` periods and more, extended.

    ``ids`` begins and ends with a number found nowhere else; ``longest`` bounds
    the length of a stretch without such a number.
    """
    found, suffixes, size = [], None, 1
    while power * size <= longest:
        periods = np.arange(size, 2 * size)
        for first in range(size, len(ids), size * max(1, PAIRS // size)):
            ends = np.arange(first, min(len(ids), first + size * max(1, PAIRS // size)), size)
            at, period = _alive(ids, ends, periods, size, power)
            if not len(at):
                continue
            suffixes = suffixes or Suffixes(ids)
            need = (power - 1) * period - size + 1
            keep = suffixes.equal(at - period, at, need)
            # The end of an earlier block lies in the same stretch: its catcher reports.
            back = np.minimum(size, at - period)
            keep &= ~(suffixes.equal(at - period - back, at - back, back) & (back == size))
            at, period = at[keep], period[keep]
            before = suffixes.common(at - period, at, np.minimum(size, at - period), -1)
            after = suffixes.common(at - period, at, len(ids) - at, 1)
            keep = before + after >= (power - 1) * period
            found.append((np.stack([at - before - period, at + after, period]))[:, keep])
        size *= 2
    if not found:
        return (np.empty(0, np.int64),) * 3
    start, end, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], period[new]


def _alive(ids, ends, periods, size, power) -> tuple[np.ndarray, np.ndarray]:
    """Block ends and periods that the first ``STEPS`` appended words leave."""
    places = ends[:, None] - periods[None, :]
    rows, columns = np.nonzero((ids[ends][:, None] == ids[places]) & (places > 0))
    at, period = ends[rows], periods[columns]
    need = (power - 1) * period - size + 1
    for step in range(1, STEPS):
        place = np.minimum(at + step, len(ids) - 1)
        keep = (need <= step) | (ids[place] == ids[np.maximum(place - period, 0)])
        at, period, need = at[keep], period[keep], need[keep]
        if not len(at):
            break
    keep = at + need <= len(ids)
    return at[keep], period[keep]


def _numbered(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, all their numbers with a mark before each text, first places."""
    words = [text.split() for text in texts]
    known: dict[bytes, int] = {}
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    first = np.concatenate([[0], np.cumsum(lengths + 1)]) + 1
    ids = np.empty(first[-1], np.int64)
    for row, of in zip(first.tolist(), words):
        ids[row:row + len(of)] = [known.setdefault(word, len(known)) for word in of]
    ids[first - 1] = len(known) + np.arange(len(first))
    return words, ids, first


def _rows(key: str, text: str, power: int, min_words: int):
    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = byte_texts(batch.column(text))
        for low, high in chunks(texts):
            words, ids, first = _numbered(texts[low:high])
            start, end, period = squares(ids, max(map(len, words)), power)
            keep = end - start >= min_words
            start, end, period = start[keep], end[keep], period[keep]
            dropped = np.zeros(len(ids) + 1, np.int64)
            np.add.at(dropped, start + period, 1)
            np.add.at(dropped, end, -1)
            kept = (np.cumsum(dropped) == 0)
            of = np.searchsorted(first, start, "right") - 1
            order = np.lexsort((period, start))
            runs = pa.StructArray.from_arrays(
                [pa.array(x[order]) for x in (start - first[of], end - start, period)],
                ["start", "length", "period"])
            counts = np.bincount(of, minlength=high - low)[:high - low]
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            collapsed = []
            for row, had in zip(first.tolist(), words):
                stays = kept[row:row + len(had)]
                if not stays.all():
                    had = [word for word, stay in zip(had, stays.tolist()) if stay]
                collapsed.append(b" ".join(had))
            yield {key: batch.column(key)[low:high],
                   "n_words": pa.array(np.fromiter(map(len, words), np.int64, high - low)),
                   "runs": pa.ListArray.from_arrays(pa.array(offsets), runs),
                   "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string())}

    return rows


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", power: int = POWER,
              min_words: int = MIN_WORDS) -> DataFrame:
    """Every run of words of each text: ``key, n_words, runs, collapsed``.

    A run is a longest stretch of words with smallest period ``period`` that is
    at least ``power`` (2 or more) periods and ``min_words`` words long; ``runs``
    holds them as ``start, length, period`` in words, by start, then period.
    ``collapsed`` is the text with one space between words and of each run
    only its first period.  Words are what spaces and 0x09-0x0D separate; case
    counts.  Null and empty texts have no words, no runs and an empty collapsed
    text; each row has its own result, also rows that repeat an id or have none.
    Other columns are not returned.  Empty tables give no rows.
    """
    if power < 2:
        raise ValueError("a run has at least two periods")
    kind = docs.schema[key].dataType.simpleString()
    return map_batches(spread(docs.select(key, text)), _rows(key, text, power, min_words),
                       f"`{key}` {kind}, n_words bigint, runs array<{RUN}>, collapsed string")


def largest_run(runs: Column) -> Column:
    """The run with most periods, exactly; ties: the first start, then the smallest period."""
    return F.reduce(runs, F.lit(None).cast(RUN), lambda best, run: F.when(
        best.isNull() | (run.length * best.period > best.length * run.period), run
    ).otherwise(best))


def with_periods(docs: DataFrame) -> DataFrame:
    """Every tenth text by a hash of its id repeats some of its words to its end."""
    hashed = F.crc32(F.col("doc_id").cast("string"))
    draw = F.floor(hashed / 10)
    words = F.when(hashed % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    split = computed_once(docs.select("doc_id", "text"), "_words", words)
    n = F.size("_words")
    begin = (draw % n).cast("int")
    period = (1 + F.floor((n - begin) / (3 + draw % 8))).cast("int")
    copies = F.ceil((n - begin) / period).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice("_words", begin + 1, period), copies))
    changed = F.concat(F.slice("_words", F.lit(1), begin), F.slice(repeated, F.lit(1), n - begin))
    return split.select("doc_id", F.when(n > 0, F.concat_ws(" ", changed)).otherwise(
        F.col("text")).alias("text"))


@query("op11_periodic_runs")
def periodic_runs(table):
    found = find_runs(with_periods(table("documents")))
    best = found.withColumn("best", largest_run(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r.start, r.length, r.period), F.lit("\n")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).cast(
            "long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
