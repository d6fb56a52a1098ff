"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as lower-cased words joined by single spaces.  An item of L
characters may occur with up to k = L // ``CHARS_PER_ERROR`` edits.  Cut into
k + 1 pieces, at least one piece of any such occurrence is untouched, so an
automaton over all pieces finds every candidate place, and Myers' bit-parallel
distance decides.  Nothing is shuffled: items go to the documents in blocks of
bounded size, and each document is read once per block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.batches import spread
from gristmill.llm.registry import query
from gristmill.session import scratch_path

CHARS_PER_ERROR = 16
BLOCK_CHARS = 2_000_000   # item text in one broadcast and one automaton
_WORDS = re.compile(r"[^\W_]+")
SCHEMA = "doc_id long, item_id long, errors int, begin int, end int"


def normalised(text: str) -> str:
    return " ".join(_WORDS.findall(text.lower()))


def pieces(text: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` consecutive pieces of nearly equal length with their offsets."""
    cuts = [len(text) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def myers(pattern: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """Smallest edit distance of the pattern to any substring of ``text``, and its end.

    ``pattern`` maps each character to the bits of its places.  Bit-parallel:
    one step per text character, whatever the pattern's length.
    """
    full, last = (1 << length) - 1, 1 << (length - 1)
    up, down, distance = full, 0, length
    best, best_end = length, 0
    for at, char in enumerate(text):
        match = pattern.get(char, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        rise, fall = down | ~(diagonal | up) & full, up & diagonal
        if rise & last:
            distance += 1
        elif fall & last:
            distance -= 1
        rise = rise << 1 & full
        up = (fall << 1 & full) | ~(diagonal | rise) & full
        down = rise & diagonal
        if distance < best:
            best, best_end = distance, at + 1
    return best, best_end


def places(text: str) -> dict[str, int]:
    bits: dict[str, int] = {}
    for at, char in enumerate(text):
        bits[char] = bits.get(char, 0) | 1 << at
    return bits


class Finder:
    """Automaton over the pieces of one block of items."""

    def __init__(self, items: list[tuple[int, str]], chars_per_error: int):
        self.items, parts = [], {}
        for item_id, raw in items:
            text = normalised(raw)
            if not text:
                continue
            errors = len(text) // chars_per_error
            self.items.append((item_id, text, errors, places(text)))
            for offset, piece in pieces(text, errors):
                parts.setdefault(piece, []).append((len(self.items) - 1, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in parts.items():
            self.automaton.add_word(piece, (len(piece), where))
        if parts:
            self.automaton.make_automaton()

    def find(self, raw: str) -> Iterator[tuple[int, int, int, int]]:
        """Each matching item once: id, fewest errors, begin and end of that place.

        Places count characters of the normalised text.
        """
        if not self.items:
            return
        text = normalised(raw)
        found: dict[int, set[int]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for item, offset in where:
                found.setdefault(item, set()).add(end + 1 - size - offset)
        for item, starts in found.items():
            item_id, body, errors, bits = self.items[item]
            best, covered = None, None
            for start in sorted(starts):
                if covered is not None and start <= covered:
                    continue        # the last window holds this place too
                low, covered = max(0, start - errors), start + errors
                distance, end = myers(bits, len(body), text[low:covered + len(body) + errors])
                if distance <= errors and (best is None or distance < best[0]):
                    best = (distance, max(0, low + end - len(body)), low + end)
                if best and best[0] == 0:
                    break
            if best:
                yield (item_id, *best)


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text",
                 chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """``doc_id, item_id, errors, begin, end``: each item a document holds, once.

    Null and empty texts hold nothing, items without letters or digits are held
    by nothing, and repeated rows of a document or item give repeated rows.
    All items are searched: a benchmark beyond ``BLOCK_CHARS`` takes several
    passes over the documents, each written out before the next.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    wanted = items.select(F.col(item_key).cast("long").alias("item_id"),
                          F.col(item_text).cast("string").alias("text")).filter(
        F.length("text") > 0)
    size = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_CHARS) if size > BLOCK_CHARS else 1
    narrow = spread(docs.select(F.col(key).cast("long"), F.col(text).cast("string")))

    def search(shared):
        def run(batches):
            finder = Finder(shared.value, chars_per_error)
            for batch in batches:
                rows = [(d, *hit) for d, t in zip(batch.column(0).to_pylist(),
                                                  batch.column(1).to_pylist(), strict=True)
                        if t for hit in finder.find(t)]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                names = ["doc_id", "item_id", "errors", "begin", "end"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        return narrow.mapInArrow(run, SCHEMA)

    if blocks == 1:
        return search(context.broadcast([tuple(r) for r in wanted.collect()]))
    # About half a block each, so that uneven dealing stays within the bound.
    stored, blocks = scratch_path(spark, "matches"), 2 * blocks
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for number in range(blocks):
        shared = context.broadcast([tuple(r) for r in wanted.filter(block == number).collect()])
        search(shared).write.mode("append").parquet(stored)
        shared.destroy()
    return spark.read.schema(SCHEMA).parquet(stored)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that hold no item, with their columns as they were."""
    held = contaminated(docs, items).select("doc_id").distinct()
    return docs.join(held, "doc_id", "left_anti")


@query("op1_benchmark_decontamination")
def op1(table):
    """Every benchmark item in every document."""
    return contaminated(table("documents"), table("benchmark"))
