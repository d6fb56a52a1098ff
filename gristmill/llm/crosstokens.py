"""Alignment of two tokenizers over a corpus, with external spill counting.

The tokens of both tokenizers cover the same bytes of a text.  Two of them are
linked where their bytes overlap; offsets where tokens of both end cut a text
into groups.  How often a pair of ids is linked in the corpus tells which id of
the one side is the counterpart of an id of the other.

1. A task aligns its texts.  A space between two other characters starts a
   token in both tokenizers, so parts between such spaces are independent and
   each different part of a batch is tokenized and aligned once.  Records (pair,
   document, times) of a batch are dealt by radix, the low digit of the pair's
   B id, sorted and written as one zstd run per radix.
2. The runs of a radix are merged over a heap, in two rounds where there are
   many, and equal pairs are added up.  A pair's key begins with its B id, so
   the merge meets all pairs of a B id in a row and knows their maximum.
3. Each run meets the counts of its radix again and turns its records into
   contributions to its documents, as one zstd block per run; the blocks of a
   batch are added up.

Only runs, counts and blocks move: a record is stored once and no pair is joined
with a document.  A batch has at most ``BATCH_CHARS`` characters (or one text),
so a task holds one batch, a frame of each run that it merges, or the counts of
one radix, whose number the vocabularies bound, with ``RUNS_A_GROUP`` runs.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import uuid
from collections.abc import Iterator
from functools import partial
from itertools import chain, groupby, islice
from math import isqrt
from operator import itemgetter
from os.path import join

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.batches import spread
from gristmill.llm.registry import query
from gristmill.session import scratch_path, shuffle_width

FOLDER, SIDE_A, SIDE_B = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
RADIX_BITS = 6
BATCH_CHARS = 4 << 20     # text of a run, unless one text is longer
BATCH_DOCS = 1 << 16
STEP = 1 << 14            # parts that are tokenized at once
FRAME = 1 << 13           # pairs that a merge holds of each run
RUNS_A_GROUP = 512        # runs that meet the counts of their radix at once
SPACE = "▁"
CUT = re.compile(r"(?<=\S) (?=\S)")
STABLE = re.compile("[ -~\u00a1-\u024f]*\\Z")
# Fixed value: how byte-level vocabularies split text before their merges.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
TOTALS = "n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups: string"


def _byte_of_letter() -> dict[str, int]:
    """Letters of byte-level vocabularies: printable bytes are themselves, others follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Sides:
    """Both tokenizers, the bytes of their tokens, and whether parts are independent."""

    def __init__(self, json_text: bytes, model: bytes):
        self.a = tokenizers.Tokenizer.from_str(json_text.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = _byte_of_letter()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for piece, number in entries.items():
            if all(letter in letters for letter in piece):
                self.bytes_a[number] = bytes(letters[letter] for letter in piece)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else
                        p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        known = json.loads(json_text)
        split = known.get("pre_tokenizer") or {}
        self.independent = (
            known.get("normalizer") is None and split.get("type") == "ByteLevel"
            and split.get("use_regex", True) and not split.get("add_prefix_space")
            and not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in pieces))
        self.size_a, self.size_b = (np.array([len(x) for x in table], np.int64)
                                    for table in (self.bytes_a, self.bytes_b))
        self.bits_a = max(1, len(self.bytes_a) - 1).bit_length()
        self.bits_b = max(RADIX_BITS, (len(pieces) - 1).bit_length())
        if self.bits_a + self.bits_b + BATCH_DOCS.bit_length() - 1 > 63:
            raise ValueError("vocabularies too large for 64-bit records")
        self.ranked = self._ranked(known) if self.independent else None
        self.digits_a, self.digits_b = _digits(len(self.bytes_a)), _digits(len(pieces))

    def _ranked(self, known: dict):
        """The same merges by rank, where the ids of merged tokens follow the order of merges."""
        vocabulary, merges = known["model"]["vocab"], known["model"]["merges"]
        ranked = all(vocabulary["".join(pair.split(" ") if isinstance(pair, str) else pair)]
                     == 256 + i for i, pair in enumerate(merges))
        if not ranked or len(vocabulary) < 256 + len(merges):
            return None
        ranks = {self.bytes_a[number]: number for number in range(256 + len(merges))}
        return tiktoken.Encoding("side_a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def parts(self, text: str) -> list[str]:
        """The text after a space, cut before every space that is between other characters."""
        if not self.independent:
            return [text]
        return text.split(" ")

    def plain_a(self, text: str) -> list[int]:
        return self.a.encode(" " + text, add_special_tokens=False).ids

    def fast_a(self, text: str) -> np.ndarray:
        return self.ranked.encode_to_numpy(" " + text, disallowed_special=())

    def ways(self, texts: list[str]):
        """Rows of texts and how to encode them: letters that all versions of Unicode
        class alike, other independent parts, the rest."""
        fast, joined, rest = [], [], []
        for row, text in enumerate(texts):
            if not self.independent or not text or text[0].isspace() or text[-1].isspace():
                rest.append(row)
            elif self.ranked and STABLE.match(text):
                fast.append(row)
            else:
                joined.append(row)
        return (fast, partial(_together, fast=True)), (joined, _together), (rest, _each)

    def strict_parts(self, text: str) -> list[str]:
        """The same for texts where white space is next to a space or at an end."""
        return CUT.split(text)

    def keys(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Radix, rest of the B id, A id; ordered by B id inside a radix."""
        radix = b & ((1 << RADIX_BITS) - 1)
        high = (radix << (self.bits_b - RADIX_BITS)) | (b >> RADIX_BITS)
        return (high << self.bits_a) | a

    def ids(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        high, rest = keys >> self.bits_a, self.bits_b - RADIX_BITS
        b = ((high & ((1 << rest) - 1)) << RADIX_BITS) | (high >> rest)
        return keys & ((1 << self.bits_a) - 1), b


def read_files(folder: str = FOLDER, side_a: str = SIDE_A, side_b: str = SIDE_B) -> tuple:
    """Contents of both tokenizer files, which travel with the tasks."""
    found = []
    for name in (side_a, side_b):
        with open(join(folder, name), "rb") as file:
            found.append(file.read())
    return tuple(found)


def _digits(size: int) -> np.ndarray:
    """Decimal digits of each id and room for a separator, zero bytes behind the digits."""
    width = len(str(size))
    text = np.char.encode(np.arange(size).astype(f"U{width}"), "ascii").astype(f"S{width + 1}")
    return text.view(np.uint8).reshape(size, width + 1)


def _offsets(counts) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(counts, np.int64))])


def _each(sides: Sides, texts: list[str]) -> tuple[np.ndarray, ...]:
    """Text by text: whether both sides restore it, bytes, counts of tokens, ids of both."""
    ids_a = [e.ids for e in sides.a.encode_batch_fast(
        [" " + t for t in texts], add_special_tokens=False)]
    ids_b = sides.b.encode(texts, num_threads=1)
    table_a, table_b = sides.bytes_a.__getitem__, sides.bytes_b.__getitem__
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        whole = b" " + text.encode()
        if b"".join(map(table_a, ids_a[i])) == whole == b"".join(map(table_b, ids_b[i])):
            sizes[i] = len(whole)
        else:
            ids_a[i] = ids_b[i] = ()
    counts = [np.fromiter(map(len, ids), np.int64, len(texts)) for ids in (ids_a, ids_b)]
    return (sizes > 0, sizes, *counts, *(np.fromiter(
        chain.from_iterable(ids), np.int64, int(n.sum()))
        for ids, n in zip((ids_a, ids_b), counts)))


def _together(sides: Sides, texts: list[str], fast: bool = False) -> tuple | None:
    """The same for parts without white space at their ends, joined to one text.

    None if a side does not restore all of it or has a token over two parts.
    """
    joined = " ".join(texts)
    whole = b" " + joined.encode()
    sizes = np.fromiter((len(t.encode()) + 1 for t in texts), np.int64, len(texts))
    limits, counts, ids = np.cumsum(sizes), [], []
    for encode, table, size in (
            (sides.fast_a if fast else sides.plain_a, sides.bytes_a, sides.size_a),
            (sides.b.encode, sides.bytes_b, sides.size_b)):
        found = np.asarray(encode(joined), np.int64)
        if b"".join(map(table.__getitem__, found.tolist())) != whole:
            return None
        upto = np.cumsum(size[found])
        last = np.searchsorted(upto, limits)
        if (upto[last] != limits).any():
            return None
        counts.append(np.diff(last, prepend=-1))
        ids.append(found)
    return np.ones(len(texts), bool), sizes, *counts, *ids


class Aligned:
    """Alignment of texts, each after a space: counts, groups and linked pairs of each."""

    def __init__(self, sides: Sides, texts: list[str]):
        encoded, order = [_each(sides, [])], []
        for rows, way in sides.ways(texts):
            order += rows
            for i in range(0, len(rows), STEP):
                part = [texts[row] for row in rows[i:i + STEP]]
                encoded.append(way(sides, part) or _each(sides, part))
        self.place = np.empty(len(texts), np.int64)      # of each text in the arrays below
        self.place[order] = np.arange(len(texts))
        self.valid, sizes, self.n_a, self.n_b, a, b = map(np.concatenate, zip(*encoded))
        ends_a, ends_b = np.cumsum(sides.size_a[a]), np.cumsum(sides.size_b[b])
        limits = np.cumsum(sizes)
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")    # merges two runs
        again = np.diff(ends, prepend=-1) == 0
        shared, ends = ends[again], ends[~again]
        self.n_groups = np.diff(np.searchsorted(shared, limits, "right"), prepend=0)
        self.n_links = self.n_a + self.n_b - self.n_groups
        self.keys = sides.keys(a[np.searchsorted(ends_a, ends)], b[np.searchsorted(ends_b, ends)])
        self.groups = self._texts(sides, a, b, ends_a, ends_b, shared)

    def _texts(self, sides, a, b, ends_a, ends_b, shared) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3``: ids of the groups of each text."""
        of_a, of_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        count_a = np.bincount(of_a, minlength=len(shared))
        count_b = np.bincount(of_b, minlength=len(shared))
        width = max(sides.digits_a.shape[1], sides.digits_b.shape[1])
        cells = np.zeros((len(a) + len(b), width), np.uint8)
        for ids, of, digits, place, last in (
                (a, of_a, sides.digits_a, np.arange(len(a)) + (np.cumsum(count_b) - count_b)[of_a],
                 ord("|")),
                (b, of_b, sides.digits_b, np.arange(len(b)) + np.cumsum(count_a)[of_b], ord(";"))):
            ends = np.ones(len(ids), bool)
            ends[:-1] = of[1:] != of[:-1]
            cells[place, :digits.shape[1]] = digits[ids]
            cells[place, width - 1] = np.where(ends, last, ord(","))
        filled = cells != 0
        sizes = _offsets(filled.sum(axis=1))
        whole = cells[filled].tobytes()
        bounds = sizes[_offsets(self.n_a + self.n_b)]
        return [whole[low:high - 1] for low, high in zip(
            bounds.tolist(), np.maximum(bounds[1:], bounds[:-1] + 1).tolist())]


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays in one zstd frame after their lengths, as 32-bit numbers where they fit."""
    parts = []
    for values in arrays:
        wide = len(values) and (int(values.max()) >= 1 << 32 or int(values.min()) < 0)
        kind = np.int64 if wide else np.uint32
        parts += [np.array([len(values), np.dtype(kind).itemsize], np.int64).tobytes(),
                  values.astype(kind).tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpacked(frame: bytes) -> list[np.ndarray]:
    data, at, found = zstandard.ZstdDecompressor().decompress(frame), 0, []
    while at < len(data):
        n, width = np.frombuffer(data, np.int64, 2, at).tolist()
        kind = np.int64 if width == 8 else np.uint32
        found.append(np.frombuffer(data, kind, n, at + 16).astype(np.int64))
        at += 16 + n * width
    return found


def _frames(keys: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """A sorted run of pairs and counts in zstd frames; keys as steps."""
    return [_packed(np.diff(keys[i:i + FRAME], prepend=0), counts[i:i + FRAME])
            for i in range(0, len(keys), FRAME)]


def _entries(frames: list[bytes]) -> Iterator[tuple[int, int]]:
    for frame in frames:
        steps, counts = _unpacked(frame)
        yield from zip(np.cumsum(steps).tolist(), counts.tolist())


def merged(runs: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Pairs of all sorted runs with the sum of their counts, by a heap over the runs."""
    for key, same in groupby(heapq.merge(*map(_entries, runs)), itemgetter(0)):
        yield key, sum(count for _, count in same)


def _stored_run(entries: Iterator[tuple[int, int]]) -> list[bytes]:
    frames = []
    while part := list(islice(entries, FRAME)):
        frames += _frames(*np.array(part, np.int64).T)
    return frames


class _Batch:
    """Texts that share their runs."""

    def __init__(self, sides: Sides):
        self.sides, self.size, self.known, self.loose = sides, 0, {}, set()
        self.keys, self.parts, self.counts = [], [], []

    def add(self, key, text: str | None) -> None:
        parts = self._numbers(self.sides.parts(text)) if text else []
        if not self.loose.isdisjoint(parts) and self.sides.independent:
            parts = self._numbers(self.sides.strict_parts(text))
        self.parts += parts
        self.counts.append(len(parts))
        self.keys.append(key)
        self.size += len(text or "")

    def _numbers(self, parts: list[str]) -> list[int]:
        """Numbers of parts; a part with white space at an end, or none, is a loose one."""
        known, before = self.known, len(self.known)
        numbers = [known.setdefault(part, len(known)) for part in parts]
        for part in islice(reversed(known), len(known) - before):
            if not part or part[0].isspace() or part[-1].isspace():
                self.loose.add(known[part])
        return numbers

    def aligned(self) -> tuple:
        """Totals and groups of the texts; aligned parts; (part, text) without invalid texts."""
        found = Aligned(self.sides, list(self.known))
        part = found.place[np.array(self.parts, np.int64)]
        first = _offsets(self.counts)
        document = np.repeat(np.arange(len(self.keys)), self.counts)
        bad = np.bincount(document, ~found.valid[part], minlength=len(self.keys)) > 0
        keep = ~bad[document]
        named = part.tolist()
        part, document = part[keep], document[keep]
        totals = [np.bincount(document, n[part], minlength=len(self.keys)).astype(np.int64)
                  for n in (found.n_a, found.n_b, found.n_groups, found.n_links)]
        texts = []
        for i in range(len(self.keys)):
            own = [] if bad[i] else named[first[i]:first[i + 1]]
            texts.append(b";".join(map(found.groups.__getitem__, own)))
        return totals, texts, found, part, document

    def runs(self, found: Aligned, part: np.ndarray, document: np.ndarray):
        """``radix, pairs, uses`` of the batch: sorted pairs with counts; documents of each."""
        pair, times = np.unique((document << 32) | part, return_counts=True)
        document, part = pair >> 32, pair & 0xFFFFFFFF
        first = _offsets(found.n_links)
        n = found.n_links[part]
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[part], n)
        bits = BATCH_DOCS.bit_length() - 1
        record = (found.keys[place] << bits) | np.repeat(document, n)
        order = np.argsort(record, kind="stable")
        record, times = record[order], np.repeat(times, n)[order]
        new = np.flatnonzero(np.diff(record, prepend=-1))
        if not len(new):
            return
        record, times = record[new], np.add.reduceat(times, new)
        key, document = record >> bits, record & (BATCH_DOCS - 1)
        head = np.flatnonzero(np.diff(key, prepend=-1))
        keys, counts = key[head], np.add.reduceat(times, head)
        uses = np.diff(head, append=len(key))
        shift = self.sides.bits_a + self.sides.bits_b - RADIX_BITS
        edges = np.searchsorted(keys >> shift, np.arange((1 << RADIX_BITS) + 1))
        places = np.concatenate([head, [len(key)]])[edges]
        for radix in np.flatnonzero(np.diff(edges)).tolist():
            low, high = edges[radix], edges[radix + 1]
            inside = slice(places[radix], places[radix + 1])
            yield radix, _frames(keys[low:high], counts[low:high]), _packed(
                uses[low:high], document[inside], times[inside])


def _batches(rows, sides: Sides, chars: int = BATCH_CHARS) -> Iterator[_Batch]:
    """Batches of a bounded number of characters and rows, one row at least."""
    batch = _Batch(sides)
    for key, text in rows:
        if batch.keys and (batch.size + len(text or "") > chars
                           or len(batch.keys) == BATCH_DOCS):
            yield batch
            batch = _Batch(sides)
        batch.add(key, text)
    if batch.keys:
        yield batch


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def align(docs: DataFrame, files: tuple[bytes, bytes], key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, groups`` of each text.

    ``groups`` lists ids as ``a1,a2|b1;a3|b2,b3``.  Texts that are null, empty or
    not restored byte for byte by both tokenizers have no tokens: zeros and an
    empty string.  Each row has its own result; nothing is shuffled.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in _batches(_rows(batches), Sides(*files)):
            totals, texts, *_ = batch.aligned()
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.keys, schema_type), *map(pa.array, totals),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                [key, "n_a", "n_b", "n_groups", "n_links", "groups"])

    schema_type = _arrow_type(docs, key)
    return spread(docs.select(key, text)).mapInArrow(
        run, f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, groups string")


def _arrow_type(docs: DataFrame, key: str) -> pa.DataType:
    return docs.select(key).limit(0).toArrow().schema.field(0).type


def write_runs(docs: DataFrame, files: tuple[bytes, bytes], key: str = "doc_id",
               text: str = "text", batch_chars: int = BATCH_CHARS) -> DataFrame:
    """Runs of all texts, stored in the shared folder.

    ``batch, radix, pairs, uses, docs``: one row a radix of each batch, and one
    with radix -1 that holds the totals of the batch's texts, groups as SHA-256.
    """
    kind, schema_type = docs.schema[key].dataType.simpleString(), _arrow_type(docs, key)
    fields = ["key", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def run(batches):
        for batch in _batches(_rows(batches), Sides(*files), batch_chars):
            totals, texts, *found = batch.aligned()
            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in texts]
            struct = pa.StructArray.from_arrays(
                [pa.array(batch.keys, schema_type), *map(pa.array, totals), pa.array(digests)],
                fields)
            rows = [(-1, [], None), *batch.runs(*found)]
            n = len(rows)
            held = pa.ListArray.from_arrays(
                pa.array([0] + [len(struct)] * n, pa.int32()), struct)
            yield pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex] * n), pa.array([r[0] for r in rows], pa.int32()),
                 pa.array([r[1] for r in rows], pa.list_(pa.binary())),
                 pa.array([r[2] for r in rows], pa.binary()), held],
                ["batch", "radix", "pairs", "uses", "docs"])

    stored = scratch_path(docs.sparkSession, "runs")
    spread(docs.select(key, text)).mapInArrow(
        run, "batch string, radix int, pairs array<binary>, uses binary, docs array<struct<"
             f"key: {kind}, {TOTALS}>>").write.option("compression", "zstd").parquet(stored)
    return docs.sparkSession.read.parquet(stored)


def pair_counts(runs: DataFrame, files: tuple[bytes, bytes]) -> DataFrame:
    """``radix, counts``: frames of pairs, counts and marks of each B id's largest, stored."""
    bits = Sides(*files).bits_a

    def add(table: pa.Table) -> pa.Table:
        frames = _stored_run(merged(table.column("pairs").to_pylist()))
        return pa.table({"radix": table.column("radix")[:1], "pairs": pa.array(
            [frames], pa.list_(pa.binary()))})

    def finish(table: pa.Table) -> pa.Table:
        keys, counts, best = [], [], []
        # All pairs of a B id come in a row.
        for _, same in groupby(merged(table.column("pairs").to_pylist()), lambda e: e[0] >> bits):
            same = list(same)
            most = max(count for _, count in same)
            keys += [key for key, _ in same]
            counts += [count for _, count in same]
            best += [count == most for _, count in same]
        frame = _packed(*(np.array(x, np.int64) for x in (keys, counts, best)))
        return pa.table({"radix": table.column("radix")[:1], "counts": pa.array(
            [frame], pa.binary())})

    only = runs.filter("radix >= 0").select("batch", "radix", "pairs")
    batches = runs.filter("radix < 0").count()
    salts = max(1, isqrt(batches))
    partial = only.withColumn("salt", F.pmod(F.xxhash64("batch"), F.lit(salts))).groupBy(
        "radix", "salt").applyInArrow(add, "radix int, pairs array<binary>")
    stored = scratch_path(runs.sparkSession, "paircounts")
    partial.groupBy("radix").applyInArrow(finish, "radix int, counts binary").write.parquet(stored)
    return runs.sparkSession.read.parquet(stored)


def pair_table(counts: DataFrame, files: tuple[bytes, bytes]) -> DataFrame:
    """``a_id, b_id, links, best``: every linked pair of ids, and whether no other A id is
    linked with this B id more often."""
    def run(batches):
        sides = Sides(*files)
        for batch in batches:
            for frame in batch.column(0).to_pylist():
                keys, links, best = _unpacked(frame)
                a, b = sides.ids(keys)
                yield pa.RecordBatch.from_pydict(
                    {"a_id": a, "b_id": b, "links": links, "best": best.astype(bool)})

    return counts.select("counts").mapInArrow(run, "a_id long, b_id long, links long, best boolean")


def _contributions(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """``batch, part``: for each run the best links and counts of its documents."""
    groups = -(-max(1, runs.filter("radix < 0").count()) // RUNS_A_GROUP)
    salt = F.pmod(F.xxhash64("batch", F.lit(1)), F.lit(groups)).cast("int")
    dealt = runs.filter("radix >= 0").select("radix", salt.alias("salt"), "batch", "pairs", "uses")
    known = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        names, parts = left.column("batch").to_pylist(), []
        keys, totals, best = _unpacked(right.column("counts")[0].as_py()) if names else [None] * 3
        for frames, packed in zip(left.column("pairs").to_pylist(),
                                  left.column("uses").to_pylist()):
            own = np.concatenate([np.cumsum(_unpacked(frame)[0]) for frame in frames])
            uses, document, times = _unpacked(packed)
            place = np.repeat(np.searchsorted(keys, own), uses)
            most, total = np.zeros((2, int(document.max()) + 1), np.int64)
            np.add.at(most, document, times * best[place])
            np.add.at(total, document, times * totals[place])
            parts.append(_packed(most, total))
        return pa.table({"batch": pa.array(names, pa.string()), "part": pa.array(
            parts, pa.binary())})

    return dealt.groupBy("radix", "salt").cogroup(known.groupBy("radix", "salt")).applyInArrow(
        meet, "batch string, part binary")


def link_scores(docs: DataFrame, files: tuple[bytes, bytes], key: str = "doc_id",
                text: str = "text", batch_chars: int = BATCH_CHARS) -> DataFrame:
    """How each text's links stand in the counts of all texts.

    ``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``:
    ``n_best`` links have a pair that is linked as often as any of its B id,
    ``count_sum`` adds the pair counts of all links; the digest is that of the
    groups of :func:`align`, empty without tokens.  Texts that are null, empty or
    not restored by both tokenizers have zeros.  Each row has its own result, also
    rows that repeat a key or have none; other columns are not returned.  Empty
    tables give no rows.
    """
    runs = write_runs(docs, files, key, text, batch_chars)
    counts = pair_counts(runs, files)
    kind = docs.schema[key].dataType.simpleString()
    own = runs.filter("radix < 0").select("batch", "docs", F.lit(None).cast("binary").alias("part"))
    given = _contributions(runs, counts).select(
        "batch", F.lit(None).cast(own.schema["docs"].dataType).alias("docs"), "part")

    def settle(table: pa.Table) -> pa.Table:
        for row in range(table.num_rows):
            if table.column("docs")[row].is_valid:
                docs = pa.concat_arrays(table.column("docs").slice(row, 1).chunks).flatten()
        sums = np.zeros((2, len(docs)), np.int64)
        for part in table.column("part").to_pylist():
            if part:
                for total, values in zip(sums, _unpacked(part)):
                    total[:len(values)] += values
        fields = dict(zip((f.name for f in docs.type), docs.flatten()))
        return pa.table({key: fields["key"], **{n: fields[n] for n in (
            "n_a", "n_b", "n_groups", "n_links")}, "n_best": sums[0], "count_sum": sums[1],
            "groups_sha256": fields["groups"]})

    return own.unionByName(given).repartition(
        shuffle_width(docs.sparkSession), "batch").groupBy("batch").applyInArrow(
        settle, f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                "count_sum long, groups_sha256 string")


@query("op12_cross_tokenizer_alignment")
def cross_tokenizer_alignment(table):
    return link_scores(table("documents"), read_files())
