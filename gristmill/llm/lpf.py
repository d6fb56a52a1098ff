"""Repeated passages by longest-previous-factor arrays, sharded by anchors.

A byte goes if it lies in a ``WINDOW``-byte string that also starts in a
document with a smaller id.  One suffix array over the corpus would be needed
to see that directly; instead every window is assigned to an anchor, the gram
inside it with the smallest priority, which depends on the window's bytes only.
Equal windows therefore have equal anchors.  The windows of one anchor
occurrence are consecutive and make a span.

1. Each batch of documents sends its spans as (anchor hash, span hash), packed
   per shard of the anchor hash.  A span met twice in a batch is sent once, for
   the smallest id; the other documents have their answer already.
2. In a shard, equal spans of several documents need no bytes: all but the
   smallest id lose the whole span.  Different spans of one anchor may still
   share windows, as at the ends of copied passages, if they agree for half of
   the rest of a window before or after the anchor; one document per such span
   is asked for its bytes.
3. These spans are gathered by anchor.  Their suffix array and the nearest
   smaller documents before and after each suffix give the longest previous
   factors; windows with a factor of full length go.
4. Each document is cut by what was found.

Spans and anchors are compared by 64-bit hashes, step 3 by bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.batches import byte_texts, chunks, mix, signed, spread
from gristmill.llm.registry import query
from gristmill.session import scratch_path, shuffle_width

WINDOW = 50
GRAM = 16
REACH = WINDOW - GRAM + 1     # grams in a window; at most so many windows have one anchor
PIECE = 1 << 20               # longer texts are handled in overlapping pieces
BLOCK = 1 << 18               # bytes of texts handled at once: their arrays stay in the cache
SHARD_ANCHORS = 2_000_000
SEND_BYTES = 16 << 20         # text whose spans are sorted together before they are sent
FACTOR_BYTES = 2 << 20        # text per group of the suffix arrays
GROUP_BYTES = 8 << 20         # text handled by one task of the last steps
STEPS = 24                    # steps back by pointers to a smaller value
HOT = 4096                    # different spans of one anchor, beyond which windows are dealt singly
BATCH_DOCS = 60_000           # documents of one packed row set: places fit 16 bits
_BASE = np.uint64(0x9E3779B97F4A7C15)
MATCHED, MIXED, MIXED_HOT = 0, 1, 2
SIDE = (WINDOW - GRAM + 1) // 2   # equal windows agree so far before or after their anchor
PACK = 6                      # codes in the first rank of a suffix
_LEVELS = np.full(256, 3, np.uint8)
_LEVELS[[10, 46, 44, 32]] = 0, 1, 1, 2
_SENT = np.dtype([("h", "<u8"), ("s", "<u8"), ("d", "<u2"), ("l", "<u2"), ("r", "<u2")])


def _powers() -> tuple[np.ndarray, np.ndarray]:
    size = PIECE + WINDOW + 1
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    one = np.ones(1, np.uint64)
    return (np.concatenate([one, np.cumprod(np.full(size, _BASE))]),
            np.concatenate([one, np.cumprod(np.full(size, inverse))]))


class Anchors:
    """Spans of the windows of several pieces of text.

    ``piece`` index, ``h`` hash of the anchor gram, ``s`` hash of the span with
    the anchor's place in it, ``first`` window (in the piece) and ``count``.
    ``left`` and ``right`` are short hashes of the ``SIDE`` bytes before and
    after the gram, 0 where the piece has fewer; without ``sides`` they are left out.
    """

    def __init__(self, pieces: list[bytes], tables: tuple[np.ndarray, np.ndarray],
                 sides: bool = True):
        powers, inverses = tables
        buf = np.frombuffer(b"".join(pieces), np.uint8)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begin = np.cumsum(size) - size
        windows = np.maximum(size - WINDOW + 1, 0)
        self.starts = np.repeat(begin - (np.cumsum(windows) - windows), windows) + np.arange(
            windows.sum())
        if not len(self.starts):
            self.piece = self.first = self.count = np.empty(0, np.int64)
            self.h = self.s = np.empty(0, np.uint64)
            self.left = self.right = np.empty(0, np.uint16)
            return
        values = mix(np.arange(256, dtype=np.uint64) + np.uint64(1))[buf]
        grams = mix(self._gram_hashes(values))
        n = len(grams)
        # Priority by the gram's own bytes: line starts, clause ends, spaces, the rest.
        level = _LEVELS[buf[:n]]
        clause = np.flatnonzero(level == 1)
        level[clause[buf[clause + 1] != 32]] = 3
        low = grams >> np.uint64(26)
        low <<= np.uint64(24)
        low |= level.astype(np.uint64) << np.uint64(62)
        low |= np.arange(n, dtype=np.uint64)
        step = 1
        while 2 * step <= REACH:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < REACH:
            low = np.minimum(low[:len(low) - (REACH - step)], low[REACH - step:])
        anchor = (low[self.starts] & np.uint64(0xFFFFFF)).astype(np.int64)
        runs = np.append(0, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1)
        first = self.starts[runs]
        self.count = np.diff(np.append(runs, len(anchor)))
        place = anchor[runs] - first
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:len(values)])])
        end = first + self.count + WINDOW - 1
        content = (sums[end] - sums[first]) * inverses[first]
        self.h = grams[anchor[runs]]
        self.s = mix(mix(content) + place.astype(np.uint64) * _BASE + self.count.astype(np.uint64))
        self.piece = np.repeat(np.arange(len(size)), windows)[runs]
        self.first = first - begin[self.piece]
        if not sides:
            return
        low_end, high_end = begin[self.piece], (begin + size)[self.piece]
        at = anchor[runs]

        def side(a, inside):
            a = np.where(inside, a, 0)
            found = mix((sums[np.minimum(a + SIDE, len(values))] - sums[a]) * inverses[a])
            return np.where(inside, found % np.uint64(65535) + np.uint64(1), 0).astype(np.uint16)

        self.left = side(at - SIDE, at - SIDE >= low_end)
        self.right = side(at + GRAM, at + GRAM + SIDE <= high_end)

    @staticmethod
    def _gram_hashes(values: np.ndarray) -> np.ndarray:
        """Polynomial hash of the ``GRAM`` (a power of two) bytes at each place."""
        found, step, factor = values, 1, _BASE
        with np.errstate(over="ignore"):
            while step < GRAM:
                found = found[:-step] + factor * found[step:]
                step, factor = 2 * step, factor * factor
        return found


def pieces_of(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Bounded lists of ``(text index, offset, piece)``; each window is in one piece."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - WINDOW + 1), PIECE):
            piece = text[at:at + PIECE + WINDOW - 1]
            if size and size + len(piece) > min(BLOCK, PIECE):
                yield held
                held, size = [], 0
            held.append((i, at, piece))
            size += len(piece)
    if held:
        yield held


def text_spans(texts: list[bytes], tables,
               sides: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, Anchors]]:
    """Per bounded list: text index and offset of each piece, and its anchors."""
    for held in pieces_of(texts):
        yield (np.array([i for i, _, _ in held]), np.array([at for _, at, _ in held]),
               Anchors([p for _, _, p in held], tables, sides))


def send_spans(docs: DataFrame, shards: int) -> DataFrame:
    """``shard, docs, sent, known``: packed spans of each batch, by shard.

    ``docs`` lists the ids, ``sent`` and ``known`` refer to them by place.
    ``known`` are the spans that a smaller id of the same batch also has.
    """
    def run(batches):
        tables = _powers()
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_DOCS):
                part = batch.slice(start, BATCH_DOCS)
                ids, texts = part.column(0).to_numpy(), byte_texts(part.column(1))
                for first, end in chunks(texts, SEND_BYTES):
                    yield from rows(ids[first:end], texts[first:end], tables)

    def rows(ids, texts, tables):
        parts = []
        for index, _, found in text_spans(texts, tables, sides=True):
            part = np.empty(len(found.h), _SENT)
            part["h"], part["s"], part["d"] = found.h, found.s, index[found.piece]
            part["l"], part["r"] = found.left, found.right
            parts.append(part)
        spans = np.concatenate(parts) if parts else np.empty(0, _SENT)
        doc = ids[spans["d"]]
        order = np.lexsort([doc, spans["s"], spans["h"]])
        spans, doc = spans[order], doc[order]
        new = np.ones(len(spans), bool)
        new[1:] = (spans["h"][1:] != spans["h"][:-1]) | (spans["s"][1:] != spans["s"][:-1])
        owner = doc[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
        repeat = ~new
        repeat[1:] &= doc[1:] == doc[:-1]
        keep, later = new, ~new & (doc > owner) & ~repeat
        shard = (spans["h"] % np.uint64(shards)).astype(np.int64)
        used = keep | later
        order = np.flatnonzero(used)[np.argsort(shard[used], kind="stable")]
        if not len(order):
            return
        edges = np.flatnonzero(np.diff(shard[order], prepend=-1))
        columns = {"shard": [], "docs": [], "sent": [], "known": []}
        for a, b in zip(edges, np.append(edges[1:], len(order)), strict=True):
            own = order[a:b]
            places, at = np.unique(spans["d"][own], return_inverse=True)
            packed = spans[own]
            packed["d"] = at
            mine = keep[own]
            columns["shard"].append(int(shard[own[0]]))
            columns["docs"].append(ids[places])
            columns["sent"].append(packed[mine].tobytes())
            columns["known"].append(packed[~mine].tobytes())
        kinds = {"shard": pa.int32(), "docs": pa.list_(pa.int64()), "sent": pa.binary(),
                 "known": pa.binary()}
        yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds[c]) for c, v in columns.items()})

    return docs.mapInArrow(run, "shard int, docs array<long>, sent binary, known binary")


def shard_fates(sent: DataFrame, shards: int) -> DataFrame:
    """``doc, s, kind`` of the spans that go whole or have to be looked at."""
    def unpack(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
        docs, spans = [], []
        for ids, packed in zip(table.column("docs").to_pylist(), table.column(column).to_pylist(),
                               strict=True):
            part = np.frombuffer(packed, _SENT)
            spans.append(part)
            docs.append(np.array(ids, np.int64)[part["d"]])
        return np.concatenate(docs), np.concatenate(spans)

    def resolve(table: pa.Table) -> pa.Table:
        doc, spans = unpack(table, "sent")
        order = np.lexsort([doc, spans["s"], spans["h"]])
        doc, spans = doc[order], spans[order]
        h, s = spans["h"], spans["s"]
        n = np.arange(len(doc))
        new_h = np.ones(len(doc), bool)
        new_h[1:] = h[1:] != h[:-1]
        new_s = new_h.copy()
        new_s[1:] |= s[1:] != s[:-1]
        owner = doc[np.maximum.accumulate(np.where(new_s, n, 0))]
        matched = doc > owner
        group = np.cumsum(new_h) - 1
        variants = np.bincount(group, new_s)[group]
        # A window in common needs another document with the same anchor and side.
        asked = np.zeros(len(doc), bool)
        several = np.flatnonzero(new_s & (variants > 1))
        for side in ("l", "r"):
            known_side = several[spans[side][several] > 0]
            known_side = known_side[np.lexsort([spans[side][known_side], h[known_side]])]
            if not len(known_side):
                continue
            edge = np.ones(len(known_side), bool)
            edge[1:] = (np.diff(spans[side][known_side].astype(np.int64)) != 0) | (
                h[known_side][1:] != h[known_side][:-1])
            low, high = (f.reduceat(doc[known_side], np.flatnonzero(edge))
                         for f in (np.minimum, np.maximum))
            asked[known_side] |= (low < high)[np.cumsum(edge) - 1]
        known_doc, known = unpack(table, "known")
        kind = np.where(variants[asked] > HOT, MIXED_HOT, MIXED)
        return pa.table({
            "doc": np.concatenate([doc[matched], known_doc, doc[asked]]),
            "s": signed(np.concatenate([s[matched], known["s"], s[asked]])),
            "kind": np.concatenate([np.full(np.count_nonzero(matched) + len(known_doc), MATCHED),
                                    kind]).astype(np.int8)})

    return sent.repartition(shards, "shard").groupBy("shard").applyInArrow(
        resolve, "doc long, s long, kind byte")


class Wanted:
    """Rows of a fates table by document and span; rows of one pair are one, with all their bits."""

    def __init__(self, table: pa.Table, values: str):
        doc, span = table.column("doc").to_numpy(), table.column("s").to_numpy()
        self.docs, d = np.unique(doc, return_inverse=True)
        self.spans, s = np.unique(span, return_inverse=True)
        key = d * len(self.spans) + s
        order = np.argsort(key, kind="stable")
        edge = np.flatnonzero(np.diff(key[order], prepend=-1))
        self.keys = key[order[edge]]
        self.first = table.column(values).to_numpy()[order[edge]]
        self.bits = np.bitwise_or.reduceat(table.column(values).to_numpy()[order], edge)

    @staticmethod
    def _place(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index in the sorted table, and whether the value is there."""
        at = np.minimum(np.searchsorted(table, values), len(table) - 1)
        return at, table[at] == values

    def has(self, docs: np.ndarray) -> np.ndarray:
        return self._place(self.docs, docs)[1]

    def find(self, docs: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs that are wanted, and their rows."""
        s, known = self._place(self.spans, spans)
        at = np.flatnonzero(known)
        d, known = self._place(self.docs, docs[at])
        at, d = at[known], d[known]
        row, known = self._place(self.keys, d * len(self.spans) + s[at])
        return at[known], row[known]


def asked_spans(texts: DataFrame, asked: DataFrame, shards: int) -> DataFrame:
    """Bytes of the spans asked for: ``shard, doc, s, window, count, piece``.

    Spans of a hot anchor are dealt window by window, by the window's bytes;
    a window that a smaller id of the same group has is settled here (null
    ``piece``, and its bit in ``count``).
    """
    names = ["shard", "doc", "s", "window", "count", "piece"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def collect(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, hot = [], []
        if left.num_rows and right.num_rows:
            wanted = Wanted(right, "kind")
            ids = left.column("doc").to_numpy()
            chosen = np.flatnonzero(wanted.has(ids))
            ids = ids[chosen]
            texts = byte_texts(left.column("text").combine_chunks().take(pa.array(chosen)))
            met, tables = np.zeros(len(wanted.keys), bool), _powers()
            for index, offset, found in text_spans(texts, tables):
                at, row = wanted.find(ids[index[found.piece]], signed(found.s))
                row, once = np.unique(row, return_index=True)
                at, once = at[once], ~met[row]
                at, row = at[once], row[once]
                met[row] = True
                piece = found.piece[at]
                text, first = index[piece], offset[piece] + found.first[at]
                for shard, doc, name, count, kind, i, a in zip(*(x.tolist() for x in (
                        found.h[at] % np.uint64(shards), ids[text], signed(found.s)[at],
                        found.count[at], wanted.first[row], text, first)), strict=True):
                    body = texts[i][a:a + count + WINDOW - 1]
                    if kind == MIXED:
                        rows.append((shard, doc, name, 0, count, body))
                    else:
                        hot += [(body[w:w + WINDOW], doc, name, w) for w in range(count)]
        hot.sort()
        owner = None
        for body, doc, name, window in hot:
            if owner is None or owner[0] != body:
                owner = (body, doc)
            if doc > owner[1]:
                rows.append((0, doc, name, 0, 1 << window, None))
            else:
                shard = int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "big") % shards
                rows.append((shard, doc, name, window, 1, body))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    return texts.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(
        collect, "shard int, doc long, s long, window int, count long, piece binary")


def packed(codes: np.ndarray, size: int) -> np.ndarray:
    """The next ``size`` codes (under 512) of each place in one number, high first."""
    padded = np.concatenate([codes, np.zeros(size, codes.dtype)])
    out = np.zeros(len(codes), np.int64)
    for k in range(size):
        out = out << 9 | padded[k:k + len(codes)]
    return out


def suffix_ranks(codes: np.ndarray, depth: int) -> dict[int, np.ndarray]:
    """Ranks of all suffixes by their first ``PACK``, twice as many, ... and ``depth`` codes."""
    size = min(PACK, depth)
    ranks = {size: np.unique(packed(codes, size), return_inverse=True)[1].astype(np.int64)}

    def joined(size: int, shift: int) -> np.ndarray:
        own = ranks[size]
        ahead = np.full(len(own), -1)
        ahead[:max(0, len(own) - shift)] = own[shift:]
        return np.unique(own * (len(own) + 1) + ahead + 1, return_inverse=True)[1]

    while 2 * size <= depth:
        ranks[2 * size] = joined(size, size)
        size *= 2
    if size < depth:
        ranks[depth] = joined(size, depth - size)
    return ranks


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value before each place, -1 where there is none.

    A place that is not smaller passes on to the place it points to itself; most
    places end after a few such steps.  For the rest, minima of the last 1, 2,
    4, ... values let them step back over the longest runs without a smaller
    value, from long to short.
    """
    n = len(values)
    padded = np.append(values, values.min() - 1 if n else 0)     # place -1 ends every search
    at = np.arange(-1, n, dtype=np.int64)
    left = np.flatnonzero(padded[at[:n]] >= values)
    for _ in range(STEPS):
        if not len(left):
            return at[:n]
        at[left] = at[at[left]]
        left = left[padded[at[left]] >= values[left]]
    levels, step = [values], 1
    while 2 * step <= n and len(left):
        low = levels[-1].copy()
        low[step:] = np.minimum(low[step:], levels[-1][:-step])
        levels.append(low)
        step *= 2
    for low in reversed(levels):
        own = at[left]
        fits = own - step + 1 >= 0
        own[fits] -= step * (low[own[fits]] >= values[left[fits]])
        at[left] = own
        step //= 2
    return at[:n]


def longest_previous_factors(codes: np.ndarray, owner: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix, its longest prefix (up to ``depth``) at a smaller ``owner``.

    Suffixes with equal prefixes of full length are one group.  In suffix order
    the best shorter match with a smaller owner is in the nearest group that
    has one, before or after.
    """
    if not len(codes):
        return np.empty(0, np.int64)
    ranks = suffix_ranks(codes, depth)
    group = ranks[depth]
    order = np.lexsort([owner, group])
    heads = order[np.flatnonzero(np.diff(group[order], prepend=-1))]
    lowest = owner[heads]
    sizes = sorted(ranks, reverse=True)

    # Places after the end differ from each other and from all before it.
    beyond = -1 - np.arange(depth + 1)
    ends = {size: np.append(ranks[size], beyond) for size in sizes}
    last = np.append(packed(codes, sizes[-1]), beyond)

    def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Codes that suffixes of different groups have in common."""
        length, x, y = np.zeros(len(a), np.int64), a.copy(), b.copy()
        for size in sizes[1:]:
            same = np.flatnonzero(ends[size][x] == ends[size][y])
            same = same[length[same] + size <= depth]
            for moved in (length, x, y):
                moved[same] += size
        # What is left is shorter than the first rank: equal codes before the first difference.
        differ = last[x] ^ last[y]
        more = np.zeros(len(a), np.int64)
        for k in range(1, sizes[-1]):
            more += (differ >> (9 * (sizes[-1] - k))) == 0
        inside = np.minimum(len(codes) - np.maximum(x, y), depth - length)
        return length + np.minimum(more, np.maximum(inside, 0))

    best = np.zeros(len(heads), np.int64)
    places = np.unique(lowest, return_inverse=True)[1].astype(np.int32)
    previous = nearest_smaller(places)
    following = len(heads) - 1 - nearest_smaller(places[::-1])[::-1]
    for near in (previous, following):
        has = np.flatnonzero((near >= 0) & (near < len(heads)))
        best[has] = np.maximum(best[has], common(heads[has], heads[near[has]]))
    return np.where(owner > lowest[group], depth, best[group])


def shared_windows(bodies: list[bytes], doc: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Whether a window of each piece may occur in a piece of another document.

    By hash, so that only these pieces need a suffix array.
    """
    size = np.array([len(b) for b in bodies])
    begin = np.cumsum(size) - size
    found = mix(np.arange(256, dtype=np.uint64) + np.uint64(1))[
        np.frombuffer(b"".join(bodies), np.uint8)]
    whole, at, step, factor = None, 0, 1, _BASE
    shift = np.uint64(1)
    with np.errstate(over="ignore"):
        while True:     # the window as a sum of stretches of 2, 16 and 32 bytes
            if WINDOW & step:
                part = found[at:]
                whole = part if whole is None else whole[:len(part)] + shift * part
                at, shift = at + step, shift * factor
            if 2 * step > WINDOW:
                break
            found = found[:-step] + factor * found[step:]
            step, factor = 2 * step, factor * factor
    piece = np.repeat(np.arange(len(bodies)), count)
    place = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count) + begin[piece]
    hashes = whole[place]
    order = np.argsort(hashes, kind="stable")
    edge = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order][:1]))
    owner = doc[piece[order]]
    low, high = (f.reduceat(owner, edge) for f in (np.minimum, np.maximum))
    several = np.repeat(low < high, np.diff(np.append(edge, len(order))))
    out = np.zeros(len(bodies), bool)
    out[piece[order[several]]] = True
    return out


def factor_masks(pieces: DataFrame) -> DataFrame:
    """``doc, s, mask``: windows of each span (bits) that a smaller id also has."""
    def find(table: pa.Table) -> pa.Table:
        kept = shared_windows(table.column("piece").to_pylist(), table.column("doc").to_numpy(),
                              table.column("count").to_numpy())
        table = table.filter(pa.array(kept))
        doc = table.column("doc").to_numpy()
        bodies = table.column("piece").to_pylist()
        count, window = table.column("count").to_numpy(), table.column("window").to_numpy()
        size = np.array([len(b) + 1 for b in bodies], np.int64)
        begin = np.cumsum(size) - size
        codes = np.frombuffer(b"".join(b + b"\0" for b in bodies), np.uint8).astype(np.int64) + 1
        codes[begin + size - 1] = 0     # between pieces: equals no byte
        factor = longest_previous_factors(codes, np.repeat(doc, size), WINDOW)
        piece = np.repeat(np.arange(len(bodies)), count)
        place = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
        full = np.flatnonzero(factor[begin[piece] + place] >= WINDOW)
        masks = np.zeros(len(bodies), np.int64)
        np.bitwise_or.at(masks, piece[full], 1 << (window[piece] + place)[full])
        return pa.table({"doc": doc, "s": table.column("s"), "mask": masks})

    settled = pieces.filter("piece is null").select("doc", "s", F.col("count").alias("mask"))
    return pieces.filter("piece is not null").groupBy("shard").applyInArrow(
        find, "doc long, s long, mask long").filter("mask != 0").unionByName(settled)


def cut(texts: DataFrame, found: DataFrame, schema: str) -> DataFrame:
    """Remove the found windows from each text; ``found`` has ``doc, s, mask``, -1 for all."""
    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("doc").to_numpy()
        texts = byte_texts(left.column("text").combine_chunks()) if left.num_rows else []
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(size) - size
        change = np.zeros(size.sum() + 1, np.int32)
        if len(texts) and right.num_rows:
            wanted = Wanted(right, "mask")
            chosen = np.flatnonzero(wanted.has(ids))
            tables = _powers()
            for index, offset, found in text_spans([texts[i] for i in chosen], tables):
                own = chosen[index]
                at, row = wanted.find(ids[own[found.piece]], signed(found.s))
                first = (begin[own] + offset)[found.piece[at]] + found.first[at]
                mask, count = wanted.bits[row], found.count[at]
                whole = mask == -1
                np.add.at(change, first[whole], 1)
                np.add.at(change, (first + count + WINDOW - 1)[whole], -1)
                first, mask, count = first[~whole], mask[~whole], count[~whole]
                for w in range(REACH):
                    start = first[(mask >> w & 1 == 1) & (count > w)] + w
                    np.add.at(change, start, 1)
                    np.add.at(change, start + WINDOW, -1)
        removed = np.cumsum(change, out=change)[:-1] > 0
        starts = removed.copy()
        starts[1:] &= ~removed[:-1]
        full = np.flatnonzero(size)
        starts[begin[full]] = removed[begin[full]]      # runs end with their text
        gone, runs = np.zeros((2, len(texts)), np.int64)
        if len(full):
            gone[full] = np.add.reduceat(removed, begin[full], dtype=np.int64)
            runs[full] = np.add.reduceat(starts, begin[full], dtype=np.int64)
        kept_bytes = np.frombuffer(b"".join(texts), np.uint8)[~removed].tobytes()
        ends = np.cumsum(size - gone)
        rows = []
        for doc, long, n, spans, end in zip(*(x.tolist() for x in (ids, size, gone, runs, ends)),
                                            strict=True):
            kept = kept_bytes[end - (long - n):end]
            rows.append((doc, long, n, spans, hashlib.sha256(kept).hexdigest(), kept))
        columns = dict(zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"),
                           list(zip(*rows, strict=True)) or [()] * 6, strict=True))
        kinds = dict(doc_id=pa.int64(), n_bytes=pa.int64(), n_removed=pa.int64(),
                     n_spans=pa.int64(), kept_sha256=pa.string(), kept=pa.binary())
        return pa.table({c.split()[0]: pa.array(columns[c.split()[0]], kinds[c.split()[0]])
                         for c in schema.split(", ")})

    return texts.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(apply, schema)


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   schema: str = DIGEST) -> DataFrame:
    """One row per document: sizes, number of removed runs and hash of what is kept.

    ``schema`` may add ``kept binary``, the remaining bytes (they need not be
    whole characters).  Null texts are empty; documents of one id don't take
    bytes from each other; rows without an id are left out; texts under 50 bytes
    stay whole.  Other columns are ignored.
    """
    spark = docs.sparkSession
    plain = docs.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = shuffle_width(spark)
    shards = max(width, -(-size // (18 * SHARD_ANCHORS)))
    parts = max(width, -(-size // GROUP_BYTES))
    stored = scratch_path(spark, "spans")
    shard_fates(send_spans(spread(plain), shards), shards).write.parquet(stored)
    part = F.pmod(F.xxhash64("doc"), F.lit(parts)).alias("part")
    fates = spark.read.parquet(stored).select("*", part)
    # Both uses of the texts read one shuffle.
    texts = plain.select("doc", "text", part).repartition(parts, "part")
    groups = max(width, -(-size // FACTOR_BYTES))
    pieces = asked_spans(texts, fates.filter(F.col("kind") != MATCHED), groups)
    partial = factor_masks(pieces).select("doc", "s", "mask", part)
    whole = fates.filter(F.col("kind") == MATCHED).select(
        "doc", "s", F.lit(-1).cast("long").alias("mask"), "part")
    return cut(texts, whole.unionByName(partial), schema)


@query("op7_longest_previous_factor_dedup")
def op7(table):
    """Repeated passages of all documents."""
    return remove_repeats(table("documents"))
