"""N-gram Jaccard join by a count-vector R-tree.

A document's set holds the hashes of its distinct word shingles.  The hashes
are dealt into groups and the group counts make the document a point; the sum
of coordinate minima bounds the overlap of two sets from above, for points as
for the upper corners of R-tree boxes.

One R-tree over all points cannot be cut into tasks well: two near copies are
much closer than unrelated texts, but only over many coordinates, so boxes on a
few of them overlap.  The directory level is therefore a set of finer group
systems, one per size class: linked sets differ in at most ``D`` shingles, so
of ``D + slack`` sections ``slack`` agree in full.  Documents that share enough
section contents with others are brought together by equality joins; what hangs
together is one family.  Chance agreement can join many unrelated sets to one
family, so each family is first parted by bit maps of the sets: bits in which two
maps differ are a lower bound of the shingles in which the sets do.  The maps
grow with the sets and are a small part of the texts.  Inside the parts an
R-tree prunes by its bound and the surviving pairs are verified on the sets
themselves, the only step for which texts travel.  All steps are exact (64-bit
hashes).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.batches import byte_texts, chunks, map_batches, mix, signed, spread, word_hashes
from gristmill.llm.components import components, mark_likely
from gristmill.llm.registry import query
from gristmill.session import cut_lineage, scratch_path, shuffle_width

GROUPS = 64               # coordinates of a point
LEAF = 16                 # points in an R-tree leaf
FAMILY_SHINGLES = 4_000_000   # sets handled by one task; larger families are cut in blocks
MAP_SHINGLES = 16_000_000     # the same where bit maps stand for the sets
MAP_BITS = 2                  # bits of a map for each shingle, at least
PAIR_SECTIONS = 8         # up to so many differences, keys are pairs of sections
PAIR_SLACK, SLACK = 4, 12     # sections that linked sets agree in at least
SHARE, MOST_SLACK = 4, 8000   # where many may differ, one for so many of those, as fits 16 bits
POINT = "doc_id long, n long, d1 long, d2 long, bits binary"


def text_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each lower-cased text."""
    words, offsets = word_hashes(texts)
    sets = []
    for i in range(len(texts)):
        own = words[offsets[i]:offsets[i + 1]]
        if len(own) >= width:
            joined = own[:len(own) - width + 1]
            for k in range(1, width):
                joined = mix(joined) + own[k:len(own) - width + 1 + k]
            sets.append(np.unique(mix(joined)))
        elif len(own):      # shorter texts: the whole sequence as one shingle
            joined = np.uint64(len(own)) * np.ones(1, np.uint64)
            for word in own:
                joined = mix(joined) + word
            sets.append(mix(joined ^ np.uint64(0x5851F42D4C957F2D)))
        else:
            sets.append(own)
    return sets


def size_classes(percent: int) -> tuple[list[int], list[int]]:
    """Lower bounds of the size classes and the differences possible in each.

    ``percent * union <= 100 * intersection`` allows a symmetric difference of
    at most ``(|A| + |B|) * (100 - percent) / (100 + percent)``.
    """
    lows = [1]
    while lows[-1] < 1 << 40:
        first = 100 // max(100 - percent, 1)    # smaller sets link only when equal
        lows.append(first if len(lows) == 1 and first > 1 else lows[-1] * 3 // 2 + 1)
    return lows, [2 * (high - 1) * (100 - percent) // (100 + percent) for high in lows[1:]]


def section_keys(own: np.ndarray, lows: list[int], most: list[int],
                 percent: int) -> tuple[np.ndarray, int]:
    """Keys by which linked sets meet, and how many of them linked sets share at least.

    A key is the content of a section, or of a pair of sections where one is a
    large part of a small set.  Empty sections make no key, so each lowers what
    linked sets must share, unless a set has so many that linked sets might
    agree in nothing else.  A set near the upper bound of its class also has
    keys of the next class; the smaller need then counts.
    """
    n = len(own)
    at = int(np.searchsorted(lows, n, "right")) - 1
    keys, need = [], []
    for k in (at, at + 1):
        if k > at and 100 * n < percent * lows[k]:
            break
        if most[k] < 1:
            continue
        paired = most[k] <= PAIR_SECTIONS
        slack = PAIR_SLACK if paired else max(SLACK, min(most[k] // SHARE, MOST_SLACK))
        count = most[k] + slack
        seed = np.uint64(0xD6E8FEB86659FD93 * (k + 1) & (1 << 64) - 1)
        dealt = mix(own ^ seed)
        section = (dealt % np.uint64(count)).astype(np.int64)
        low = np.bincount(section, (dealt & np.uint64(0xFFFFFFFF)).astype(float), count)
        high = np.bincount(section, (dealt >> np.uint64(32)).astype(float), count)
        content = mix(low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32)))
        filled = np.bincount(section, minlength=count) > 0
        named = mix(content + np.arange(1, count + 1, dtype=np.uint64) * seed)
        empty = int(np.count_nonzero(~filled))
        if paired:
            a, b = np.triu_indices(count, 1)
            pairs = mix(named[a]) + named[b]
            keys.append(mix(pairs[filled[a] | filled[b]] if empty < slack else pairs))
            whole = slack * (slack - 1) // 2
            need.append(whole - empty * (empty - 1) // 2 if empty < slack else whole)
        else:
            keys.append(named[filled] if empty < slack else named)
            need.append(slack - empty if empty < slack else slack)
    if not keys:
        return np.empty(0, np.uint64), 0
    return np.unique(np.concatenate(keys)), min(need)


def set_points(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, d1, d2, bits``: set size, two digests and the bit map of the set."""
    def points(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = batch.column(0)
        texts = [t.lower() for t in byte_texts(batch.column(1))]
        for start, end in chunks(texts):
            rows = text_sets(texts[start:end], width)
            yield {"doc_id": ids.slice(start, end - start),
                   "n": np.array([len(s) for s in rows], np.int64),
                   "d1": signed(np.array([mix(s).sum(dtype=np.uint64) for s in rows], np.uint64)),
                   "d2": signed(np.array([mix(~s).sum(dtype=np.uint64) for s in rows], np.uint64)),
                   "bits": pa.array([bit_map(s) for s in rows], pa.binary())}

    return map_batches(docs, points, POINT)


ALONE, LOCAL, SETTLED = 0, 1, 2


def shared_keys(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b, need`` per document ``a`` and key that several have; ``b`` has it too.

    ``b`` is the smallest id with the key, or that of the same batch.
    Of equal texts in a batch only the smallest id has keys.  Each batch
    forwards a key once, for its smallest id; the other documents of the batch
    that have it are settled at once and need not travel with the key, so a key
    that very many documents have is thinned out before the shuffle.  After it,
    rows are sorted by key and only compared with their neighbours.
    """
    lows, most = size_classes(percent)

    def forward(batch: pa.RecordBatch) -> Iterator[dict]:
        heads: dict[bytes, int] = {}
        for doc, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
            text = text.lower()
            heads[text] = min(doc, heads.get(text, doc))
        texts, found = list(heads), []
        for start, end in chunks(texts):
            for text, own in zip(texts[start:end], text_sets(texts[start:end], width), strict=True):
                if len(own):
                    keys, need = section_keys(own, lows, most, percent)
                    found.append((keys, heads[text], need))
        if not found:
            return
        counts = [len(k) for k, _, _ in found]
        keys = signed(np.concatenate([k for k, _, _ in found]))
        docs = np.repeat(np.array([d for _, d, _ in found], np.int64), counts)
        need = np.repeat(np.array([n for _, _, n in found], np.int16), counts)
        order = np.lexsort([docs, keys])
        keys, docs, need = keys[order], docs[order], need[order]
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        again = np.zeros(len(keys), bool)
        again[:-1] = first[:-1] & ~first[1:]
        tag = np.where(first, np.where(again, LOCAL, ALONE), SETTLED).astype(np.int8)
        # A settled row carries the id it is settled with in place of the key.
        center = docs[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
        yield {"key": np.where(first, keys, center), "doc_id": docs,
               "tag": (need * 4 + tag).astype(np.int16)}

    def meet(batches):
        held = None         # last forwarded row: key, id, center, need, and whether it is shared
        for batch in batches:
            key, doc, tag = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            need, tag = tag // 4, tag % 4
            settled = tag == SETTLED
            out = [(doc[settled], key[settled], need[settled])]
            key, doc, need, tag = key[~settled], doc[~settled], need[~settled], tag[~settled]
            if len(key):
                same = key[1:] == key[:-1]
                first = np.append(True, ~same)
                center = doc[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
                keep = tag == LOCAL
                keep[1:] |= same
                keep[:-1] |= same
                if held:
                    if meets := bool(held[0] == key[0]):
                        center[key == key[0]] = held[2]
                        keep[0] = True
                    if held[4] or meets:
                        out.append(tuple(np.array([x]) for x in held[1:4]))
                out.append(tuple(x[:-1][keep[:-1]] for x in (doc, center, need)))
                held = (key[-1], doc[-1], center[-1], need[-1], bool(keep[-1]))
            yield rows(*(np.concatenate(x) for x in zip(*out, strict=True)))
        if held and held[4]:
            yield rows(*(np.array([x]) for x in held[1:4]))

    def rows(a, b, need):
        return pa.RecordBatch.from_pydict({
            "a": a.astype(np.int64), "b": b.astype(np.int64), "need": need.astype(np.int32)})

    sent = map_batches(docs, forward, "key long, doc_id long, tag short")
    route = F.when(F.col("tag") % 4 == SETTLED, F.xxhash64("key", "doc_id")).otherwise(F.col("key"))
    dealt = sent.repartition(shuffle_width(docs.sparkSession), route)
    return dealt.sortWithinPartitions("key", "doc_id").mapInArrow(
        meet, "a long, b long, need int")


def count_vectors(sets: list[np.ndarray]) -> np.ndarray:
    """Points: how many shingles of each set fall into each group."""
    shift = np.uint64(64 - GROUPS.bit_length() + 1)
    return np.stack([np.bincount((s >> shift).astype(np.int64), minlength=GROUPS) for s in sets])


def bit_map(own: np.ndarray) -> bytes:
    """Which groups the shingles of a set fall in, for as many groups as its size asks for."""
    power = max(6, (MAP_BITS * len(own) - 1).bit_length())
    filled = np.zeros(1 << power, bool)
    filled[(own >> np.uint64(64 - power)).astype(np.int64)] = True
    return np.packbits(filled).tobytes()


def even_maps(maps: list[bytes]) -> np.ndarray:
    """Maps of equal width as columns of 64-bit words: finer ones join neighbouring groups."""
    width = min(map(len, maps))
    even = [m if len(m) == width else np.packbits(np.unpackbits(np.frombuffer(
        m, np.uint8)).reshape(8 * width, -1).any(1)).tobytes() for m in maps]
    return np.ascontiguousarray(np.frombuffer(b"".join(even), np.uint64).reshape(len(maps), -1).T)


class CountTree:
    """Bulk-loaded R-tree over count vectors: two levels of boxes above the points.

    Points are sorted by total and then by coordinates, and packed.  A box
    keeps its largest coordinates and totals; ``sum(min(q, high))`` is an upper
    bound for the overlap with anything inside.
    """

    def __init__(self, points: np.ndarray):
        self.points, self.total = points, points.sum(1)
        spread_by = np.argsort(-points.var(0), kind="stable")[:3]
        self.order = np.lexsort([*points[:, spread_by].T[::-1], self.total])
        self.leaves = self._boxes(points[self.order], self.total[self.order],
                                  self.total[self.order])
        self.nodes = self._boxes(*self.leaves)

    @staticmethod
    def _boxes(high: np.ndarray, least: np.ndarray, most: np.ndarray):
        cuts = np.arange(0, len(high), LEAF)
        return (np.maximum.reduceat(high, cuts), np.minimum.reduceat(least, cuts),
                np.maximum.reduceat(most, cuts))

    def search(self, q: int, percent: int) -> np.ndarray:
        """Points whose overlap bound with point ``q`` reaches the threshold."""
        point, size = self.points[q], self.total[q]

        def passing(high, least, most):
            # 100 * overlap >= percent * union, with union = size + other - overlap
            bound = np.minimum(point, high).sum(1)
            return ((100 + percent) * bound >= percent * (size + least)) & (
                100 * most >= percent * size) & (100 * size >= percent * least)

        def inside(chosen, count):
            return (chosen[:, None] * LEAF + np.arange(LEAF)).ravel(), count

        level, _ = inside(np.flatnonzero(passing(*self.nodes)), 0)
        level = level[level < len(self.leaves[0])]
        level = level[passing(*(x[level] for x in self.leaves))]
        rows, _ = inside(level, 0)
        rows = self.order[rows[rows < len(self.order)]]
        return rows[passing(self.points[rows], self.total[rows], self.total[rows])]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def tree_links(ids: np.ndarray, sets: list[np.ndarray], percent: int,
               side: np.ndarray | None = None,
               visitor: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that span the components among the sets.

    A pair already connected through others adds nothing and is not verified,
    so a group of copies costs about one verification per member.  With
    ``side``, only pairs of different sides are looked at, with ``visitor`` no
    pairs of two visitors.
    """
    tree, parent, links = CountTree(count_vectors(sets)), list(range(len(sets))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for q in range(len(sets)):
        found = tree.search(q, percent)
        for other in found[found < q]:
            if side is not None and side[other] == side[q]:
                continue
            if visitor is not None and visitor[other] and visitor[q]:
                continue
            if root(q) != root(other) and linked(sets[q], sets[other], percent):
                parent[root(q)] = root(other)
                links.append((int(ids[q]), int(ids[other])))
    return links


def map_links(ids: np.ndarray, sizes: np.ndarray, maps: np.ndarray, percent: int,
              side: np.ndarray | None = None,
              visitor: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs that span the components of all pairs whose bit maps let them link.

    ``side`` and ``visitor`` as in :func:`tree_links`; visitors are no smaller than
    the others.  A group of n sets that all may link gives n - 1 pairs.  Each set is
    compared with those of its size and above, as far as sizes may link, first on
    as many words of the maps as it takes to part most sets that have nothing in common.
    """
    # Visitors come last and ask nothing.
    order = np.argsort(sizes, kind="stable") if visitor is None else np.lexsort([sizes, visitor])
    ids, sizes = ids[order], sizes[order]
    side = None if side is None else side[order]
    asking = len(ids) if visitor is None else len(ids) - np.count_nonzero(visitor)
    ends = np.searchsorted(sizes, 100 * sizes // percent, "right")
    most = (100 - percent) * sizes
    # Bits of a word in which unrelated sets differ, and those that linked sets may differ in.
    filled = np.bitwise_count(maps).mean() / 64
    allowed = 2 * np.quantile(most, 0.9) / (100 + percent)
    first_words = int(min(1.2 * allowed / max(128 * filled * (1 - filled), 1) + 1, len(maps)))
    few, rest = (np.ascontiguousarray(part[:, order]) for part in np.split(maps, [first_words]))
    label, links = np.arange(len(ids)), []
    narrow = np.uint16 if len(maps) < 1024 else np.int64

    def apart(part: np.ndarray, q: int, others) -> np.ndarray:
        bits = np.bitwise_count(part[:, others] ^ part[:, q:q + 1])
        return (100 + percent) * np.add.reduce(bits, 0, dtype=narrow).astype(np.int64)

    for q in range(asking):
        later = slice(q + 1, ends[q])
        lower = apart(few, q, later)
        found = np.flatnonzero((lower <= most[later] + most[q]) & (label[later] != label[q]))
        if len(found):
            lower, found = lower[found], found + q + 1
            found = found[lower + apart(rest, q, found) <= most[found] + most[q]]
        if side is not None:
            found = found[side[found] != side[q]]
        if len(found):
            others, first = np.unique(label[found], return_index=True)
            links += [(int(ids[q]), int(ids[other])) for other in found[first]]
            label[np.isin(label, others)] = label[q]
    return links


def family_cells(members: DataFrame, percent: int, most: int | None = None) -> DataFrame:
    """``doc_id, family, n`` -> cells of documents that may link: ``family, level, x, y``.

    Sizes of linked sets are at most a factor 100 / percent apart, so their levels
    (logarithms to that base) differ by one at most.  A cell holds the documents
    of its level and, as visitors, those of the next; without a pair to look at
    there is no cell.  A cell whose sets exceed ``most`` shingles, by default
    ``FAMILY_SHINGLES``, is cut into blocks by hash, and one task handles each
    pair of blocks.
    """
    # A little less than the logarithm, so rounding never parts levels by two.
    level = F.col("n") if percent == 100 else F.floor(
        F.log(F.col("n").cast("double")) / math.log(100 / percent) * (1 - 1e-9))
    cells = members.withColumn("level", level.cast("long")).select(
        "doc_id", "family", "n", F.explode(F.array(
            F.struct(F.col("level"), F.lit(False).alias("visitor")),
            F.struct((F.col("level") - 1).alias("level"), F.lit(True).alias("visitor")))).alias("c"))
    cells = cells.select("doc_id", "family", "n", "c.level", "c.visitor")
    blocks = F.ceil(F.sum("n") / F.lit((most or FAMILY_SHINGLES) / 2)).cast("int")
    sizes = cells.groupBy("family", "level").agg(
        F.when(blocks > 2, blocks).otherwise(1).alias("blocks"), F.count("*").alias("all"),
        F.count_if(~F.col("visitor")).alias("own")).filter("own > 0 and all > 1")
    dealt = cells.join(sizes.drop("all", "own"), ["family", "level"]).withColumn(
        "own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select("doc_id", "family", "level", F.least("own", "other").alias("x"),
                        F.greatest("own", "other").alias("y"), "own", "visitor")


CELL = ("family", "level", "x", "y")


def by_cell(dealt: DataFrame):
    """Grouped by the whole cell: a partitioning by family alone would keep its blocks in one task."""
    return dealt.repartition(shuffle_width(dealt.sparkSession), *CELL).groupBy(*CELL)


def family_parts(members: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """``doc_id, family, n`` and bit maps -> ``a, b`` that span what may link inside each family."""
    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        own = table.column("own").to_numpy()
        visitor = table.column("visitor").to_numpy(zero_copy_only=False)
        crossing = table.column("x")[0].as_py() != table.column("y")[0].as_py()
        found = map_links(
            table.column("doc_id").to_numpy(), table.column("n").to_numpy(),
            even_maps(table.column("bits").to_pylist()), percent, own if crossing else None, visitor)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()),
                         "b": pa.array([b for _, b in found], pa.int64())})

    cells = family_cells(members, percent, MAP_SHINGLES)
    return by_cell(cells.join(points, "doc_id")).applyInArrow(link, "a long, b long")


def family_links(dealt: DataFrame, width: int, percent: int) -> DataFrame:
    """Cells with texts -> links ``a, b`` that span the components inside each family."""
    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, own = table.column("doc_id").to_numpy(), table.column("own").to_numpy()
        visitor = table.column("visitor").to_numpy(zero_copy_only=False)
        crossing = table.column("x")[0].as_py() != table.column("y")[0].as_py()
        texts = [t.lower() for t in byte_texts(table.column("text"))]
        sets = []
        for start, end in chunks(texts):
            sets += text_sets(texts[start:end], width)
        found = tree_links(ids, sets, percent, own if crossing else None, visitor)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()),
                         "b": pa.array([b for _, b in found], pa.int64())})

    return by_cell(dealt).applyInArrow(link, "a long, b long")


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3,
                 percent: int = 90) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Documents link when the Jaccard similarity of their shingle sets is at
    least ``percent`` / 100; ``component_id`` is the smallest id reachable.
    Null or empty texts, and texts without words, have no shingles and link
    with nothing.  Equal sets link at any size; repeated rows of one id give
    repeated rows.  Rows without an id are dropped.  Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    stored, meetings = scratch_path(spark, "points"), scratch_path(spark, "keys")
    set_points(spread(texts), width).write.parquet(stored)
    points = spark.read.parquet(stored)
    # Keys are made from the texts again: they would take more room than the texts.
    shared_keys(spread(texts), width, percent).write.parquet(meetings)
    shared = spark.read.parquet(meetings)
    # Linked sets share several keys, so a few keys in common by chance lead nowhere.
    often = shared.groupBy("a").agg(F.count("*").alias("shared"), F.min("need").alias("need")).filter(
        F.col("shared") >= F.col("need")).select("a")
    ways = shared.filter("a != b").select("a", "b")
    edges = ways.join(often, "a", "left_semi").distinct()
    # A document may be settled with one that shares little itself, whose own way to the
    # smallest id with the key is needed then.
    through = edges.select(F.col("b").alias("a")).distinct()
    edges = edges.unionByName(ways.join(through, "a", "left_semi")).distinct()
    families = components(edges).withColumnRenamed("component", "family")
    # Equal sets are one class, represented by the smallest id.
    known = points.select("doc_id", "n", "d1", "d2").filter("n > 0")
    classes = known.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("class_id"))
    heads = classes.select(F.col("class_id").alias("doc_id"), "n").dropDuplicates(["doc_id"])
    wanted = cut_lineage(families.withColumnRenamed("id", "doc_id").join(heads, "doc_id"))
    # An id with several texts has all their maps.
    maps = points.dropDuplicates(["doc_id", "d1", "d2"]).select("doc_id", "n", "bits")
    parts = components(family_parts(wanted, maps, percent)).withColumnRenamed("component", "family")
    wanted = cut_lineage(parts.withColumnRenamed("id", "doc_id").join(heads, "doc_id"))
    cells = cut_lineage(family_cells(wanted, percent))
    nearly = mark_likely(texts, cells, "doc_id").filter("_likely").drop("_likely")
    found = components(family_links(
        cells.join(nearly.dropDuplicates(["doc_id"]), "doc_id"), width, percent))
    rows = points.select("doc_id", "n", "d1", "d2").join(classes, ["d1", "d2", "n"], "left")
    return rows.join(found.withColumnRenamed("id", "class_id"), "class_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "class_id", "doc_id").alias("component_id"))


@query("op10_ngram_jaccard_join")
def op10(table):
    """Near copies among all documents: 3-word shingles, similarity 0.9 or more."""
    return jaccard_join(table("documents"))
