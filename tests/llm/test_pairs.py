"""N-gram join, fingerprints, repeated passages: against brute force and on edges."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import EDGE_TEXTS, by_id, prose

from gristmill.llm import imatch, lpf, ngramjoin
from gristmill.llm.batches import word_hashes
from gristmill.llm.components import components


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_components(texts, width, percent):
    sets = {d: shingles(t, width) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def edited(text, seed, share):
    draw = random.Random(seed)
    words = text.split()
    for _ in range(max(1, int(len(words) * share))):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10 ** 6)}"
    return " ".join(words)


def sharing_one_section(text, section, lows, most, draw):
    """A text of the same size class that agrees with ``text`` in this section's key alone."""
    own = ngramjoin.text_sets([text.encode()], 3)[0]
    keys = set(ngramjoin.section_keys(own, lows, most, 90)[0].tolist())
    words, at = text.split(), int(np.searchsorted(lows, len(own), "right")) - 1
    seed = np.uint64(0xD6E8FEB86659FD93 * (at + 1) & (1 << 64) - 1)
    hashes = [ngramjoin.text_sets([" ".join(words[i:i + 3]).encode()], 3)[0][0]
              for i in range(len(words) - 2)]
    count = np.uint64(most[at] + ngramjoin.SLACK)
    needed = [i for i, h in enumerate(hashes)
              if ngramjoin.mix(np.array([h]) ^ seed)[0] % count == section]
    if not needed:      # an empty section makes no key
        return None
    while True:
        parts = [f"{draw.random()}" for _ in range(len(words) - 4 * len(needed))]
        for i in needed:
            parts += [*words[i:i + 3], f"{draw.random()}"]
        other = ngramjoin.text_sets([" ".join(parts).encode()], 3)[0]
        both = keys & set(ngramjoin.section_keys(other, lows, most, 90)[0].tolist())
        if len(both) == 1 and int(np.searchsorted(lows, len(other), "right")) - 1 == at:
            return " ".join(parts)


def test_links_through_documents_that_share_little(spark):
    """All keys of a text settle with unrelated texts of its batch, one key each."""
    lows, most = ngramjoin.size_classes(90)
    text, draw = prose(77, 152, 10 ** 6), random.Random(1)
    at = int(np.searchsorted(lows, 150, "right")) - 1
    others = [sharing_one_section(text, k, lows, most, draw)
              for k in range(most[at] + ngramjoin.SLACK)]
    others = [t for t in others if t]
    batch = [(100 + i, t) for i, t in enumerate(others)] + [(500, text)]
    parts = [batch, [(0, " ".join(text.split()[:-1]))]] + [[(900 + i, prose(i, 30))] for i in range(8)]
    rows = [(k, *row) for k, part in enumerate(parts) for row in part]
    frame = spark.createDataFrame(rows, "part int, doc_id long, text string").repartitionByRange(
        len(parts), "part").drop("part")
    got = {r.doc_id: r.component_id for r in ngramjoin.jaccard_join(frame).collect()}
    assert got == {d: d if d != 500 else 0 for part in parts for d, _ in part}


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_join_equals_brute_force(spark, width, percent):
    texts, draw = {}, random.Random(width)
    for family in range(16):
        base = prose(family, draw.choice([2, 5, 9, 10, 11, 12, 20, 40, 150, 600]))
        for _ in range(draw.randrange(1, 6)):
            texts[len(texts)] = edited(base, len(texts), draw.choice([0, 0.002, 0.01, 0.03]))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in ngramjoin.jaccard_join(
        frame, width=width, percent=percent).collect()}
    assert got == brute_components(texts, width, percent)


def test_join_links_a_nine_and_a_ten_shingle_set(spark):
    words = prose(5, 12).split()
    frame = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:-1]))],
                                  "doc_id long, text string")
    assert {r["component_id"] for r in ngramjoin.jaccard_join(frame).collect()} == {1}


def test_join_edges(edge_docs, no_docs):
    assert ngramjoin.jaccard_join(no_docs).count() == 0
    got = by_id(ngramjoin.jaccard_join(edge_docs).collect())
    want = brute_components({i * 3: t for i, t in enumerate(EDGE_TEXTS)}, 3, 90)
    assert {d: (r[0]["n_shingles"], r[0]["component_id"]) for d, r in got.items()} == want
    assert len(got[18]) == 2 and got[0][0]["n_shingles"] == 0


def test_large_families_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "FAMILY_SHINGLES", 600)
    base = prose(1, 100)
    texts = {i: edited(base, i, 0.01) for i in range(30)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in ngramjoin.jaccard_join(frame).collect()}
    assert got == brute_components(texts, 3, 90)


def test_tree_bound_never_loses_a_link():
    draw = np.random.default_rng(3)
    sets = []
    for _ in range(60):
        base = draw.integers(0, 2 ** 63, draw.integers(5, 400)).astype(np.uint64)
        for _ in range(3):
            keep = base[draw.random(len(base)) > draw.choice([0, 0.03, 0.08])]
            sets.append(np.unique(keep) if len(keep) else np.unique(base))
    tree = ngramjoin.CountTree(ngramjoin.count_vectors(sets))
    for q in range(len(sets)):
        found = set(tree.search(q, 90).tolist())
        assert found >= {i for i in range(len(sets)) if ngramjoin.linked(sets[q], sets[i], 90)}


def test_bit_maps_never_lose_a_link():
    draw = np.random.default_rng(4)
    sets = []
    for size in (1, 9, 31, 33, 63, 70, 128, 140, 250, 500):
        base = np.unique(draw.integers(0, 2 ** 63, size).astype(np.uint64) * np.uint64(2))
        sets += [base, base[:-1] if size > 1 else base, base[draw.random(len(base)) > 0.12]]
    sets = [s for s in sets if len(s)]
    maps = [ngramjoin.bit_map(s) for s in sets]
    assert len({len(m) for m in maps}) > 2
    for percent in (80, 90, 100):
        for q in range(len(sets)):
            for i in range(q):
                got = ngramjoin.map_links(
                    np.array([q, i]), np.array([len(sets[q]), len(sets[i])]),
                    ngramjoin.even_maps([maps[q], maps[i]]), percent)
                assert got or not ngramjoin.linked(sets[q], sets[i], percent)


@pytest.mark.parametrize("most", [16_000_000, 3_000])
def test_a_family_by_chance_is_parted_before_texts_travel(spark, monkeypatch, most):
    monkeypatch.setattr(ngramjoin, "MAP_SHINGLES", most)
    texts = {i: prose(i, 100 + i) for i in range(40)}
    texts |= {100 + i: edited(texts[i], i, 0.01) for i in (3, 20)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    points = ngramjoin.set_points(frame, 3)
    members = points.selectExpr("doc_id", "0L as family", "n")
    found = ngramjoin.family_parts(members, points, 90).collect()
    assert {frozenset(r) for r in found} == {frozenset((3, 103)), frozenset((20, 120))}


def test_sets_in_which_much_may_differ_must_share_more_sections():
    """A few common passages do not bring long texts together; linked ones share what they need."""
    lows, most = ngramjoin.size_classes(80)
    draw = np.random.default_rng(3)
    own = np.unique(draw.integers(0, 1 << 63, 1_000, dtype=np.uint64))
    common = own[:250]
    other = np.unique(np.append(common, draw.integers(0, 1 << 63, 750, dtype=np.uint64)))
    near = np.unique(np.append(own[:-100], draw.integers(0, 1 << 63, 100, dtype=np.uint64)))
    (mine, need), (chance, _), (copy, least) = (
        ngramjoin.section_keys(s, lows, most, 80) for s in (own, other, near))
    assert ngramjoin.linked(own, near, 80) and not ngramjoin.linked(own, other, 80)
    assert len(np.intersect1d(mine, copy)) >= max(need, least)
    assert 4 * need >= most[int(np.searchsorted(lows, len(own), "right")) - 1] // 2
    assert len(np.intersect1d(mine, chance)) < need


def test_maps_part_sets_as_whole_ones_do():
    draw = np.random.default_rng(7)
    sets = [np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            for n in draw.integers(300, 700, 120)]
    sets += [np.unique(np.append(s[20:], draw.integers(0, 1 << 63, 15, dtype=np.uint64)))
             for s in sets[:30]]
    sizes, maps = np.array([len(s) for s in sets]), ngramjoin.even_maps(
        [ngramjoin.bit_map(s) for s in sets])
    apart = np.bitwise_count(maps[:, :, None] ^ maps[:, None]).sum(0, dtype=np.int64)
    may = (180 * apart <= 20 * (sizes + sizes[:, None])) & (
        100 * np.minimum(sizes, sizes[:, None]) >= 80 * np.maximum(sizes, sizes[:, None]))
    visitor, side = sizes >= 500, np.arange(len(sets)) % 2
    for seen, sides, given in ((may, None, None), (may & (side != side[:, None]), side, None),
                               (may & ~(visitor & visitor[:, None]), None, visitor)):
        want = {frozenset((a, b)) for a, b in zip(*np.nonzero(seen), strict=True) if a < b}
        found = {frozenset(p) for p in ngramjoin.map_links(
            np.arange(len(sets)), sizes, maps, 80, sides, given)}
        assert found <= want and components_of(found) == components_of(want)


def components_of(pairs):
    groups = []
    for pair in pairs:
        joined = [g for g in groups if g & pair]
        groups = [g for g in groups if not g & pair] + [frozenset(pair).union(*joined)]
    return set(groups)


def test_only_texts_that_may_link_travel(spark, monkeypatch):
    """Every text is made of lines that others have too, so that all share many sections."""
    draw, lines = random.Random(5), [prose(i, 12) for i in range(24)]
    texts = {i: " ".join(draw.sample(lines, 12)) for i in range(60)}
    texts[60] = texts[7] + " end"
    sent, links = [], ngramjoin.family_links

    def seen(dealt, width, percent):
        sent.extend(r["doc_id"] for r in dealt.select("doc_id").distinct().collect())
        return links(dealt, width, percent)

    monkeypatch.setattr(ngramjoin, "family_links", seen)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in ngramjoin.jaccard_join(frame).collect()}
    assert got == brute_components(texts, 3, 90)
    assert sorted(sent) == [7, 60]


def test_words_are_split_at_ascii_white_space():
    texts = [b"a b\x0bc\x1fd\x85e", b"", b" \n", b"a", b"b c"]
    hashes, offsets = word_hashes(texts)
    assert list(np.diff(offsets)) == [3, 0, 0, 1, 2]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[4]
    assert list(np.diff(offsets)) == [len(t.split()) for t in texts]


def test_components_equal_brute_force(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)]
    edges += [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["component"] for r in components(frame).collect()}
    alone = {a for a, b in edges if a == b}
    assert got == {x: root(x) for x in parent if x not in alone or x in got}
    assert components(frame.limit(0)).count() == 0


def brute_repeats(texts, window=50):
    seen, out = {}, {}
    for doc in sorted(texts):
        body = (texts[doc] or "").encode()
        gone = bytearray(len(body))
        own = [body[i:i + window] for i in range(len(body) - window + 1)]
        for i, w in enumerate(own):
            if w in seen:
                gone[i:i + window] = b"\1" * window
        for w in own:
            seen[w] = doc
        kept = bytes(c for c, g in zip(body, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(body), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def repeats(frame):
    rows = lpf.remove_repeats(frame).collect()
    return {r[0]: tuple(r[1:]) for r in rows}, len(rows)


def test_repeats_equal_brute_force(spark):
    draw, texts = random.Random(4), {}
    passages = [prose(i + 100, 12) for i in range(8)] + ["\n" * 60, "ab" * 40, "q" * 70]
    for doc in range(60):
        parts = [prose(doc, draw.randrange(0, 40), 50)]
        for _ in range(draw.randrange(4)):
            p = draw.choice(passages)
            parts.append(p[draw.randrange(8):len(p) - draw.randrange(8)])
            parts.append(prose(draw.randrange(1000), draw.randrange(6), 50))
        texts[doc] = draw.choice(["", " "]).join(parts)
    texts[70], texts[71] = texts[3], texts[3]
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert repeats(frame)[0] == brute_repeats(texts)


def test_hot_anchors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lpf, "HOT", 3)
    line = "This common line stands in every single document of them all."
    texts = {i: f"{prose(i, 5)} {line} {prose(i + 500, 5)}" for i in range(40)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert repeats(frame)[0] == brute_repeats(texts)


def test_repeats_edges(edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(lpf, "PIECE", 5000)
    assert lpf.remove_repeats(no_docs).count() == 0
    got, rows = repeats(edge_docs)
    assert got == brute_repeats({i * 3: t for i, t in enumerate(EDGE_TEXTS)})
    assert rows == edge_docs.count()


def test_longest_previous_factors_equal_brute_force():
    draw = random.Random(9)
    for depth in (3, 7, 50):
        codes = np.array([draw.randrange(1, 4) for _ in range(150)])
        owner = np.sort(np.array([draw.randrange(12) for _ in range(150)]))
        got = lpf.longest_previous_factors(codes, owner, depth)
        for i in range(len(codes)):
            best = 0
            for j in range(len(codes)):
                if owner[j] < owner[i]:
                    n = 0
                    while n < depth and max(i, j) + n < len(codes) and codes[i + n] == codes[j + n]:
                        n += 1
                    best = max(best, n)
            assert got[i] == best


def test_nearest_smaller_equals_brute_force(monkeypatch):
    draw = random.Random(2)
    shapes = [[draw.randrange(9) for _ in range(200)], [0] * 70, list(range(90)) + [0] * 3,
              list(range(90, 0, -1)), list(range(60)) + [30, 5, 5, 0], [4], []]
    for steps in (0, 1, lpf.STEPS):
        monkeypatch.setattr(lpf, "STEPS", steps)
        for values in shapes:
            want = [max((j for j in range(i) if values[j] < values[i]), default=-1)
                    for i in range(len(values))]
            assert lpf.nearest_smaller(np.array(values, np.int32)).tolist() == want


def test_spans_do_not_depend_on_blocks(monkeypatch):
    texts = [prose(i, i * 7).encode() for i in range(40)] + [b"", b"a. b\n" * 90]

    def spans():
        return sorted((int(index[p]), int(at[p] + f), int(n), int(s))
                      for index, at, x in lpf.text_spans(texts, lpf._powers())
                      for p, f, n, s in zip(x.piece, x.first, x.count, x.s, strict=True))

    whole = spans()
    monkeypatch.setattr(lpf, "BLOCK", 700)
    assert spans() == whole and len(list(lpf.text_spans(texts, lpf._powers()))) > 10


def test_wanted_spans_are_found_by_document_and_span():
    table = pa.table({"doc": [5, 5, 2, 5], "s": [9, 7, 7, 9], "mask": [1, -1, 4, 2]})
    wanted = lpf.Wanted(table, "mask")
    at, row = wanted.find(np.array([5, 2, 2, 3, 5, 5]), np.array([9, 9, 7, 7, 8, 7]))
    assert at.tolist() == [0, 2, 5] and wanted.bits[row].tolist() == [3, 4, -1]
    assert wanted.has(np.array([2, 3, 6])).tolist() == [True, False, False]


def brute_edited(texts):
    ids = sorted(texts)
    out = {}
    for i, doc in enumerate(ids):
        own, following = texts[doc] or "", texts[ids[(i + 1) % len(ids)]] or ""
        part = len(own) // 4
        body = own[:len(own) - part] + following[:part]
        out[doc] = (len(own), hashlib.sha256(body.encode()).hexdigest())
    return out


def test_fingerprints(documents):
    rows = imatch.compared(documents).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in rows} == brute_edited(texts)
    prints = {}
    for r in rows:
        prints.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    assert all(len(p) == 1 for p in prints.values())
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows]) > 0.9
    plain = imatch.fingerprints(documents).collect()
    assert {r[0]: r[1] for r in plain} == {r["doc_id"]: r["fingerprint"] for r in rows}


def test_fingerprint_edges(edge_docs, no_docs):
    assert imatch.compared(no_docs).count() == 0
    rows = imatch.compared(edge_docs.dropDuplicates(["doc_id"])).collect()
    texts = {i * 3: t for i, t in enumerate(EDGE_TEXTS)}
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in rows} == brute_edited(texts)
    found = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert found[18] == found[21] == found[24] and found[0] == found[3]
    assert imatch.compared(edge_docs).count() == edge_docs.count()


def test_every_lexicon_term_counts(spark):
    frame = spark.createDataFrame([(i, f"word{i // 2}") for i in range(400)],
                                  "doc_id long, text string")
    rows = sorted(imatch.compared(frame).collect())
    prints = [r["fingerprint"] for r in rows]
    assert prints[::2] == prints[1::2] and len(set(prints)) == 200
    assert not any(set(p.split(".")) == {"0"} for p in prints)
    assert all(r["near_next"] == (r["doc_id"] % 2 == 0) for r in rows)


def test_lexicon_band(spark):
    frame = spark.createDataFrame([(i, f"always often{i % 5} once{i}") for i in range(100)],
                                  "doc_id long, text string")
    words = [int(w) for w in imatch.lexicon(frame, band=(1.0, 4.0)).split(",")]
    assert sum(bin(w & (1 << 64) - 1).count("1") for w in words) == 5
