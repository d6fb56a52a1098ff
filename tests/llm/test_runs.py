"""Runs of words: against brute force, on edges, and the registered query."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import EDGE_TEXTS, SF, by_id

from gristmill.llm import runs
from gristmill.llm.registry import all_queries


def brute_runs(words, power=4, least=6):
    """By definition: all longest stretches for every period, smallest period of each."""
    known = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    found = {}
    for period in range(1, len(ids) // power + 1):
        same = np.concatenate([[False], ids[period:] == ids[:-period], [False]])
        edges = np.flatnonzero(np.diff(same.astype(np.int8)))
        for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if last - first >= (power - 1) * period:
                found.setdefault((first, last + period), period)
    return sorted((s, e - s, p) for (s, e), p in found.items() if e - s >= max(least, power * p))


def brute_collapsed(words, found):
    drop = set()
    for start, length, period in found:
        drop.update(range(start + period, start + length))
    return b" ".join(w for i, w in enumerate(words) if i not in drop)


def edited(doc_id, text):
    words = (text or "").encode().split()
    hashed = zlib.crc32(str(doc_id).encode())
    if hashed % 10 == 0 and words:
        n, g = len(words), hashed // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(doc_id, text):
    words = edited(doc_id, text)
    found = brute_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join("%d,%d,%d\n" % r for r in found)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *head, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(brute_collapsed(words, found)).hexdigest())


def random_text(draw):
    words = []
    for _ in range(draw.randrange(1, 12)):
        part = [draw.choice("ab" if draw.random() < 0.5 else "abcdefgh")
                for _ in range(draw.randrange(1, 40))]
        words += part * draw.choice([1, 1, 2, 3, 4, 5, 9]) + part[:draw.randrange(len(part) + 1)]
    return " ".join(words)


@pytest.mark.parametrize("power", [2, 3, 4])
def test_random_texts_equal_brute_force(spark, power):
    draw = random.Random(power)
    texts = [random_text(draw) for _ in range(400)]
    texts += ["a " * n for n in (5, 6, 7, 500)] + ["a b " * n for n in (3, 4, 100)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in runs.find_runs(frame, power=power).collect():
        words = texts[row.doc_id].encode().split()
        want = brute_runs(words, power)
        assert [tuple(r) for r in row.runs] == want, texts[row.doc_id]
        assert row.collapsed.encode() == brute_collapsed(words, want)
        assert row.n_words == len(words)


def test_slices_of_catchers_lose_nothing(monkeypatch):
    draw = random.Random(9)
    ids = np.array([-1] + [draw.randrange(2) for _ in range(3000)] + [9], np.int64) + 1
    whole = runs.squares(ids, 3000, 2)
    monkeypatch.setattr(runs, "PAIRS", 64)
    assert all((a == b).all() for a, b in zip(whole, runs.squares(ids, 3000, 2)))
    assert len(whole[0]) > 1000


def test_long_repetitions_stay_cheap():
    for period in (1, 7, 3000):
        ids = np.concatenate([[10_000], np.arange(300_000) % period, [10_001]])
        found = [x.tolist() for x in runs.squares(ids, 300_000, 4)]
        assert found == [[1], [300_001], [period]]


def test_query_equals_brute_force(spark, documents):
    got = {r[0]: tuple(r)[1:] for r in all_queries()["op11_periodic_runs"](spark, SF).collect()}
    want = {r.doc_id: expected(r.doc_id, r.text) for r in documents.collect()}
    assert got == want
    assert any(zlib.crc32(str(d).encode()) % 10 == 0 and v[0] for d, v in want.items())


def test_edges(spark, edge_docs, no_docs, tmp_path):
    edge_docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = all_queries()["op11_periodic_runs"](spark, str(tmp_path)).collect()
    texts = {i * 3: t for i, t in enumerate(EDGE_TEXTS)}
    assert len(rows) == len(EDGE_TEXTS) + 2
    for doc_id, found in by_id(rows).items():
        assert all(tuple(r)[1:] == expected(doc_id, texts[doc_id]) for r in found)
    assert runs.find_runs(no_docs).collect() == []
    nothing = spark.createDataFrame([(None, "a a a a a a"), (None, None)], "doc_id long, text string")
    nothing.write.parquet(f"{tmp_path}/none/documents.parquet")
    rows = all_queries()["op11_periodic_runs"](spark, f"{tmp_path}/none").collect()
    assert sorted((r.doc_id, r.n_runs, r.length) for r in rows if r.n_runs) == [(None, 1, 6)]
    assert len(rows) == 2
    with pytest.raises(ValueError):
        runs.find_runs(no_docs, power=1)
