"""Decontamination, mixing and the pipeline."""

import random
from fractions import Fraction

import pytest
from conftest import SF, by_id, prose

import corpus_pipeline
from gristmill.llm import decontaminate, langid, ngramjoin, pfair, pii


def distance_anywhere(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        previous, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (p != t))
    return min(row)


def test_myers_equals_dynamic_programming():
    draw = random.Random(1)
    for _ in range(150):
        pattern = "".join(draw.choice("abc ") for _ in range(draw.randrange(1, 90)))
        text = "".join(draw.choice("abc ") for _ in range(draw.randrange(0, 120)))
        best, end = decontaminate.myers(decontaminate.places(pattern), len(pattern), text)
        assert best == distance_anywhere(pattern, text)
        assert 0 <= end <= len(text)


def test_matches_equal_brute_force(spark):
    draw = random.Random(5)
    items = [(i, prose(i + 50, 20)) for i in range(6)]
    docs = []
    for doc in range(40):
        body = prose(doc, 30)
        if doc % 2:
            passage = list(draw.choice(items)[1])
            for _ in range(draw.randrange(0, 12)):
                at = draw.randrange(len(passage))
                passage[at:at + 1] = draw.choice(["", "z", passage[at] + "y"])
            body = f"{body} {''.join(passage).upper()}!! {prose(doc + 900, 10)}"
        docs.append((doc, body))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    held = decontaminate.contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): r["errors"] for r in held.collect()}
    want = {}
    for doc, body in docs:
        for item, text in items:
            pattern = decontaminate.normalised(text)
            errors = distance_anywhere(pattern, decontaminate.normalised(body))
            if errors <= len(pattern) // decontaminate.CHARS_PER_ERROR:
                want[doc, item] = errors
    assert got.keys() == want.keys() and len(want) > 5
    assert all(got[k] == want[k] for k in want)


def test_large_benchmarks_take_several_passes(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i, 40)) for i in range(12)], "doc_id long, text string")
    items = spark.createDataFrame([(i, prose(i, 30)) for i in range(0, 12, 2)],
                                  "item_id long, text string")
    once = sorted(decontaminate.contaminated(docs, items).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 200)
    assert sorted(decontaminate.contaminated(docs, items).collect()) == once and len(once) == 6


def test_decontamination_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "!!!"), (4, prose(1, 60)), (4, prose(1, 60))],
                                  "item_id long, text string")
    got = decontaminate.contaminated(edge_docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(d, 4) for d in (18, 21, 24)}
    kept = decontaminate.clean(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 5
    assert decontaminate.contaminated(no_docs, items).count() == 0
    assert decontaminate.clean(edge_docs, items.limit(0)).count() == edge_docs.count()


@pytest.mark.parametrize("sizes, weights", [
    ({"a": 400, "b": 100, "c": 30}, {"a": 1, "b": 1, "c": 1}),
    ({"a": 50, "b": 5000}, {"a": 0.9, "b": 0.1}),
    ({s: 20 + s for s in range(30)}, {s: 1 + s % 7 for s in range(30)}),
    ({"only": 7}, {"only": 3})])
def test_schedule_stays_within_one_block(sizes, weights):
    rows = pfair.schedule(sizes, weights)
    slots = {}
    for source, first, until, base, per, period, places in rows:
        for j in range(first, until):
            inside = j - first
            slots[base + inside // per * period + places[inside % per]] = (source, j)
    assert sorted(slots) == list(range(sum(sizes.values())))
    seen = dict.fromkeys(sizes, 0)
    # Every phase starts where a source has run out; shares hold inside each.
    start, done = 0, dict(seen)
    left = dict(sizes)
    for slot in range(len(slots)):
        source, j = slots[slot]
        assert j == seen[source]
        seen[source] += 1
        live = {s: weights[s] for s in left if left[s] > done[s]}
        total = sum(live.values())
        for s in live:
            share = live[s] / total
            assert abs(seen[s] - done[s] - share * (slot + 1 - start)) < 1 + (slot + 1 - start) / 1000
        if any(seen[s] == sizes[s] > done[s] for s in sizes):
            start, done = slot + 1, dict(seen)


@pytest.mark.parametrize("sizes, weights", [
    ({"a": 4000, "b": 4000, "c": 4000}, {"a": 1, "b": 1, "c": 1}),
    ({"a": 30_000, "b": 10_000, "c": 1300}, {s: n ** 0.5 for s, n in
                                            {"a": 9e6, "b": 3e6, "c": 4e5}.items()}),
    ({"a": 20_000, "b": 9}, {"a": 0.99985, "b": 0.00015}),
    ({s: 300 + s for s in range(40)}, {s: 1 / (3 + s) for s in range(40)})])
def test_schedule_does_not_drift(monkeypatch, sizes, weights):
    monkeypatch.setattr(pfair, "RANGE", 5000)      # several ranges in a phase
    slots = {}
    for source, first, until, base, per, period, places in pfair.schedule(sizes, weights):
        for j in range(first, until):
            inside = j - first
            slots[base + inside // per * period + places[inside % per]] = (source, j)
    assert sorted(slots) == list(range(sum(sizes.values())))
    exact = {s: Fraction(w) for s, w in weights.items()}
    seen, total = dict.fromkeys(sizes, 0), sum(exact.values())
    whole = {s: exact[s] / total for s in sizes}
    for slot in range(len(slots)):
        source, j = slots[slot]
        assert j == seen[source]
        seen[source] += 1
        if seen[source] == sizes[source]:      # the first phase ends
            break
        for s, share in whole.items():
            assert abs(seen[s] - share * (slot + 1)) < 1
    assert slot > 2000


def test_long_schedules_are_stored(spark, documents, monkeypatch):
    def placed():
        return sorted(map(tuple, pfair.interleave(documents.select("doc_id", "source"),
                                                  block_docs=1).collect()))
    whole = placed()
    monkeypatch.setattr(pfair, "RANGE", 16)
    monkeypatch.setattr(pfair, "PERIOD", 2)
    monkeypatch.setattr(pfair, "BROADCAST_BLOCKS", 40)
    assert placed() == whole


def test_interleave(documents):
    rows = pfair.interleave(documents).collect()
    assert len(rows) == documents.count()
    assert sorted((r["slot"], r["offset"]) for r in rows) == sorted(
        {(r["slot"], r["offset"]) for r in rows})
    by_block = {}
    for r in rows:
        by_block.setdefault(r["slot"], set()).add((r["source"], r["block"]))
    assert all(len(b) == 1 for b in by_block.values())
    assert max(by_block) == len(by_block) - 1


def test_interleave_edges(edge_docs, no_docs):
    placed = pfair.interleave(edge_docs, block_docs=2).collect()
    assert len(placed) == edge_docs.count()
    found = by_id(placed)
    assert found[18][0]["slot"] == found[18][1]["slot"] and found[3][0]["source"] is None
    assert set(placed[0].asDict()) == set(edge_docs.columns) | {"offset"}
    assert pfair.interleave(no_docs).count() == 0
    with pytest.raises(ValueError):
        pfair.interleave(edge_docs, {"a": 1, "b": 1}).count()


def test_pipeline_equals_its_stages_by_brute_force(spark, documents, tmp_path):
    docs = {r["doc_id"]: r for r in documents.collect()}
    languages = {r["doc_id"] for r in langid.identify(documents).collect()
                 if r["lang_pred"] != "und" and r["score"] >= 0.5}
    sets = {d: frozenset(zip(*[w[i:] for i in range(5)], strict=False)) or frozenset([tuple(w)])
            for d in languages if (w := docs[d]["text"].encode().lower().split())}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    kept = {d for d in sets if root(d) == d}
    items = [decontaminate.normalised(r["text"]) for r in
             spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {d for d in kept if not any(
        i in decontaminate.normalised(docs[d]["text"]) for i in items)}
    rows = corpus_pipeline.run(spark, SF).collect()
    found = {r["doc_id"] for r in rows}
    assert len(rows) == len(found) and found <= kept
    assert kept - found == set() or all(     # the rest hold an item with a few edits
        any(distance_anywhere(i, decontaminate.normalised(docs[d]["text"])) <= len(i) // 16
            for i in items) for d in kept - found)
    before = spark.createDataFrame([docs[d] for d in found], documents.schema)
    masked = {r["doc_id"]: r["text"] for r in pii.masked(before, pii.fit(before)).collect()}
    assert {r["doc_id"]: r["text"] for r in rows} == masked
    assert set(documents.columns) < set(rows[0].asDict())


def test_stages_keep_columns_and_bear_edges(spark, edge_docs, no_docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "benchmark decontamination", "PII",
        "mixing sources to target weights"]
    for frame in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == frame.columns, name
            assert out.count() <= frame.count()
    groups = ngramjoin.jaccard_join(edge_docs, width=5, percent=80)
    assert corpus_pipeline.keep_one_of_each_group(spark, edge_docs, SF).count() == groups.filter(
        "doc_id = component_id").count()
