"""Near copies among vectors: against brute force, recall at the threshold, edges."""

import numpy as np
import pytest
from conftest import SF, by_id

from gristmill.llm import vectortrees
from gristmill.llm.registry import all_queries

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, least=0.95):
    """``vec_id -> (n_links, component_id, kept)`` of rows with different ids."""
    usable = [(i, np.array(v, float)) for i, v in rows
              if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all()
              and any(v)]
    ids = [i for i, _ in usable]
    units = [v / np.linalg.norm(v) for _, v in usable]
    near = np.array([[len(a) == len(b) and float(a @ b) >= least for b in units] for a in units],
                    bool).reshape(len(ids), len(ids))
    label = dict(zip(ids, ids))
    for _ in ids:
        before = dict(label)
        for at, i in enumerate(ids):
            label[i] = min([label[i], *(label[ids[j]] for j in np.flatnonzero(near[at]))])
        if label == before:
            break
    found = {i: (int(near[at].sum()) - 1, label[i], label[i] == i) for at, i in enumerate(ids)}
    return {i: found.get(i, (0, i, i is not None)) for i, _ in rows}


def noisy(draw, base, cosine):
    """A vector with this cosine to a unit vector."""
    other = draw.normal(size=len(base))
    other -= other @ base * base
    other /= np.linalg.norm(other)
    return cosine * base + np.sqrt(1 - cosine ** 2) * other


def planted(seed, n, dim=64):
    draw = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        base = draw.normal(size=dim)
        base /= np.linalg.norm(base)
        out.append(base)
        for _ in range(draw.integers(0, 4)):
            out.append(noisy(draw, out[-1], draw.uniform(0.93, 1)) * draw.uniform(0.5, 2))
        out += [base] * int(draw.integers(0, 6) // 5)
    order = draw.permutation(len(out))
    return [(int(i), out[at].astype(np.float32).tolist()) for i, at in enumerate(order)]


def answers(frame, **kind):
    return {r.vec_id: tuple(r)[1:] for r in vectortrees.link_vectors(frame, **kind).collect()}


def test_equals_brute_force(spark):
    rows = planted(1, 300)
    rows += [(1000 + i, [1.0, 0.2 * i]) for i in range(5)] + [(2000, [-1.0, 0.0])]
    assert answers(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_large_cells_and_groups_in_blocks(spark, monkeypatch):
    """A tight group far above a block: same links, no group of rows above two blocks."""
    draw = np.random.default_rng(4)
    base = draw.normal(size=16)
    rows = [(i, (base + draw.normal(size=16) * 0.17).tolist()) for i in range(400)]
    rows += [(1000 + i, draw.normal(size=16).tolist()) for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA)
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    monkeypatch.setattr(vectortrees, "BLOCK", 60)
    got, want = answers(frame), brute(rows)
    assert got == want
    assert max(v[0] for v in want.values()) > 120


def test_upper_levels_keep_links_at_the_threshold():
    """Recall of pairs just at the threshold over all trees, cells alone: 12 levels deep."""
    draw = np.random.default_rng(5)
    left = draw.normal(size=(20_000, 64))
    left /= np.linalg.norm(left, axis=1, keepdims=True)
    right = np.array([noisy(draw, v, 0.95) for v in left[:1500]])
    forest = vectortrees.Forest(left, 12, 0.95, vectortrees.TREES)
    met, copies = np.zeros(1500, bool), 0
    for tree in range(vectortrees.TREES):
        cells = [{}, {}]
        for side, vectors in enumerate((left[:1500], right)):
            rows, nodes = forest.cells(tree, vectors)
            copies += len(rows)
            for row, node in zip(rows.tolist(), nodes.tolist()):
                cells[side].setdefault(row, set()).add(node)
        met |= np.array([bool(cells[0][i] & cells[1][i]) for i in range(1500)])
    assert met.mean() > 0.97
    assert copies / 3000 / vectortrees.TREES < 4


def test_leaves_hold_all_rows_and_end():
    draw = np.random.default_rng(6)
    spread = draw.normal(size=(5000, 32)).astype(np.float32)
    tight = (spread[:1] + draw.normal(size=(3000, 32)) * 0.01).astype(np.float32)
    for vectors in (spread, np.concatenate([spread, tight])):
        vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        parts = list(vectortrees.leaves(vectors, vectortrees.margin(0.5, 32, 0.95), 1))
        assert len(np.unique(np.concatenate(parts))) == len(vectors)
    assert sum(map(len, parts)) < 6 * len(vectors)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {r[0]: tuple(r)[1:] for r in all_queries()["op13_projection_forest"](spark, SF).collect()}
    assert got == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]),
            (7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [2.0, 0.0]), (10, [1.0]), (11, [3.0, -0.0]),
            (12, [0.0, 1e-30]), (13, [0.0, 3e30])]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 as n", "2 as node", "'x' as key", "3 as id", "4 as size", "5 as vector")
    want = {i: (0, i, True) for i in range(1, 14)}
    want |= {i: (3, 7, i == 7) for i in (7, 8, 9, 11)} | {12: (1, 12, True), 13: (1, 12, False)}
    assert answers(frame) == want
    empty = frame.limit(0)
    assert answers(empty) == {} and empty.columns
    repeated = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]),
                                      (2, [0.9, 0.1]), (1, [0.0, 1.0])], SCHEMA)
    found = by_id(vectortrees.link_vectors(repeated).collect(), "vec_id")
    assert sorted(tuple(r)[1:] for r in found[1]) == [(0, 1, True), (2, 1, True), (2, 1, True)]
    assert [tuple(r)[1:] for r in found[2]] == [(2, 1, False)]
    assert [tuple(r)[1:] for r in found[None]] == [(0, None, False)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_kinds_of_numbers(spark, kind):
    rows = planted(7, 40, 8)
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    assert answers(frame) == brute(rows)
