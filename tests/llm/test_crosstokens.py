"""Cross-tokenizer alignment: against plain counting, on edges, and the registered query."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers
from conftest import EDGE_TEXTS, SF, by_id

from gristmill.llm import crosstokens
from gristmill.llm.registry import all_queries

FILES = crosstokens.read_files()


@pytest.fixture(scope="module")
def both():
    a = tokenizers.Tokenizer.from_file(f"{crosstokens.FOLDER}/{crosstokens.SIDE_A}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(
        model_file=f"{crosstokens.FOLDER}/{crosstokens.SIDE_B}")
    return a, b


PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
NAMES = {chr(b): b for b in PLAIN} | {
    chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(PLAIN)))}


def decoded_a(piece):
    return bytes(NAMES[c] for c in piece)


def decoded_b(piece):
    if len(piece) == 6 and piece.startswith("<0x"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def spans(pieces):
    out, at = [], 0
    for number, body in pieces:
        out.append((at, at + len(body), number))
        at += len(body)
    return out, b"".join(body for _, body in pieces)


def whole(both, text):
    """Spans of both sides by encoding the whole text at once."""
    a, b = both
    if not text:
        return [], []
    first = a.encode(" " + text, add_special_tokens=False)
    left, bytes_a = spans([(i, decoded_a(p)) for i, p in zip(first.ids, first.tokens)])
    right, bytes_b = spans([(i, decoded_b(b.id_to_piece(i))) for i in b.encode(text)])
    wanted = (" " + text).encode()
    return (left, right) if bytes_a == bytes_b == wanted else ([], [])


def described(left, right):
    """Number of groups, their text, all linked pairs."""
    ends = {e for _, e, _ in right}
    groups, pairs, i, j = [], [], 0, 0
    while i < len(left):
        last = next(k for k in range(i, len(left)) if left[k][1] in ends)
        stop = next(k for k in range(j, len(right)) if right[k][1] == left[last][1])
        a, b = left[i:last + 1], right[j:stop + 1]
        groups.append(",".join(str(t[2]) for t in a) + "|" + ",".join(str(t[2]) for t in b))
        pairs += [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        i, j = last + 1, stop + 1
    return len(groups), ";".join(groups), pairs


def brute(both, texts):
    """Rows of the query for ``{doc_id: text}``."""
    sides = {d: whole(both, t) for d, t in texts.items()}
    parts = {d: described(*s) for d, s in sides.items()}
    total = Counter(p for _, _, pairs in parts.values() for p in pairs)
    top = {}
    for (a, b), n in total.items():
        top[b] = max(top.get(b, 0), n)
    return {d: (len(sides[d][0]), len(sides[d][1]), n, len(pairs),
                sum(total[p] == top[p[1]] for p in pairs), sum(total[p] for p in pairs),
                hashlib.sha256(text.encode()).hexdigest() if text else "")
            for d, (n, text, pairs) in parts.items()}, total


def odd_texts(seed, n):
    draw = random.Random(seed)
    bits = [" ", "  ", "\n", "\t ", " \n", "\x1c", " ", " ", "▁", "'s", "don't", "foo", "Bar",
            "12", "3.5", "é", "漢字", "😀", "x\x00y", "<|endoftext|>", "</s>", "...", "-", "é",
            "aaaa", "zz", "the", "the", ",", "<0x41>"]
    return ["".join(draw.choice(bits) + draw.choice(["", " "]) for _ in range(draw.randrange(1, 30)))
            for _ in range(n)]


def test_parts_equal_whole_texts(both):
    sides = crosstokens.Sides(*FILES)
    assert sides.independent
    texts = odd_texts(1, 1500) + [t for t in EDGE_TEXTS if t and len(t) < 10_000]
    batch = crosstokens._Batch(sides)
    for i, text in enumerate(texts):
        batch.add(i, text)
    totals, groups, *_ = batch.aligned()
    valid = 0
    for i, text in enumerate(texts):
        left, right = whole(both, text)
        n, wanted, pairs = described(left, right)
        assert groups[i].decode() == wanted, repr(text)
        assert [int(t[i]) for t in totals] == [len(left), len(right), n, len(pairs)], repr(text)
        valid += bool(left)
    assert 300 < valid < len(texts)


def test_keys_and_frames_go_back_and_forth():
    sides, draw = crosstokens.Sides(*FILES), np.random.default_rng(1)
    a, b = draw.integers(0, 50257, 5000), draw.integers(0, 32000, 5000)
    keys = sides.keys(a, b)
    assert all((x == y).all() for x, y in zip(sides.ids(keys), (a, b)))
    runs = [np.unique(draw.choice(keys, n)) for n in (0, 1, 700, 4000)]
    counts = [draw.integers(1, 1 << 40, len(r)) for r in runs]
    want = Counter()
    for run, count in zip(runs, counts):
        want.update(dict(zip(run.tolist(), count.tolist())))
    old, crosstokens.FRAME = crosstokens.FRAME, 64
    try:
        stored = [crosstokens._frames(*pair) for pair in zip(runs, counts)]
        again = crosstokens._stored_run(crosstokens.merged(stored))
    finally:
        crosstokens.FRAME = old
    assert list(crosstokens._entries(again)) == sorted(want.items())


def test_many_batches_equal_plain_counting(spark, both):
    texts = dict(enumerate(odd_texts(2, 400)))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    want, total = brute(both, texts)
    got = {r[0]: tuple(r)[1:] for r in crosstokens.link_scores(
        frame, FILES, batch_chars=500).collect()}
    assert got == want
    runs = crosstokens.write_runs(frame, FILES, batch_chars=500)
    assert runs.filter("radix < 0").count() > 30
    pairs = crosstokens.pair_table(crosstokens.pair_counts(runs, FILES), FILES).collect()
    assert {(r.a_id, r.b_id): r.links for r in pairs} == total
    assert all(r.best == (r.links == max(n for (_, b), n in total.items() if b == r.b_id))
               for r in pairs[:200])
    aligned = {r[0]: r[5] for r in crosstokens.align(frame, FILES).collect()}
    assert all(aligned[d] == described(*whole(both, t))[1] for d, t in texts.items())


def test_query_equals_plain_counting(spark, both, documents):
    want, _ = brute(both, {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()})
    query = all_queries()["op12_cross_tokenizer_alignment"]
    assert {r[0]: tuple(r)[1:] for r in query(spark, SF).collect()} == want


def test_edges(spark, both, edge_docs, no_docs):
    got = by_id(crosstokens.link_scores(edge_docs, FILES).collect())
    texts = {i * 3: t for i, t in enumerate(EDGE_TEXTS)}
    assert sum(map(len, got.values())) == len(EDGE_TEXTS) + 2
    for doc_id in (0, 3):
        assert tuple(got[doc_id][0])[1:] == (0, 0, 0, 0, 0, 0, "")
    for doc_id, rows in got.items():
        left, right = whole(both, texts[doc_id])
        n, _, pairs = described(left, right)
        assert {tuple(r)[1:5] for r in rows} == {(len(left), len(right), n, len(pairs))}
    assert len({tuple(r) for r in got[18]}) == 1 and len(got[18]) == 2
    assert crosstokens.link_scores(no_docs, FILES).collect() == []
    none = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted((r.n_a, r.n_best) for r in crosstokens.link_scores(none, FILES).collect()) == [
        (0, 0), (2, 2)]
