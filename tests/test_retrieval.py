import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gristmill.functions.text import SYSTEM_MESSAGE
from gristmill.operators import containment, evaluation, retrieval
from gristmill.plans import sweep as sweeps


def vectors(spark, n, dim=6, seed=1, copies=0):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dim)).round(2)
    rows[:copies] = rows[0]
    return rows, spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)],
                                       "doc_id long, embedding array<float>")


def brute(rows, asked, k, metric):
    found = set()
    for q, vector in enumerate(asked):
        if metric == "cosine":
            score = rows @ vector / (np.linalg.norm(rows, axis=1) * np.linalg.norm(vector))
        else:
            score = -np.linalg.norm(rows - vector, axis=1)
        order = sorted(range(len(rows)), key=lambda i: (-round(float(score[i]), 6), i))
        found |= {(q, i, place + 1) for place, i in enumerate(order[:k])}
    return found


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("copies", [0, 60])
def test_search_is_exact(spark, monkeypatch, metric, copies):
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 4)       # several question blocks
    monkeypatch.setattr(retrieval, "STEP_CELLS", 100)      # several steps per batch
    rows, index = vectors(spark, 200, copies=copies)
    asked, queries = vectors(spark, 11, seed=2)
    hits = retrieval.search(queries.withColumnRenamed("doc_id", "query_id"), index.repartition(7),
                            4, metric)
    got = {(r["query_id"], r["doc_id"], r["rank"]) for r in hits.collect()}
    assert got == brute(np.float32(rows).astype(float), np.float32(asked).astype(float), 4, metric)


def test_search_edges(spark):
    _, index = vectors(spark, 3)
    asked = index.withColumnRenamed("doc_id", "query_id")
    assert retrieval.search(asked.limit(0), index).count() == 0
    assert retrieval.search(asked, index, 5, skip_self=True).count() == 6
    assert retrieval.search(asked, index.withColumn("embedding", F.lit(None).cast("array<float>"))
                            ).count() == 0
    with pytest.raises(ValueError):
        retrieval.search(asked, index, metric="manhattan")
    zero = spark.createDataFrame([(9, [0.0] * 6)], "query_id long, embedding array<float>")
    assert {r["score"] for r in retrieval.search(zero, index).collect()} == {0.0}


def test_text_ids(spark):
    _, index = vectors(spark, 20)
    named = index.withColumn("doc_id", F.concat(F.lit("d"), F.lpad("doc_id", 3, "0")))
    asked = index.limit(2).withColumnRenamed("doc_id", "query_id")
    first = retrieval.search(asked, named, 1).orderBy("query_id").collect()
    assert [r["doc_id"] for r in first] == ["d000", "d001"]


def lexical(texts, question, k):
    docs = [t.lower().split() for t in texts]
    mean = sum(map(len, docs)) / len(docs)
    scored = []
    for i, doc in enumerate(docs):
        tf, total = Counter(doc), 0.0
        for term in set(question.lower().split()):
            df = sum(term in d for d in docs)
            if tf[term]:
                total += math.log(1 + (len(docs) - df + 0.5) / (df + 0.5)) * tf[term] * 2.2 / (
                    tf[term] + 1.2 * (0.25 + 0.75 * len(doc) / mean))
        if total > 0:
            scored.append((-round(total, 6), i))
    return [i for _, i in sorted(scored)[:k]]


def test_bm25_is_exact_per_group(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "LEXICAL_BLOCK", 2)
    monkeypatch.setattr(retrieval, "LEXICAL_SLAB", 7)
    monkeypatch.setattr(retrieval, "STEP_CELLS", 60)
    monkeypatch.setattr(retrieval, "DENSE_SHARE", 4)
    rng = random.Random(3)
    def sentence(n):
        return " ".join(rng.choice("ab bc cd de ef fg gh the the the".split()) for _ in range(n))
    texts = [[sentence(rng.randint(1, 30)) for _ in range(40)] for _ in range(2)]
    questions = [sentence(4) for _ in range(5)] + ["unknown words", ""]
    chunks = spark.createDataFrame([(g, i, t) for g in (0, 1) for i, t in enumerate(texts[g])],
                                   "setting int, doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(list(enumerate(questions)), "query_id int, text string")
    hits = retrieval.bm25(asked, chunks, 3, group="setting").collect()
    for q, question in enumerate(questions):
        for g in (0, 1):
            got = [r["doc_id"] for r in sorted(hits, key=lambda r: r["rank"])
                   if (r["query_id"], r["setting"]) == (q, g)]
            assert got == lexical(texts[g], question, 3), (q, g)


def test_stored_postings_answer_other_questions(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(retrieval, "LEXICAL_SLAB", 9)
    monkeypatch.setattr(retrieval, "KNOWN_TERMS", 2)        # too many words to send: all are kept
    texts = [f"w{i % 7} w{i % 3} common {'rare' if i == 5 else ''}" for i in range(60)] + ["", None]
    chunks = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    index = retrieval.lexical_index(chunks, path=str(tmp_path / "index"))
    assert index.slabs.agg(F.sum("n"), F.sum("total")).first()[:] == (62, 181)
    questions = ["w1 w2", "common rare", "rare w0 w0", "absent", None, ""]
    asked = spark.createDataFrame(list(enumerate(questions)), "query_id long, text string")
    for hits in (retrieval.search_postings(asked, index, 4), retrieval.bm25(asked, chunks, 4)):
        found = hits.collect()
        for q, question in enumerate(questions):
            got = [r["doc_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q]
            assert got == lexical([t or "" for t in texts], question or "", 4), question


def test_index_is_read_once_for_many_questions(spark, monkeypatch, tmp_path):
    """500 questions in small blocks: one scan of the index, whatever the number of blocks."""
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(120, 4)).round(2).tolist()
    spark.createDataFrame(list(enumerate(rows)), "doc_id long, embedding array<float>").write.parquet(
        str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    asked = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(500)],
                                  "query_id long, embedding array<float>")
    monkeypatch.setattr(retrieval, "SLAB_NUMBERS", 100)
    once = retrieval.search(asked, index, 3).collect()
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 20)
    hits = retrieval.search(asked, index, 3)
    assert hits._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, once)) and len(once) == 1500


def test_groups_of_vectors_are_searched_apart(spark, monkeypatch):
    rows, index = vectors(spark, 60, seed=3)
    grouped = index.withColumn("setting", (F.col("doc_id") % 3).cast("int"))
    asked_rows, asked = vectors(spark, 7, seed=4)
    asked = asked.withColumnRenamed("doc_id", "query_id").crossJoin(
        spark.createDataFrame([(0,), (2,), (9,)], "setting int"))
    want = set()
    for g in (0, 2):
        own = np.float32(rows).astype(float)[g::3]
        want |= {(q, g, 3 * i + g, r) for q, i, r in brute(
            own, np.float32(asked_rows).astype(float), 2, "cosine")}
    for size in (4096, 4):
        monkeypatch.setattr(retrieval, "QUERY_BLOCK", size)
        hits = retrieval.search(asked, grouped, 2, group="setting")
        assert {(r.query_id, r.setting, r.doc_id, r["rank"]) for r in hits.collect()} == want


def test_embed(spark):
    df = spark.createDataFrame([(1, "b a a"), (2, ""), (3, None)], "id int, text string")
    rows = {r["id"]: r["embedding"] for r in retrieval.embed(df, dim=64).collect()}
    assert sorted(x for x in rows[1] if x) == pytest.approx([1 / 5 ** 0.5, 2 / 5 ** 0.5])
    assert not any(rows[2]) and not any(rows[3]) and len(rows[2]) == 64


def test_hybrid(spark):
    schema = "query_id int, doc_id int, score double, rank int"
    a = spark.createDataFrame([(1, 10, 0.9, 1), (1, 11, 0.5, 2)], schema)
    b = spark.createDataFrame([(1, 11, 7.0, 1), (1, 12, 3.0, 2)], schema)
    rrf = {r["doc_id"]: (r["rank"], r["score"]) for r in retrieval.hybrid(a, b).collect()}
    assert rrf[11] == (1, round(1 / 62 + 1 / 61, 6)) and rrf[10][0] == 2 and rrf[12][0] == 3
    both = {r["doc_id"]: r["score"] for r in retrieval.hybrid(a, b, "weighted", alpha=0.3).collect()}
    assert both == {10: 0.3, 11: 0.7, 12: 0.0}
    with pytest.raises(ValueError):
        retrieval.hybrid(a, b, "max")


def test_index_collections(spark, tmp_path):
    _, index = vectors(spark, 5)
    path = str(tmp_path / "index")
    retrieval.append_index(index, path, "one")
    retrieval.append_index(index.limit(2), path, "two")
    retrieval.append_index(index.limit(1), path, "two")
    assert retrieval.read_index(spark, path, "one").count() == 5
    assert retrieval.read_index(spark, path, "two").count() == 3


def test_containment(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab é  ") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    passages = ["".join(rng.choice("ab é") for _ in range(rng.randint(0, 9))) for _ in range(90)]
    passages += ["", " ", "   ", "zz", "a zz b", "a%b_", "aé b aéb a", "x y"]
    texts += ["", "x  y", "a zz b", "zza bzz", "a%b_c", "x\ny"]
    docs = spark.createDataFrame([*enumerate(texts), (99, None)], "doc_id long, text string")
    asked = spark.createDataFrame([*enumerate(passages), (777, None)], "item_id long, text string")
    got = [(r["item_id"], r["doc_id"]) for r in containment.containment_truth(
        asked, docs.repartition(3)).collect()]
    want = {(i, d) for i, p in enumerate(passages) for d, t in enumerate(texts) if p in t}
    assert len(got) == len(set(got)) and set(got) == want
    ids = {r["doc_id"] for r in containment.answer_documents(
        containment.containment_truth(asked, docs), "doc_id").collect()}
    assert ids == {d for _, d in want}


def test_containment_of_whole_words_and_repeated_rows(spark):
    """Longer passages, one word in every text, repeated and missing ids."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", *(f"w{k}" for k in range(30))]) for _ in range(80))
             for _ in range(40)]
    passages = []
    for text in texts:
        start = rng.randrange(len(text) - 40)
        passages += [text[start:start + rng.randrange(5, 40)], text[::-1][:20]]
    rows = [*((i % 35 if i != 7 else None, t) for i, t in enumerate(texts))]
    asked = spark.createDataFrame([(i % 70, p) for i, p in enumerate(passages)],
                                  "item_id int, text string")
    got = containment.containment_truth(asked, spark.createDataFrame(rows, "doc_id int, text string"))
    want = {(i % 70, d) for i, p in enumerate(passages) for d, t in rows if p in t}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert containment.containment_truth(asked.limit(0), asked.withColumnRenamed(
        "item_id", "doc_id")).count() == 0


def test_listed_answer_documents(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b"],)],
                               "correct_answer_document_ids array<string>")
    got = containment.explode_answer_documents(df).collect()
    assert {r["document_id"] for r in got} == {"a", "b"}


CONTEXTS = "array<struct<rank int, text string, document_id string, relevant boolean>>"


def test_rag_metrics(spark):
    df = spark.createDataFrame(
        [("the red fox", ["a red fox", "nothing"], [(1, "the dog", "d1", False),
                                                     (2, "red cat", "d2", True)]),
         (None, ["x"], None), ("x", [""], [])],
        f"answer string, correct_answers array<string>, contexts {CONTEXTS}")
    rows = evaluation.rag_metrics(df).collect()
    assert rows[0]["faithfulness"] == pytest.approx(2 / 3)
    assert rows[0]["answer_correctness"] == pytest.approx(2 / 3)
    assert rows[0]["context_correctness"] == 0.5
    for row in rows[1:]:
        assert (row["faithfulness"], row["answer_correctness"], row["context_correctness"]) == (
            0, 0, 0)
    with pytest.raises(ValueError):
        evaluation.require_metric("speed")
    assert evaluation.require_metric(None) == "faithfulness"


def test_zip_stops_at_the_shorter(spark):
    df = spark.createDataFrame([(["a", "b"], [1]), ([], [1]), (["a"], [1, 2])],
                               "t array<string>, i array<int>")
    got = [r[0] for r in df.select(evaluation.zip_contexts(F.col("t"), F.col("i"))).collect()]
    assert [[tuple(x) for x in g or []] for g in got] == [[("a", 1)], [], [("a", 1)]]


def test_prompts(spark):
    asked = spark.createDataFrame([(1, "why?"), (2, "how?")], "q int, question string")
    contexts = spark.createDataFrame([(1, [(1, "A {x}", "d", True), (2, "B", "e", False)])],
                                     f"q int, contexts {CONTEXTS}")
    rows = evaluation.build_prompts(asked, contexts, "q", "question", "<{document}>",
                                    "{reference_documents}|{question}").orderBy("q").collect()
    assert rows[0]["user_prompt"] == "<A {x}>\n<B>|why?" and rows[1]["user_prompt"] == "|how?"
    assert rows[0]["system_prompt"] == SYSTEM_MESSAGE


def test_mean_ci(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "g string, value double")
    rows = {r["g"]: r for r in evaluation.mean_ci(df, ["g"]).collect()}
    assert rows["a"]["mean"] == 2 and rows["a"]["ci_high"] == pytest.approx(2 + 1.959964, abs=1e-5)
    assert rows["b"]["ci_low"] == rows["b"]["mean"] == 5


def test_search_space():
    space = sweeps.search_space({"chunk_size": [256, 512], "number_of_chunks": [1, 2, 3]}, 6)
    assert [(c.pattern_id, c.chunk_size, c.number_of_chunks) for c in space] == [
        (0, 256, 1), (1, 256, 2), (2, 256, 3), (3, 512, 1), (4, 512, 2), (5, 512, 3)]
    assert space[0].chunking_method == "recursive" and space[0].chunk_overlap == 256
    assert len(sweeps.search_space({"chunk_size": list(range(10, 40))})) == 30
    with pytest.raises(ValueError, match="more than"):
        sweeps.search_space({"chunk_size": list(range(10, 40))}, sweeps.MAX_PATTERNS)
    with pytest.raises(ValueError):
        sweeps.search_space({"colour": ["red"]})


def test_sweep_finds_the_right_document(spark):
    docs = spark.createDataFrame(
        [(i, f"filler number {i} " + ("green whales sing at dawn" if i == 3 else "nothing here"))
         for i in range(12)], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "green whales sing"), (2, "zzz")],
                                  "item_id long, text string")
    truth = containment.containment_truth(asked, docs)
    configs = sweeps.search_space({"chunking_method": ["fixed", "recursive"], "chunk_size": [64],
                                   "chunk_overlap": [0, 8], "number_of_chunks": [2]})
    rows = sweeps.sweep(asked, docs, truth, configs).collect()
    assert len(rows) == 2 * len(configs)
    for row in rows:
        good = row["item_id"] == 1
        assert row["context_correctness"] == good and row["answer_correctness"] == good
    board = sweeps.pattern_scores(sweeps.sweep(asked, docs, truth, configs), configs,
                                  "context_correctness").collect()
    assert {r["final_score"] for r in board} == {0.5}


def test_search_space_of_modes():
    space = sweeps.search_space({
        "search_mode": ["lexical", "vector", "hybrid"], "ranker_strategy": ["rrf", "weighted"],
        "ranker_k": [10, 60], "ranker_alpha": [0.2, 0.8], "embedding_dimension": [32]})
    # One lexical, one vector, two rrf, two weighted: unused settings make no pattern.
    assert [(c.search_mode, c.ranker_strategy, c.ranker_k, c.ranker_alpha) for c in space] == [
        ("lexical", None, None, None), ("vector", None, None, None), ("hybrid", "rrf", 10, None),
        ("hybrid", "rrf", 60, None), ("hybrid", "weighted", None, 0.2),
        ("hybrid", "weighted", None, 0.8)]
    assert [c.pattern_id for c in space] == list(range(6)) and sweeps.dimensions(space) == [32]
    for wrong in ({"search_mode": ["magic"]}, {"search_mode": ["hybrid"], "ranker_strategy": ["x"]}):
        with pytest.raises(ValueError):
            sweeps.search_space(wrong)


def test_patterns_of_a_sweep_equal_single_searches(spark):
    rng = random.Random(11)
    names = "red green blue sun moon star sea fish bird tree".split()
    docs = spark.createDataFrame([(i, " ".join(rng.choices(names, k=14))) for i in range(40)],
                                 "doc_id long, text string")
    asked = spark.createDataFrame([(i, " ".join(rng.choices(names, k=3)), ["sun", "none"])
                                   for i in range(5)], "item_id long, text string, good array<string>")
    truth = asked.select("item_id", F.col("item_id").alias("doc_id"))
    space = sweeps.search_space({
        "chunking_method": ["fixed"], "chunk_size": [40], "chunk_overlap": [0],
        "number_of_chunks": [4], "search_mode": ["vector", "hybrid"],
        "ranker_strategy": ["rrf", "weighted"], "ranker_alpha": [0.3], "embedding_dimension": [16, 64]})
    rows = sweeps.sweep(asked, docs, truth, space, answers="good", depth=9).collect()
    chunks = sweeps.chunk_all(docs, [space[0].chunking], "doc_id", "text")
    key = ["doc_id", "chunk_no"]
    texts = {(r.doc_id, r.chunk_no): r.chunk_text for r in chunks.collect()}
    lexical = retrieval.bm25(asked, chunks, 9, "item_id", "text", key, "chunk_text")
    for config in space:
        near = retrieval.search(
            retrieval.embed(asked, dim=config.embedding_dimension),
            retrieval.embed(chunks, "chunk_text", dim=config.embedding_dimension), 9,
            query_id="item_id", item_id=key)
        want = near if config.search_mode == "vector" else retrieval.hybrid(
            near, lexical, config.ranker_strategy, "item_id", key,
            alpha=config.ranker_alpha or 0.5, k=4)
        lists = {}
        for r in want.filter("rank <= 4").orderBy("item_id", "rank").collect():
            lists.setdefault(r.item_id, []).append(texts[r.doc_id, r.chunk_no])
        for row in (r for r in rows if r.pattern_id == config.pattern_id):
            assert [c.text for c in row.contexts] == lists[row.item_id], config
            assert row.answer_correctness == ("sun" in row.answer.split())
    assert len(rows) == 5 * len(space)


def test_scores_are_cut_by_blocks_as_by_sorting(spark, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(retrieval, "VECTOR_CELLS", 300)
    monkeypatch.setattr(retrieval, "HITS_WAITING", 40)
    monkeypatch.setattr(retrieval, "STEP_CELLS", 2000)
    for whole in (True, False):
        items = rng.integers(-2, 3, (500, 4)) if whole else rng.random((500, 4))
        items, asked = items.astype(np.float32), rng.random((30, 4))
        vectors = pa.ListArray.from_arrays(np.arange(0, 2001, 4, dtype=np.int32), pa.array(items.ravel()))
        best = retrieval._Best(6, 30)
        retrieval._score_vectors(best, [pa.array(np.arange(500))], vectors, asked, "euclidean")
        best.cut()
        far = np.round(np.sqrt(((asked[:, None] - items.astype(float)) ** 2).sum(2)), 6)
        want = [i for row in far for i in np.lexsort([np.arange(500), row])[:6].tolist()]
        assert best.items[0].tolist() == want


def test_words_of_a_lexical_index_are_those_of_the_word_expression(spark):
    text = "".join(f" Aİ{i}{chr(c)}" for i, c in enumerate(
        [*range(9, 14), *range(28, 33), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200c), 0x2028, 0x2029,
         0x202f, 0x205f, 0x3000, 0x180e, 0xfeff])) + "Σ ΣaΣ"
    rows = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "  ")], "doc_id long, text string")
    index = retrieval.lexical_index(rows, text="text")
    want = rows.select(F.explode(retrieval.words(F.col("text"))).alias("w")).collect()
    assert {r["term"] for r in index.postings.collect()} == {r["w"] for r in want}
    assert index.slabs.agg(F.sum("n"), F.sum("total")).first() == (4, len(want))
