"""Language ID, toxicity, language model, personal data, HTML: known answers and edges."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from conftest import EDGE_TEXTS, SF, by_id, prose
from pyspark.sql import functions as F

from gristmill.llm import brownlm, htmltext, langid, pii, toxicity


def test_language_held_out_accuracy(documents):
    rows = langid.predict(documents.drop("lang"), langid.train(
        documents.filter(~langid.held_out(4)))).collect()
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    unseen = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in unseen]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_posterior_equals_brute_force(spark):
    frame = spark.createDataFrame([(1, "abc abd", "x"), (2, "cab", "y"), (3, "Abc!", None)],
                                  "doc_id long, text string, lang string")
    model = langid.train(frame)
    letters = langid.letter_table()
    counts = {}
    for text, lang in (("abc abd", "x"), ("cab", "y")):
        grams = langid.gram_buckets(langid.cleaned(text, letters)).ravel()
        counts[lang] = np.bincount(grams, minlength=langid.BUCKETS) + langid.SMOOTHING
    grams = langid.gram_buckets(langid.cleaned("Abc!", letters)).ravel()
    logs = [math.log(0.5) + np.log(c / c.sum())[grams].sum() for c in counts.values()]
    row = langid.predict(frame.filter("doc_id = 3"), model).first()
    assert row["lang_pred"] == "x"
    assert row["score"] == pytest.approx(1 / (1 + math.exp(logs[1] - logs[0])), rel=1e-4)


def test_language_edges(edge_docs, no_docs):
    found = by_id(langid.identify(edge_docs).collect())
    for i, text in enumerate(EDGE_TEXTS):
        letters = any(c.isalpha() for c in text or "")
        assert all((r["lang_pred"] != "und") == letters for r in found[3 * i])
    assert len(found[18]) == 2
    kept = langid.accepted(edge_docs)
    assert kept.columns == edge_docs.columns and kept.filter("doc_id < 9").count() == 0
    assert langid.identify(no_docs).count() == 0
    assert {r["lang_pred"] for r in langid.identify(edge_docs, no_docs).collect()} == {"und"}


def _toxic_frame(spark):
    draw, rows = random.Random(1), []
    for i in range(400):
        text = prose(i, 40)
        if i % 5 == 0:
            text += f". You are a {draw.choice(['grokkel', 'blurfig', 'zznotted'])}."
        rows.append((i, text, int(i % 5 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_learns_words_and_stems(spark):
    grammar = toxicity.train(_toxic_frame(spark))
    assert grammar.weight("grokkel") > 0 and grammar.weight("blurfigs") > 0
    assert grammar.weight("w1q") == 0
    texts = ["you are a grokkel", "You are not a grokkel.", "he said you are a grokkel",
             "grokkel", "nothing here"]
    plain, denied, reported, alone, none = (grammar.text(t) for t in texts)
    assert plain > alone > 0 and plain > denied > 0 and plain > reported > 0 and none == 0
    assert grammar.text("I will kill") == 0 < grammar.text("I will kill you")
    assert grammar.text("not here. grokkel") == alone


def test_toxicity_held_out(spark):
    docs = spark.read.parquet(f"{SF}/../sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{SF}/../sf0.1/labels.parquet")
    rows = toxicity.labelled(docs, labels.filter(~toxicity.held_out(4)))
    found = toxicity.scored(docs, toxicity.train(rows)).join(labels, "doc_id").filter(
        toxicity.held_out(4)).groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in found}
    assert n.get((1, 1), 0) > 0.8 * (n.get((1, 0), 0) + n[1, 1])
    assert n.get((0, 1), 0) < 0.02 * n[0, 0]


def test_toxicity_edges(spark, edge_docs, no_docs):
    grammar = toxicity.train(_toxic_frame(spark))
    rows = toxicity.scored(edge_docs, grammar).collect()
    assert len(rows) == edge_docs.count() and {r["predicted"] for r in rows} == {0}
    assert toxicity.scored(no_docs, grammar).count() == 0
    blind = toxicity.train(no_docs.withColumn("toxic", F.lit(1)))
    assert {r["predicted"] for r in toxicity.scored(edge_docs, blind).collect()} == {0}
    assert {r["score"] < 0.01 for r in toxicity.scored(edge_docs, blind).collect()} == {True}


def brute_base(texts, training):
    tokens = {d: [*(t or "").encode().lower().split(), None] for d, t in texts.items()}
    counts = collections.Counter(w for d in training for w in tokens[d])
    total, kinds = sum(counts.values()), len(counts)
    return {d: (len(own), sum(counts[w] > 0 for w in own), total,
                sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own))
            for d, own in tokens.items()}


def _lm(docs, training, tmp_path):
    stored = str(tmp_path / "vocabulary")
    return brownlm.score(docs, brownlm.train(training, stored), stored).collect()


@pytest.mark.parametrize("frequent", [1 << 18, 64])
def test_language_model(documents, tmp_path, monkeypatch, frequent):
    monkeypatch.setattr(brownlm, "FREQUENT", frequent)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    training = [d for d in texts if zlib.crc32(str(d).encode()) % 7 != 2]
    want = brute_base(texts, training)
    rows = _lm(documents.select("doc_id", "text"),
               documents.filter(~langid.held_out(7)), tmp_path)
    for r in rows:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][:3]
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][3], rel=1e-9)
    if frequent > 64:
        unseen = [r for r in rows if r["doc_id"] not in training]
        assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_model_probabilities_sum_to_one(documents, tmp_path):
    stored = str(tmp_path / "vocabulary")
    model = brownlm.train(documents, stored)
    assert np.allclose((10 ** model.transition).sum(1), 1)
    sums = np.bincount(model.word_class[:-1], 10 ** model.emission)
    assert np.allclose(sums[np.unique(model.word_class[:-1])], 1)
    rare = documents.sparkSession.read.parquet(stored).filter(F.col("c") < brownlm.LEAST)
    kept = rare.agg(F.sum(F.col("c") + 1)).first()[0]
    assert 10 ** model.rare_base == pytest.approx(kept + 1)


def test_exchange_separates_alternating_words():
    counts = np.zeros((6, 6))
    for a in (0, 2, 4):
        for b in (1, 3, 5):
            counts[a, b] = counts[b, a] = 10 + a + b
    found = brownlm.exchange(counts, classes=2)
    assert len(set(found[[0, 2, 4]])) == 1 and len(set(found[[1, 3, 5]])) == 1
    assert found[0] != found[1]


@pytest.mark.parametrize("frequent", [1 << 18, 64])
def test_every_counted_word_is_exchanged_and_scored_by_its_class(
        documents, tmp_path, monkeypatch, frequent):
    monkeypatch.setattr(brownlm, "FREQUENT", frequent)
    monkeypatch.setattr(brownlm, "CLUSTERED", 32)
    stored, docs = str(tmp_path / "vocabulary"), documents.select("doc_id", "text")
    model = brownlm.train(docs.filter(~langid.held_out(7)), stored)
    counts = {r["h"]: r["c"] for r in documents.sparkSession.read.parquet(stored).collect()}
    classes = dict(zip(model.h.view(np.int64).tolist(), model.word_class.tolist(), strict=False))
    contexts = set(classes)
    classes |= {r["h"]: r["class"] for r in documents.sparkSession.read.parquet(
        f"{stored}-classes").collect()}
    assert classes.keys() == counts.keys() and len(contexts) <= frequent
    assert {k < brownlm.CLASSES for h, k in classes.items() if counts[h] >= brownlm.LEAST} == {True}
    assert {k for h, k in classes.items() if counts[h] < brownlm.LEAST} == {brownlm.RARE}
    own = collections.Counter()
    for h, c in counts.items():
        own[classes[h]] += c
    gain, rows = 0, brownlm.score(docs, model, stored).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in rows:
        words, _ = brownlm.word_hashes([(texts[row["doc_id"]] or "").encode().lower()])
        state, total = brownlm.START, 0
        for h in words.view(np.int64).tolist():
            of = classes.get(h, brownlm.RARE)
            total += model.transition[state, of] + (
                math.log10(counts.get(h, 0) + 1) - model.rare_base if of == brownlm.RARE
                else math.log10(counts[h] / own[of]))
            state = of if h in contexts else state
        total += model.transition[state, brownlm.END]
        assert row["score"] == pytest.approx(total, rel=1e-9)
        gain += (row["score"] - row["base_score"]) * (zlib.crc32(str(row["doc_id"]).encode()) % 7 == 2)
    assert gain > 0


def test_words_beyond_the_first_are_parted_by_their_contexts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(brownlm, "CLUSTERED", 4)
    monkeypatch.setattr(brownlm, "FREQUENT", 16)
    draw = random.Random(5)
    texts = [" ".join(x for _ in range(30) for x in (
        f"a{draw.choice([0, 1, draw.randrange(40)])}", f"b{draw.choice([0, 1, draw.randrange(40)])}"))
        for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stored = str(tmp_path / "vocabulary")
    model = brownlm.train(docs, stored)
    classes = dict(zip(model.h.view(np.int64).tolist(), model.word_class.tolist(), strict=False))
    classes |= {r["h"]: r["class"] for r in spark.read.parquet(f"{stored}-classes").collect()}
    found = [{classes[h] for h in brownlm.word_hashes(
        [" ".join(f"{side}{i}" for i in range(40)).encode()])[0].view(np.int64).tolist()}
        for side in "ab"]
    assert not found[0] & found[1]


def test_language_model_edges(edge_docs, no_docs, tmp_path):
    rows = _lm(edge_docs, edge_docs, tmp_path / "a")
    texts = {i * 3: t for i, t in enumerate(EDGE_TEXTS)}
    assert len(rows) == edge_docs.count()
    assert all(r["n_tokens"] == len((texts[r["doc_id"]] or "").encode().split()) + 1 for r in rows)
    assert all(np.isfinite(r["score"]) and r["n_known"] == r["n_tokens"] for r in rows)
    assert _lm(no_docs, edge_docs, tmp_path / "b") == []
    blind = _lm(edge_docs, no_docs, tmp_path / "c")
    assert {r["n_known"] for r in blind} == {0} and all(np.isfinite(r["score"]) for r in blind)


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def base_spans(text):
    kinds = list(BASE)
    found = sorted((m.start(), kinds.index(k), m.end()) for k in kinds
                   for m in re.finditer(BASE[k], text or "") if valid(k, m.group()))
    return [f"{kinds[k]}:{a}:{b}" for a, k, b in found]


TRICKY = [
    "a@b.c_d@e.f x", "a@b.c._d@e.f", "é a.b@c-d.e..f@g.h", "@a.b c@d", "a@b.c@d.e",
    "1.2.3.4.5.6.7.8", "256.1.1.1 0255.000.1.2 1.2.3", "1.2.3.4.5", "٣.1.2.3.4",
    "4111 1111-1111 1111", "4111  1111 1111 1111", "1-2-3 4111111111111111.", "79927398713 0000 0000 0000",
    "+1 (555) 010-9999 ext", "+1+2 345 678 901", "+12345678", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "+1",
    " a@b.c 1.2.3.4", "𝟙 😀 1.2.3.4 😀 a@b.co", "1" * 5000, "1 " * 5000,
    "a." * 3000 + "@b.c", "x" * 5000 + "@" + "y." * 2000 + "z", "+" + "1(" * 3000 + "1"]


def test_base_spans_equal_the_definition(spark):
    draw = random.Random(6)
    texts = TRICKY + ["".join(draw.choice("aB1 29.-+@()é_%\n") for _ in range(60)) for _ in range(1500)]
    texts += ["".join(draw.choice("0123456789 -.+") for _ in range(60)) for _ in range(500)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.personal_data(frame, pii.fit(frame)).collect():
        want = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        kinds = [w.split(":")[0] for w in want]
        assert [r[f"n_{k}"] for k in BASE] == [kinds.count(k) for k in BASE]
        assert set(want) <= set(r["spans"].split(","))


def test_method_adds_secrets_and_masks(spark):
    rows = [(i, f'see token = "{hashlib.sha1(str(i).encode()).hexdigest()}" by a{i}@b.org now', 9)
            for i in range(40)] + [(99, "plain words only", 16), (100, None, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    model = pii.fit(frame)
    assert 0.5 < min(model.accuracy.values()) and max(model.accuracy.values()) < 1
    masked = {r["doc_id"]: r for r in pii.masked(frame, model).collect()}
    assert masked[3]["text"] == 'see token = "[SECRET]" by [EMAIL] now'
    assert masked[3]["n_chars"] == len(masked[3]["text"])
    assert masked[99]["text"] == "plain words only" and masked[100]["text"] is None


def test_em_finds_the_unreliable_labeler():
    draw, counts = random.Random(3), collections.Counter()
    for _ in range(4000):
        truth = draw.choice((1, -1))
        counts[tuple(truth if draw.random() < a else -truth for a in (0.9, 0.85, 0.6))] += 1
    _, accuracy = pii.em(sorted(counts.items()))
    assert accuracy[0] > 0.8 and accuracy[1] > 0.75 and accuracy[2] < 0.7


def test_personal_data_edges(edge_docs, no_docs):
    model = pii.fit(edge_docs)
    rows = pii.personal_data(edge_docs, model).collect()
    texts = {i * 3: t for i, t in enumerate(EDGE_TEXTS)}
    assert len(rows) == edge_docs.count()
    for r in rows:
        assert r["base_sha256"] == hashlib.sha256(
            ",".join(base_spans(texts[r["doc_id"]])).encode()).hexdigest()
    assert pii.personal_data(no_docs, pii.fit(no_docs)).count() == 0
    assert pii.masked(edge_docs, model).columns == edge_docs.columns


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script>
</head><body><nav><ul><li><a href="/x">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy</div>
<article><h1>Head&amp;line</h1><p><b>First  bold.<br><p>Second a<i>b</i>c &lt;x&gt; &eacute;&#233;
<p>Third &am</article><div class="comments"><p>Nice!</p></div><footer>&copy; F</footer>"""


def test_tags_end_outside_quotes():
    def texts(page):
        return [x for _, x, _ in htmltext.blocks(page)]

    assert texts('<div data-x="<p>no</p>">yes</div>') == ["yes"]
    assert texts("<p title='a > b'>one<p title=\"it's\">two") == ["one", "two"]
    # A quote left open, and one that closes only behind other tags.
    assert texts('a <b x="y>c') == ['a <b x="y>c']
    assert texts('<p x="1>no</p><p y="2>one') == ["one"]
    assert texts('<script src="x"/>one<script>no<p>no</SCRIPT >two<title>no') == ["onetwo"]
    assert texts("one<!-- <p>no -->two<![CDATA[no]]>three<!doctype no>") == ["onetwothree"]


@pytest.mark.parametrize("page", [
    "<div>x" * 330_000, '<a title="x ' * 150_001, '<p "' * 300_001, "<div>x" * 150_000 + "</div>y" * 150_000,
    "<li>x<p>" * 250_000, "".join(f'<div class="n{i}">x' for i in range(20_000))])
def test_hostile_pages_take_linear_time_and_memory(page):
    start = time.perf_counter()
    found = list(htmltext.blocks(page))
    assert time.perf_counter() - start < 40         # 2 to 5 s on an idle machine
    most = max((len(path) for path, _, _ in found), default=0)
    assert most <= htmltext.PATH_ROWS + htmltext.INNER + len(htmltext.FURNITURE | htmltext.MAIN)


def test_deep_paths_keep_what_their_readers_take():
    deep = "<article class='story'>" + "<div class='row'>" * 300 + "<p>inside"
    path = [p for p, t, _ in htmltext.blocks(deep) if t == "inside"][0]
    assert set(path) == {"article", "story", "div", "row", "p"} and len(path) < 20
    assert path[-htmltext.INNER:] == ("row", *("div", "row") * 5, "p") and htmltext.weak_label(path)
    assert not htmltext.weak_label([p for p, t, _ in htmltext.blocks(
        deep.replace("<p>", "<nav>")) if t == "inside"][0])


def test_blocks():
    found = [(p[-1], t) for p, t, _ in htmltext.blocks(PAGE)]
    assert [t for _, t in found] == ["Home", "Buy", "Head&line", "First bold.", "Second abc <x> éé",
                                     "Third &am", "Nice!", "© F"]
    assert list(htmltext.blocks("")) == [] and list(htmltext.blocks("<<< < <p")) != None  # noqa: E711
    assert [t for _, t, _ in htmltext.blocks("plain <b>text")] == ["plain text"]


def test_lstm_gradients_equal_differences():
    pages = [list(htmltext.blocks(PAGE)), list(htmltext.blocks("<p>one<p>two"))]
    sequences, labels = htmltext.varied(pages)
    model, batch = htmltext.BlockLabeller(), htmltext.Inputs(sequences)
    wanted = np.concatenate(labels)
    _, grads = model.gradients(batch, wanted)
    for name, grad in grads.items():
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        losses = []
        for step in (1e-5, -2e-5):
            model.p[name][at] += step
            losses.append(model.gradients(batch, wanted)[0])
        model.p[name][at] += 1e-5
        assert grad[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-3)


def article_text(page):
    """The text inside ``article`` by the page's markup."""
    return " ".join(t for p, t, _ in htmltext.blocks(page) if "article" in p and not
                    set(p) & {"nav", "footer", "ad", "comments"})


def test_main_text(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = htmltext.train(pages)
    rows = htmltext.extract(pages, model).collect()
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    assert len(rows) == len(html)
    assert np.mean([r["text"] == article_text(html[r["page_id"]]) for r in rows]) > 0.97
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    odd = spark.createDataFrame(
        [(1, None, "u"), (2, "", "u"), (3, PAGE, "u"), (3, PAGE, "u"), (4, "<p>" * 3000, "u"),
         (5, "<article>" + "<p>word word." * 3000, "u")], "page_id long, html string, text string")
    found = by_id(htmltext.extract(odd, model).collect(), "page_id")
    assert found[1][0]["text"] == found[2][0]["text"] == found[4][0]["text"] == ""
    assert len(found[3]) == 2 and found[3][0]["text"].startswith("Head&line First bold.")
    assert "Nice!" not in found[3][0]["text"]
    assert found[5][0]["n_chars"] == 3000 * 11 - 1
    assert htmltext.extract(odd.limit(0), model).count() == 0
    assert htmltext.extract(odd.limit(0), htmltext.train(odd.limit(0))).count() == 0


def test_whole_path_and_all_words_reach_the_labeller():
    long = tuple(f"t{i}" for i in range(30))
    base = (("html", "article", *long), "word " * 10_000 + "end", 0.0)
    model = htmltext.BlockLabeller()

    def found(*block):
        return model._embed(htmltext.Inputs([[block]]))[0]

    assert not np.allclose(found(*base), found(("html", "nav", *long), *base[1:]))
    assert not np.allclose(found(*base), found(base[0], "word " * 10_000 + "fin", 0.0), atol=1e-9)
    # Long texts in pieces have the mean of all their words.
    words = [zlib.crc32(w.encode()) % htmltext.WORD_ROWS for w in base[1].split()]
    start = 2 * htmltext.PATH_SIZE
    assert np.allclose(found(*base)[start:start + htmltext.WORD_SIZE],
                       model.p["word"][words].mean(0))


def test_deeply_nested_blocks_are_labelled(spark):
    pages = [list(htmltext.blocks(r["html"])) for r in
             spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]
    model = htmltext.BlockLabeller()
    model.fit(*htmltext.varied(pages[::2]))
    sequences, labels = htmltext.varied(pages[1::2], seed=99)
    deep, wanted = sequences[2::3], np.concatenate(labels[2::3])
    assert max(len(p) for s in deep for p, _, _ in s) > 30
    assert np.mean((np.concatenate(model.label(deep)) >= 0.5) == wanted) > 0.9


@pytest.mark.parametrize("tag", ["<svg class='x'/>", "<svg>", "<button>", "<select>", "<object>",
                                 "<iframe src='u'>", "<noscript>", "<button>Share",
                                 "<svg><title/></svg>"])
def test_open_elements_keep_what_follows(tag):
    page = f"<body><article><p>One {tag}<p>Two</article><div>Three <button>Go</button></div>"
    found = list(htmltext.blocks(page))
    text = " ".join(t for _, t, _ in found)
    assert text.replace("Share ", "") == "One Two Three Go"
    assert all(htmltext.weak_label(p) == (t in ("One", "Two")) for p, t, _ in found
               if "Share" not in t)
    assert [t for _, t, _ in htmltext.blocks("a<script>b</script>c<title>d")] == ["ac"]
