import math
import random
import string
from collections import Counter

import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gristmill.functions import scores, text
from gristmill.functions.stem import stem
from gristmill.operators import chat, checks, documents

SHARED = settings(max_examples=15, deadline=None,
                  suppress_health_check=[HealthCheck.function_scoped_fixture])


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def scored(spark, prediction, target, logprob=None):
    df = spark.createDataFrame([(prediction, target, logprob)],
                               "prediction string, target string, logprob double")
    return scores.score_text(df).first()


def test_scores_by_hand(spark):
    row = scored(spark, "The cat sat", "the cat", -4.0)
    assert row["exact_match"] == 0 and row["contains_match"] == 1
    assert row["f1_overlap"] == pytest.approx(0.8)
    assert row["loss"] == 2 and row["perplexity"] == pytest.approx(math.exp(2))
    assert row["rouge1"] == pytest.approx(0.8) and row["rougeL"] == pytest.approx(0.8)


def test_scores_at_the_edges(spark):
    row = scored(spark, "anything", "", -1.0)
    assert row["contains_match"] == 1 and row["f1_overlap"] == 0 and row["bleu"] == 0
    row = scored(spark, "a", "word", -2000.0)
    assert (row["loss"], row["perplexity"]) == (10.0, 10000.0)
    row = scored(spark, "a", "word", -20.0)
    assert (row["loss"], row["perplexity"]) == (20.0, 10000.0)
    row = scored(spark, "a", "two words", 1.0)
    assert row["loss"] == -1.0 and row["perplexity"] == pytest.approx(math.exp(-1))
    row = scored(spark, "a", "word", None)
    assert (row["loss"], row["perplexity"]) == (10.0, 10000.0)
    row = scored(spark, " Same text. ", "same text.", 0.0)
    assert row["exact_match"] == 1 and row["rouge2"] == 1
    assert scored(spark, "x" * 50 + "tail", "x" * 50 + "other")["contains_match"] == 1


def bleu(prediction, target):
    """By definition, row by row."""
    logs, halving, hit = [], 1.0, False
    for n in range(1, 5):
        total = len(prediction) - n + 1
        if total <= 0:
            break
        grams = [Counter(zip(*(side[i:] for i in range(n)))) for side in (prediction, target)]
        common = (grams[0] & grams[1]).total()
        hit = hit or common > 0
        halving = halving if common else 2 * halving
        logs.append(math.log(common / total if common else 1 / (halving * total)))
    return math.exp(min(0.0, 1 - len(target) / len(prediction)) + sum(logs) / len(logs)) if hit else 0.0


def rouge(prediction, target, n):
    sides = [Counter(zip(*(side[i:] for i in range(n)))) for side in (prediction, target)]
    common = (sides[0] & sides[1]).total()
    return 2 * common / (sides[0].total() + sides[1].total()) if common else 0.0


def batch(pairs, stemmed=False):
    texts = [pd.Series([" ".join(pair[side]) for pair in pairs]) for side in (0, 1)]
    return scores.overlap_batch(texts, texts, stemmed)


def test_bleu_known_values():
    same = "the quick brown fox jumps".split()
    pairs = [(same, same), (["a", "b"], ["a", "c"]), (["x"], ["y"]), ([], ["y"]), (["a"], ["a", "b"])]
    # One of two words right: 1/2 and a smoothed 1/(2*1) over two orders.
    assert batch(pairs)["bleu"].tolist() == pytest.approx(
        [1.0, math.sqrt(0.5 * 0.5), 0.0, 0.0, math.exp(-1)])


@pytest.mark.parametrize("stemmed", [False, True])
def test_batches_equal_the_definitions_row_by_row(monkeypatch, stemmed):
    monkeypatch.setattr(scores, "MASK_CELLS", 1000)     # several groups of rows
    rng = random.Random(2)
    vocabulary = ["the", "a", "run", "running", "runs", "flies", "fly", "x1", "é"]
    pairs = [[[rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 5, 63, 64, 65, 130, 200]))]
              for _ in range(2)] for _ in range(120)]
    # More words than the common steps take.
    pairs.append([[rng.choice(vocabulary) for _ in range(n)] for n in (1100, 300)])
    got = batch(pairs, stemmed)
    named = [[[scores.stem(w) if stemmed and len(w) > 3 else w for w in side] for side in pair]
             for pair in pairs]
    assert got["bleu"].tolist() == pytest.approx([bleu(*pair) for pair in pairs])
    for n in (1, 2):
        assert got[f"rouge{n}"].tolist() == pytest.approx([rouge(*pair, n) for pair in named])
    common = [longest(*pair) for pair in named]
    assert got["rougeL"].tolist() == pytest.approx([
        2 * c / (len(a) + len(b)) if c else 0.0 for c, (a, b) in zip(common, named)])
    assert batch([], stemmed).empty and batch([([], [])], stemmed).to_numpy().tolist() == [[0] * 4]


def test_bleu_tokens(spark):
    got = value(spark, scores.bleu_tokens(F.lit('Say "hi", it\'s 3.5-4 &amp; more.\nEnd-\nless')))
    assert got == 'Say " hi " , it\'s 3.5 - 4 & more . Endless'


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_subsequence_equals_the_table():
    rng = random.Random(5)
    pairs = [[[rng.choice("abcd") for _ in range(rng.randint(0, 90))] for _ in range(2)]
             for _ in range(300)]
    left, right = (pd.Series([" ".join(pair[side]) for pair in pairs]) for side in (0, 1))
    assert scores._Tokens(left, right).subsequence().tolist() == [longest(*pair) for pair in pairs]


@pytest.mark.parametrize("word,want", [
    ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("agreed", "agre"),
    ("plastered", "plaster"), ("motoring", "motor"), ("conflated", "conflat"), ("hopping", "hop"),
    ("falling", "fall"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"),
    ("relational", "relat"), ("conditional", "condit"), ("digitizer", "digit"),
    ("vietnamization", "vietnam"), ("hopefulness", "hope"), ("formaliti", "formal"),
    ("triplicate", "triplic"), ("electrical", "electr"), ("revival", "reviv"),
    ("replacement", "replac"), ("adoption", "adopt"), ("effective", "effect"), ("rate", "rate"),
    ("cease", "ceas"), ("controll", "control"), ("roll", "roll"), ("dies", "die"),
    ("enjoy", "enjoy"), ("generalizations", "gener"), ("oscillators", "oscil")])
def test_stems(word, want):
    assert stem(word) == want


@SHARED
@given(st.text(alphabet=string.ascii_lowercase + " .\n", max_size=60),
       st.text(alphabet=string.ascii_lowercase + " .\n", max_size=60))
def test_scores_stay_in_range(spark, a, b):
    row = scored(spark, a, b, -1.0)
    for name in ("exact_match", "contains_match", "bleu", "rouge1", "rouge2", "rougeL",
                 "f1_overlap"):
        assert 0 <= row[name] <= 1 + 1e-9, name


def test_words_split_like_python(spark):
    sample = "A\tb\x0bc\x1cd e f 　 G\n"
    assert value(spark, text.words(F.lit(sample))) == sample.lower().split()
    assert value(spark, text.strip(F.lit("  x y\n"))) == "x y"


@SHARED
@given(st.text(alphabet="ab é\n😀", max_size=80), st.integers(3, 12), st.integers(0, 2))
def test_fixed_chunks_rebuild_the_text(spark, body, size, overlap):
    pieces = value(spark, text.fixed_pieces(F.lit(body), size, overlap))
    want, start, step = [], 0, size - overlap
    while start < len(body) and (start == 0 or start + overlap < len(body)):
        want.append(body[start:start + size])
        start += step
    assert pieces == want


@SHARED
@given(st.text(alphabet="ab c\n", max_size=120), st.integers(5, 20), st.integers(0, 2))
def test_recursive_chunks_keep_the_text(spark, body, size, overlap):
    df = spark.createDataFrame([(1, body)], "doc_id int, text string")
    rows = documents.chunk(df, method="recursive", size=size, overlap=overlap).orderBy(
        "chunk_no").collect()
    pieces = [r["chunk_text"] for r in rows]
    assert all(len(p) <= size for p in pieces)
    plain = [r["chunk_text"] for r in documents.chunk(
        df, method="recursive", size=size - overlap).orderBy("chunk_no").collect()]
    assert "".join(plain) == body and len(plain) == len(pieces)


def test_recursive_chunks_prefer_paragraphs(spark):
    body = "one two\n\nthree four\nfive six seven"
    assert value(spark, text.recursive_pieces(F.lit(body), 20)) == [
        "one two\n\n", "three four\n", "five six seven"]
    with pytest.raises(ValueError):
        documents.chunk(spark.createDataFrame([(1, "x")], "doc_id int, text string"),
                        method="semantic")


def test_html_text(spark):
    html = ("<html><head><title>t</title></head><body><!-- no --><script>var a='<p>';</script>"
            "<p>One &amp; two</p><div>three&nbsp;<b>four</b></div></body></html>")
    assert value(spark, text.html_to_text(F.lit(html))) == "One & two\nthree four"
    coded = "<p>caf&#233; &eacute;t&#xe9; &mdash; &lt;b&gt; &amp;lt; &unknown; R&amp</p>"
    assert value(spark, text.html_to_text(F.lit(coded))) == "café été — <b> &lt; &unknown; R&"
    df = spark.createDataFrame([("<p>a</p>",), ("<p></p>",), (None,)], "html string")
    out = documents.extraction_summary(documents.extract_text(df)).first()
    assert (out["processed"], out["errors"]) == (1, 2)


def test_templates_and_ids(spark):
    got = text.fill_template("{A} and {{x}} {MISSING}|{B}", {"A": F.lit("{B}"), "B": F.lit(2)})
    assert value(spark, got) == "{B} and {x} |2"
    assert value(spark, text.document_id(F.lit("a/report.pdf.md"))) == "report.pdf"
    assert value(spark, text.document_id(F.lit(".hidden"))) == ".hidden"


def test_stop_strings(spark):
    assert value(spark, text.truncate_at_stop(F.lit("yes\n\nUser: no</s>"))) == "yes"
    assert value(spark, text.truncate_at_stop(F.lit("plain"))) == "plain"
    assert value(spark, text.truncate_at_stop(F.lit("a</s>b<|im_end|>"))) == "a"


MESSAGES = "id int, messages array<struct<role string, content string>>"


def test_chat_parts_both_forms(spark):
    rows = [(1, [("system", "s"), ("user", "u1"), ("user", "u2"), ("assistant", "a1")]),
            (2, [("user", "only")])]
    df = spark.createDataFrame(rows, MESSAGES)
    parts = text.chat_prompt, chat.message_parts(F.col("messages"))
    nested = df.select("id", *[c.alias(n) for n, c in parts[1].items()]).orderBy("id").collect()
    long = chat.chat_parts(checks.messages_long(df, "id"), "id").orderBy("id").collect()
    assert [tuple(r) for r in nested] == [tuple(r) for r in long] == [
        (1, "s", "u1", "a1"), (2, None, "only", None)]
    prompts = chat.prompts_and_targets(chat.chat_parts(checks.messages_long(df, "id"), "id"),
                                       "id").orderBy("id").collect()
    assert prompts[0]["prompt"] == ("<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu1"
                                    "<|im_end|>\n<|im_start|>assistant\n")
    assert prompts[1]["prompt"] == "<|im_start|>user\nonly<|im_end|>\n<|im_start|>assistant\n"
    assert prompts[1]["target"] == ""


def test_chat_checks(spark):
    good = spark.createDataFrame([(1, [("user", "x"), ("tool", "y")])], MESSAGES)
    assert checks.validate_chat(good, "id").count() == 1
    other = good.withColumnRenamed("messages", "conversations")
    assert checks.validate_chat(other, "id").count() == 1
    with pytest.raises(ValueError, match="message 1: invalid role"):
        checks.validate_chat(spark.createDataFrame([(1, [("user", "x"), ("bot", "y")])], MESSAGES),
                             "id")
    with pytest.raises(ValueError, match="missing role or content"):
        checks.validate_chat(spark.createDataFrame([(1, [("user", None)])], MESSAGES), "id")
    call = spark.createDataFrame([(1, [("user", "x"), ("assistant", None)])], MESSAGES)
    assert checks.validate_chat(call, "id").count() == 1
    with pytest.raises(ValueError, match="must be a list"):
        checks.validate_chat(spark.createDataFrame([(1, None)], MESSAGES), "id")
    with pytest.raises(ValueError, match="empty"):
        checks.validate_chat(good.limit(0), "id")
    with pytest.raises(ValueError, match="found"):
        checks.validate_chat(good.withColumnRenamed("messages", "other"), "id")
    late = spark.createDataFrame([(i, [("bot" if i == 150 else "user", "x")]) for i in range(200)],
                                 MESSAGES)
    assert checks.validate_chat(late, "id", full=False).count() == 200
    with pytest.raises(ValueError):
        checks.validate_chat(late, "id")


LONG = "conv_id int, turn int, role string, text string"


def test_holdout_checks(spark):
    bad = [(1, 0, "user", "x"), (2, 0, "user", ""), (2, 1, "assistant", "y"),
           (3, 0, "user", "x"), (3, 1, "user", "x")]
    passes, valid, report = checks.validate_holdout(spark.createDataFrame(bad, LONG))
    assert not passes and valid == 0 and report == [
        "1: fewer than 2 messages", "2: no user message", "3: no assistant message"]
    good = bad + [(4, 0, "user", "q"), (4, 1, "assistant", "a")]
    assert checks.validate_holdout(spark.createDataFrame(good, LONG))[:2] == (True, 1)


def test_freshness_limits(spark):
    df = spark.sql("""
        select * from values (269), (270), (359), (360), (null) as t(days)""").withColumn(
        "at", F.timestamp_seconds(F.lit(1_700_000_000) - F.col("days") * 86400))
    rows = checks.freshness(df, F.col("at"), F.timestamp_seconds(F.lit(1_700_000_000))).collect()
    assert [(r["age_days"], r["category"]) for r in rows] == [
        (269, "fresh"), (270, "warning"), (359, "warning"), (360, "stale"), (0, "stale")]
    order = [r["age_days"] for r in checks.freshness_report(checks.freshness(
        df, F.col("at"), F.timestamp_seconds(F.lit(1_700_000_000)))).collect()]
    assert order == [360, 0, 359, 270, 269]


@pytest.mark.parametrize("form", ["2024-03-01T10:00:00Z", "2024-03-01 10:00:00+0000",
                                  "2024-03-01T12:00:00+02:00"])
def test_dates(spark, form):
    got = value(spark, F.date_format(checks.parse_date(F.lit(form)), "yyyy-MM-dd HH:mm"))
    assert got == "2024-03-01 10:00"


def test_to_chat_and_prompts(spark):
    df = spark.createDataFrame([("do", "", "done")], "i string, x string, o string")
    row = chat.to_chat(df, "alpaca", {"instruction": "i", "input": "x", "output": "o"}).first()
    assert [(m["role"], m["content"]) for m in row["messages"]] == [("user", "do"),
                                                                    ("assistant", "done")]
    with pytest.raises(ValueError):
        chat.to_chat(df, "other", {})
    yoda = spark.createDataFrame([("s", "t", "te")],
                                 "sentence string, translation string, translation_extra string")
    out = chat.prompt_completion(yoda, "sentence", "translation_extra", ["translation"],
                                 "Translate the following to Yoda speak: ")
    assert out.columns == ["prompt", "completion"] and out.first()["prompt"].endswith("speak: s")


def test_shape_training(spark):
    df = spark.createDataFrame([(1, 0, "user", "a b c"), (1, 1, "assistant", "d e"),
                                (2, 0, "user", "too many words here"), (3, 0, "assistant", "z")],
                               LONG)
    rows = chat.shape_training(df, ["conv_id", "turn"], "text", 3, 5).orderBy(
        "conv_id", "turn").collect()
    assert [(r["conv_id"], r["pack"], r["in_loss"]) for r in rows] == [
        (1, 0, False), (1, 0, True), (3, 1, True)]


def test_scores_of_a_batch_are_computed_in_parts_of_bounded_size(monkeypatch):
    texts = [pd.Series([("ab " * (i % 9) + f"w{i % 4} cd").strip() for i in range(60)]),
             pd.Series(["ab w1 cd " * (i % 5) for i in range(60)])] * 2
    whole = scores.overlap_parts(tuple(texts), True)
    sizes, one = [], scores.overlap_batch

    def seen(bleu, rouge, stemmed):
        sizes.append(sum(len(t) for side in (*bleu, *rouge) for t in side))
        return one(bleu, rouge, stemmed)

    monkeypatch.setattr(scores, "BATCH_CHARS", 200)
    monkeypatch.setattr(scores, "overlap_batch", seen)
    parts = scores.overlap_parts(tuple(texts), True)
    assert len(sizes) > 10 and max(sizes) < 200 + 200
    pd.testing.assert_frame_equal(parts, whole)
    empty = scores.overlap_parts(tuple(t.iloc[:0] for t in texts), True)
    assert list(empty.columns) == list(whole.columns) and not len(empty)


def test_references_are_decoded_a_few_texts_at_a_time(monkeypatch):
    monkeypatch.setattr(text, "TEXTS_AT_ONCE", 4)
    texts = pa.array([None, "", "a\xa0b", "a&nbsp;b\xa0c", "&#65;&lt;&copy", "&NewLine;x"] * 5)
    got = text.decode_references.func(texts)
    assert got.to_pylist() == [None, "", "a\xa0b", "a b c", "A<©", "\nx"] * 5
    assert text.decode_references.func(texts.slice(0, 0)).to_pylist() == []
