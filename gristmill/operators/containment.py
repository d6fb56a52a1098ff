"""Which documents contain which passages, word for word.

Built-in expressions offer only a comparison of every passage with every
document.  Here a passage meets only the documents that hold its rarest whole
word (what stands between two spaces of the passage), and only these pairs are
verified.  A passage without such a word is looked up among the distinct words
of the documents by its rarest three letters, and meets the documents of the
words found.  Both are equality joins of narrow rows: passages without a chance
are never formed into pairs, words with a passage are broadcast where they are
few, and a word that many documents hold is split by Spark's skew join, as the
joins are inner ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3
SENT_PASSAGES = 10_000        # passages that are sent to the texts whole


def pieces_of(text: str, size: Column) -> Column:
    """All distinct pieces of this many characters."""
    last = F.length(text) - size + 1
    return F.when(last > 0, F.array_distinct(F.transform(
        F.sequence(F.lit(1), last), lambda i: F.substr(F.col(text), i, size)))).otherwise(
        F.array().cast("array<string>"))


def _words(text: Column) -> Column:
    """What stands between single spaces; empty where two meet."""
    return F.split(text, " ", -1)


def _anchors(parts: DataFrame, held: DataFrame) -> DataFrame:
    """``(passage, part)``: the passage's rarest part.

    ``parts`` is (passage, part), every one needed; ``held`` is (unit, part).  A
    passage with a part that no unit holds gets none.
    """
    counts = held.join(parts.select("part").distinct(), "part", "left_semi").groupBy("part").agg(
        F.count("*").alias("n"))
    rarest = parts.join(counts, "part", "left").groupBy("passage").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), -F.length("part"), "part")).alias("a"))
    return rarest.filter("a.n > 0").select("passage", F.col("a.part").alias("part"))


def _anchored(parts: DataFrame, held: DataFrame) -> DataFrame:
    """``(passage, unit)`` where the unit holds the passage's rarest part."""
    return held.join(_anchors(parts, held), "part").select("passage", "unit")


def _loose(passages: DataFrame, held: DataFrame) -> DataFrame:
    """``(passage, unit)`` for passages without a whole word, by the words that hold their
    longer end."""
    cut = _words(F.col("passage"))
    first, last, n = cut[0], F.element_at(cut, -1), F.size(cut)
    ends = passages.withColumns({
        "piece": F.when(F.length(first) >= F.length(last), first).otherwise(last),
        "inside": n == 1, "ends": F.length(first) >= F.length(last)})
    size = F.least(F.length("piece"), F.lit(GRAM))
    grams = ends.select("passage", F.explode(pieces_of("piece", size)).alias("part"), "piece")
    vocabulary = held.select(F.col("part").alias("unit")).distinct()
    by_gram = vocabulary.select("unit", F.explode(F.array_distinct(F.concat(*[
        pieces_of("unit", F.lit(k)) for k in range(1, GRAM + 1)]))).alias("part"))
    found = _anchored(grams.select("passage", "part").distinct(), by_gram).withColumnRenamed(
        "unit", "word").join(ends, "passage")
    match = F.when(F.col("inside"), F.contains("word", "piece")).when(
        F.col("ends"), F.endswith("word", "piece")).otherwise(F.startswith("word", "piece"))
    words = found.filter(match).select("passage", F.col("word").alias("part"))
    return held.join(words, "part").select("passage", "unit").distinct()


def _blank(passages: DataFrame, texts: DataFrame) -> DataFrame:
    """``(passage, unit)`` for passages of spaces only, the empty one included."""
    runs = F.transform(F.regexp_extract_all("text", F.lit("( +)"), F.lit(1)), lambda r: F.length(r))
    longest = F.coalesce(F.array_max(runs), F.lit(0))
    held = texts.select("unit", F.explode(F.sequence(F.lit(0), longest)).alias("n"))
    return held.join(passages.withColumn("n", F.length("passage")), "n").select("passage", "unit")


def containment_truth(passages: DataFrame, documents: DataFrame, item: str = "item_id",
                      passage: str = "text", doc: str = "doc_id", text: str = "text") -> DataFrame:
    """All distinct (item, doc) pairs where the document's text contains the passage.

    Null passages and texts are in no pair; an empty passage is in every text.
    Ids may be null or repeat.
    """
    known = passages.select(F.col(item).alias("item"), F.col(passage).alias("passage")).filter(
        F.col("passage").isNotNull())
    texts = documents.select(F.col(doc).alias("unit"), F.col(text).alias("text")).filter(
        F.col("text").isNotNull())
    in_text = texts.select("unit", "text", F.explode(F.array_distinct(_words(F.col(
        "text")))).alias("part")).filter("part <> ''")
    held = in_text.select("unit", "part")
    cut = _words(F.col("passage"))
    whole = F.array_remove(F.slice(cut, 2, F.greatest(F.size(cut) - 2, F.lit(0))), "")
    distinct = known.select("passage").distinct().withColumn("whole", F.array_distinct(whole))
    kinds = distinct.agg(
        F.count_if(F.size("whole") > 0).alias("whole"),
        F.count_if((F.size("whole") == 0) & (F.trim("passage") != "")).alias("loose"),
        F.count_if(F.trim("passage") == "").alias("blank")).first()
    parts = distinct.select("passage", F.explode("whole").alias("part"))

    def verified(pairs):
        return pairs.join(texts.withColumnRenamed("unit", "id"), F.col("unit").eqNullSafe(
            F.col("id"))).filter(F.contains("text", "passage")).select("passage", "unit")

    # Few passages go to the texts, which then need no shuffle.
    found = in_text.join(F.broadcast(_anchors(parts, held)), "part").filter(F.contains(
        "text", "passage")).select("passage", "unit") if kinds[
        "whole"] <= SENT_PASSAGES else verified(_anchored(parts, held))
    if kinds["loose"]:
        found = found.unionByName(verified(_loose(distinct.filter(
            (F.size("whole") == 0) & (F.trim("passage") != "")).select("passage"), held)))
    if kinds["blank"]:
        found = found.unionByName(_blank(distinct.filter(F.trim("passage") == "").select(
            "passage"), texts))
    return found.join(known, "passage").select(
        F.col("item").alias(item), F.col("unit").alias(doc)).distinct()


def answer_documents(truth: DataFrame, doc: str) -> DataFrame:
    """The set of documents named by any question."""
    return truth.select(doc).distinct()


def explode_answer_documents(benchmark: DataFrame,
                             ids: str = "correct_answer_document_ids") -> DataFrame:
    """The same set from a benchmark that lists its documents."""
    return benchmark.select(F.explode(ids).alias("document_id")).distinct()
