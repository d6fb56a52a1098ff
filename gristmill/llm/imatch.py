"""Document fingerprints by I-Match over randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency lies in a band.
It is kept as one bit per hash cell (``CELLS`` of them), so its size does not
grow with the corpus.  A document's terms in the lexicon are sorted, and one
hash is taken for each of several lexicon subsets.  Subsets come in scales: those
of the coarsest hold every term of the lexicon, the finer ones ever fewer terms,
so that short and long documents both have subsets of a few terms: an edit
changes only the subsets whose terms it touches.
Column expressions only; texts are split once per fingerprint.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.functions.once import computed_once
from gristmill.llm.batches import spread
from gristmill.llm.registry import query
from gristmill.session import shuffle_width

CELL_BITS = 20
CELLS = 1 << CELL_BITS
IDF_BAND = (2.5, 8.5)     # natural logarithm of documents / documents with the term
SUBSETS = 8               # per scale
# One term in so many belongs to a subset; at the first scale every term to one of them.
SCALES = (SUBSETS, 16, 64, 256, 1024, 4096, 16384)
_SEPARATORS = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    """64-bit hashes of the lower-cased words, one of an empty word where a mark leads."""
    return F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS),
                       lambda w: F.xxhash64(w))


def terms(text: Column) -> Column:
    """Distinct word hashes; none for null and empty texts."""
    return F.array_remove(F.array_distinct(_words(text)), F.xxhash64(F.lit("")))


def _cell(term: Column) -> Column:
    return term.bitwiseAND(F.lit(CELLS - 1))


def lexicon(docs: DataFrame, text: str = "text",
            band: tuple[float, float] = IDF_BAND) -> str:
    """Cells of the terms in the band, as decimal 64-bit words joined by commas.

    Document frequencies are counted over all rows; the counts are summed per
    task before the shuffle, and at most ``CELLS / 64`` words reach the driver.
    A cell met in one document only is never in the band.
    """
    total = docs.count()
    most, least = total * math.exp(-band[0]), max(2.0, total * math.exp(-band[1]))
    cells = spread(docs.select(text)).select(F.explode(F.array_distinct(F.transform(
        _words(F.col(text)), lambda t: _cell(t).cast("int")))).alias("cell"))
    held = cells.groupBy("cell").agg(F.count("*").alias("df")).filter(
        F.col("df").between(F.lit(least), F.lit(most)))
    bits = held.groupBy(F.shiftright("cell", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cell & 63)")).alias("bits")).collect()
    words = [0] * (CELLS // 64)
    for row in bits:
        words[row["word"]] = row["bits"]
    return ",".join(map(str, words))


def fingerprint(text: Column, lexicon_words: str) -> Column:
    """One hash per subset, 0 for a subset without terms.

    A text without any term of the lexicon is represented by all its terms, so
    that it is like its own copies only.
    """
    table = F.split(F.lit(lexicon_words), ",").cast("array<bigint>")

    def listed(term):
        word = F.get(table, F.shiftright(_cell(term), 6).cast("int"))
        return F.call_function("getbit", word, term.bitwiseAND(F.lit(63)).cast("int")) == 1

    none = F.xxhash64(F.array().cast("array<bigint>"))

    def subset(base, scale):
        found = F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda j: F.xxhash64(
            F.filter(base, lambda t: _draw(t, scale) == j)))
        return F.transform(found, lambda h: F.when(h == none, F.lit(0)).otherwise(h))

    def hashes(ordered, scales=SCALES):
        # Each scale's terms are bound to a name, so a coarser scale is read once.
        scale, *finer = scales
        base = F.filter(ordered, lambda t: _draw(t, scale) < SUBSETS)
        return once(base, lambda b: F.concat(subset(b, scale), hashes(b, finer)) if finer
                    else subset(b, scale))

    def once(array, use):       # bind a value to a name inside one expression
        return F.element_at(F.transform(F.array(array), use), 1)

    def chosen(all_terms):
        kept = F.filter(all_terms, listed)
        return once(F.array_sort(kept), lambda k: F.when(F.size(k) > 0, hashes(k)).otherwise(
            F.array_repeat(F.xxhash64(F.array_sort(all_terms)), SUBSETS * len(SCALES))))

    return once(terms(text), chosen)


def _draw(term: Column, scale: int) -> Column:
    """Random place of a term among ``scale``; nested: a finer scale refines a coarser one."""
    return F.shiftrightunsigned(term, CELL_BITS).bitwiseAND(F.lit(scale - 1))


def likeness(a: Column, b: Column) -> Column:
    """Equal subset hashes among the subsets that have terms in either, 0 to 1."""
    pairs = F.filter(F.arrays_zip(a.alias("x"), b.alias("y")),
                     lambda p: (p["x"] != 0) | (p["y"] != 0))
    same = F.size(F.filter(pairs, lambda p: p["x"] == p["y"]))
    return F.when(F.size(pairs) == 0, F.lit(1.0)).otherwise(same / F.size(pairs))


def written(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), ".")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` for every row; equal texts have equal fingerprints."""
    words = lexicon(docs, text)
    return docs.select(key, written(fingerprint(F.col(text), words)).alias("fingerprint"))


def with_next(docs: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Add ``_next``, a struct of ``columns`` of the row with the next larger key.

    Rows are dealt into key ranges whose bounds are keys of the table.  The row
    at a bound also goes to the range before it, as its last row, so that one
    shuffle and no join finds every successor; the first row follows the last.
    Equal keys follow each other in order of the columns.
    """
    spark: SparkSession = docs.sparkSession
    ranges = max(2, shuffle_width(spark))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    found = docs.agg(F.min(key).alias("low"),
                     F.percentile_approx(key, shares, F.lit(10_000)).alias("cuts")).first()
    if found["low"] is None:
        kinds = ", ".join(f"{c}: {docs.schema[c].dataType.simpleString()}" for c in columns)
        return docs.withColumn("_next", F.lit(None).cast(
            "struct<" + kinds.replace(": ", ":") + ">"))
    bounds = sorted({found["low"], *found["cuts"]})
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    place = F.size(F.filter(table, lambda c: c <= F.col(key))) - 1
    before = F.pmod(F.col("_range") - 1, F.lit(len(bounds)))
    at_bound = F.element_at(table, (F.col("_range") + 1).cast("int")) == F.col(key)

    def copy(where, extra):
        return F.struct(where.cast("int").alias("range"), F.lit(extra).alias("extra"))

    dealt = docs.withColumn("_range", place).withColumn("_copy", F.explode(F.when(
        at_bound, F.array(copy(F.col("_range"), 0), copy(before, 1))).otherwise(
        F.array(copy(F.col("_range"), 0)))))
    dealt = dealt.withColumn("_range", F.col("_copy.range")).withColumn(
        "_extra", F.col("_copy.extra")).drop("_copy")
    order = Window.partitionBy("_range").orderBy("_extra", key, *columns)
    return dealt.withColumn("_next", F.lead(F.struct(*columns)).over(order)).filter(
        "_extra = 0").drop("_range", "_extra")


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness.

    The edited form has the last quarter of the text (whole code points, rounded
    down) replaced by as many first ones of the next document.  Null texts are
    empty; rows without an id are left out; other columns are ignored.
    """
    words = lexicon(docs, text)
    plain = spread(docs.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")))
    own = computed_once(plain, "print", fingerprint(F.col("text"), words))
    rows = with_next(own, "doc_id", ["text", "print"])
    size = F.length("text")
    part = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - part),
                      F.substring(F.col("_next.text"), F.lit(1), part))
    rows = computed_once(rows, "edited", edited)
    rows = computed_once(rows, "edited_print", fingerprint(F.col("edited"), words))
    return rows.select(
        "doc_id", size.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("print")).alias("fingerprint"),
        written(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("_next.print")).alias("near_next"))


@query("op2_imatch_fingerprints")
def op2(table):
    """Fingerprints of all documents and of their edited forms."""
    return compared(table("documents"))
