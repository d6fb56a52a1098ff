"""Toxicity by a weighted finite-state grammar over clauses.

Five transducers read the words of a clause: insult and threat words carry
weights learnt from labelled documents, target words raise the weight of what
follows or precedes them, negation lowers it, and reported speech lowers it
until the clause ends.  Their composition is one transducer whose states are
the combinations of the parts' states; a clause's weight is the sum of what it
puts out.  Only clauses with an insult or threat word can score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.batches import hashed_sample, spread
from gristmill.llm.langid import held_out
from gristmill.llm.registry import query

THRESHOLD = 0.3
LABELLED = 30_000         # labelled documents learnt from, picked by a hash of their id
LEXICON = 20_000          # learnt features kept, strongest first: bounds the broadcast
STEMS = (4, 5, 6)         # prefix lengths that stand for inflected forms
REMEMBERED = 300_000      # words a task remembers whether they score
FLUSH = 200_000           # distinct features a task holds before it sends its counts
WORD = re.compile(r"[^\W\d_]+|[.!?;:\n\"«»“”]")
CLAUSE_END = frozenset(".!?;\n")
QUOTES = frozenset("\"«»“”:")

TARGETS = frozenset(("you your yours yourself he him she her they them these those people "
                     "du dich dir ihr euch sie ihn tu te toi vous ils elles lui tú te vosotros "
                     "usted ustedes ellos ellas").split())
NEGATIONS = frozenset(("not no never nobody none neither nor isn aren don doesn nicht kein keine "
                       "nie niemals pas jamais aucun aucune ne nunca jamás ningún ninguna").split())
REPORTS = frozenset(("said says say wrote writes claimed claims called quoted reported sagte sagt "
                     "schrieb behauptete dit disait écrit déclaré dijo dice escribió afirmó").split())
THREATS = frozenset(("kill hurt destroy beat burn shoot stab töten schlagen verbrennen tuer "
                     "frapper brûler matar golpear quemar").split())
THREAT_WEIGHT = 1.0       # without a target; a target doubles it
FACTORS = {"target": 1.5, "negated": 0.4, "reported": 0.5}
NEGATION_REACH = 3        # words


@dataclass
class Grammar:
    """Learnt weights of words (``=word``) and stems (``^prefix``), and the score curve."""

    weights: dict[str, float] = field(default_factory=dict)
    slope: float = 1.0
    offset: float = 0.0
    seen: dict[str, bool] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        found = self.weights.get("=" + word)
        if found is None:
            found = max((self.weights.get("^" + word[:n], 0.0)
                         for n in STEMS if len(word) >= n), default=0.0)
        return found

    def clause(self, symbols: list[str]) -> float:
        """Weight put out by the composed transducer over one clause's words.

        The state is (target seen, words of negation left, reported); each part
        reads every symbol, and an insult or threat puts out its weight times the
        factors of the state.  A target after the word adds its share afterwards.
        """
        total, waiting = 0.0, 0.0
        targeted, negation, reported = False, 0, False
        for word in symbols:
            if word in QUOTES:
                continue
            out = self.weight(word)
            if word in THREATS and not out:
                out = THREAT_WEIGHT if targeted else 0.0
                waiting += 0.0 if targeted else THREAT_WEIGHT / FACTORS["target"]
            if out > 0:
                out *= FACTORS["target"] if targeted else 1.0
                out *= FACTORS["negated"] if negation else 1.0
                out *= FACTORS["reported"] if reported else 1.0
                total += out
                waiting += 0.0 if targeted else out
            if word in TARGETS:
                if waiting and not targeted:
                    total += waiting * (FACTORS["target"] - 1)
                targeted = True
            elif word in REPORTS:
                reported = True
            negation = NEGATION_REACH if word in NEGATIONS else max(0, negation - 1)
        return total

    def text(self, text: str) -> float:
        """Sum over the clauses that hold an insult or threat word."""
        words = WORD.findall(text.lower())
        scoring = {word for word in set(words) if self.scores(word)}
        if not scoring:
            return 0.0
        total, start, hit = 0.0, 0, False
        for at, word in enumerate([*words, "."]):
            if word in CLAUSE_END:
                if hit:
                    total += self.clause(words[start:at])
                start, hit = at + 1, False
            elif word in scoring:
                hit = True
        return total

    def scores(self, word: str) -> bool:
        """Whether a clause with this word has to be read."""
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) > REMEMBERED:
                self.seen.clear()
            found = self.seen[word] = word in THREATS or self.weight(word) > 0
        return found

    def score(self, total: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * total + self.offset))))


def features(text: str) -> set[str]:
    words = {w for w in WORD.findall(text.lower()) if w[0].isalpha()}
    return {"=" + w for w in words} | {"^" + w[:n] for w in words for n in STEMS if len(w) >= n}


def _feature_counts(rows: DataFrame) -> DataFrame:
    """``feature, toxic, clean``: documents of each label that hold the feature."""
    def count(batches):
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def send():
            names = list(held[0].keys() | held[1].keys())
            yield pa.RecordBatch.from_pydict({
                "feature": pa.array(names, pa.string()),
                "toxic": pa.array([held[1][n] for n in names], pa.int64()),
                "clean": pa.array([held[0][n] for n in names], pa.int64())})
            held[0].clear()
            held[1].clear()

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   strict=True):
                held[toxic].update(features(text or ""))
                if len(held[0]) + len(held[1]) > FLUSH:
                    yield from send()
        yield from send()

    sent = spread(rows).mapInArrow(count, "feature string, toxic long, clean long")
    return sent.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def train(rows: DataFrame) -> Grammar:
    """``text, toxic`` -> grammar: weights from all these rows, then the score curve.

    A word or stem gets a weight where it is far more frequent in toxic
    documents: its log-likelihood ratio must beat chance among all features
    looked at.  The score curve is a logistic fit to (clause weight, label) counts.
    Without rows of both labels every text scores 0.
    """
    rows = rows.filter(F.col("toxic").isin(0, 1)).select(
        F.col("text").cast("string"), F.col("toxic").cast("int").alias("toxic"))
    sums = rows.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in sums}
    if len(n) < 2:
        return Grammar(slope=0.0, offset=-30.0)
    share, odds = n[1] / (n[0] + n[1]), n[1] / n[0]
    seen = F.col("toxic") + F.col("clean")
    gain = F.log((F.col("toxic") + 0.5) / ((F.col("clean") + 0.5) * odds))
    # Log-likelihood ratio of "toxic share among holders" against the overall share.
    tox, part = F.col("toxic") / seen, F.lit(share)
    ratio = 2 * (F.col("toxic") * F.log(F.greatest(tox, F.lit(1e-9)) / part)
                 + F.col("clean") * F.log(F.greatest(1 - tox, F.lit(1e-9)) / (1 - part)))
    strong = _feature_counts(rows).filter((F.col("toxic") >= 3) & (tox >= 0.6)).withColumn(
        "ratio", ratio).filter(F.col("ratio") > 24).withColumn("gain", gain)
    kept = strong.orderBy(F.desc("ratio"), "feature").limit(LEXICON).select(
        "feature", "gain").collect()
    grammar = Grammar({r["feature"]: float(r["gain"]) for r in kept})
    totals = weights(rows.withColumn("key", F.col("toxic")), grammar, "key")
    curve = totals.groupBy(F.col("key").alias("toxic"),
                           F.round("weight", 1).alias("weight")).count()
    # Weights are rounded, so there are few distinct ones; high ones share the last bin.
    bins = curve.withColumn("weight", F.least("weight", F.lit(20.0))).groupBy(
        "toxic", "weight").agg(F.sum("count").alias("n")).collect()
    x = np.array([float(r["weight"]) for r in bins])
    y = np.array([r["toxic"] for r in bins], float)
    many = np.array([r["n"] for r in bins], float)
    a, b = 1.0, 0.0
    for _ in range(200):        # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        slope = np.array([(many * (p - y) * x).sum() + 0.05 * a, (many * (p - y)).sum() + 0.05 * b])
        w = many * p * (1 - p) + 1e-9
        curvature = np.array([[(w * x * x).sum() + 0.05, (w * x).sum()],
                              [(w * x).sum(), w.sum() + 0.05]])
        step = np.linalg.solve(curvature, slope)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
        if np.abs(step).max() < 1e-9:
            break
    grammar.slope, grammar.offset = max(a, 0.0), b
    return grammar


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of at most ``LABELLED`` documents with a label.

    The sample is the first ids in order of their hash; it is small enough to
    be broadcast, so the texts are not shuffled.  An id with both labels counts
    as toxic; null ids and labels are left out.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    picked = hashed_sample(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id",
                           LABELLED)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic")


def weights(docs: DataFrame, grammar: Grammar, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``key, weight``: the grammar's total for each text; null and empty texts give 0."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        own = shared.value
        for batch in batches:
            totals = [own.text(t) if t else 0.0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({key: batch.column(0),
                                              "weight": pa.array(totals, pa.float64())})

    narrow = spread(docs.select(key, F.col(text).cast("string")))
    return narrow.mapInArrow(run, f"`{key}` {kind}, weight double")


def scored(docs: DataFrame, grammar: Grammar, key: str = "doc_id") -> DataFrame:
    """``key, weight, score, predicted`` for every document; repeated rows stay."""
    curve = F.lit(grammar.slope) * F.col("weight") + F.lit(grammar.offset)
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), curve))))
    return weights(docs, grammar, key).withColumn("score", score).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


@query("op8_toxicity_grammar")
def op8(table):
    """All documents, by a grammar learnt from labelled rows outside the held-out quarter."""
    docs = table("documents").select("doc_id", "text")
    rows = labelled(docs, table("labels").filter(~held_out(4)))
    return scored(docs, train(rows)).select(
        "doc_id", held_out(4).alias("held_out"), "score", "predicted", "weight")
