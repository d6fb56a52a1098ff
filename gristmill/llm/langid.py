"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and every run of non-letters becomes one space; the 1- to
3-grams of the result are hashed into ``BUCKETS``.  Counts per language and
bucket over all training rows give a matrix of log probabilities.  Its size is
``languages * BUCKETS`` whatever the corpus, so it is broadcast; each task
multiplies the sparse n-gram counts of a chunk of documents by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.batches import spread
from gristmill.llm.registry import query

BUCKETS = 1 << 16
SMOOTHING = 0.5
MAX_LANGUAGES = 500       # bounds the broadcast matrix: 500 * 65,536 * 4 bytes = 131 MB
CHUNK_CHARS = 1 << 20
UNKNOWN = "und"
_HASH = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


def letter_table() -> np.ndarray:
    """True for the code points that are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def cleaned(text: str, letters: np.ndarray) -> np.ndarray:
    """Code points of the lower-cased text, each run of non-letters as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letters[points]
    if not known.any():
        return points[:0]
    first = np.empty(len(points), bool)
    first[0], first[1:] = True, known[:-1]
    kept = np.where(known, points, np.uint32(32))[known | first]
    start, end = int(kept[0] == 32), len(kept) - int(kept[-1] == 32)
    return np.concatenate([kept[:1] * 0 + 32, kept[start:end], kept[:1] * 0 + 32]).astype(np.uint32)


def gram_buckets(points: np.ndarray) -> np.ndarray:
    """Buckets of the 1- to 3-grams that start at each position (rows of three)."""
    padded = np.concatenate([points, np.zeros(2, np.uint32)])
    n = len(points)
    with np.errstate(over="ignore"):
        one = padded[:n] * _HASH[0] + np.uint32(1)
        two = (one ^ (one >> np.uint32(15))) * _HASH[1] + padded[1:n + 1] * _HASH[2]
        three = (two ^ (two >> np.uint32(13))) * _HASH[2] + padded[2:n + 2] * _HASH[0]
    shift = np.uint32(16)
    return np.stack([(h ^ (h >> np.uint32(7))) * _HASH[1] >> shift for h in (one, two, three)], 1)


@dataclass
class Model:
    languages: list[str]
    log_probability: np.ndarray     # BUCKETS x languages, float32
    log_prior: np.ndarray


def train(rows: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """Count n-grams per language over all rows with a label and letters.

    Every task sends one count row per language, so what is shuffled depends on
    the number of tasks and languages only.
    """
    used = rows.filter(F.col(label).isNotNull()).select(
        F.col(label).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))

    def count(batches):
        letters, counts, documents = letter_table(), {}, {}
        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  strict=True):
                points = cleaned(body or "", letters)
                if not len(points):
                    continue
                own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                documents[lang] = documents.get(lang, 0) + 1
                for at in range(0, len(points), CHUNK_CHARS):
                    grams = gram_buckets(points[at:at + CHUNK_CHARS + 2])[:CHUNK_CHARS]
                    own += np.bincount(grams.ravel(), minlength=BUCKETS)
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * (len(at) + 1)),
                "bucket": pa.array(np.append(at, -1).astype(np.int32)),
                "n": pa.array(np.append(own[at], documents[lang]))})

    totals = spread(used).mapInArrow(count, "lang string, bucket int, n long").groupBy(
        "lang", "bucket").agg(F.sum("n").alias("n"))
    per_language = totals.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("all"))
    found = per_language.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of {label}")
    found.sort(key=lambda r: r["lang"])
    matrix = np.zeros((BUCKETS, len(found)))
    prior = np.zeros(len(found))
    for k, row in enumerate(found):
        for bucket, n in row["all"]:
            if bucket < 0:
                prior[k] = n
            else:
                matrix[bucket, k] = n
    smooth = matrix + SMOOTHING
    return Model([r["lang"] for r in found],
                 np.log(smooth / smooth.sum(0, keepdims=True)).astype(np.float32),
                 np.log(prior / max(prior.sum(), 1)))


def judged(texts: pa.Array, model: Model, letters: np.ndarray) -> tuple[list[str], list[float]]:
    """Best language and its posterior for each text."""
    names, scores = [], []
    for body in texts.to_pylist():
        points = cleaned(body or "", letters)
        if not len(points) or not model.languages:
            names.append(UNKNOWN)
            scores.append(0.0)
            continue
        total = model.log_prior.copy()
        for at in range(0, len(points), CHUNK_CHARS):
            grams = gram_buckets(points[at:at + CHUNK_CHARS + 2])[:CHUNK_CHARS].ravel()
            if len(grams) > BUCKETS:
                counts = np.bincount(grams, minlength=BUCKETS)
                total += counts @ model.log_probability.astype(float)
            else:
                total += model.log_probability[grams].sum(0, dtype=float)
        best = int(np.argmax(total))
        names.append(model.languages[best])
        scores.append(float(1 / np.exp(total - total[best]).sum()))
    return names, scores


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score``: best language and its posterior probability.

    Null texts, texts without a letter, and any text under a model without
    languages give ``und`` and score 0.  Ties go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        letters = letter_table()
        for batch in batches:
            names, scores = judged(batch.column(1), shared.value, letters)
            yield pa.RecordBatch.from_pydict({
                key: batch.column(0), "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(scores, pa.float64())})

    narrow = spread(docs.select(key, F.col(text).cast("string")))
    return narrow.mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def held_out(remainders: int, key: str = "doc_id") -> Column:
    """True for the documents that no model here may learn from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % remainders == 2


def identify(docs: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """``doc_id, lang_pred, score`` for all documents, trained on ``rows`` or on all."""
    return predict(docs, train(docs if rows is None else rows))


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents with a recognised language, with their columns as they were.

    Rejected are texts without letters (null and empty ones too) and texts
    whose best language has a posterior below ``least``.  Repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs.select("text", "lang")))

    def run(batches):
        letters = letter_table()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            names, scores = judged(texts, shared.value, letters)
            kept = [n != UNKNOWN and s >= least for n, s in zip(names, scores, strict=True)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return spread(docs).mapInArrow(run, docs.schema)


@query("op3_language_id")
def op3(table):
    """Predictions for all documents; the held-out quarter is not learnt from."""
    docs = table("documents").select("doc_id", "text", "lang")
    found = predict(docs.drop("lang"), train(docs.filter(~held_out(4))))
    return found.select("doc_id", held_out(4).alias("held_out"), "lang_pred", "score")
