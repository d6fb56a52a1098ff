"""Text-generation scores of one prediction against one target.

The word-set scores and the likelihood scores are built-in expressions.  The
n-gram scores need counts of repeated n-grams and longest common subsequences,
which array expressions can only give in quadratic time: they are computed for
whole Arrow batches, all rows together, with sorted counts of numbered n-grams
and bit vectors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.stem import stem
from gristmill.functions.text import strip, word_count, words

# Score names and direction, caps, lengths.
HIGHER_IS_BETTER = {
    "exact_match": True, "contains_match": True, "bleu": True, "rouge1": True, "rouge2": True,
    "rougeL": True, "f1_overlap": True, "perplexity": False, "loss": False}
PERPLEXITY_CAP = 10000.0
OVERFLOW_LOSS = 10.0
EXP_LIMIT = 709.782712893384      # exp() of more does not fit a double
CONTAINS_CHARS = 50
STEM_ABOVE = 3                    # shorter words are not stemmed

VECTOR_WORDS = 1024               # tokens of a text whose bits fit the common steps of a batch
MASK_CELLS = 1 << 22
BATCH_CHARS = 1 << 20             # characters of all texts that are scored together


def exact_match(prediction: Column, target: Column) -> Column:
    return (F.lower(prediction) == F.lower(target)).cast("double")


def contains_match(prediction: Column, target: Column) -> Column:
    """The first 50 characters of the target occur in the prediction."""
    start = F.when(F.length(target) > CONTAINS_CHARS,
                   F.substring(F.lower(target), 1, CONTAINS_CHARS)).otherwise(F.lower(target))
    return F.contains(F.lower(prediction), start).cast("double")


def _log_loss(logprob: Column, target: Column) -> Column:
    return F.when(logprob < 0, -logprob / F.greatest(word_count(target), F.lit(1))
                  ).otherwise(-logprob)


def loss(logprob: Column, target: Column) -> Column:
    value = _log_loss(logprob, target)
    return F.when(value.isNull() | (value > EXP_LIMIT), OVERFLOW_LOSS).otherwise(value)


def perplexity(logprob: Column, target: Column) -> Column:
    value = _log_loss(logprob, target)
    return F.when(value.isNull() | (value > EXP_LIMIT), PERPLEXITY_CAP).otherwise(
        F.least(F.exp(value), F.lit(PERPLEXITY_CAP)))


def f1_overlap(prediction: Column, target: Column) -> Column:
    """F1 of the distinct words; 0 when either side has none."""
    left, right = F.array_distinct(words(prediction)), F.array_distinct(words(target))
    common = F.size(F.array_intersect(left, right))
    return F.when(common > 0, 2.0 * common / (F.size(left) + F.size(right))).otherwise(0.0)


def bleu_tokens(text: Column) -> Column:
    """Tokens of the standard machine-translation scorer, joined by spaces."""
    # The published tokenisation patterns.
    text = F.replace(F.replace(text, F.lit("<skipped>"), F.lit("")), F.lit("-\n"), F.lit(""))
    text = F.replace(text, F.lit("\n"), F.lit(" "))
    for entity, character in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = F.replace(text, F.lit(entity), F.lit(character))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for pattern, replacement in ((r"([\x7b-\x7e\x5b-\x60\x20-\x26\x28-\x2b\x3a-\x40\x2f])", " $1 "),
                                 (r"([^0-9])([.,])", "$1 $2 "),
                                 (r"([.,])([^0-9])", " $1 $2"),
                                 (r"([0-9])(-)", "$1 $2 ")):
        text = F.regexp_replace(text, pattern, replacement)
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def rouge_tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits, joined by spaces."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


class _Tokens:
    """Tokens of two text columns as numbers: rows and codes of each side."""

    def __init__(self, left: pd.Series, right: pd.Series, stemmed: bool = False):
        lists = [pc.split_pattern(pa.array(side, pa.string()), " ") for side in (left, right)]
        flat = pa.chunked_array([x.flatten() for x in lists], pa.string()).combine_chunks()
        coded = flat.dictionary_encode()
        known, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        filled = np.array([bool(token) for token in known], bool)
        if stemmed:     # each different word of the batch once
            names = {}
            codes = np.array([names.setdefault(
                stem(token) if len(token) > STEM_ABOVE else token, len(names))
                for token in known], np.int64)[codes]
            filled = np.array([bool(name) for name in names], bool)
        self.n, start, self.sides = len(left), 0, []
        for x in lists:
            row = np.repeat(np.arange(self.n), pc.list_value_length(x).to_numpy())
            code = codes[start:start + len(row)].astype(np.int64)
            start += len(row)
            keep = filled[code] if len(code) else np.zeros(0, bool)
            self.sides.append((row[keep], code[keep]))
        self.lengths = [np.bincount(row, minlength=self.n) for row, _ in self.sides]

    def common(self, most: int) -> Iterator[np.ndarray]:
        """Clipped common n-grams of each row, for n from 1 to ``most``.

        An n-gram is numbered from the number of its first n - 1 tokens and
        that of its last one, so its length does not matter.
        """
        grams = [(row, code, np.arange(len(row))) for row, code in self.sides]
        width = 1 + max(int(code.max(initial=0)) for _, code in self.sides)
        for n in range(1, most + 1):
            if n > 1:
                grams = [self._longer(*gram, *side, n, width) for gram, side in zip(grams, self.sides)]
            codes = np.unique(np.concatenate([code for _, code, _ in grams]), return_inverse=True)[1]
            cut, size = len(grams[0][0]), max(1, int(codes.max(initial=0)) + 1)
            grams = [(row, part, at) for (row, _, at), part in zip(grams, (codes[:cut], codes[cut:]))]
            counted = [np.unique(row * size + code, return_counts=True) for row, code, _ in grams]
            keys, left, right = np.intersect1d(counted[0][0], counted[1][0], True, True)
            both = np.minimum(counted[0][1][left], counted[1][1][right])
            yield np.bincount(keys // size, both, self.n).astype(np.int64)

    @staticmethod
    def _longer(row, code, at, rows, codes, n, width):
        """Grams of n tokens from those of n - 1, numbered by both parts."""
        last = at + n - 1
        keep = last < len(rows)
        keep[keep] = rows[last[keep]] == row[keep]
        row, code, last, at = row[keep], code[keep], last[keep], at[keep]
        return row, code * width + codes[last], at

    def subsequence(self) -> np.ndarray:
        """Length of the longest common subsequence of each row.

        One bit for each left token and one step for each right token: rows of
        up to ``VECTOR_WORDS`` tokens advance together in 64-bit words, longer
        ones by one large integer each.
        """
        found = np.zeros(self.n, np.int64)
        words = -(-self.lengths[0] // 64)
        for size in np.unique(words[words > 0]).tolist():
            rows = np.flatnonzero(words == size)
            rows = rows[np.argsort(-self.lengths[1][rows], kind="stable")]
            step = max(1, MASK_CELLS // (64 * size * size)) if size <= VECTOR_WORDS // 64 else 1
            for start in range(0, len(rows), step):
                part = rows[start:start + step]
                found[part] = self._together(part, size) if size <= VECTOR_WORDS // 64 else \
                    self._alone(part[0])
        return found

    def _of(self, side: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place among ``rows``, place in the text and code of their tokens."""
        row, code = self.sides[side]
        first = np.cumsum(self.lengths[side]) - self.lengths[side]
        sizes = self.lengths[side][rows]
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return np.repeat(np.arange(len(rows)), sizes), at, code[np.repeat(first[rows], sizes) + at]

    def _together(self, rows: np.ndarray, size: int) -> np.ndarray:
        """Rows by falling right length, each with left tokens for ``size`` words of bits."""
        place, at, code = self._of(0, rows)
        width = max(int(c.max(initial=0)) for _, c in self.sides) + 1
        keys, which = np.unique(place * width + code, return_inverse=True)
        masks = np.zeros((len(keys) + 1, size), np.uint64)
        np.bitwise_or.at(masks, (which, at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
        place, _, code = self._of(1, rows)
        wanted = place * width + code
        index = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        index[keys[index] != wanted] = len(keys)
        sizes = self.lengths[1][rows]
        first, state = np.cumsum(sizes) - sizes, np.full((len(rows), size), ~np.uint64(0))
        for token in range(int(sizes[0]) if len(sizes) else 0):
            active = np.searchsorted(-sizes, -token)        # the rows with a token here
            now = state[:active]
            met = now & masks[index[first[:active] + token]]
            rest, carry = now & ~met, np.zeros(active, np.uint64)
            for word in range(size):
                total = now[:, word] + met[:, word]
                over = total < met[:, word]
                whole = total + carry
                carry = (over | (whole < carry)).astype(np.uint64)
                now[:, word] = whole | rest[:, word]
        return 64 * size - np.bitwise_count(state).sum(axis=1).astype(np.int64)

    def _alone(self, row: int) -> int:
        left, right = (self._of(side, np.array([row]))[2].tolist() for side in (0, 1))
        places: dict[int, int] = {}
        for i, token in enumerate(left):
            places[token] = places.get(token, 0) | 1 << i
        state = full = (1 << len(left)) - 1
        for token in right:
            met = state & places.get(token, 0)
            state = (state + met | state - met) & full
        return len(left) - state.bit_count()


def bleu_scores(tokens: _Tokens) -> np.ndarray:
    """Sentence BLEU up to 4-grams, exponential smoothing, effective order."""
    left, right = (n.astype(np.float64) for n in tokens.lengths)
    logs, orders, halving = np.zeros(tokens.n), np.zeros(tokens.n), np.ones(tokens.n)
    hit = np.zeros(tokens.n, bool)
    for n, common in enumerate(tokens.common(4), 1):
        total = left - n + 1
        valid, some = total > 0, common > 0
        halving[valid & ~some] *= 2
        share = np.where(some, common, 1 / halving) / np.maximum(total, 1)
        logs += np.where(valid, np.log(share), 0)
        orders += valid
        hit |= valid & some
    brevity = np.minimum(0, 1 - right / np.maximum(left, 1))
    return np.where(hit, np.exp(brevity + logs / np.maximum(orders, 1)), 0.0)


def _f1(common: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.where(common > 0, 2 * common / np.maximum(left + right, 1), 0.0)


def overlap_batch(bleu: tuple[pd.Series, pd.Series], rouge: tuple[pd.Series, pd.Series],
                  stemmed: bool) -> pd.DataFrame:
    """The four scores of a batch of token texts."""
    tokens = _Tokens(*rouge, stemmed)
    left, right = tokens.lengths
    ones, twos = tokens.common(2)
    return pd.DataFrame({
        "bleu": bleu_scores(_Tokens(*bleu)), "rouge1": _f1(ones, left, right),
        "rouge2": _f1(twos, np.maximum(left - 1, 0), np.maximum(right - 1, 0)),
        "rougeL": _f1(tokens.subsequence(), left, right)})


def overlap_parts(texts: tuple[pd.Series, ...], stemmed: bool) -> pd.DataFrame:
    """The scores of a batch, computed for rows of about ``BATCH_CHARS`` characters at a time.

    The arrays of a part take many times the bytes of its texts.
    """
    sizes = sum(np.fromiter((len(t) if isinstance(t, str) else 0 for t in side), np.int64,
                            len(side)) for side in texts)
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // BATCH_CHARS, prepend=-1)).tolist()
    parts = [[side.iloc[low:high] for side in texts]
             for low, high in zip(cuts, [*cuts[1:], len(sizes)])] or [list(texts)]
    return pd.concat([overlap_batch(tuple(p[:2]), tuple(p[2:]), stemmed) for p in parts],
                     ignore_index=True)


def overlap_scores(prediction: Column, target: Column, stemmed: bool = True) -> Column:
    """Struct of bleu, rouge1, rouge2 and rougeL."""
    @F.pandas_udf("bleu double, rouge1 double, rouge2 double, rougeL double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield overlap_parts(texts, stemmed)

    return score(bleu_tokens(prediction), bleu_tokens(target),
                 rouge_tokens(prediction), rouge_tokens(target))


def score_text(df: DataFrame, prediction: str = "prediction", target: str = "target",
               logprob: str | None = "logprob", stemmed: bool = True) -> DataFrame:
    """Add the nine scores; both texts are stripped first."""
    left = strip(F.coalesce(F.col(prediction), F.lit("")))
    right = strip(F.coalesce(F.col(target), F.lit("")))
    likelihood = F.col(logprob).cast("double") if logprob else F.lit(None).cast("double")
    scored = df.withColumn("_overlap", overlap_scores(left, right, stemmed))
    return scored.withColumns({
        "exact_match": exact_match(left, right), "contains_match": contains_match(left, right),
        "bleu": F.col("_overlap.bleu"), "rouge1": F.col("_overlap.rouge1"),
        "rouge2": F.col("_overlap.rouge2"), "rougeL": F.col("_overlap.rougeL"),
        "f1_overlap": f1_overlap(left, right), "perplexity": perplexity(likelihood, right),
        "loss": loss(likelihood, right)}).drop("_overlap")


def score_summary(df: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Mean of the nine scores."""
    return df.groupBy(*(group or [])).agg(*[F.avg(m).alias(m) for m in HIGHER_IS_BETTER])


def best_by_metric(df: DataFrame, run: str, metrics: Sequence[str]) -> DataFrame:
    """The run with the best mean of each score, each in its own direction; ties to the
    smallest run."""
    means = df.groupBy(run).agg(*[F.round(F.avg(m), 6).alias(m) for m in metrics])
    rows = means.unpivot([run], list(metrics), "metric", "mean").filter("mean is not null")
    up = F.col("metric").isin([m for m in metrics if HIGHER_IS_BETTER[m]])
    loss = F.when(up, -F.col("mean")).otherwise(F.col("mean"))
    return rows.groupBy("metric", up.alias("higher_is_better")).agg(
        F.min_by(F.struct(run, "mean"), F.struct(loss, F.col(run))).alias("_best")).select(
        "metric", "higher_is_better", F.col(f"_best.{run}").alias("best_run"),
        F.col("_best.mean").alias("mean"))
