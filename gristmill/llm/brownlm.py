"""Class-based n-gram scores: exchange clustering, class transitions, word emissions.

Words are handled by 64-bit hashes.  ``vocabulary`` counts every token of the
training rows; it grows with the corpus and stays distributed.  Its most
frequent words, at most ``FREQUENT`` of them, are broadcast; the rest reach
their counts and classes by a join.  All words seen ``LEAST`` times or more are
clustered, those seen less often form the rare class with unseen ones.

Exchange on the driver, one word at a time, gives the ``CLUSTERED`` most frequent
words the classes to start from; it works on a matrix of fixed size.  From there
the whole vocabulary is exchanged where it lies: tasks move all words at once,
each to the class that makes its contexts likeliest, and send back only the class
counts, until a sweep moves none.  That is done twice: with the contexts that the
first words give, then with those of all broadcast words.  The context of a token
is the class of the last broadcast word before it that has one, so rare words in
between do not hide it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.batches import byte_texts, chunks, map_batches, signed, spread, word_hashes
from gristmill.llm.langid import held_out
from gristmill.llm.registry import query
from gristmill.session import scratch_path, shuffle_width

FREQUENT = 1 << 18        # words broadcast with their counts: 4 MB
LEAST = 6                 # words seen less often belong to the rare class, as unseen ones do
CLUSTERED = 1024          # words that make the classes to start from
CLASSES = 32
SWEEPS = 8
FINE = 1 << 20            # steps of a logarithm: whole numbers, so equal in every task
PULL = 20.0               # weight of the unconditional class distribution
FLUSH = 1 << 20           # distinct words a task holds before it sends its counts
_BINS = 8                 # histogram steps per doubling of a count


def _token_chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First text, word hashes and offsets of each bounded chunk of a batch."""
    texts = [t.lower() for t in byte_texts(batch.column(column))]
    for start, end in chunks(texts):
        words, offsets = word_hashes(texts[start:end])
        yield start, words, offsets


def vocabulary(rows: DataFrame, text: str = "text") -> DataFrame:
    """``h, c``: every distinct word of the rows and its count."""
    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            words = np.concatenate([w for w, _ in held])
            sums = np.concatenate([c for _, c in held])
            order = np.argsort(words, kind="stable")
            words, sums = words[order], sums[order]
            first = np.flatnonzero(np.diff(words, prepend=~words[:1]))
            return words[first], np.add.reduceat(sums, first)

        size = 0
        for batch in batches:
            for _, words, _ in _token_chunks(batch, 0):
                if not len(words):
                    continue
                held.append(np.unique(words, return_counts=True))
                size += len(held[-1][0])
                if size > 2 * FLUSH:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > FLUSH:
                        yield _pairs(*held[0])
                        held, size = [], 0
        if held:
            yield _pairs(*merged())

    def _pairs(words, counts):
        return pa.RecordBatch.from_pydict({"h": signed(words), "c": counts.astype(np.int64)})

    sent = spread(rows.select(F.col(text).cast("string"))).mapInArrow(count, "h long, c long")
    return sent.groupBy("h").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    """Everything bounded that scoring needs; ``h`` is sorted."""

    h: np.ndarray           # uint64 hashes of the frequent words
    c: np.ndarray           # their counts
    word_class: np.ndarray
    transition: np.ndarray  # log10 p(class | context), contexts x classes
    emission: np.ndarray    # log10 p(word | class)
    tokens: int             # all training tokens, ends included
    types: int              # distinct training tokens, the end included
    ends: int               # training documents
    rare_base: float        # log10 of the rare class's denominator
    own: np.ndarray         # tokens of each class


RARE, END, START = CLASSES, CLASSES + 1, CLASSES
STATES = CLASSES + 1      # contexts: the classes and the start


def _lookup(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index of each word in the sorted table, -1 where it is absent."""
    if not len(table):
        return np.full(len(words), -1)
    at = np.searchsorted(table, words)
    at[at == len(table)] = 0
    return np.where(table[at] == words, at, -1)


def _with_ends(values: np.ndarray, offsets: np.ndarray, end: int) -> np.ndarray:
    """Insert ``end`` after each text's values."""
    return np.insert(values, offsets[1:], end)


def _contexts(classes: np.ndarray) -> np.ndarray:
    """Class of the last word with a class before each token; the start after an end."""
    informs = (classes < CLASSES) | (classes == END)
    last = np.maximum.accumulate(np.where(informs, np.arange(len(classes)), -1))
    before = np.concatenate([[-1], last[:-1]])
    found = classes[before]
    return np.where((before < 0) | (found == END), START, found)


def _summed(rows: DataFrame, size: int, places: Callable[[np.ndarray, np.ndarray], np.ndarray],
            text: str) -> np.ndarray:
    """Sum over all rows of how often ``places`` names each of ``size`` cells."""
    def count(batches):
        cells = np.zeros(size, np.int64)
        for batch in batches:
            for _, words, offsets in _token_chunks(batch, 0):
                cells += np.bincount(places(words, offsets), minlength=size)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_pydict({"cell": at.astype(np.int64), "n": cells[at]})

    sent = spread(rows.select(F.col(text).cast("string"))).mapInArrow(count, "cell long, n long")
    table = sent.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    return out


def exchange(counts: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Exchange clustering: word bigram counts -> class of each word.

    Words start in classes by rank and move, one at a time, to the class with
    the highest class-bigram likelihood, until a sweep moves none.
    """
    n_words = len(counts)
    of = np.arange(n_words) % classes
    member = np.zeros((n_words, classes))
    member[np.arange(n_words), of] = 1
    counts = counts.astype(float)
    n = member.T @ counts @ member
    left, right = counts.sum(1), counts.sum(0)

    def f(x):
        return x * np.log(np.maximum(x, 1e-12))

    diagonal = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for w in range(n_words):
            own, old = counts[w, w], of[w]
            after, before = counts[w] @ member, counts[:, w] @ member
            after[old] -= own
            before[old] -= own
            n[old] -= after
            n[:, old] -= before
            n[old, old] -= own
            base = f(n)
            rows = f(n + after) - base
            columns = f(n + before[:, None]) - base
            joint = f(n[diagonal, diagonal] + after + before + own) - base[diagonal, diagonal]
            gain = (rows.sum(1) - rows[diagonal, diagonal] + columns.sum(0)
                    - columns[diagonal, diagonal] + joint)
            out, into = n.sum(1), n.sum(0)
            gain -= f(out + left[w]) - f(out) + f(into + right[w]) - f(into)
            best = int(np.argmax(gain))
            if gain[best] <= gain[old] + 1e-9:
                best = old
            member[w, old], of[w] = 0, best
            member[w, best] = 1
            n[best] += after
            n[:, best] += before
            n[best, best] += own
            moved += best != old
        if not moved:
            break
    return of


def profiles(rows: DataFrame, h: np.ndarray, word_class: np.ndarray,
             text: str = "text") -> DataFrame:
    """``h, c, kind, v``: every word, its count and how often it has each context.

    ``word_class`` are the classes of the words ``h`` that make contexts.  Words
    under ``LEAST`` have the kind ``RARE``, others 0; contexts of rare words and
    of ends (kind ``END``) are summed, a row of each for every partition, without
    a count.
    """
    def count(batches):
        known = np.zeros(len(h) * STATES, np.int32)
        ends = np.zeros(STATES, np.int64)
        held: list[tuple[np.ndarray, ...]] = []

        def merged(parts):
            words, states, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort([states, words])
            words, states, counts = words[order], states[order], counts[order]
            first = np.ones(len(words), bool)
            first[1:] = (words[1:] != words[:-1]) | (states[1:] != states[:-1])
            at = np.flatnonzero(first)
            return words[at], states[at], np.add.reduceat(counts, at)

        size = 0
        for batch in batches:
            for _, words, offsets in _token_chunks(batch, 0):
                at = _lookup(words, h)
                states = _contexts(_with_ends(word_class[at], offsets, END))
                last = offsets[1:] + np.arange(len(offsets) - 1)
                ends += np.bincount(states[last], minlength=STATES)
                states = np.delete(states, last)
                cells, times = np.unique(at[at >= 0] * STATES + states[at >= 0], return_counts=True)
                known[cells] += times.astype(np.int32)
                other = words[at < 0]
                if not len(other):
                    continue
                held.append(merged([(other, states[at < 0], np.ones(len(other), np.int64))]))
                size += len(held[-1][0])
                if size > 2 * FLUSH:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > FLUSH:
                        yield sent_rows(*held[0])
                        held, size = [], 0
        if held:
            yield sent_rows(*merged(held))
        cells = np.flatnonzero(known)
        for start in range(0, len(cells), FLUSH):
            part = cells[start:start + FLUSH]
            yield sent_rows(h[part // STATES], part % STATES, known[part])
        yield sent_rows(np.zeros(STATES, np.uint64), STATES + np.arange(STATES), ends)

    def sent_rows(words, states, counts):
        return pa.RecordBatch.from_pydict({"h": signed(words), "s": states.astype(np.int8),
                                           "n": counts.astype(np.int64)})

    def gather(batches):
        rest = np.zeros((2, STATES), np.int64)
        word, seen = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            words, states, counts = (batch.column(i).to_numpy() for i in range(3))
            new = np.append(True, words[1:] != words[:-1])
            cells = (np.cumsum(new) - 1) * (2 * STATES) + states
            sums = np.bincount(cells, counts, np.count_nonzero(new) * 2 * STATES).astype(
                np.int64).reshape(-1, 2 * STATES)
            names = words[new]
            if word is not None and names[0] == word:
                sums[0] += seen
            elif word is not None:
                yield kept(np.array([word]), seen[None], rest)
            word, seen = names[-1], sums[-1]
            yield kept(names[:-1], sums[:-1], rest)
        if word is not None:
            yield kept(np.array([word]), seen[None], rest)
        yield table(np.zeros(2, np.int64), np.zeros(2, np.int64), np.array([RARE, END]), rest)

    def kept(names, sums, rest):
        own, total = sums[:, :STATES], sums[:, :STATES].sum(1)
        rare = total < LEAST
        rest += np.stack([own[rare].sum(0), sums[:, STATES:].sum(0)])
        real = total > 0
        return table(names[real], total[real], np.where(rare, RARE, 0)[real],
                     np.where(rare[:, None], 0, own)[real])

    def table(names, total, kind, sums):
        cuts = np.arange(len(names) + 1, dtype=np.int32) * (8 * STATES)
        data = pa.Array.from_buffers(pa.binary(), len(names), [
            None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(sums, np.int64))])
        return pa.RecordBatch.from_pydict({
            "h": names.astype(np.int64), "c": total.astype(np.int64),
            "kind": kind.astype(np.int32), "v": data})

    sent = spread(rows.select(F.col(text).cast("string"))).mapInArrow(count, "h long, s byte, n long")
    dealt = sent.repartition(shuffle_width(rows.sparkSession), "h").sortWithinPartitions("h")
    return dealt.mapInArrow(gather, "h long, c long, kind int, v binary")


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, STATES)


def fits(moves: np.ndarray) -> np.ndarray:
    """Class counts, contexts x classes -> logarithms of p(context | class) in whole steps."""
    known = moves + 0.5
    return np.rint(np.log(known / known.sum(0)) * FINE).astype(np.int64)


def class_moves(words: DataFrame, place: Callable[[np.ndarray, np.ndarray], np.ndarray],
                before: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """Counts, contexts x classes, where ``place`` gives words a class or -1, and how many moved.

    Moved are words whose class is not the best by ``before``.
    """
    def count(batches):
        cells, moved = np.zeros((STATES, CLASSES)), 0
        for batch in batches:
            seen = _vectors(batch.column(1))
            of = place(np.array(batch.column(0)).view(np.uint64), seen)
            if before is not None:
                moved += int(np.count_nonzero(of != np.argmax(seen @ before, 1)))
            member = np.zeros((len(of), CLASSES))
            member[of >= 0, of[of >= 0]] = 1
            cells += seen.T.astype(float) @ member      # whole numbers below 2^53: exact
        cells = np.append(cells.ravel(), moved)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_pydict({"cell": at.astype(np.int64), "n": cells[at].astype(np.int64)})

    table = words.select("h", "v").mapInArrow(count, "cell long, n long").groupBy("cell").agg(
        F.sum("n").alias("n")).toArrow()
    out = np.zeros(STATES * CLASSES + 1, np.int64)
    out[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    return out[:-1].reshape(STATES, CLASSES), int(out[-1])


def exchange_all(words: DataFrame, h: np.ndarray, word_class: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exchange over all words, from the classes of ``h``: the fits of the last sweep and its counts.

    Class counts are kept for a sweep, then counted anew.  A word's best class is
    then the best of all in each sweep, and the likelihood never falls.
    """
    def given(names, seen):
        of = word_class[_lookup(names, h)]
        return np.where(of < CLASSES, of, -1)

    moves, _ = class_moves(words, given)
    fit, before = fits(moves), None
    for _ in range(SWEEPS):
        moves, moved = class_moves(words, lambda _, seen, fit=fit: np.argmax(seen @ fit, 1), before)
        if before is not None and not moved:
            break
        before, fit = fit, fits(moves)
    return before, moves


def best_classes(words: DataFrame, fit: np.ndarray) -> DataFrame:
    """``h, c, class`` of words with their kinds; rare words have the class ``RARE``."""
    def name(batch: pa.RecordBatch) -> Iterator[dict]:
        rare = batch.column(2).to_numpy() == RARE
        yield {"h": batch.column(0), "c": batch.column(1),
               "class": np.where(rare, RARE, np.argmax(_vectors(batch.column(3)) @ fit, 1)).astype(np.int32)}

    return map_batches(words.select("h", "c", "kind", "v"), name, "h long, c long, class int")


def train(rows: DataFrame, stored: str, text: str = "text") -> Model:
    """Fit on all rows; the whole vocabulary is written to ``stored``.

    The classes of words that are not broadcast are written beside it.
    """
    spark = rows.sparkSession
    vocabulary(rows, text).write.parquet(stored)
    words = spark.read.parquet(stored)
    # Words under LEAST share bin -1, which is never broadcast.
    bin_of = F.when(F.col("c") >= LEAST, F.floor(F.log2("c") * _BINS)).otherwise(-1)
    histogram = sorted(words.groupBy(bin_of.alias("bin")).agg(
        F.count("*").alias("types"), F.sum("c").alias("tokens")).collect(), reverse=True)
    ends = rows.count()
    kept, cut = 0, None
    for row in histogram:
        if row["bin"] < 0 or kept + row["types"] > FREQUENT:
            break
        kept, cut = kept + row["types"], row["bin"]
    table = words.filter(bin_of >= F.lit(cut)).toArrow() if cut is not None else None
    h = np.array(table.column("h").to_numpy()).view(np.uint64) if table else np.empty(0, np.uint64)
    c = np.array(table.column("c").to_numpy()) if table else np.empty(0, np.int64)
    order = np.argsort(h)
    h, c = h[order], c[order]
    word_types = sum(r["types"] for r in histogram)
    word_tokens = sum(r["tokens"] for r in histogram)
    rank = np.lexsort([h, -c])

    # Bigram counts of the most frequent words; all others are one symbol each way.
    top = rank[:CLUSTERED]
    symbol = np.full(len(h) + 1, len(top))
    symbol[top] = np.arange(len(top))
    width = len(top) + 1

    def bigrams(found, offsets):
        ids = _with_ends(symbol[_lookup(found, h)], offsets, len(top))
        return ids[:-1] * width + ids[1:]

    matrix = _summed(rows, width * width, bigrams, text).reshape(width, width)[:-1, :-1]
    word_class = np.full(len(h) + 1, RARE)
    if len(top):
        word_class[top] = exchange(matrix)
    least = int(c.min()) if len(c) else None
    for turn in range(2):
        path = f"{stored}-contexts{turn}"
        profiles(rows, h, word_class, text).write.parquet(path)
        seen = spark.read.parquet(path)
        fit, moves = exchange_all(seen.filter("kind = 0"), h, word_class)
        classes = best_classes(seen.filter("c > 0"), fit)
        if least is not None:
            found = classes.filter(F.col("c") >= least).toArrow()
            at = _lookup(np.array(found.column("h").to_numpy()).view(np.uint64), h)
            word_class[at] = found.column("class").to_numpy()
    if least is not None:
        classes = classes.filter(F.col("c") < least)
    classes.write.parquet(f"{stored}-classes")
    other = seen.filter(F.col("kind").isin(RARE, END) & (F.col("c") == 0)).select("kind", "v").toArrow()
    beside, sums = other.column("kind").to_numpy(), _vectors(other.column("v"))
    moves = np.column_stack([moves, *(sums[beside == kind].sum(0) for kind in (RARE, END))])
    plain = moves.sum(0) + 1.0
    plain /= plain.sum()
    chance = (moves + PULL * plain) / (moves.sum(1, keepdims=True) + PULL)
    own = moves.sum(0)
    rare = sum(r["tokens"] + r["types"] for r in histogram if r["bin"] < 0) + 1
    return Model(h, c, word_class, np.log10(chance),
                 np.log10(c / np.maximum(own[word_class[:-1]], 1)), word_tokens + ends,
                 word_types + (ends > 0), ends, float(np.log10(rare)), own)


def score(docs: DataFrame, model: Model, stored: str, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``key, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``.

    ``score`` and ``base_score`` are log10 probabilities.  Null texts are empty:
    one token, the end.  Repeated rows stay.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        m = shared.value
        known_class = np.concatenate([m.emission, [-m.rare_base]])
        logs = np.concatenate([np.log10(m.c + 1.0), [0.0]])
        whole = np.log10(m.tokens + m.types + 1)
        end_log = np.log10(m.ends + 1.0)
        for batch in batches:
            ids = batch.column(0)
            for start, words, offsets in _token_chunks(batch, 1):
                at = _lookup(words, m.h)
                classes = _with_ends(m.word_class[at], offsets, END)
                contexts = _contexts(classes)
                step = m.transition[contexts, classes]
                emitted = _with_ends(known_class[at], offsets, 0)
                counts = np.diff(offsets)
                firsts = np.concatenate([[0], np.cumsum(counts + 1)])[:-1]
                missing = np.flatnonzero(at < 0)
                row = np.searchsorted(offsets, missing, "right") - 1
                state = contexts[missing + row]
                order = np.lexsort([state, words[missing], row])
                row, state, rare = row[order], state[order], words[missing[order]]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (state[1:] != state[:-1]) | (rare[1:] != rare[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(row)))
                ends = np.searchsorted(row[first], np.arange(len(counts) + 1))
                sums = np.concatenate([[0], np.cumsum(logs[at])])
                held = np.concatenate([[0], np.cumsum(at >= 0)])
                columns = {
                    key: ids.slice(start, len(counts)), "n_tokens": counts + 1,
                    "known": np.diff(held[offsets]) + (m.ends > 0),
                    "base": np.diff(sums[offsets]) + end_log - (counts + 1) * whole,
                    "model": np.add.reduceat(step + emitted, firsts)}
                lists = {"rare": signed(rare[first]), "state": state[first].astype(np.int32),
                         "times": times.astype(np.int64)}
                columns |= {n: pa.ListArray.from_arrays(ends.astype(np.int32), v)
                            for n, v in lists.items()}
                yield pa.RecordBatch.from_pydict(columns)

    held = scratch_path(spark, "tokens")
    narrow = spread(docs.select(key, F.col(text).cast("string")))
    narrow.mapInArrow(run, f"`{key}` {kind}, n_tokens long, known long, base double, model double,"
                           " rare array<long>, state array<int>, times array<long>").withColumn(
        "row", F.monotonically_increasing_id()).write.parquet(held)
    rows = spark.read.parquet(held)
    # Words outside the broadcast table are rare by construction: no hot keys here.
    pairs = rows.select("row", F.explode(F.arrays_zip("rare", "state", "times")).alias("pair")).select(
        "row", F.col("pair.rare").alias("h"), F.col("pair.state").alias("state"),
        F.col("pair.times").alias("times"))
    # They were scored as rare ones without a count; those with a class change over to it.
    instead = model.transition - model.transition[:, RARE:RARE + 1] - np.log10(
        np.maximum(model.own, 1)) + model.rare_base
    instead[:, RARE] = 0
    gain = F.get(F.lit(instead.ravel()), F.col("state") * (END + 1) + F.col("class"))
    log = F.log10(F.col("c") + F.when(F.col("class") == RARE, 1).otherwise(0))
    counted = pairs.join(spark.read.parquet(f"{stored}-classes"), "h").groupBy("row").agg(
        F.sum("times").alias("more_known"),
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"),
        F.sum(F.col("times") * (gain + log)).alias("more_model"))
    more, more_model = (F.coalesce(n, F.lit(0.0)) for n in ("more", "more_model"))
    return rows.drop("rare", "state", "times").join(counted, "row", "left").select(
        key, "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("model") + more_model).alias("score"))


@query("op5_brown_class_lm")
def op5(table):
    """All documents scored by a model of those outside the held-out seventh."""
    docs = table("documents").select("doc_id", "text")
    stored = scratch_path(docs.sparkSession, "vocabulary")
    model = train(docs.filter(~held_out(7)), stored)
    return score(docs, model, stored).select(
        "doc_id", held_out(7).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")
