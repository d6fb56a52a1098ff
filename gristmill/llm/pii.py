"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Candidates are the strict matches of four kinds (email, ip, card, phone) and
looser ones (long tokens of letters and digits, long digit runs, addresses
written with "(at)").  Pattern, gazetteer and context labelers vote for or
against each candidate.  Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is, without any labels; the
resulting probabilities train a naive Bayes classifier on the candidates'
features, which admits loose candidates.  Strict matches always stay.

Everything that touches texts is a column expression.  Only the tables of vote
patterns and feature values, whose sizes don't depend on the corpus, reach the
driver.  Matches are marked with private-use characters and the marked text is
split, so places are sums of lengths.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.once import computed_once
from gristmill.llm.batches import spread
from gristmill.llm.registry import query

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "number", "address")
SEP, DOT, OPEN, CLOSE = "\ue000", "\ue001", "\ue002", "\ue003"
CONTEXT = 32              # characters before a candidate that context labelers read
ITERATIONS = 60
_EMAIL = "[A-Za-z0-9._%+" + DOT + "-]"
_LABEL = "[A-Za-z0-9" + DOT + "-]"
# The same matches as the kinds' definitions, without groups in unbounded loops,
# and for cards only runs with a possible number of digits: SEP stands for a separator between two digits, DOT for a dot inside a host name.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_EMAIL})){_EMAIL}++@[A-Za-z0-9-]+{DOT}{_LABEL}+",
    "ip": r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": rf"(?<![0-9{SEP}])[0-9](?:{SEP}?[0-9]){{11,18}}(?![0-9{SEP}])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+",
    "number": rf"(?<![0-9A-Za-z{SEP}])[0-9][0-9{SEP}]{{6,}}(?![A-Za-z])",
    "address": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++[ ]?[(\[]at[)\]][ ]?[A-Za-z0-9-]+"
               r"(?:\.[A-Za-z0-9-]{1,63}){1,8}"}
# A text without this can hold no match of the kind.
NEEDS = {"email": "@", "phone": r"\+", "address": r"[(\[]at[)\]]", "secret": r"[0-9]",
         "ip": r"[0-9]", "card": r"[0-9]", "number": r"[0-9]"}
CUES = ("token|secret|key|password|passwd|pwd|api|auth|bearer|credential|tel|phone|call|mobile|"
        "fax|mail|email|contact|card|visa|mastercard|iban|account|ssn|passport|address|host|"
        "telefon|konto|karte|ausweis|kontakt|téléphone|compte|carte|correo|teléfono|cuenta|"
        "tarjeta|contraseña|schlüssel|clé")
HARMLESS = ("version|copyright|isbn|issn|page|order|figure|table|chapter|vol|year|section|"
            "commit|revision|build|kapitel|seite|página|volume")
LABELERS = ("pattern", "cue", "harmless", "delimited", "shape")


def _plain(text: Column) -> Column:
    """Null as empty; the marks replaced by characters that no pattern holds."""
    return F.translate(F.coalesce(text, F.lit("")), SEP + DOT + OPEN + CLOSE,
                       "\ue004\ue005\ue006\ue007")


def _matches(text: Column, kind: str) -> Column:
    """``kind, start, end, match, before, after`` of the leftmost matches, in order."""
    given = text
    if kind in ("card", "number"):
        given = F.regexp_replace(given, r"(?<=[0-9])[\x20-](?=[0-9])", SEP)
    elif kind == "email":
        given = F.regexp_replace(given, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT)
    marked = F.regexp_replace(given, f"({PATTERNS[kind]})", OPEN + "$1" + CLOSE)
    span = "struct<start:int,end:int,match:string,before:string,after:string>"

    def add(state, piece):
        match = F.substring_index(piece, CLOSE, 1)
        rest = F.substring_index(piece, CLOSE, -1)
        end = state["at"] + F.length(match)
        return F.struct((end + F.length(rest)).alias("at"), F.array_append(state["spans"], F.struct(
            state["at"].alias("start"), end.alias("end"), match.alias("match"),
            state["rest"].alias("before"), F.substring(rest, 1, 1).alias("after"))).alias("spans"),
            F.substring(F.concat(state["rest"], match, rest), -CONTEXT, CONTEXT).alias("rest"))

    none = F.array().cast(f"array<{span}>")

    def spans(pieces):
        first = F.element_at(pieces, 1)
        start = F.struct(F.length(first).alias("at"), none.alias("spans"),
                         F.substring(first, -CONTEXT, CONTEXT).alias("rest"))
        return F.when(F.size(pieces) > 1, F.aggregate(
            F.slice(pieces, 2, F.size(pieces)), start, add,
            lambda state: state["spans"])).otherwise(none)

    # The marked text is split once and bound to a name.
    found = F.element_at(F.transform(F.array(F.split(marked, OPEN, -1)), spans), 1)
    return F.when(text.rlike(NEEDS[kind]), found).otherwise(none)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    backwards = F.split(F.reverse(digits), "")

    def value(char, at):
        number = char.cast("int")
        twice = number * 2
        return F.when(char == "", 0).when(at % 2 == 0, number).otherwise(
            F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.transform(backwards, value), F.lit(0), lambda s, x: s + x)
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(12, 19) & _luhn(F.substring(digits, 1, 19))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _spans(text: Column, kind: str) -> Column:
    """Matches of a kind as candidates, strict ones with their check already made."""
    order = KINDS.index(kind)
    found = _matches(text, kind)
    if kind in BASE:
        found = F.filter(found, lambda s: _valid(kind, s["match"]))
    elif kind == "secret":      # a letter and a digit, and no plain word with hyphens
        found = F.filter(found, lambda s: s["match"].rlike("[0-9]") & s["match"].rlike("[A-Za-z]"))
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("kind"), s["end"].alias("end"),
        s["match"].alias("match"), s["before"].alias("before"), s["after"].alias("after")))


def candidates(docs: DataFrame, text: str, out: str = "_found") -> DataFrame:
    """Add the array of candidates: strict ones, then loose ones clear of them."""
    rows = computed_once(docs, "_plain", _plain(F.col(text)))
    strict = F.concat(*[_spans(F.col("_plain"), k) for k in BASE])
    rows = computed_once(rows, "_strict", strict)
    loose = F.concat(*[_spans(F.col("_plain"), k) for k in KINDS[len(BASE):]])
    clear = F.filter(loose, lambda s: ~F.exists(
        F.col("_strict"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return rows.withColumn(out, F.concat("_strict", clear)).drop("_plain", "_strict")


def _votes(s: Column) -> dict[str, Column]:
    """Votes of the labelers on a candidate: 1 for, -1 against, 0 none."""
    before, match = F.lower(s["before"]), s["match"]
    digits = _digits(match)
    strict = s["kind"] < len(BASE)
    varied = F.size(F.array_distinct(F.split(match, "")))
    number = KINDS.index("number")
    checked = F.length(digits).between(12, 19) & _luhn(F.substring(digits, 1, 19))

    def vote(yes, no=F.lit(False)):
        return F.when(yes, 1).when(no, -1).otherwise(0)

    return {
        "pattern": vote(strict | (s["kind"] == KINDS.index("address")),
                        (s["kind"] == number) & ~checked),
        "cue": vote(before.rlike(rf"(?:^|[^\p{{L}}])(?:{CUES})[^\p{{L}}]*(?:is|ist|est|es)?[^\p{{L}}]*$")),
        "harmless": vote(F.lit(False), before.rlike(
            rf"(?:^|[^\p{{L}}])(?:{HARMLESS})[^\p{{L}}]*$|[$€£#]\x20?$")),
        "delimited": vote(before.rlike("[=:\"'<]\\x20?[\"']?$") | s["after"].isin('"', "'", ">")),
        "shape": vote((varied >= 8) & (F.length(match) >= 7), (varied <= 4))}


def _features(s: Column) -> dict[str, Column]:
    size = F.length(s["match"])
    return {
        "kind": s["kind"].cast("string"),
        "size": F.floor(F.log2(size + 1) * 2).cast("string"),
        "after": F.when(s["after"] == "", "end").when(s["after"].rlike(r"\s"), "space").when(
            s["after"].rlike("[A-Za-z0-9]"), "word").otherwise("mark"),
        **{name: vote.cast("string") for name, vote in _votes(s).items()}}


@dataclass
class Model:
    prior: float                                # log odds of a candidate
    accuracy: dict[str, float]                  # of each labeler's votes, by EM
    odds: dict[str, dict[str, float]]           # feature -> value -> log likelihood ratio


def em(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[list[float], list[float]]:
    """Vote patterns with counts -> probability per pattern, accuracy per labeler.

    Two classes; a labeler that votes is right with its accuracy, whatever the
    class, and abstaining tells nothing.  Accuracies start above one half,
    which fixes which class is which, and stay between 0.55 and 0.99.
    """
    width = len(patterns[0][0]) if patterns else len(LABELERS)
    accuracy, share, total = [0.75] * width, 0.5, sum(n for _, n in patterns)
    posterior = [0.5] * len(patterns)
    for _ in range(ITERATIONS):
        for k, (votes, _) in enumerate(patterns):
            score = math.log(share / (1 - share)) + sum(
                v * math.log(a / (1 - a)) for v, a in zip(votes, accuracy, strict=True))
            posterior[k] = 1 / (1 + math.exp(-max(-50.0, min(50.0, score))))
        share = sum(p * n for p, (_, n) in zip(posterior, patterns, strict=True)) / max(total, 1)
        share = min(0.95, max(0.05, share))
        for j in range(width):
            right = cast = 0.0
            for p, (votes, n) in zip(posterior, patterns, strict=True):
                if votes[j]:
                    cast += n
                    right += n * (p if votes[j] > 0 else 1 - p)
            accuracy[j] = min(0.99, max(0.55, (right + 7.5) / (cast + 10)))
    return posterior, accuracy


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Count candidates by features over all rows, weigh the labelers, train the classifier."""
    found = candidates(spread(docs.select(text)), text).select(F.explode("_found").alias("s"))
    named = _features(F.col("s"))
    counts = found.select(*[c.alias(n) for n, c in named.items()]).groupBy(*named).count().collect()
    names = list(named)
    by_votes: dict[tuple[int, ...], int] = {}
    for row in counts:
        votes = tuple(int(row[v]) for v in LABELERS)
        by_votes[votes] = by_votes.get(votes, 0) + row["count"]
    patterns = sorted(by_votes.items())
    posterior, accuracy = em(patterns)
    chance = {votes: p for (votes, _), p in zip(patterns, posterior, strict=True)}
    odds: dict[str, dict[str, float]] = {}
    sums = [1.0, 1.0]
    weights: dict[str, dict[str, list[float]]] = {n: {} for n in names}
    for row in counts:
        p = chance[tuple(int(row[v]) for v in LABELERS)]
        for k, w in enumerate((p, 1 - p)):
            sums[k] += w * row["count"]
            for n in names:
                weights[n].setdefault(row[n], [0.5, 0.5])[k] += w * row["count"]
    for n in names:
        whole = [sum(w[k] for w in weights[n].values()) for k in (0, 1)]
        odds[n] = {v: math.log(w[0] / whole[0]) - math.log(w[1] / whole[1])
                   for v, w in weights[n].items()}
    return Model(math.log(sums[0] / sums[1]), dict(zip(LABELERS, accuracy, strict=True)), odds)


def _admitted(s: Column, model: Model) -> Column:
    """Strict candidates, and loose ones that the classifier finds likelier than not."""
    def ratio(name, value):
        table = model.odds.get(name, {})
        return reduce(lambda rest, item: F.when(value == item[0], F.lit(item[1])).otherwise(rest),
                      table.items(), F.lit(0.0))

    score = sum((ratio(n, c) for n, c in _features(s).items()), F.lit(model.prior))
    return (s["kind"] < len(BASE)) | (score > 0)


def detect(docs: DataFrame, model: Model, text: str = "text", out: str = "_spans") -> DataFrame:
    """Add the sorted array of admitted spans ``(start, kind, end)``; ``kind`` is an index."""
    rows = candidates(docs, text)
    kept = F.filter("_found", lambda s: _admitted(s, model))
    return rows.withColumn(out, F.array_sort(F.transform(kept, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))).drop("_found")


def written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def masked(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Replace each admitted span in ``text`` by its kind in brackets; columns stay.

    Of overlapping spans the first replaces up to the end of the last.  A null
    text stays null.  ``n_chars``, where the table has it, is set anew.
    """
    rows = computed_once(detect(docs, model, text, "_kept"), "_spans", F.col("_kept")).drop("_kept")
    body = F.col(text)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def add(state, s):
        inside = s["start"] < state["at"]
        between = F.substring(body, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(
            inside, state["out"]).otherwise(F.concat(state["out"], between, F.get(
                names, s["kind"]))).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate("_spans", start, add, lambda state: F.concat(
        state["out"], F.substring(body, state["at"] + 1, F.length(body))))
    rows = rows.withColumn(text, F.when(F.size("_spans") > 0, whole).otherwise(body)).drop("_spans")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(
            body.isNull(), F.col("n_chars")).otherwise(F.length(text).cast(kind)))
    return rows.select(docs.columns)


def personal_data(docs: DataFrame, model: Model, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """Counts and spans per row; null and empty texts have none; repeated rows stay."""
    rows = computed_once(detect(spread(docs.select(key, text)), model, text).drop(text),
                         "spans_found", F.col("_spans"))
    base = F.filter("spans_found", lambda s: s["kind"] < len(BASE))

    def count(kind):
        at = KINDS.index(kind)
        return F.size(F.filter("spans_found", lambda s: s["kind"] == at)).cast("long")

    return rows.select(key, *[count(k).alias(f"n_{k}") for k in BASE],
                       F.sha2(written(base), 256).alias("base_sha256"),
                       written(F.col("spans_found")).alias("spans"))


@query("op6_weak_supervision_pii")
def op6(table):
    """Personal data in all documents."""
    docs = table("documents").select("doc_id", "text")
    return personal_data(docs, fit(docs))
