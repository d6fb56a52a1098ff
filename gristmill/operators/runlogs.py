"""Training logs: summary and loss curve per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.once import computed_once
from gristmill.operators.ranking import global_rank

# Log names of each metric, in order of preference, and the cap.
METRIC_NAMES = {"loss": ("loss", "avg_loss"), "learning_rate": ("lr",),
                "grad_norm": ("grad_norm", "gradnorm"), "eval_loss": ("val_loss",),
                "epoch": ("epoch",), "step": ("step",)}
SERIES_NAMES = ("loss", "avg_loss")
PERPLEXITY_EXPONENT = 10


def _field(entry: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(entry, f"$['{name}']", kind)


def _counts(entry: Column, name: str) -> Column:
    """The value is present and neither null, empty, zero nor false; the text "0" counts."""
    text, value = _field(entry, name, "string"), _field(entry, name, "variant")
    is_text = F.schema_of_variant(value) == "STRING"
    empty = text.isin("", "[]", "{}") | (~is_text & (
        (text == "false") | F.coalesce(text.try_cast("double") == 0, F.lit(False))))
    return F.coalesce(~empty, F.lit(False))


def series_value(entry: Column) -> Column:
    """Loss of a log entry: the first name that counts, null when it is not a number."""
    value = F.lit(None).cast("double")
    for name in reversed(SERIES_NAMES):
        value = F.when(_counts(entry, name), _field(entry, name, "double")).otherwise(value)
    return value


def parse_log(log: DataFrame, text: str = "text") -> DataFrame:
    """Lines with their entry and loss; blank and malformed lines have neither.

    Bare NaN and Infinity, which training logs hold but JSON does not know, are
    read as numbers: a diverged run keeps its last values.
    """
    readable = F.regexp_replace(F.col(text), r"([:\[,]\s*)(NaN|-?Infinity)(?=\s*[,}\]])", '$1"$2"')
    entry = computed_once(log, "_entry", F.try_parse_json(readable))
    return computed_once(entry, "_loss", series_value(F.col("_entry")))


def training_summary(log: DataFrame, run: str = "run", line: str = "line",
                     text: str = "text") -> DataFrame:
    """First valid value of every metric, final and least loss, final perplexity.

    A loss of zero is a valid first value but not part of the loss series.
    """
    parsed = parse_log(log, text)
    found = {}
    for metric, names in METRIC_NAMES.items():
        found[metric] = F.coalesce(*[_field(F.col("_entry"), n, "double") for n in names])
    parsed = parsed.withColumns({f"_{m}_value": v for m, v in found.items()})
    firsts = [F.min_by(f"_{m}_value", F.when(F.col(f"_{m}_value").isNotNull(), F.col(line)))
              .alias(m) for m in METRIC_NAMES]
    last = F.max_by("_loss", F.when(F.col("_loss").isNotNull(), F.col(line)))
    return parsed.groupBy(run).agg(
        *firsts, last.alias("final_loss"), F.min("_loss").alias("min_loss"),
        F.count("_loss").alias("steps")).withColumn(
        "final_perplexity", F.when(F.col("final_loss").isNotNull(), F.exp(F.least(
            F.col("final_loss"), F.lit(float(PERPLEXITY_EXPONENT))))))


def loss_curve(log: DataFrame, run: str = "run", line: str = "line",
               text: str = "text") -> DataFrame:
    """(run, step, loss): lines with a loss, numbered from 1 per run."""
    kept = parse_log(log, text).filter(F.col("_loss").isNotNull()).select(
        run, line, F.col("_loss").alias("loss"))
    return global_rank(kept, line, run, out="step").select(run, "step", "loss")


def lowest_point(curve: DataFrame, run: str = "run") -> DataFrame:
    """Least loss per run and the first step that has it."""
    return curve.groupBy(run).agg(
        F.min("loss").alias("min_loss"),
        F.min_by("step", F.struct("loss", "step")).alias("min_step"),
        F.max("step").alias("steps"))
