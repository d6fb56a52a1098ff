"""Chat datasets: parts, prompts, field mapping, training-set shaping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import chat_prompt, word_count
from gristmill.operators.ranking import running_sum


def chat_parts(df: DataFrame, item: str = "conv_id", turn: str = "turn", role: str = "role",
               content: str = "text") -> DataFrame:
    """First system, user and assistant text per conversation, null when absent.

    Reduced on the map side: no list of messages is built.
    """
    def first(name: str) -> Column:
        return F.min_by(F.coalesce(F.col(content), F.lit("")),
                        F.when(F.col(role) == name, F.col(turn))).alias(name)

    return df.groupBy(item).agg(first("system"), first("user"), first("assistant"))


def message_parts(messages: Column) -> dict[str, Column]:
    """The same from an array of (role, content)."""
    def first(name: str) -> Column:
        found = F.filter(messages, lambda m: m["role"] == name)
        return F.when(F.size(found) > 0, F.coalesce(F.get(found, F.lit(0))["content"], F.lit("")))

    return {name: first(name) for name in ("system", "user", "assistant")}


def prompts_and_targets(parts: DataFrame, item: str = "conv_id") -> DataFrame:
    return parts.select(item, chat_prompt(F.col("system"), F.col("user")).alias("prompt"),
                        F.coalesce("assistant", F.lit("")).alias("target"))


def to_chat(df: DataFrame, kind: str, fields: Mapping[str, str]) -> DataFrame:
    """Map field names to a ``messages`` array.

    ``chat`` takes the ``messages`` field as it is; ``alpaca`` builds a user
    message from ``instruction`` and optional ``input`` and an assistant
    message from ``output``.
    """
    if kind == "chat":
        return df.withColumnRenamed(fields["messages"], "messages")
    if kind != "alpaca":
        raise ValueError(f"unknown dataset type {kind!r}")
    extra = F.col(fields["input"]) if "input" in fields else F.lit(None)
    ask = F.concat_ws("\n\n", F.col(fields["instruction"]), F.when(extra != "", extra))

    def message(name: str, text: Column) -> Column:
        return F.struct(F.lit(name).alias("role"), text.alias("content"))

    return df.withColumn("messages", F.array(message("user", ask),
                                             message("assistant", F.col(fields["output"]))))


def prompt_completion(df: DataFrame, prompt: str, completion: str, drop: list[str] | None = None,
                      prefix: str = "") -> DataFrame:
    """Rename two columns to prompt and completion, with an instruction in front."""
    renamed = df.withColumnsRenamed({prompt: "prompt", completion: "completion"}).drop(
        *(drop or []))
    return renamed.withColumn("prompt", F.concat(F.lit(prefix), "prompt")) if prefix else renamed


def shape_training(df: DataFrame, key: list[str], text: str, max_words: int, pack_words: int,
                   role: str = "role", unmask: bool = False) -> DataFrame:
    """Rows within ``max_words``, packed in key order, with a loss flag per row.

    A word stands for a token.  Packs hold about ``pack_words`` words; the
    loss covers assistant rows only, or all with ``unmask``.
    """
    counted = df.select(*key, role, word_count(F.col(text)).cast("long").alias("n_words"))
    kept = counted.filter(F.col("n_words") <= max_words)
    packed = running_sum(kept, key, "n_words", out="_upto")
    return packed.withColumn(
        "pack", F.floor((F.col("_upto") - F.col("n_words")) / F.lit(pack_words))).withColumn(
        "in_loss", F.lit(True) if unmask else F.col(role) == "assistant").drop("_upto")
