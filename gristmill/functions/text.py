"""Text expressions: words, prompts, templates, chunks, plain text from HTML."""

from __future__ import annotations

import html
import re
from collections.abc import Mapping
from string import Formatter

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whitespace as text.split() sees it, stop strings, chat markers.
SPACE = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
         r"\x{205f}\x{3000}]")
STOP_STRINGS = ("<|im_end|>", "<|endoftext|>", "</s>", "<|end|>", "\n\nUser:", "\n\nHuman:")
BLOCK_OPEN = "<|im_start|>"
BLOCK_CLOSE = "<|im_end|>"
TEXTS_AT_ONCE = 256

# Default prompt texts of a retrieval pattern.
CONTEXT_TEMPLATE = "{document}"
USER_MESSAGE = (
    "\n\nContext:\n{reference_documents}:\n\nQuestion: {question}. \nAgain, please answer "
    "the question based on the context provided only. If the context is not related to "
    "the question, just say you cannot answer. Respond exclusively in the language of "
    "the question.")
SYSTEM_MESSAGE = (
    "Please answer the question I provide in the Question section below, based solely "
    "on the information I provide in the Context section. If unanswerable, say so.")


def words(text: Column) -> Column:
    """Lower-cased whitespace words, in order, with repeats."""
    return F.array_remove(F.split(F.lower(text), f"{SPACE}+"), "")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, f"{SPACE}+"), ""))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def chat_prompt(system: Column, user: Column) -> Column:
    """Optional system block, user block, open assistant block; empty without user text."""
    def block(role: str, text: Column) -> Column:
        return F.concat(F.lit(f"{BLOCK_OPEN}{role}\n"), text, F.lit(BLOCK_CLOSE))

    prompt = F.concat_ws("\n", F.when(system != "", block("system", system)),
                         block("user", user), F.lit(f"{BLOCK_OPEN}assistant\n"))
    return F.when(F.coalesce(user, F.lit("")) == "", "").otherwise(prompt)


def truncate_at_stop(text: Column) -> Column:
    """Text before the earliest stop string."""
    return F.split(text, "|".join(re.escape(s) for s in STOP_STRINGS), 2)[0]


def document_id(file_name: Column) -> Column:
    """File stem: the name without its last suffix (``report.pdf.md`` -> ``report.pdf``)."""
    base = F.element_at(F.split(file_name, "/"), -1)
    return F.regexp_replace(base, r"(?<=.)\.[^.]+$", "")


def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """Replace ``{name}`` placeholders; a name without a value becomes empty.

    The template is cut once on the driver, so braces inside values stay as
    they are.
    """
    pieces = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if field in values:
            pieces.append(F.coalesce(values[field].cast("string"), F.lit("")))
    return F.concat(*pieces) if pieces else F.lit("")


def fixed_pieces(text: Column, size: int, overlap: int = 0) -> Column:
    """Windows of ``size`` characters every ``size - overlap``, until the text is covered.

    One regular expression walks the text once; taking substrings by position
    would walk it again for every chunk.
    """
    step = size - overlap
    if size <= 0 or overlap < 0 or step <= 0:
        raise ValueError("need 0 <= overlap < size")
    if overlap == 0:
        return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    windows = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{size}}})).{{1,{step}}}"), F.lit(1))
    wanted = F.ceil(F.greatest(F.length(text) - overlap, F.lit(1)) / step).cast("int")
    return F.slice(windows, F.lit(1), wanted)


def recursive_pieces(text: Column, size: int) -> Column:
    """Pieces that end at the last paragraph break that fits, else line break,
    else space, else after ``size`` characters.  Joined they give the text.
    """
    if size < 3:
        raise ValueError("need a size of at least 3")
    rest = rf"(?s).{{1,{size}}}\z"
    breaks = rf".{{1,{size - 2}}}\n\n|.{{1,{size - 1}}}\n|.{{1,{size - 1}}} |.{{1,{size}}}"
    return F.regexp_extract_all(text, F.lit(f"{rest}|{breaks}"), F.lit(0))


def repeat_ends(pieces: Column, overlap: int | Column) -> Column:
    """Put the last ``overlap`` characters of the piece before in front of each piece."""
    overlap = F.lit(overlap) if isinstance(overlap, int) else overlap
    return F.transform(pieces, lambda piece, i: F.concat(
        F.when(i > 0, F.right(F.get(pieces, i - 1), overlap)).otherwise(""), piece))


# Blocks without text, tags that end a line.
HIDDEN = ("script", "style", "head", "noscript", "template")
LINE_TAGS = "p|br|div|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|blockquote|pre"


@F.arrow_udf(T.StringType())
def decode_references(texts: pa.Array) -> pa.Array:
    """Named and numeric character references decoded; a hard space becomes a plain one.

    Few texts of a batch are Python objects at a time.
    """
    parts = [pa.array([html.unescape(t).replace("\xa0", " ") if t and "&" in t else t
                       for t in texts.slice(start, TEXTS_AT_ONCE).to_pylist()], pa.string())
             for start in range(0, len(texts), TEXTS_AT_ONCE)]
    return pa.concat_arrays(parts) if parts else texts


def html_to_text(page: Column) -> Column:
    """Visible text: hidden blocks and comments dropped, line tags become line ends."""
    text = F.regexp_replace(page, r"(?s)<!--.*?-->", "")
    for name in HIDDEN:
        text = F.regexp_replace(text, rf"(?is)<{name}(\s[^>]*)?>.*?</{name}\s*>", "")
    text = F.regexp_replace(text, rf"(?i)</?({LINE_TAGS})(\s[^>]*)?/?>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    text = decode_references(text)
    text = F.regexp_replace(text, r"[ \t\r]+", " ")
    text = F.regexp_replace(text, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(text, r"^[ \n]+|[ \n]+$", "")
