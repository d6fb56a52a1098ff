"""Chat data, chunking, extraction and text scores over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import scores, text
from gristmill.operators import chat, checks, documents
from gristmill.plans.registry import query, spread

PARTS = """
parts as (select conv_id, arg_min(text, turn) filter (role = 'system') as system,
                 arg_min(text, turn) filter (role = 'user') as user_text,
                 arg_min(text, turn) filter (role = 'assistant') as assistant
          from conversations group by 1)
"""


@query(f"with {PARTS} select conv_id, system, user_text as user, assistant from parts")
def chat_parts(table):
    return chat.chat_parts(table("conversations"))


@query(f"""
with {PARTS}
select conv_id,
       case when coalesce(user_text, '') = '' then ''
            else case when system <> '' then '<|im_start|>system' || chr(10) || system
                           || '<|im_end|>' || chr(10) else '' end
                 || '<|im_start|>user' || chr(10) || user_text || '<|im_end|>' || chr(10)
                 || '<|im_start|>assistant' || chr(10) end as prompt,
       coalesce(assistant, '') as target
from parts
""")
def prompts_and_targets(table):
    return chat.prompts_and_targets(chat.chat_parts(table("conversations")))


@query("""
select conv_id, min(turn) as turn, arg_min(role, turn) as role, 'invalid role' as fault
from conversations where role not in ('system', 'assistant', 'function', 'tool') group by 1
""")
def chat_violations(table):
    # The table has no faults, so one role is renamed to an unknown one.
    rows = table("conversations").withColumn(
        "role", F.when(F.col("role") == "user", "human").otherwise(F.col("role")))
    return checks.chat_violations(rows).withColumn(
        "role", F.when(F.col("role") == "human", "user").otherwise(F.col("role")))


@query("""
with p as (select conv_id, count(*) as messages,
                  arg_min(text, turn) filter (role = 'user') as u,
                  arg_min(text, turn) filter (role = 'assistant') as a
           from conversations group by 1)
select conv_id, messages,
       case when messages < 2 then 'fewer than 2 messages'
            when coalesce(u, '') = '' then 'no user message'
            when coalesce(a, '') = '' then 'no assistant message' end as error
from p
""")
def holdout_errors(table):
    return checks.holdout_errors(table("conversations"))


@query("""
select count(*)::bigint as messages, count(*) filter (role in ('system', 'user', 'assistant'))
       as valid, count(distinct conv_id) as items from conversations
""")
def chat_validated(table):
    rows = table("conversations")
    nested = rows.select("conv_id", F.array(F.struct(
        "role", F.col("text").alias("content"))).alias("messages"))
    checked = checks.validate_chat(nested, "conv_id")
    long = checks.messages_long(checked, "conv_id")
    return long.agg(F.count("*").alias("messages"),
                    F.count_if(F.col("role").isin(*checks.CHAT_ROLES)).alias("valid"),
                    F.count_distinct("conv_id").alias("items"))


# Six stop strings as the tables' own words meet them: each replaces another mark, and the
# earliest of them ends the answer.
STOPS = (("a", "<|im_end|>"), ("e", "<|endoftext|>"), ("i", "</s>"), ("o", "<|end|>"),
         ("u", "\n\nUser:"), ("r", "\n\nHuman:"))


def _stop_sql() -> str:
    value = "text"
    for letter, stop in STOPS:
        shown = stop.replace("\n", "' || chr(10) || '")
        value = f"replace({value}, '{letter}. ', '{shown}')"
    places = ", ".join("nullif(strpos(t, '{}'), 0)".format(stop.replace("\n", "' || chr(10) || '"))
                       for _, stop in STOPS)
    return f"""
select conv_id, turn, case when place is null then t else substr(t, 1, place - 1) end as answer
from (select *, least({places}) as place from (select conv_id, turn, {value} as t from conversations))
"""


@query(_stop_sql())
def truncate_at_stop(table):
    """Sentence ends turned into the six stop strings, by the letter before."""
    marked = F.col("text")
    for letter, stop in STOPS:
        marked = F.replace(marked, F.lit(f"{letter}. "), F.lit(stop))
    return table("conversations").select(
        "conv_id", "turn", text.truncate_at_stop(marked).alias("answer"))


@query("""
select o_orderkey, 'Summarise: ' || o_orderpriority as prompt, o_orderstatus as completion
from orders
""")
def prompt_completion(table):
    rows = table("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_custkey")
    return chat.prompt_completion(rows, "o_orderpriority", "o_orderstatus", ["o_custkey"],
                                  "Summarise: ")


@query("""
select p_partkey, 'user' as ask_role,
       case when p_brand <> 'Brand#3' then p_name || chr(10) || chr(10) || p_brand else p_name end
       as ask, 'assistant' as reply_role, p_type as reply
from part
""")
def to_chat(table):
    rows = table("part").withColumn("extra", F.when(F.col("p_brand") == "Brand#3", "").otherwise(
        F.col("p_brand")))
    out = chat.to_chat(rows, "alpaca", {"instruction": "p_name", "input": "extra",
                                        "output": "p_type"})
    ask, reply = F.col("messages")[0], F.col("messages")[1]
    return out.select("p_partkey", ask["role"].alias("ask_role"), ask["content"].alias("ask"),
                      reply["role"].alias("reply_role"), reply["content"].alias("reply"))


@query(r"""
with w as (select conv_id, turn, role,
                  len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))::bigint
                  as n_words from conversations),
k as (select *, sum(n_words) over (order by conv_id, turn) as upto from w where n_words <= 180)
select conv_id, turn, role, n_words, ((upto - n_words) // 1000)::bigint as pack,
       role = 'assistant' as in_loss
from k
""")
def shape_training(table):
    return chat.shape_training(table("conversations"), ["conv_id", "turn"], "text", 180, 1000)


@query("""
select doc_id, i::int as chunk_no, (i * 800)::bigint as start, substr(text, i * 800 + 1, 1000)
       as chunk_text
from documents, generate_series(0, ceil(greatest(length(text) - 200, 1) / 800)::int - 1) g(i)
where length(text) > 0
""")
def chunk_fixed(table):
    return documents.chunk(spread(table("documents").select("doc_id", "text")), method="fixed", size=1000, overlap=200)


RECURSIVE = (r"'(?s).{1,512}\z|.{1,510}\n\n|.{1,511}\n|.{1,511} |.{1,512}'")


@query(f"""
with p as (select doc_id, regexp_extract_all(text, {RECURSIVE}) as pieces from documents)
select doc_id, (i - 1)::int as chunk_no, pieces[i] as chunk_text
from p, generate_series(1, len(pieces)) g(i)
""")
def chunk_recursive(table):
    return documents.chunk(spread(table("documents").select("doc_id", "text")), method="recursive", size=512)


@query(f"""
with p as (select doc_id, regexp_extract_all(text, {RECURSIVE}) as pieces from documents)
select doc_id, (i - 1)::int as chunk_no,
       case when i > 1 then right(pieces[i - 1], 50) else '' end || pieces[i] as chunk_text
from p, generate_series(1, len(pieces)) g(i)
""")
def chunk_recursive_overlap(table):
    return documents.chunk(spread(table("documents").select("doc_id", "text")), method="recursive", size=562, overlap=50)


def sql_plain_text() -> str:
    value = r"regexp_replace(html, '<!--.*?-->', '', 'gs')"
    for name in text.HIDDEN:
        value = rf"regexp_replace({value}, '<{name}(\s[^>]*)?>.*?</{name}\s*>', '', 'gis')"
    value = rf"regexp_replace({value}, '</?({text.LINE_TAGS})(\s[^>]*)?/?>', chr(10), 'gi')"
    value = f"regexp_replace({value}, '<[^>]*>', '', 'g')"
    # The references that occur in the pages; HTML bears a missing semicolon here.
    for name, character in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        value = f"regexp_replace({value}, '&{name};?', '{character}', 'g')"
    value = rf"regexp_replace({value}, '[ \t\r]+', ' ', 'g')"
    value = rf"regexp_replace({value}, ' ?\n[ \n]*', chr(10), 'g')"
    return rf"regexp_replace({value}, '^[ \n]+|[ \n]+$', '', 'g')"


@query(f"select page_id, {sql_plain_text()} as text from pages")
def extract_text(table):
    return documents.extract_text(spread(table("pages"))).select("page_id", "text")


@query(f"""
select count(*) filter (t <> '') as processed, count(*) filter (coalesce(t = '', true)) as errors
from (select {sql_plain_text()} as t from pages)
""")
def extraction_summary(table):
    return documents.extraction_summary(documents.extract_text(spread(table("pages").select("html"))))


@query(r"""
select page_id, regexp_extract(url, '[^/]*$') as file_name,
       regexp_replace(regexp_extract(url, '[^/]*$'), '(.)\.[^.]+$', '\1') as document_id
from pages
""")
def document_ids(table):
    return table("pages").select(
        "page_id", F.element_at(F.split("url", "/"), -1).alias("file_name"),
        text.document_id(F.col("url")).alias("document_id"))


@query("""
select o_orderkey, 'Order ' || o_orderkey::varchar || ' [' || o_orderstatus || '] {' ||
       o_orderpriority || '} ' as line from orders
""")
def fill_template(table):
    template = "Order {KEY} [{STATUS}] {{{PRIORITY}}} {UNKNOWN}"
    values = {"KEY": F.col("o_orderkey"), "STATUS": F.col("o_orderstatus"),
              "PRIORITY": F.col("o_orderpriority")}
    return table("orders").select("o_orderkey", text.fill_template(template, values).alias("line"))


def _pairs(table):
    """Prediction = last assistant text, target = first one, with a stand-in likelihood."""
    rows = table("conversations").filter(F.col("role") == "assistant")
    pairs = rows.groupBy("conv_id").agg(F.max_by("text", "turn").alias("prediction"),
                                        F.min_by("text", "turn").alias("target"))
    return pairs.withColumn("logprob", -F.length("target") / F.lit(7.0))


PAIRS = """
pairs as (select conv_id, trim(arg_max(text, turn)) as p, trim(arg_min(text, turn)) as t,
                 -length(arg_min(text, turn)) / 7.0::double as logprob
          from conversations where role = 'assistant' group by 1)
"""
WORD_SCORES = PAIRS + r""",
sets as (select *, list_distinct(list_filter(regexp_split_to_array(lower(p), '\s+'),
                                             lambda x: x <> '')) as pw,
                list_distinct(list_filter(regexp_split_to_array(lower(t), '\s+'),
                                          lambda x: x <> '')) as tw,
                greatest(len(list_filter(regexp_split_to_array(t, '\s+'), lambda x: x <> '')), 1)
                as n from pairs),
word_scores as (
  select conv_id, (lower(p) = lower(t))::int::double as exact_match,
         contains(lower(p), lower(t)[1:50])::int::double as contains_match,
         case when len(list_intersect(pw, tw)) > 0
              then 2.0 * len(list_intersect(pw, tw)) / (len(pw) + len(tw)) else 0.0 end::double
         as f1_overlap,
         least(exp(-logprob / n), 10000.0)::double as perplexity, -logprob / n as loss from sets)
"""


@query(f"""
with {WORD_SCORES}
select conv_id, exact_match, contains_match, round(f1_overlap, 6) as f1_overlap,
       round(perplexity, 6) as perplexity, round(loss, 6) as loss from word_scores
""")
def word_scores(table):
    p, t = text.strip(F.col("prediction")), text.strip(F.col("target"))
    return _pairs(table).select(
        "conv_id", scores.exact_match(p, t).alias("exact_match"),
        scores.contains_match(p, t).alias("contains_match"),
        F.round(scores.f1_overlap(p, t), 6).alias("f1_overlap"),
        F.round(scores.perplexity(F.col("logprob"), t), 6).alias("perplexity"),
        F.round(scores.loss(F.col("logprob"), t), 6).alias("loss"))


def _gram_sql(side: str, tokens: str, n: int) -> str:
    joined = " || ' ' || ".join(f"x[i + {k}]" for k in range(n))
    return f"""
  select conv_id, '{side}' as side, {n} as n, unnest(list_transform(
           range(1, len(x) - {n - 2}), lambda i: {joined})) as gram
  from (select conv_id, {tokens} as x from tok)"""


def _count_sql(source: str, orders: tuple[int, ...]) -> str:
    grams = " union all ".join(_gram_sql(side, f"{source}_{side}", n)
                               for side in "pt" for n in orders)
    return f"""
  select conv_id, n, sum(least(cp, ct)) as common, sum(cp) as total_p, sum(ct) as total_t
  from (select conv_id, n, gram, count(*) filter (side = 'p') as cp,
               count(*) filter (side = 't') as ct from ({grams}) group by all) group by all"""


def _bleu_token_sql(value: str) -> str:
    value = f"replace(replace(replace({value}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for entity, character in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        value = f"replace({value}, '{entity}', '{character}')"
    value = f"' ' || {value} || ' '"
    for pattern, replacement in ((r"([\x7b-\x7e\x5b-\x60\x20-\x26\x28-\x2b\x3a-\x40\x2f])", r" \1 "),
                                 (r"([^0-9])([.,])", r"\1 \2 "), (r"([.,])([^0-9])", r" \1 \2"),
                                 (r"([0-9])(-)", r"\1 \2 ")):
        value = f"regexp_replace({value}, '{pattern}', '{replacement}', 'g')"
    return rf"string_split(trim(regexp_replace({value}, '\s+', ' ', 'g')), ' ')"


def _rouge_token_sql(value: str) -> str:
    clean = f"trim(regexp_replace(lower({value}), '[^a-z0-9]+', ' ', 'g'))"
    return f"list_filter(string_split({clean}, ' '), lambda w: w <> '')"


GRAM_SCORES = f"""
with {PAIRS},
tok as materialized (select conv_id, {_bleu_token_sql('p')} as b_p, {_bleu_token_sql('t')} as b_t,
               {_rouge_token_sql('p')} as r_p, {_rouge_token_sql('t')} as r_t from pairs),
bc as materialized ({_count_sql('b', (1, 2, 3, 4))}),
b1 as (select *, sum((common = 0)::int) over (partition by conv_id order by n) as zeros
       from bc where total_p > 0),
bl as (select conv_id, avg(case when common > 0 then ln(common / total_p)
                                else -ln(pow(2, zeros) * total_p) end) as mean_log,
              max(common) as best from b1 group by 1),
rc as materialized ({_count_sql('r', (1, 2))}),
-- The table of common subsequences, one row of it for each token of the target.
lc as materialized (
  select conv_id, list_reduce(r_t, lambda row, w: [0::bigint] || list_transform(
           range(1, len(r_p) + 1), lambda i: list_max(list_transform(range(1, i + 1), lambda j:
             greatest(row[j + 1], case when r_p[j] = w then row[j] + 1 else 0 end)))),
           list_transform(range(0, len(r_p) + 1), lambda i: 0::bigint))[-1] as common from tok)
select tok.conv_id,
       round(case when best is null or best = 0 then 0.0
            else exp(mean_log + least(0.0, 1 - len(b_t) / len(b_p))) end, 6)::double as bleu,
       round(coalesce(2.0 * r1.common / (r1.total_p + r1.total_t), 0.0), 6)::double as rouge1,
       round(coalesce(2.0 * r2.common / (r2.total_p + r2.total_t), 0.0), 6)::double as rouge2,
       round(case when lc.common > 0 then 2.0 * lc.common / (len(r_p) + len(r_t)) else 0.0 end,
             6)::double as "rougeL"
from tok join lc on lc.conv_id = tok.conv_id left join bl on tok.conv_id = bl.conv_id
left join rc r1 on r1.conv_id = tok.conv_id and r1.n = 1
left join rc r2 on r2.conv_id = tok.conv_id and r2.n = 2
"""


@query(GRAM_SCORES)
def gram_scores(table):
    p, t = text.strip(F.col("prediction")), text.strip(F.col("target"))
    scored = _pairs(table).withColumn("s", scores.overlap_scores(p, t, stemmed=False))
    return scored.select("conv_id", *[F.round(f"s.{m}", 6).alias(m)
                                      for m in ("bleu", "rouge1", "rouge2", "rougeL")])


@query()
def text_scores(table):
    scored = scores.score_text(_pairs(table))
    return scored.select("conv_id", *[F.round(m, 6).alias(m) for m in scores.HIGHER_IS_BETTER])


@query(f"""
with {WORD_SCORES}, grams as ({GRAM_SCORES.replace(", 6)::double", ", 12)::double").replace(
    "             6)::double", "             12)::double")})
select round(avg(exact_match), 6) as exact_match, round(avg(contains_match), 6) as contains_match,
       round(avg(bleu), 6) as bleu, round(avg(rouge1), 6) as rouge1, round(avg(rouge2), 6) as rouge2,
       round(avg("rougeL"), 6) as "rougeL", round(avg(f1_overlap), 6) as f1_overlap,
       round(avg(perplexity), 6) as perplexity, round(avg(loss), 6) as loss
from word_scores join grams using (conv_id)
""")
def score_summary(table):
    """All nine means; words are compared as they are, which SQL can repeat."""
    summary = scores.score_summary(scores.score_text(_pairs(table), stemmed=False))
    return summary.select(*[F.round(m, 6).alias(m) for m in scores.HIGHER_IS_BETTER])
