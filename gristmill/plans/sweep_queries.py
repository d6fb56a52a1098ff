"""Pattern sweep, evaluation records and pattern leaderboards over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions.once import computed_once
from gristmill.operators import boards, evaluation, patterns, retrieval
from gristmill.operators.containment import containment_truth
from gristmill.plans import sweep as sweeps
from gristmill.plans.registry import query, spread
from gristmill.plans.retrieval_queries import (
    WORDS, bm25_sql, cosine_sql, letter_counts, letters_sql)

SPACE = {"chunking_method": ["fixed"], "chunk_size": [512, 1024, 2048], "chunk_overlap": [0, 128],
         "number_of_chunks": [3, 5]}
CONFIGS = sweeps.search_space(SPACE, 12)
CUTS = list(dict.fromkeys(c.chunking for c in CONFIGS))


def _chunks_sql(cuts=CUTS) -> str:
    parts = []
    for g, (_, size, overlap) in enumerate(cuts):
        step = size - overlap
        parts.append(f"""
  select {g} as g, doc_id, i as chunk_no, substr(text, i * {step} + 1, {size}) as chunk_text
  from documents, generate_series(0, ceil(greatest(length(text) - {overlap}, 1) / {step})::int - 1)
       s(i) where length(text) > 0""")
    return " union all ".join(parts)


_CONFIG_ROWS = ", ".join(f"({c.pattern_id}, {CUTS.index(c.chunking)}, {c.number_of_chunks})"
                         for c in CONFIGS)
SWEEP = f"""
with cut as materialized ({_chunks_sql()}),
{bm25_sql(f"select g, doc_id, chunk_no, {WORDS.format('chunk_text')} as x from cut",
           "doc_id, chunk_no")},
truth as materialized (
  select b.item_id, d.doc_id from benchmark b join documents d on contains(d.text, b.text)),
config(pattern_id, g, k) as (values {_CONFIG_ROWS}),
ctx as (select pattern_id, h.item_id, rank, h.doc_id, x, t.doc_id is not null as relevant
        from hits h join config c on c.g = h.g and h.rank <= c.k
        join ch on ch.g = h.g and ch.doc_id = h.doc_id and ch.chunk_no = h.chunk_no
        left join truth t on t.item_id = h.item_id and t.doc_id = h.doc_id),
agg as (select pattern_id, item_id, min(rank) filter (relevant) as first_hit,
               list_distinct(arg_min(x, rank)) as said,
               list_distinct(flatten(list(x))) as seen from ctx group by all),
evaluated as materialized (
  select config.pattern_id, b.item_id,
         coalesce(1.0 / first_hit, 0.0)::double as context_correctness,
         coalesce(len(list_intersect(want, said)) / len(want), 0.0)::double as answer_correctness,
         case when len(said) > 0 then len(list_intersect(said, seen)) / len(said) else 0.0
         end::double as faithfulness
  from (select item_id, list_distinct({WORDS.format('text')}) as want from benchmark) b
  join config on true left join agg on agg.item_id = b.item_id
       and agg.pattern_id = config.pattern_id),
board as (select pattern_id, count(*) as n, round(avg(context_correctness), 6) as context_correctness,
                 round(avg(answer_correctness), 6) as answer_correctness,
                 round(avg(faithfulness), 6) as faithfulness,
                 round(avg(answer_correctness) - 1.959963984540054
                       * stddev_samp(answer_correctness) / sqrt(count(*)), 6) as answer_ci_low
          from evaluated group by 1)
"""


def _truth(table):
    return containment_truth(table("benchmark"), _documents(table))


def _documents(table):
    return spread(table("documents").select("doc_id", "text"))


def _evaluated(table, configs=CONFIGS):
    return sweeps.sweep(table("benchmark"), _documents(table), _truth(table), configs)


@query(SWEEP + """
select pattern_id::int as pattern_id, item_id, round(faithfulness, 6) as faithfulness,
       round(answer_correctness, 6) as answer_correctness,
       round(context_correctness, 6) as context_correctness from evaluated
""")
def sweep_evaluation(table):
    return _evaluated(table).select("pattern_id", "item_id", *[
        F.round(m, 6).alias(m) for m in evaluation.PATTERN_METRICS])


@query(SWEEP + """
select row_number() over (order by answer_correctness desc, 'pattern_' || pattern_id) as rank,
       'pattern_' || pattern_id as name, answer_correctness as final_score, answer_ci_low,
       context_correctness from board
""")
def sweep_leaderboard(table):
    scored = sweeps.pattern_scores(_evaluated(table), CONFIGS, "answer_correctness")
    score = F.col("scores")
    board = scored.select(
        "name", F.round("final_score", 6).alias("final_score"),
        F.round(score["answer_correctness"]["ci_low"], 6).alias("answer_ci_low"),
        F.round(score["context_correctness"]["mean"], 6).alias("context_correctness"))
    return boards.leaderboard(board, "final_score", "name")


# Three ways to search, both rankers, two embeddings, two chunk sizes.
MODES = sweeps.search_space({
    "chunking_method": ["fixed"], "chunk_size": [1024, 2048], "chunk_overlap": [0],
    "number_of_chunks": [3], "search_mode": ["lexical", "vector", "hybrid"],
    "ranker_strategy": ["rrf", "weighted"], "ranker_alpha": [0.3, 0.7],
    "embedding_dimension": [13, 26]})
MODE_CUTS = list(dict.fromkeys(c.chunking for c in MODES))


def _mode_rows() -> str:
    """Pattern, chunk setting, result count, and of each list it uses: embedding and value."""
    rows = []
    for c in MODES:
        head, hybrid = f"{c.pattern_id}, {MODE_CUTS.index(c.chunking)}, 3", c.search_mode == "hybrid"
        values = {-1: "score", c.embedding_dimension: "score"}
        if c.ranker_strategy == "rrf":
            values = dict.fromkeys(values, "rrf")
        elif hybrid:
            values = {-1: f"{1 - c.ranker_alpha}", c.embedding_dimension: f"{c.ranker_alpha}"}
        unused = {"lexical": {None}, "vector": {-1}, "hybrid": set()}[c.search_mode]
        rows += [f"({head}, {e}, '{v}', {20 if hybrid else 3})" for e, v in values.items()
                 if e not in unused]
    return ", ".join(rows)


SWEEP_MODES = f"""
with cut as materialized ({_chunks_sql(MODE_CUTS)}),
{bm25_sql(f"select g, doc_id, chunk_no, {WORDS.format('chunk_text')} as x from cut",
           "doc_id, chunk_no")},
truth as materialized (
  select b.item_id, d.doc_id from benchmark b join documents d on contains(d.text, b.text)),
qv as materialized (select item_id, e, ({letters_sql('text')})[1:e] as q
                    from benchmark, (values (13), (26)) s(e)),
cv as materialized (select g, doc_id, chunk_no, e, ({letters_sql('chunk_text')})[1:e] as d
                    from cut, (values (13), (26)) s(e)),
near as (select item_id, g, cv.e, doc_id, chunk_no, round({cosine_sql('q', 'd')}, 6) as score
         from qv join cv on qv.e = cv.e),
lists as materialized (
  select -1 as e, g, item_id, doc_id, chunk_no, score, rank from hits where rank <= 20
  union all
  select * from (select e, g, item_id, doc_id, chunk_no, score, row_number() over (
                   partition by item_id, g, e order by score desc, doc_id, chunk_no) as rank
                 from near) where rank <= 20),
config(pattern_id, g, k, e, how, deep) as (values {_mode_rows()}),
used as (select pattern_id, k, how, lists.*,
                min(score) over (partition by pattern_id, lists.e, item_id) as low,
                max(score) over (partition by pattern_id, lists.e, item_id) as high
         from lists join config c on c.e = lists.e and c.g = lists.g and rank <= deep),
merged as (select pattern_id, g, k, item_id, doc_id, chunk_no, round(sum(
             case how when 'score' then score when 'rrf' then 1.0::double / (60 + rank)
             else how::double * case when high > low then (score - low) / (high - low)
                                else 1.0 end end), 6) as score
           from used group by all),
ranked as (select * from (select *, row_number() over (
             partition by pattern_id, item_id order by score desc, doc_id, chunk_no) as rank
           from merged) where rank <= k),
ctx as (select pattern_id, h.item_id, rank, x, t.doc_id is not null as relevant
        from ranked h join ch on ch.g = h.g and ch.doc_id = h.doc_id and ch.chunk_no = h.chunk_no
        left join truth t on t.item_id = h.item_id and t.doc_id = h.doc_id),
agg as (select pattern_id, item_id, min(rank) filter (relevant) as first_hit,
               list_distinct(arg_min(x, rank)) as said,
               list_distinct(flatten(list(x))) as seen from ctx group by all),
answers as (select item_id, list_distinct({WORDS.format('text')}) as whole,
                   list_distinct({WORDS.format('substr(text, length(text) // 2 + 1)')}) as half
            from benchmark),
evaluated as (
  select p.pattern_id, b.item_id, coalesce(1.0 / first_hit, 0.0)::double as context_correctness,
         greatest(coalesce(len(list_intersect(whole, said)) / len(whole), 0.0),
                  coalesce(len(list_intersect(half, said)) / len(half), 0.0))::double
         as answer_correctness,
         case when len(said) > 0 then len(list_intersect(said, seen)) / len(said) else 0.0
         end::double as faithfulness
  from answers b join (select distinct pattern_id from config) p on true
  left join agg on agg.item_id = b.item_id and agg.pattern_id = p.pattern_id)
"""


@query(SWEEP_MODES + """
select pattern_id::int as pattern_id, item_id, round(faithfulness, 6) as faithfulness,
       round(answer_correctness, 6) as answer_correctness,
       round(context_correctness, 6) as context_correctness from evaluated
""")
def sweep_hybrid(table):
    """Words, vectors and both merged, with the second half of a passage as an answer too."""
    asked = table("benchmark").withColumn("answers", F.array("text", F.expr(
        "substring(text, cast(length(text) div 2 + 1 as int))")))
    rows = sweeps.sweep(asked, _documents(table), _truth(table), MODES, answers="answers",
                        embed=letter_counts)
    return rows.select("pattern_id", "item_id", *[
        F.round(m, 6).alias(m) for m in evaluation.PATTERN_METRICS])


@query(SWEEP + """
select pattern_id::int as pattern_id, 'answer_correctness' as metric, n,
       answer_correctness as mean, answer_ci_low as ci_low from board
""")
def mean_with_interval(table):
    stats = evaluation.mean_ci(sweeps.score_rows(_evaluated(table), ["answer_correctness"]),
                               ["pattern_id", "metric"])
    return stats.select("pattern_id", "metric", "n", F.round("mean", 6).alias("mean"),
                        F.round("ci_low", 6).alias("ci_low"))


@query(SWEEP.replace("qw as (select item_id", """
sample as (select item_id, text from benchmark
           qualify row_number() over (order by md5('17:' || item_id::varchar)) <= 5),
qw as (select item_id""").replace("as term from benchmark)", "as term from sample)")
       .replace("as want from benchmark) b", "as want from sample) b") + """
select chunk_size, round(score, 6) as score from (
  select case when g in (0, 1) then 512 when g in (2, 3) then 1024 else 2048 end::bigint
         as chunk_size, avg(answer_correctness) as score
  from evaluated join config using (pattern_id) group by 1)
order by score desc, chunk_size limit 2
""")
def preselect_options(table):
    best = sweeps.preselect(table("benchmark"), _documents(table), _truth(table), CONFIGS, "chunk_size", sweeps.TOP_EMBEDDING,
                            "answer_correctness")
    return best.select("chunk_size", F.round("score", 6).alias("score"))


@query()
def sweep_pattern_table(table):
    """Sweep results written as pattern records, read back and laid out as table cells."""
    scored = sweeps.pattern_scores(_evaluated(table), CONFIGS, "context_correctness")
    record = patterns.build_pattern(scored)
    full = F.to_json(F.struct(record["name"].alias("name"), record["settings"].alias("settings"),
                              "scores", "final_score"))
    read = patterns.normalize_pattern(scored.select("name", full.alias("pattern")).withColumnRenamed(
        "name", "directory"), keep=("directory",))
    return patterns.leaderboard_table(patterns.pattern_order(read, "directory"),
                                      "context_correctness")


def _records(table):
    """Parts as pattern records in three layouts, some without scores."""
    layout = F.pmod("p_partkey", F.lit(3))
    chunking = F.struct(F.lit("fixed").alias("method"), F.col("p_size").alias("chunk_size"))
    scores = F.when(F.pmod("p_partkey", F.lit(5)) != 0, F.struct(F.struct(
        (F.col("p_retailprice") / 2000).alias("mean")).alias("faithfulness")))
    final = F.when(F.pmod("p_partkey", F.lit(2)) == 0, F.col("p_size") / 100)
    model = F.struct(F.col("p_brand").alias("model_id"))
    legacy = F.to_json(F.struct(
        F.struct("p_name", F.col("p_name").alias("name"), F.struct(
            chunking.alias("chunking"), model.alias("embedding"), F.lit("window").alias("method")
        ).alias("settings")).alias("rag_pattern"), scores.alias("scores"),
        final.alias("final_score")))
    flat = F.to_json(F.struct(
        F.col("p_name").alias("name"), F.struct(
            chunking.alias("chunking"), F.col("p_brand").alias("embedding_model"),
            F.struct(F.lit("simple").alias("method"), F.lit("rrf").alias("ranker_strategy")
                     ).alias("retrieval")).alias("settings"),
        F.struct(scores.alias("scores")).alias("scores"), final.alias("final_score")))
    old = F.to_json(F.struct(
        F.col("p_name").alias("pattern_name"),
        F.struct(chunking.alias("chunking"), F.lit("a").alias("foundation_model"))
        .alias("indexing_params"),
        F.struct(F.col("p_brand").alias("embedding_model"),
                 F.struct(F.lit("simple").alias("method")).alias("retrieval"),
                 F.col("p_type").alias("foundation_model")).alias("rag_params"),
        scores.alias("scores"), final.alias("final_score")))
    text = F.when(layout == 0, legacy).when(layout == 1, flat).otherwise(old)
    return spread(table("part")).select("p_partkey", text.alias("pattern"))


RECORDS = """
r as (select p_partkey, p_name as name, case when p_partkey % 2 = 0 then p_size / 100 end
             as final_score,
             case when p_partkey % 5 <> 0 then p_retailprice / 2000 end as mean,
             p_size::varchar as chunk_size, p_brand as model,
             case when p_partkey % 3 = 0 then 'window' else 'simple' end as method,
             case when p_partkey % 3 = 1 then 'rrf' end as ranker,
             case when p_partkey % 3 = 2 then p_type end as generation from part)
"""


@query(f"""
with {RECORDS}
select p_partkey, name, round(final_score, 6) as final_score, round(mean, 6) as mean,
       'fixed' as "chunking.method", chunk_size as "chunking.chunk_size",
       model as "embeddings.model_id", method as "retrieval.method",
       ranker as "retrieval.ranker_strategy", generation as "generation.model_id" from r
""")
def normalize_patterns(table):
    read = patterns.normalize_pattern(_records(table), keep=("p_partkey",))
    return read.select("p_partkey", "name", F.round("final_score", 6).alias("final_score"),
                       F.round(F.get("means", F.lit(0))["mean"], 6).alias("mean"),
                       *[f"`{c}`" for c in ("chunking.method", "chunking.chunk_size",
                                            "embeddings.model_id", "retrieval.method",
                                            "retrieval.ranker_strategy", "generation.model_id")])


@query(f"""
with {RECORDS}
select row_number() over (order by coalesce(final_score, mean) desc nulls last, p_partkey) as rank,
       p_partkey, name from r
""")
def pattern_order(table):
    read = patterns.normalize_pattern(_records(table), keep=("p_partkey",))
    return patterns.pattern_order(read, "p_partkey").select("rank", "p_partkey", "name")


@query(f"""
with {RECORDS}
select row_number() over (order by coalesce(final_score, mean) desc nulls last, p_partkey) as rank,
       name as "Pattern_Name", coalesce(format('{{:.4f}}', mean), '') as mean_faithfulness,
       'fixed' as "chunking.method", chunk_size as "chunking.chunk_size",
       '' as "chunking.chunk_overlap", model as "embeddings.model_id",
       method as "retrieval.method", '' as "retrieval.number_of_chunks",
       '' as "retrieval.search_mode", coalesce(ranker, '-') as "retrieval.ranker_strategy",
       coalesce(generation, '') as "generation.model_id" from r
""")
def pattern_table(table):
    read = patterns.normalize_pattern(_records(table), keep=("p_partkey",))
    return patterns.leaderboard_table(patterns.pattern_order(read, "p_partkey"))


@query("""
select p_partkey, p_name as name, 'recursive' as method,
       case when p_size > 25 then p_size else 2048 end as chunk_size, 256 as chunk_overlap,
       'cosine' as distance_metric, 768 as dimension, p_brand as model, 5 as number_of_chunks,
       case when p_size <= 10 then 'hybrid' end as search_mode, p_size <= 10 as has_search_mode
from part
""")
def build_patterns(table):
    rows = table("part").select(
        "p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("embedding_model"),
        F.when(F.col("p_size") > 25, F.col("p_size")).alias("chunk_size"),
        F.when(F.col("p_size") <= 10, "hybrid").alias("search_mode"))
    built = rows.select("p_partkey", patterns.build_pattern(rows).alias("p"))
    settings = F.col("p.settings")
    return built.select(
        "p_partkey", "p.name", settings["chunking"]["method"].alias("method"),
        settings["chunking"]["chunk_size"].alias("chunk_size"),
        settings["chunking"]["chunk_overlap"].alias("chunk_overlap"),
        settings["embedding"]["distance_metric"].alias("distance_metric"),
        settings["embedding"]["embedding_params"]["embedding_dimension"].alias("dimension"),
        settings["embedding"]["model_id"].alias("model"),
        settings["retrieval"]["number_of_chunks"].alias("number_of_chunks"),
        settings["retrieval"]["search_mode"].alias("search_mode"),
        F.contains(F.to_json("p"), F.lit('"search_mode"')).alias("has_search_mode"))


@query(r"""
with w as (select doc_id, string_split(text, chr(10)) as texts,
                  list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') as ids
           from documents)
select doc_id, i - 1 as place, texts[i] as text, ids[i] as document_id
from w, generate_series(1, least(len(texts), len(ids))::bigint) g(i)
""")
def zip_contexts(table):
    rows = computed_once(spread(table("documents").select("doc_id", "text")), "texts",
                         F.split("text", "\n"))
    rows = computed_once(rows, "ids", F.array_remove(F.split("text", r"\s+"), ""))
    zipped = rows.select("doc_id", evaluation.zip_contexts(F.col("texts"), F.col("ids")).alias("c"))
    return zipped.select("doc_id", F.posexplode("c").alias("place", "pair")).select(
        "doc_id", F.col("place").cast("long").alias("place"), "pair.text", "pair.document_id")


@query("""
with s as (select o_custkey, o_orderstatus as metric, avg(o_totalprice) as value
           from orders group by all)
select c_custkey, count(s.metric)::int as n_scores, round(max(value) filter (s.metric = 'F'), 4)
       as f_score
from customer left join s on s.o_custkey = c_custkey group by 1
""")
def attach_scores(table):
    orders = table("orders").select(F.col("o_custkey").alias("question_id"),
                                    F.col("o_orderstatus").alias("metric"), "o_totalprice")
    scored = orders.groupBy("question_id", "metric").agg(F.avg("o_totalprice").alias("value"))
    rows = evaluation.attach_scores(
        table("customer").select(F.col("c_custkey").alias("question_id")), scored)
    return rows.select(F.col("question_id").alias("c_custkey"), F.size("scores").alias("n_scores"),
                       F.round(F.try_element_at("scores", F.lit("F")), 4).alias("f_score"))


@query("""
with a as (select conv_id, arg_min(text, turn) filter (role = 'user') as question,
                  arg_max(text, turn) filter (role = 'assistant') as answer
           from conversations group by 1)
select conv_id, question, answer from a where question is not null and answer is not null
""")
def build_evaluation(table):
    rows = table("conversations")
    asked = rows.filter("role = 'user'").groupBy("conv_id").agg(
        F.min_by("text", "turn").alias("question"))
    answered = rows.filter("role = 'assistant'").groupBy("conv_id").agg(
        F.max_by("text", "turn").alias("answer"))
    return evaluation.build_evaluation(asked, answered, "conv_id")


@query("""
select s_suppkey as pattern_id, count(l_orderkey) as n_rows
from supplier left join lineitem on l_suppkey = s_suppkey group by 1
""")
def pattern_results(table):
    found = table("lineitem").select(
        F.col("l_suppkey").alias("pattern_id"), "l_orderkey")
    joined = evaluation.pattern_results(
        table("supplier").select(F.col("s_suppkey").alias("pattern_id")), found)
    return joined.groupBy("pattern_id").agg(F.count("l_orderkey").alias("n_rows"))


@query(f"""
with {bm25_sql(f"select 0 as g, doc_id, {WORDS.format('text')} as x from documents", "doc_id")}
select b.item_id, chr(10) || chr(10) || 'Context:' || chr(10)
       || string_agg('[' || d.text || ']', chr(10) order by rank) || ':' || chr(10) || chr(10)
       || 'Question: ' || b.text || '. ' || chr(10)
       || 'Again, please answer the question based on the context provided only. If the context is '
       || 'not related to the question, just say you cannot answer. Respond exclusively in the '
       || 'language of the question.' as user_prompt,
       'Please answer the question I provide in the Question section below, based solely on the '
       || 'information I provide in the Context section. If unanswerable, say so.' as system_prompt
from benchmark b join hits h on h.item_id = b.item_id and rank <= 3
join documents d on d.doc_id = h.doc_id group by b.item_id, b.text
""")
def build_prompts(table):
    """Whole prompts: three contexts in rank order, each in brackets."""
    docs = _documents(table)
    asked = table("benchmark")
    hits = retrieval.bm25(asked, docs, 3, "item_id").join(docs, "doc_id").withColumn(
        "relevant", F.lit(False))
    contexts = evaluation.gather_contexts(hits, ["item_id"], "doc_id", "text")
    return evaluation.build_prompts(asked, contexts, "item_id", "text", "[{document}]")
