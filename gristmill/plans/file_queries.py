"""Files, manifests, run records and reports over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import scores
from gristmill.operators import boards, checks, patterns, sampling
from gristmill.plans.registry import query, spread
from gristmill.plans.sampling_queries import _selected
from gristmill.plans.sweep_queries import RECORDS, _records
from gristmill.plans.tabular_queries import AGED, _aged
from gristmill.plans.text_queries import WORD_SCORES, _pairs
from gristmill.session import scratch_path, shuffle_width
from gristmill.sources import readers, writers
from gristmill.streaming import indexing


@query(r"""
select page_id, url, regexp_replace(html, '\r\n', chr(10), 'g') as html from pages
""")
def csv_quoted_cells(table):
    """Pages with quotes and line ends in their cells, written as CSV and read with kinds found."""
    rows = table("pages").select("page_id", "url", "html")
    path = scratch_path(rows.sparkSession, "cells")
    writers.write_table(spread(rows), path, "csv")
    back = readers.read_table(rows.sparkSession, path)
    return back.withColumn("page_id", F.col("page_id").cast("long"))


@query("""
select row_number() over (order by item_id) - 1 as question_id, text as question,
       left(text, 20) as first_answer, item_id::varchar as document from benchmark
""")
def benchmark_questions(table):
    """Benchmark passages as one JSON array file, read back with their positions."""
    rows = table("benchmark").select("item_id", F.struct(
        F.col("text").alias("question"), F.array(F.left("text", F.lit(20)), "text").alias(
            "correct_answers"),
        F.array(F.col("item_id").cast("string")).alias("correct_answer_document_ids")).alias("entry"))
    path = scratch_path(rows.sparkSession, "questions") + ".json"
    whole = rows.agg(F.array_sort(F.collect_list(F.struct("item_id", "entry"))).alias("all"))
    whole.select(F.to_json(F.transform("all", lambda x: x["entry"]))).write.text(path)
    found = readers.load_benchmark(rows.sparkSession, path)
    return found.select("question_id", "question", F.get("correct_answers", F.lit(0)).alias(
        "first_answer"), F.get("correct_answer_document_ids", F.lit(0)).alias("document"))


@query(f"""
with {RECORDS}
select row_number() over (order by coalesce(final_score, mean) desc nulls last, p_partkey) as rank,
       p_partkey::int as directory, name, chunk_size as "chunking.chunk_size" from r
""")
def patterns_from_files(table):
    """A pattern file for each part, found below a folder and ranked."""
    rows = _records(table)
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "patterns")
    writers.write_folders(rows, path, "p_partkey", "pattern", shuffle_width(spark))
    files = readers.load_patterns(spark, path, "part-*").withColumn(
        "directory", F.regexp_extract("directory", r"(\d+)$", 1).cast("int"))
    read = patterns.normalize_pattern(files, keep=("directory",))
    return patterns.pattern_order(read, "directory").select(
        "rank", "directory", "name", "`chunking.chunk_size`")


@query("""
with d as (select lang, strlen(text) as bytes from documents)
select 'corpus' as bucket, 'all' as prefix, sum(bytes)::bigint as total_size_bytes,
       count(*) as count, count(*) as listed, sum(bytes)::bigint as listed_bytes from d
""")
def manifest_object(table):
    """Every document in a manifest: its list and its totals, written and read back."""
    files = table("documents").select(F.col("doc_id").alias("key"), F.octet_length(
        "text").cast("long").alias("size_bytes"))
    spark, path = files.sparkSession, scratch_path(files.sparkSession, "manifest")
    writers.write_manifest(files, sampling.manifest(files, "corpus", "all"), path)
    listed = spark.read.parquet(f"{path}/documents").agg(
        F.count("*").alias("listed"), F.sum("size_bytes").alias("listed_bytes"))
    totals = spark.read.json(f"{path}/summary")
    return totals.select("bucket", "prefix", "total_size_bytes", "count").join(F.broadcast(listed))


TASKS = """
m as (select p_brand as run, case when p_retailprice > 990 then 'custom_holdout_eval'
                                  else p_type end as task from part)
"""


@query(f"""
with {TASKS},
f as (select run, count(distinct task)::varchar as tasks,
             max((task = 'custom_holdout_eval')::int)::varchar as custom,
             coalesce(string_agg(distinct task, ',' order by task)
               filter (task <> 'custom_holdout_eval'), '') as names,
             count(*) / 4.0 as duration from m group by 1)
select run, 'eval_tasks_count' as key, tasks as value from f
union all select run, 'eval_custom_eval_enabled', custom from f
union all select run, 'eval_benchmark_tasks', names from f
union all select run, 'eval_duration_ok', 'true' from f
union all select distinct run, 'base_model', 'small' from f
""")
def run_facts(table):
    """What evaluations tell of themselves, one run per brand."""
    task = F.when(F.col("p_retailprice") > 990, "custom_holdout_eval").otherwise(F.col("p_type"))
    rows = table("part").select(F.col("p_brand").alias("run"), task.alias("task"))
    seconds = rows.groupBy("run").agg((F.count("*") / 4.0).alias("duration"))
    facts = boards.evaluation_facts(rows, "run", seconds)
    # Numbers have their own text form here and there: only their presence is compared.
    facts = facts.withColumn("duration_ok", F.col("duration_seconds") > 0).drop("duration_seconds")
    none = rows.select("run", F.lit("x").alias("metric"), F.lit(0.0).alias("value")).limit(0)
    return boards.merge_run_metadata(none, none, "run", {"base_model": "small"}, facts)


@query(f"""
with {AGED}
select row_number() over (order by case category when 'stale' then 0 when 'warning' then 1 else 2 end,
                          age_days desc, o_orderkey) as place, o_orderkey, age_days, category from f
""")
def freshness_listing(table):
    """All orders in report order: stale, warning, fresh, oldest first."""
    return checks.freshness_listing(_aged(table), "o_orderkey")


@query(f"""
with {WORD_SCORES},
s as (select conv_id % 7 as run, unnest(['exact_match', 'contains_match', 'f1_overlap', 'perplexity',
             'loss']) as metric, unnest([exact_match, contains_match, f1_overlap, perplexity, loss])
             as value from word_scores),
a as (select run, metric, round(avg(value), 6) as mean,
             metric not in ('perplexity', 'loss') as higher_is_better from s group by 1, 2)
select metric, higher_is_better, run as best_run, mean from (
  select *, row_number() over (partition by metric order by case when higher_is_better then -mean
                               else mean end, run) as place from a) where place = 1
""")
def best_runs(table):
    """The best of seven runs by every score, each in its own direction."""
    scored = scores.score_text(_pairs(table)).withColumn("run", F.col("conv_id") % 7)
    return scores.best_by_metric(scored, "run", ["exact_match", "contains_match", "f1_overlap",
                                                 "perplexity", "loss"])


@query(r"""
select count(*) as documents, sum(len(regexp_extract_all(
         text, '(?s).{1,1000}\z|.{1,998}\n\n|.{1,999}\n|.{1,999} |.{1,1000}')))::bigint as chunks,
       2 as batches, true as adds_up from documents
where length(text) > 0
""")
def index_totals(table):
    """Running totals that a stream of 30 files in batches of 20 keeps."""
    rows = table("documents").select("doc_id", "text").filter(F.length("text") > 0)
    spark = rows.sparkSession
    source, path = scratch_path(spark, "incoming"), scratch_path(spark, "index")
    rows.repartition(30).write.parquet(source)
    stream = indexing.document_stream(spark, source, "doc_id long, text string")
    indexing.run_index(stream, path, scratch_path(spark, "progress"), "docs", size=1000, dim=16)
    steps = indexing.index_progress(spark, path, "docs")
    return steps.agg(
        F.max("documents_so_far").alias("documents"), F.max("chunks_so_far").alias("chunks"),
        F.count("*").cast("int").alias("batches"),
        (F.sum("chunks") == F.max("chunks_so_far")).alias("adds_up"))
