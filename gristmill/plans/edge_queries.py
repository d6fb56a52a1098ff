"""Rows that the test tables lack: nulls, texts as numbers, diverged logs, two sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import boards, checks, runlogs, tabular
from gristmill.plans.registry import query
from gristmill.session import scratch_path
from gristmill.streaming import indexing


@query("""
with j as (select case when doc_id % 5 = 0 then null else 'c' || quality end as y,
                  case when doc_id % 7 = 0 then null else 'c' || toxic end as p from labels),
k as (select y as v from j union select p from j)
select a.v as label, b.v as prediction, (select count(*) from j
       where j.y is not distinct from a.v and j.p is not distinct from b.v) as n
from k a join k b on true
""")
def confusion_with_nulls(table):
    rows = table("labels").select(
        F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("c"), "quality")).alias("y"),
        F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("c"), "toxic")).alias("p"))
    return tabular.confusion(rows, "y", "p")


@query("""
with r as (select o_orderstatus, o_totalprice as y, o_totalprice * 0.9 + 100 as p from orders
           where o_orderkey % 3 <> 0 and o_custkey % 4 <> 0)
select o_orderstatus, round(sqrt(sum((y - p) ** 2) / count(*)), 3) as root_mean_squared_error,
       round(sum(abs(y - p)) / count(*), 3) as mean_absolute_error,
       round(1 - sum((y - p) ** 2) / (sum(y * y) - sum(y) ** 2 / count(*)), 6) as r2
from r group by 1
""")
def regression_metrics_with_nulls(table):
    y = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice"))
    guess = F.when(F.col("o_custkey") % 4 != 0, F.col("o_totalprice") * 0.9 + 100)
    rows = table("orders").select("o_orderstatus", y.alias("y"), guess.alias("p"))
    scored = tabular.regression_metrics(rows, "y", "p", ["o_orderstatus"])
    return scored.select("o_orderstatus", F.round("r2", 6).alias("r2"), *[
        F.round(c, 3).alias(c) for c in ("root_mean_squared_error", "mean_absolute_error")])


@query("""
with log as (select event_type as run, event_id as line,
                    case when event_id % 9 = 0 then 'nan'::double
                         when event_id % 13 = 0 then 'infinity'::double else value + 1 end as loss
             from events)
select run, count(*) as steps, round(min(loss), 4) as min_loss,
       count(*) filter (isnan(loss)) as lost, round(max(loss) filter (isfinite(loss)), 4) as top
from log group by 1
""")
def diverged_loss(table):
    """Bare NaN and Infinity in log lines are losses like the others."""
    value = F.when(F.col("event_id") % 9 == 0, "NaN").when(
        F.col("event_id") % 13 == 0, "Infinity").otherwise((F.col("value") + 1).cast("string"))
    log = table("events").select(F.col("event_type").alias("run"), F.col("event_id").alias("line"),
                                 F.concat(F.lit('{"loss": '), value, F.lit("}")).alias("text"))
    loss = F.col("loss")
    return runlogs.loss_curve(log).groupBy("run").agg(
        F.max("step").cast("long").alias("steps"), F.round(F.min(loss), 4).alias("min_loss"),
        F.count_if(F.isnan(loss)).alias("lost"),
        F.round(F.max(F.when(~F.isnan(loss) & (loss != float("inf")), loss)), 4).alias("top"))


@query("""
select p_brand as model, 'parts' as metric, count(*)::double as value from part group by 1
union all select p_brand, 'share', round(avg(p_size), 4) from part group by 1
""")
def metrics_without_texts(table):
    """Numbers written as texts are no metrics."""
    sums = table("part").groupBy("p_brand").agg(
        F.count("*").alias("parts"), F.round(F.avg("p_size"), 4).alias("share"))
    body = F.to_json(F.struct("parts", "share", F.lit("0.5").alias("half"),
                              F.lit("NaN").alias("none"), F.lit("true").alias("yes")))
    return boards.metrics_long(sums.select(F.col("p_brand").alias("model"), body.alias("metrics")),
                               "model", "metrics")


@query("""
select distinct event_type as run, 'base_model' as key, 'small' as value from events
union all select event_type, 'training_rows', count(*)::varchar from events
          where event_type <> 'view' group by 1
""")
def run_metadata_of_empty_runs(table):
    """A run with bookkeeping entries only still gets its record."""
    events = table("events").withColumnRenamed("event_type", "run")
    training = events.groupBy("run").agg(F.count("*").cast("string").alias("value")).select(
        "run", F.when(F.col("run") == "view", "display_name").otherwise("rows").alias("metric"),
        "value")
    return boards.merge_run_metadata(training, training.limit(0), "run", {"base_model": "small"})


@query("""
select conv_id, min(turn) as turn, 'missing role or content' as fault
from conversations where (conv_id + turn) % 3 = 0 and role <> 'assistant' group by 1
""")
def chat_null_contents(table):
    """Null contents are faults, except of assistant messages."""
    rows = table("conversations").withColumn(
        "text", F.when((F.col("conv_id") + F.col("turn")) % 3 != 0, F.coalesce("text", F.lit(""))))
    return checks.chat_violations(rows).select("conv_id", "turn", "fault")


@query(r"""
select doc_id, len(regexp_extract_all(text, '(?s).{1,1000}\z|.{1,998}\n\n|.{1,999}\n|.{1,999} |.{1,1000}'))
       as chunks
from documents where length(text) > 0
""")
def incremental_index_two_sources(table):
    """Two streams with their own progress fill one collection."""
    rows = table("documents").select("doc_id", "text")
    spark = rows.sparkSession
    path = scratch_path(spark, "index")
    for part in (0, 1):
        source = scratch_path(spark, "incoming")
        rows.filter(F.col("doc_id") % 2 == part).repartition(6).write.parquet(source)
        stream = indexing.document_stream(spark, source, "doc_id long, text string")
        indexing.run_index(stream, path, scratch_path(spark, "progress"), "docs", size=1000, dim=32)
    return spark.read.parquet(path).groupBy("doc_id").agg(F.count("*").alias("chunks"))
