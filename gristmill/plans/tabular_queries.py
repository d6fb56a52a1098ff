"""Metrics, leaderboards, run logs, freshness, models, sources and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import boards, checks, runlogs, splits, tabular
from gristmill.plans.registry import query, spread
from gristmill.session import scratch_path
from gristmill.sources import readers, writers
from gristmill.streaming import indexing

PRICED = """
p as (select l_suppkey, l_returnflag, l_extendedprice as y, l_quantity * p_retailprice as yhat
      from lineitem join part on l_partkey = p_partkey)
"""
ERRORS = """round(sqrt(avg((y - yhat) * (y - yhat))), 4) as root_mean_squared_error,
       round(avg(abs(y - yhat)), 4) as mean_absolute_error,
       round(1 - avg((y - yhat) * (y - yhat)) / var_pop(y), 6) as r2"""


def _priced(table):
    lines = table("lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_quantity",
                                     "l_extendedprice")
    parts = table("part").select("p_partkey", "p_retailprice")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "predicted", F.col("l_quantity") * F.col("p_retailprice"))


def _rounded(df, *keys):
    return df.select(*keys, F.round("root_mean_squared_error", 4).alias("root_mean_squared_error"),
                     F.round("mean_absolute_error", 4).alias("mean_absolute_error"),
                     F.round("r2", 6).alias("r2"))


@query(f"with {PRICED} select l_returnflag, {ERRORS} from p group by 1")
def regression_metrics(table):
    scored = tabular.regression_metrics(_priced(table), "l_extendedprice", "predicted",
                                        ["l_returnflag"])
    return _rounded(scored, "l_returnflag")


JUDGED = """
j as (select quality as y, (n_chars > 1500)::int as p from documents join labels using (doc_id))
"""


def _judged(table):
    docs = table("documents").select("doc_id", (F.col("n_chars") > 1500).cast("int").alias("guess"))
    return table("labels").select("doc_id", "quality").join(docs, "doc_id")


@query(f"with {JUDGED} select round(avg((y = p)::int), 6) as accuracy from j")
def accuracy(table):
    return tabular.accuracy(_judged(table), "quality", "guess").select(
        F.round("accuracy", 6).alias("accuracy"))


@query(f"""
with {JUDGED},
c as (select class, count(*) filter (y = class) as actual, count(*) filter (p = class) as predicted,
             count(*) filter (y = class and p = class) as hit
      from j, (select distinct y as class from j union select distinct p from j) k group by 1)
select class, round(case when predicted > 0 then hit / predicted else 0 end, 6)::double as precision,
       round(case when actual > 0 then hit / actual else 0 end, 6)::double as recall,
       round(2.0 * hit / (actual + predicted), 6)::double as f1 from c
""")
def class_metrics(table):
    scored = tabular.class_metrics(_judged(table), "quality", "guess")
    return scored.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(f"""
with {JUDGED}, k as (select distinct y as v from j union select distinct p from j)
select a.v as label, b.v as prediction, count(j.y) as n
from k a join k b on true left join j on j.y = a.v and j.p = b.v group by all
""")
def confusion(table):
    return tabular.confusion(_judged(table), "quality", "guess")


@query(f"""
with {PRICED}, m as (select l_suppkey, {ERRORS} from p group by 1)
select row_number() over (order by r2 desc nulls last, s_name) as rank, s_name,
       root_mean_squared_error, mean_absolute_error, r2,
       'models/' || s_name || '/notebooks/automl_predictor_notebook.ipynb' as notebook,
       'models/' || s_name || '/predictor/predictor.pkl' as predictor
from m join supplier on s_suppkey = l_suppkey
""")
def model_leaderboard(table):
    names = table("supplier").select("s_suppkey", "s_name", F.lit("models/").alias("uri"))
    scored = tabular.regression_metrics(_priced(table), "l_extendedprice", "predicted",
                                        ["l_suppkey"])
    rows = _rounded(scored, F.col("l_suppkey").alias("s_suppkey"))
    named = rows.join(names.select("s_suppkey", "s_name"), "s_suppkey").drop("s_suppkey")
    board = boards.model_board(names.select("s_name", "uri"), named, "s_name", "uri")
    return boards.leaderboard(board.drop("uri"), "r2", "s_name")


@query(f"""
with {PRICED}, m as (select l_suppkey, {ERRORS} from p group by 1)
select l_suppkey, mean_absolute_error from m order by mean_absolute_error, l_suppkey limit 3
""")
def top_models(table):
    scored = tabular.regression_metrics(_priced(table), "l_extendedprice", "predicted",
                                        ["l_suppkey"])
    return boards.top_n(_rounded(scored, "l_suppkey"), "mean_absolute_error", "l_suppkey", 3,
                        higher_is_better=False).select("l_suppkey", "mean_absolute_error")


@query("""
with m as (select l_returnflag, avg(l_discount) as v from lineitem group by 1)
select 1::bigint as rank, l_returnflag, round(v, 6) as mean_discount from m
order by v desc, l_returnflag limit 1
""")
def best_row(table):
    means = table("lineitem").groupBy("l_returnflag").agg(F.avg("l_discount").alias("v"))
    best = boards.best_row(boards.leaderboard(means, "v", "l_returnflag"))
    return best.select("rank", "l_returnflag", F.round("v", 6).alias("mean_discount"))


@query("""
with a as (select l_returnflag, l_linestatus, count(*) as n, avg(l_quantity) as q
           from lineitem group by all)
select l_returnflag, 'task ' || l_linestatus as task,
       case when l_linestatus = 'F' then 'holdout_' else 'Task_O_' end || metric as metric, value
from (select l_returnflag, case when l_linestatus = 'F' then 'F' else 'O' end as l_linestatus,
             unnest(['rows', 'mean_quantity,none', 'good']) as metric,
             unnest([n::double, round(q, 4), 1.0]) as value from a)
""")
def flatten_metrics(table):
    sums = table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.round(F.avg("l_quantity"), 4).alias("q"))
    task = F.when(F.col("l_linestatus") == "F", boards.HOLDOUT_TASK).otherwise("task O")
    body = F.to_json(F.struct(
        F.concat(F.lit("Task "), "l_linestatus").alias("alias"), F.col("n").alias("rows"),
        F.col("q").alias("mean/quantity,none"), F.lit(True).alias("good"),
        F.lit("text").alias("note")))
    results = F.concat(F.lit('{"'), task, F.lit('":'), body, F.lit("}"))
    flat = boards.flatten_metrics(sums.select("l_returnflag", results.alias("results")), "results")
    return flat.withColumn("task", F.when(F.col("task") == boards.HOLDOUT_TASK, "task F").otherwise(
        F.col("task")))


RUNS = """
t as (select event_type as run, 'rows' as metric, count(*)::varchar as value from events group by 1
      union all select event_type, 'display_name', event_type from events group by 1),
e as (select event_type as run, 'task' || (user_id % 7) || '_acc,none' as metric,
             user_id % 7 as place, round(avg(value), 4) as value from events group by all
      union all select event_type, 'task_acc,stderr', 99, 1e9 from events group by 1)
"""


def _runs(table):
    events = table("events")
    name = F.col("event_type").alias("run")
    training = events.groupBy(name).agg(F.count("*").cast("string").alias("rows")).select(
        "run", F.explode(F.create_map(F.lit("rows"), "rows", F.lit("display_name"), "run")).alias(
            "metric", "value"))
    place = F.pmod("user_id", F.lit(7))
    measured = events.groupBy(name, place.alias("place")).agg(
        F.round(F.avg("value"), 4).alias("value")).select(
        "run", F.concat(F.lit("task"), F.col("place").cast("string"), F.lit("_acc,none"))
        .alias("metric"), "place", "value")
    noise = events.select(name).distinct().select(
        "run", F.lit("task_acc,stderr").alias("metric"), F.lit(99).cast("long").alias("place"),
        F.lit(1e9).alias("value"))
    return training, measured.unionByName(noise)


@query(f"""
with {RUNS}
select run, 'training_' || metric as key, value from t where metric <> 'display_name'
union all select run, 'eval_' || metric, printf('%.3f', value) from e
union all select distinct run, 'base_model', 'small' from t
""")
def merge_run_metadata(table):
    training, measured = _runs(table)
    shown = measured.withColumn("value", boards.number_text(F.col("value"), 3))
    return boards.merge_run_metadata(training, shown, "run", {"base_model": "small"})


@query(f"""
with {RUNS}
select run, arg_max(metric, value) as eval_best_metric, max(value)::varchar as eval_best_score
from e where metric not like '%stderr%' group by 1
""")
def best_metric(table):
    return boards.best_metric(_runs(table)[1], "run", "place")


# Log lines made from events: plain, text numbers, other names, zeros, malformed, blank.
LOG = """
log as (select event_type as run, event_id as line, value as v, event_id % 11 as kind from events),
entry as (select *, case when kind in (0, 1) then null when kind = 2 then 0.0 else v end as first_loss,
                 -- a zero is not part of the series, the text "0.0" is
                 case when kind in (0, 1) then null when kind = 2 then nullif(v * 2, 0)
                      when kind = 3 then v else nullif(v, 0) end as series
          from log)
"""


def _log(table):
    kind, v = F.pmod("event_id", F.lit(11)), F.col("value")
    number = v.cast("string")
    line = (F.when(kind == 0, "bad{").when(kind == 1, " ")
            .when(kind == 2, F.concat(F.lit('{"loss": 0, "avg_loss": '), (v * 2).cast("string"),
                                      F.lit("}")))
            .when(kind == 3, F.concat(F.lit('{"avg_loss": "'), number, F.lit('", "lr": 0.5}')))
            .otherwise(F.concat(F.lit('{"loss": '), number, F.lit(', "gradnorm": '),
                                F.col("user_id").cast("string"), F.lit(', "epoch": "x"}'))))
    return spread(table("events")).select(F.col("event_type").alias("run"),
                                  F.col("event_id").alias("line"), line.alias("text"))


@query(f"""
with {LOG}
select run, round(arg_min(first_loss, line), 4) as loss,
       case when count(*) filter (kind = 3) > 0 then 0.5 end::double as learning_rate,
       null::double as epoch, round(arg_max(series, line), 4) as final_loss,
       round(min(series), 4) as min_loss, count(series) as steps,
       round(exp(least(arg_max(series, line), 10)), 2) as final_perplexity
from entry group by 1
""")
def training_summary(table):
    summary = runlogs.training_summary(_log(table))
    return summary.select("run", F.round("loss", 4).alias("loss"), "learning_rate", "epoch",
                          F.round("final_loss", 4).alias("final_loss"),
                          F.round("min_loss", 4).alias("min_loss"), "steps",
                          F.round("final_perplexity", 2).alias("final_perplexity"))


@query(f"""
with {LOG}
select run, row_number() over (partition by run order by line) as step, round(series, 4) as loss
from entry where series is not null
""")
def loss_curve(table):
    return runlogs.loss_curve(_log(table)).select("run", "step", F.round("loss", 4).alias("loss"))


@query(f"""
with {LOG},
c as (select run, row_number() over (partition by run order by line) as step, series as loss
      from entry where series is not null)
select run, round(min(loss), 4) as min_loss, arg_min(step, (loss, step)) as min_step,
       max(step) as steps from c group by 1
""")
def loss_lowest_point(table):
    low = runlogs.lowest_point(runlogs.loss_curve(_log(table)))
    return low.select("run", F.round("min_loss", 4).alias("min_loss"), "min_step", "steps")


AGED = """
a as (select o_orderkey, case when o_orderkey % 5 = 4 then null
                              else floor(epoch(timestamp '1999-06-15 12:00:00'
                                               - date_trunc('day', o_orderdate)) / 86400) end as age
      from orders),
f as (select o_orderkey, coalesce(age, 0)::bigint as age_days,
             case when age is null then 'stale' when age < 270 then 'fresh'
                  when age < 360 then 'warning' else 'stale' end as category from a)
"""


def _aged(table):
    form = F.pmod("o_orderkey", F.lit(5))
    date = F.date_trunc("day", F.col("o_orderdate"))
    text = (F.when(form == 0, F.date_format(date, "yyyy-MM-dd"))
            .when(form == 1, F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(form == 2, F.date_format(date, "yyyy-MM-dd HH:mm:ssXX"))
            .when(form == 3, F.date_format(date, "yyyy-MM-dd'T'HH:mm:ssXXX")).otherwise("soon"))
    rows = spread(table("orders").select("o_orderkey", "o_orderdate")).select(
        "o_orderkey", text.alias("verified"))
    return checks.freshness(rows, checks.parse_date(F.col("verified")),
                            F.to_timestamp(F.lit("1999-06-15 12:00:00")))


@query(f"with {AGED} select o_orderkey, age_days, category from f")
def freshness(table):
    return _aged(table).select("o_orderkey", "age_days", "category")


@query(f"with {AGED} select category, count(*) as n from f group by 1")
def freshness_counts(table):
    return checks.freshness_counts(_aged(table))


@query("select c_custkey, c_name, c_acctbal, c_mktsegment from customer")
def csv_round_trip(table):
    rows = splits.label_last(table("customer").select("c_custkey", "c_mktsegment", "c_name",
                                                      "c_acctbal"), "c_mktsegment")
    path = scratch_path(rows.sparkSession, "csv")
    writers.write_table(rows, path, "csv")
    return readers.read_table(rows.sparkSession, path, "csv", rows.schema)


@query("select conv_id, turn, role, text from conversations")
def json_round_trip(table):
    rows = table("conversations")
    path = scratch_path(rows.sparkSession, "records") + ".jsonl"
    writers.write_records(rows, path)
    return readers.read_records(rows.sparkSession, path, rows.schema)


@query("select page_id, url, html from pages")
def parquet_round_trip(table):
    rows = table("pages")
    path = scratch_path(rows.sparkSession, "table")
    writers.write_table(rows, path, "parquet")
    return readers.read_table(rows.sparkSession, path, "parquet")


@query("""
select o_orderstatus as pattern, count(*) as n, round(sum(o_totalprice), 2) as total
from orders group by 1
""")
def evaluation_files(table):
    rows = table("orders").select(F.col("o_orderstatus").alias("pattern"), "o_orderkey",
                                  "o_totalprice")
    path = scratch_path(rows.sparkSession, "evaluations")
    writers.write_evaluations(rows, path)
    back = rows.sparkSession.read.schema(rows.schema).json(path)
    return back.groupBy("pattern").agg(F.count("*").alias("n"),
                                       F.round(F.sum("o_totalprice"), 2).alias("total"))


def _text_files(table):
    """Customers written as text files, one per market segment and nation."""
    rows = table("customer").select(
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("name"),
        F.col("c_name").alias("value"))
    path = scratch_path(rows.sparkSession, "files")
    rows.repartition("name").write.partitionBy("name").text(path)
    return rows.sparkSession, path


@query("""
select c_mktsegment || '-' || c_nationkey as name, (sum(length(c_name) + 1))::bigint as size_bytes
from customer group by 1
""")
def list_documents(table):
    spark, path = _text_files(table)
    files = readers.list_documents(spark, path)
    return files.groupBy(F.regexp_extract("key", "name=([^/]+)/", 1).alias("name")).agg(
        F.sum("size_bytes").alias("size_bytes"))


@query("""
select count(distinct c_mktsegment || '-' || c_nationkey) as documents,
       (sum(length(c_name) + 1))::bigint as characters from customer
""")
def load_text_documents(table):
    spark, path = _text_files(table)
    docs = readers.load_text_documents(spark, f"{path}/*/*.txt")
    return docs.agg(F.count_distinct("document_id").alias("files"), F.count("*").alias("documents"),
                    F.sum(F.length("text")).alias("characters")).drop("files")


@query("""
select p_brand as model, metric, value from (
  select p_brand, unnest(['parts', 'mean_size']) as metric,
         unnest([count(*)::double, round(avg(p_size), 4)]) as value from part group by 1)
""")
def load_model_metrics(table):
    """A metric file for each model, found below a folder and read as long rows."""
    sums = table("part").groupBy("p_brand").agg(F.count("*").alias("parts"),
                                                F.round(F.avg("p_size"), 4).alias("mean_size"))
    text = sums.select(F.col("p_brand").alias("model"), F.to_json(F.struct(
        "parts", "mean_size", F.lit("none").alias("note"))).alias("metrics"))
    spark, path = text.sparkSession, scratch_path(text.sparkSession, "models")
    text.repartition("model").withColumn("_model", F.col("model")).drop("model").write.partitionBy(
        "_model").text(path)
    files = readers.load_model_metrics(spark, path, "part-*").withColumn(
        "model", F.url_decode(F.regexp_replace("model", "^_model=", "")))
    return boards.metrics_long(files, "model", "metrics")


@query()
def select_models(table):
    rows = table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                    "l_quantity", "l_discount", "l_returnflag", "l_extendedprice")
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    train, test = splits.train_test_split(rows, "l_extendedprice", "regression", 0.2, key)
    board, _ = tabular.select_models(
        train, test, "l_extendedprice", "regression", skip=["l_orderkey", "l_linenumber"])
    return board


@query()
def refit_models(table):
    rows = table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                                  "o_orderstatus")
    folds = splits.assign_folds(rows, "o_orderkey")
    train, test = splits.train_test_split(folds, "o_orderstatus", "multiclass", 0.2, "o_orderkey")
    known, held = train.filter("not in_holdout"), train.filter("in_holdout")
    skip = ["o_orderkey", "fold", "in_holdout"]
    _, best = tabular.select_models(known, held, "o_orderstatus", "multiclass", skip=skip)
    records, _ = tabular.refit_full(
        best, known, held, test, "o_orderstatus", "multiclass", skip[1:], key=["o_orderkey"],
        split={"test_size": 0.2}, settings={"folds": splits.FOLDS})
    return records


@query()
def stack_models(table):
    """Prices of parts: all families on four levels, each row by models that never saw it."""
    rows = table("part").select("p_partkey", "p_size", "p_type", "p_retailprice")
    return tabular.stack_predictions(rows, "p_retailprice", "regression", ["p_partkey"])


@query()
def stack_classes(table):
    """Quality of documents by their language, source and length, with class probabilities."""
    rows = table("labels").select("doc_id", "quality").join(
        table("documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")
    found = tabular.stack_predictions(rows, "quality", "binary", ["doc_id"])
    return found.select("doc_id", "quality", "fold", "prediction",
                        F.round(F.array_max("probabilities"), 6).alias("certainty"))


@query()
def permutation_importance(table):
    """Of every family, by name: what a sum depends on."""
    rows = _priced(table).select("l_partkey", "l_suppkey", "l_quantity", "p_retailprice",
                                 "l_extendedprice").groupBy("l_partkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("quantity"), F.avg("p_retailprice").alias("price"),
        F.sum("l_extendedprice").alias("amount"))
    key = ["l_partkey", "l_suppkey"]
    train, test = splits.train_test_split(rows, "amount", "regression", 0.3, key)
    _, fitted = tabular.select_models(train, test, "amount", "regression", 4, key)
    return tabular.permutation_importances(dict(sorted(fitted.items())), test, "amount",
                                           "regression", ["quantity", "price"], key)


@query(r"""
select doc_id, len(regexp_extract_all(text, '(?s).{1,1000}\z|.{1,998}\n\n|.{1,999}\n|.{1,999} |.{1,1000}'))
       as chunks
from documents where length(text) > 0
""")
def incremental_index(table):
    """Documents written as 30 files, indexed as a stream in batches of 20 files."""
    rows = table("documents").select("doc_id", "text")
    spark = rows.sparkSession
    source, path = scratch_path(spark, "incoming"), scratch_path(spark, "index")
    rows.repartition(30).write.parquet(source)
    stream = indexing.document_stream(spark, source, "doc_id long, text string")
    indexing.run_index(stream, path, scratch_path(spark, "progress"), "docs", size=1000, dim=64)
    return spark.read.parquet(path).groupBy("doc_id").agg(F.count("*").alias("chunks"))
