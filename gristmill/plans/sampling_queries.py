"""Sampling, budget selection and splits over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import sampling, splits
from gristmill.operators.containment import answer_documents, containment_truth
from gristmill.plans.registry import query, spread
from gristmill.session import cut_lineage

SPLIT_BY_LANG = """
select lang, case when rn <= ceil(round((1 - 0.9) * n, 9)) then 'eval' else 'train' end as side,
       count(*) as n_docs
from (select lang, count(*) over () as n,
             row_number() over (order by md5('42:' || doc_id::varchar), doc_id) as rn
      from documents)
group by all
"""


@query(SPLIT_BY_LANG)
def split_sizes_by_lang(table):
    marked = splits.mark_eval(table("documents").select("doc_id", "lang"), 0.9, "doc_id")
    side = F.when(F.col("in_eval"), "eval").otherwise("train").alias("side")
    return marked.groupBy("lang", side).agg(F.count("*").alias("n_docs"))


@query("""
select event_id, event_type,
       row_number() over (order by md5('42:' || event_id::varchar))
         <= ceil(round((1 - 0.8) * count(*) over (), 9)) as in_eval
from events
""")
def train_eval_split(table):
    return splits.mark_eval(table("events").select("event_id", "event_type"), 0.8, "event_id")


@query("""
select 'orders' as dataset_uri, count(*) as num_examples, 'train' as split,
       cast(1.0 as double) as train_split_ratio from orders
union all select 'orders', 0, 'eval', cast(1.0 as double)
""")
def split_all_train(table):
    orders = table("orders").select("o_orderkey", "o_totalprice")
    train, evaluation = splits.train_eval_split(orders, 1.0, "o_orderkey")
    return splits.split_metadata(train, evaluation, "orders", 1.0)


@query("""
with n as (select count(*) as n, ceil(round((1 - 0.9) * count(*), 9))::bigint as e from orders)
select 'orders' as dataset_uri, n - e as num_examples, 'train' as split,
       cast(0.9 as double) as train_split_ratio from n
union all select 'orders', e, 'eval', cast(0.9 as double) from n
""")
def split_metadata(table):
    orders = table("orders").select("o_orderkey")
    train, evaluation = splits.train_eval_split(orders, 0.9, "o_orderkey")
    return splits.split_metadata(train, evaluation, "orders", 0.9)


@query("""
with t as (select *, row_number() over (order by md5('42:' || o_orderkey::varchar))
             <= ceil(round(0.3 * count(*) over (), 9)) as in_test from orders)
select o_orderkey, o_orderstatus, o_orderpriority, in_test, o_totalprice from t
""")
def train_test_split_random(table):
    orders = table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus",
                                    "o_orderpriority")
    train, test = splits.train_test_split(orders, "o_totalprice", "regression", 0.3, "o_orderkey")
    both = train.withColumn("in_test", F.lit(False)).unionByName(
        test.withColumn("in_test", F.lit(True)))
    return splits.label_last(both, "o_totalprice")


@query("""
with c as (select c_mktsegment, count(*) as n, sum(count(*)) over () as total
           from customer group by 1),
q as (select *, ceil(round(0.3 * total, 9))::bigint as wanted,
             floor(round(ceil(round(0.3 * total, 9)) * n / total, 9))::bigint as base,
             round(round(ceil(round(0.3 * total, 9)) * n / total, 9)
                   - floor(round(ceil(round(0.3 * total, 9)) * n / total, 9)), 9) as rest from c),
k as (select c_mktsegment, base
        + case when row_number() over (order by rest desc, c_mktsegment)
                    <= wanted - sum(base) over () then 1 else 0 end as quota from q)
select c_custkey, c.c_mktsegment,
       row_number() over (partition by c.c_mktsegment order by md5('42:' || c_custkey::varchar))
         <= quota as in_test
from customer c join k on c.c_mktsegment = k.c_mktsegment
""")
def train_test_split_stratified(table):
    rows = table("customer").select("c_custkey", "c_mktsegment")
    return splits.mark_test(rows, "c_mktsegment", "multiclass", 0.3, "c_custkey")


@query("""
with c as (select quality, count(*) as n, sum(count(*)) over () as total from labels group by 1),
q as (select *, ceil(round(0.2 * total, 9))::bigint as wanted,
             floor(round(ceil(round(0.2 * total, 9)) * n / total, 9))::bigint as base,
             round(round(ceil(round(0.2 * total, 9)) * n / total, 9)
                   - floor(round(ceil(round(0.2 * total, 9)) * n / total, 9)), 9) as rest from c)
select quality, n, (base + case when row_number() over (order by rest desc, quality)
                               <= wanted - sum(base) over () then 1 else 0 end)::bigint as quota
from q
""")
def class_quotas(table):
    rows = table("labels").select("doc_id", "quality")
    counts = rows.groupBy("quality").agg(F.count("*").alias("n"))
    return counts.join(splits.class_quotas(rows, "quality", 0.2), "quality")


@query("""
select vec_id, ('0x' || substr(md5('42:' || vec_id::varchar), 1, 8))::bigint % 2 as fold,
       ('0x' || substr(md5('43:' || vec_id::varchar), 1, 8))::bigint < 858993459 as in_holdout
from embeddings
""")
def assign_folds(table):
    return splits.assign_folds(table("embeddings").select("vec_id"), "vec_id")


@query("""
with t as (select count(*) as n,
                  sum(strlen(o_orderkey::varchar) + strlen(o_custkey::varchar)
                      + strlen(o_orderstatus) + strlen(o_totalprice::varchar)
                      + strlen(o_orderdate::varchar) + strlen(o_orderpriority)) as bytes
           from orders),
r as (select o.*, row_number() over (order by md5('42:' || o_orderkey::varchar)) as rn from orders o)
select o_orderkey, o_custkey, o_totalprice from r, t
where rn <= round_even(n * (200000 / bytes), 0)
""")
def sample_random(table):
    picked = sampling.sample_budget(table("orders"), "o_orderkey", 200_000, task="regression")
    return picked.select("o_orderkey", "o_custkey", "o_totalprice")


@query("""
with d as (select doc_id, nullif(lang, 'es') as lang,
                  strlen(doc_id::varchar) + strlen(text) + strlen(lang) + strlen(source)
                  + strlen(n_chars::varchar) as bytes from documents),
t as (select sum(bytes) as bytes from d where lang is not null),
r as (select doc_id, lang, count(*) over (partition by lang) as n,
             row_number() over (partition by lang order by md5('42:' || doc_id::varchar)) as rn
      from d where lang is not null)
select doc_id, lang from r, t where rn <= round_even((1000000 / bytes) * n, 0)
""")
def sample_stratified(table):
    docs = table("documents")
    docs = docs.withColumn("lang", F.nullif("lang", F.lit("es")))
    return sampling.sample_budget(docs, "doc_id", 1_000_000, label="lang",
                                  task="multiclass").select("doc_id", "lang")


@query("""
with s as (select *, strlen(l_orderkey::varchar) + strlen(l_linenumber::varchar)
                     + strlen(l_partkey::varchar) + strlen(l_suppkey::varchar)
                     + strlen(l_returnflag) as bytes from lineitem),
c as (select *, row_number() over w as rn, sum(bytes) over w as cum from s
      window w as (order by l_orderkey, l_linenumber, l_partkey, l_suppkey
                   rows unbounded preceding))
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag from c
where cum <= 500000 or rn = 1
""")
def sample_first_rows(table):
    rows = table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                    "l_returnflag")
    return sampling.sample_budget(
        rows, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 500_000, "first_n_rows")


@query("""
select l_returnflag, count(*) as n_rows,
       sum(strlen(l_orderkey::varchar) + strlen(l_partkey::varchar) + strlen(l_quantity::varchar)
           + strlen(l_shipdate::varchar))::bigint as bytes
from lineitem group by 1
""")
def row_bytes(table):
    rows = table("lineitem")
    size = sampling.row_bytes(rows, ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"])
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n_rows"), F.sum(size).alias("bytes"))


@query("""
select event_id, user_id, event_type from events
qualify row_number() over (order by md5('42:' || event_id::varchar)) <= 3000
""")
def subset_exact(table):
    return sampling.subset(table("events").select("event_id", "user_id", "event_type"), 3000,
                           "event_id")


@query("""
select item_id, text from benchmark
qualify row_number() over (order by md5('17:' || item_id::varchar)) <= 5
""")
def question_sample(table):
    return sampling.subset(table("benchmark"), sampling.QUESTION_COUNT, "item_id",
                           sampling.QUESTION_SEED)


@query("""
select event_type, event_id, ts from events
qualify row_number() over (partition by event_type order by ts, event_id) <= 25
""")
def limit_per_group(table):
    return sampling.limit_per_group(table("events").select("event_type", "event_id", "ts"),
                                    "event_type", 25, ["ts", "event_id"])


@query("""
with n as (select conv_id, count(*) as chunks, row_number() over (order by conv_id) as rn
           from conversations group by 1),
b as (select (rn - 1) // 20 + 1 as batch, count(*) as documents, sum(chunks)::bigint as chunks
      from n group by 1)
select batch, documents, chunks, sum(chunks) over (order by batch)::bigint as chunks_so_far from b
""")
def batch_stats(table):
    items = table("conversations").groupBy("conv_id").agg(F.count("*").alias("chunks"))
    return sampling.batch_stats(items, "conv_id", "chunks")


def _truth(table):
    return containment_truth(table("benchmark"),
                             spread(table("documents").select("doc_id", "text")))


def _files(table):
    return table("documents").select("doc_id", F.octet_length("text").cast("long")
                                     .alias("size_bytes"))


WALK = """
with recursive named as (
  select distinct d.doc_id from benchmark b join documents d on contains(d.text, b.text)),
f as (select d.doc_id, strlen(d.text) as size_bytes, n.doc_id is not null as named,
             row_number() over (order by (n.doc_id is null), d.doc_id) as rn
      from documents d left join named n on d.doc_id = n.doc_id),
w as (select 0::bigint as rn, 0::bigint as used, null::bigint as doc_id, null::boolean as named,
             null::bigint as size_bytes, false as kept
  union all
  select f.rn, w.used + case when w.used + f.size_bytes <= {cap} then f.size_bytes else 0 end,
         f.doc_id, f.named, f.size_bytes, w.used + f.size_bytes <= {cap}
  from w join f on f.rn = w.rn + 1)
"""


def _selected(table, cap):
    truth = cut_lineage(_truth(table))      # read again by the final filter
    files = sampling.mark_priority(_files(table), answer_documents(truth, "doc_id"),
                                   F.col("doc_id"), "doc_id")
    return sampling.select_within_budget(files, cap, "doc_id", priority="named")


@query(WALK.format(cap=600000) + "select doc_id, size_bytes, named from w where kept")
def select_within_budget(table):
    return _selected(table, 600_000)


@query("""
select doc_id, size_bytes from (
  select doc_id, strlen(text) as size_bytes, sum(strlen(text)) over (order by doc_id) as cum
  from documents) where cum <= 700000
""")
def select_prefix(table):
    return sampling.select_within_budget(_files(table), 700_000, "doc_id", mode="prefix")


@query(WALK.format(cap=300000) + """
select 'corpus' as bucket, 'documents' as prefix, sum(size_bytes)::bigint as total_size_bytes,
       count(*) as count from w where kept
""")
def selection_manifest(table):
    return sampling.manifest(_selected(table, 300_000), "corpus", "documents", "doc_id")


@query("""
select b.item_id, d.doc_id from benchmark b join documents d on contains(d.text, b.text)
""")
def passage_containment(table):
    return _truth(table)


@query("""
select distinct d.doc_id from benchmark b join documents d on contains(d.text, b.text)
""")
def answer_documents_set(table):
    return answer_documents(_truth(table), "doc_id")


@query("""
select d.doc_id, d.lang, exists (select 1 from benchmark b where contains(d.text, b.text)) as named
from documents d
""")
def priority_flag(table):
    truth = _truth(table)
    return sampling.mark_priority(table("documents").select("doc_id", "lang"),
                                  answer_documents(truth, "doc_id"), F.col("doc_id"), "doc_id")


@query("""
select lang, count(*) as n_docs from documents d
where not exists (select 1 from labels l where l.doc_id = d.doc_id) group by 1
""")
def unlabelled_documents(table):
    rest = table("documents").select("doc_id", "lang").join(
        table("labels").select("doc_id"), "doc_id", "left_anti")
    return rest.groupBy("lang").agg(F.count("*").alias("n_docs"))


@query("""
with n as (select count(*) as n, ceil(round(0.3 * count(*), 6))::bigint as t from customer)
select n - t as train_rows, t as test_rows, n as either, 0::bigint as in_both from n
""")
def split_overlap(table):
    """Both sides have their sizes, cover all rows and share none."""
    rows = table("customer").select("c_custkey")
    train, test = (part.withColumn("side", F.lit(name)) for name, part in zip(
        ("train", "test"), splits.train_eval_split(rows, 0.7, "c_custkey"), strict=True))
    sides = train.unionByName(test).groupBy("c_custkey").agg(
        F.collect_set("side").alias("sides"))
    return sides.agg(
        F.count_if(F.array_contains("sides", "train")).alias("train_rows"),
        F.count_if(F.array_contains("sides", "test")).alias("test_rows"),
        F.count("*").alias("either"), F.count_if(F.size("sides") == 2).alias("in_both"))


@query("""
select 'train_sft' as split, count(*) as n from orders where o_orderstatus = 'F'
""")
def choose_split(table):
    """A preferred name wins over one that comes first in the alphabet."""
    name = F.when(F.col("o_orderstatus") == "F", "train_sft").when(
        F.col("o_orderstatus") == "O", "all").otherwise("training")
    rows = table("orders").select(name.alias("split"), "o_orderkey")
    return splits.choose_split(rows).groupBy("split").agg(F.count("*").alias("n"))


@query("select distinct o_orderpriority as split, count(*) as n from orders where "
       "o_orderpriority = (select min(o_orderpriority) from orders) group by 1")
def choose_split_without_preferred(table):
    rows = table("orders").select(F.col("o_orderpriority").alias("split"), "o_orderkey")
    return splits.choose_split(rows).groupBy("split").agg(F.count("*").alias("n"))


@query("""
select '[' || json_object('o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus)::varchar
       || ']' as sample_row
from orders order by o_orderkey limit 1
""")
def sample_row_json(table):
    return splits.sample_row_json(table("orders").select("o_orderkey", "o_orderstatus",
                                                         "o_totalprice"),
                                  ["o_orderkey"], drop=["o_totalprice"])
