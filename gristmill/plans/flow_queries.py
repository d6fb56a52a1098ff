"""Whole flows over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import documents, retrieval
from gristmill.plans import flows
from gristmill.plans.registry import query, spread
from gristmill.plans.text_queries import sql_plain_text
from gristmill.session import scratch_path


@query("""
with s as (select *, row_number() over (order by md5('42:' || conv_id::varchar || ':'
                                                     || turn::varchar)) as rn,
                  least(count(*) over (), 300) as n from conversations)
select role, case when rn <= ceil(round((1 - 0.9) * n, 9)) then 'eval' else 'train' end as side,
       count(*) as items
from s where rn <= 300 group by all
""")
def ingest_chat(table):
    items = table("conversations").select("conv_id", "turn", "role", F.array(F.struct(
        "role", F.col("text").alias("content"))).alias("messages"))
    train, held = flows.ingest_chat(items, ["conv_id", "turn"], 300)
    both = train.withColumn("side", F.lit("train")).unionByName(
        held.withColumn("side", F.lit("eval")))
    return both.groupBy("role", "side").agg(F.count("*").alias("items"))


@query("""
with d as (select *, strlen(o_orderkey::varchar) + strlen(o_custkey::varchar)
                     + strlen(o_orderpriority) as bytes from orders),
k as (select *, md5('42:' || o_orderkey::varchar) as h, count(*) over (partition by o_orderpriority)
             as n, sum(bytes) over () as total from d),
s as (select *, row_number() over (partition by o_orderpriority order by h) as rn from k
      qualify row_number() over (partition by o_orderpriority order by h)
              <= round_even((100000 / total) * n, 0)),
c as (select o_orderpriority, count(*) as n, sum(count(*)) over () as total from s group by 1),
q as (select *, ceil(round(0.2 * total, 9))::bigint as wanted,
             floor(round(ceil(round(0.2 * total, 9)) * n / total, 9))::bigint as base,
             round(ceil(round(0.2 * total, 9)) * n / total, 9) as share from c),
t as (select o_orderpriority, base + case when row_number() over (
               order by round(share - base, 9) desc, o_orderpriority)
             <= wanted - sum(base) over () then 1 else 0 end as quota from q)
select s.o_orderpriority, rn <= quota as in_test, count(*) as n_rows,
       sum(o_custkey)::bigint as customers
from s join t on s.o_orderpriority = t.o_orderpriority group by all
""")
def prepare_table(table):
    rows = table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    train, test = flows.prepare_table(rows, "o_orderkey", "o_orderpriority", "multiclass", 100_000,
                                      0.2)
    both = train.withColumn("in_test", F.lit(False)).unionByName(
        test.withColumn("in_test", F.lit(True)))
    return both.groupBy("o_orderpriority", "in_test").agg(
        F.count("*").alias("n_rows"), F.sum("o_custkey").alias("customers"))


@query(rf"""
with recursive f as (select page_id, strlen(html) as size_bytes,
                            row_number() over (order by page_id) as rn from pages),
w as (select 0::bigint as rn, 0::bigint as used, null::bigint as page_id, false as kept
  union all
  select f.rn, w.used + case when w.used + f.size_bytes <= 400000 then f.size_bytes else 0 end,
         f.page_id, w.used + f.size_bytes <= 400000
  from w join f on f.rn = w.rn + 1),
t as (select page_id, {sql_plain_text()} as text from pages
      where page_id in (select page_id from w where kept))
select page_id, len(regexp_extract_all(text, '(?s).{{1,900}}\z|.{{1,898}}\n\n|.{{1,899}}\n|.{{1,899}} |.{{1,900}}'))
       as chunks, length(text) as characters
from t where text <> ''
""")
def index_documents(table):
    chunks = flows.index_documents(spread(table("pages").select("page_id", "html")), "page_id",
                                   "html", 400_000, 900, dim=64)
    return chunks.groupBy("page_id").agg(F.count("*").alias("chunks"),
                                         F.sum(F.length("chunk_text")).alias("characters"))


@query(r"""
select 'documents' as collection, sum(len(regexp_extract_all(
         text, '(?s).{1,800}\z|.{1,798}\n\n|.{1,799}\n|.{1,799} |.{1,800}')))::bigint as vectors
from documents
union all select 'questions', count(*) from benchmark
""")
def index_collections(table):
    """Chunk vectors appended to two named collections and read back."""
    docs = documents.chunk(spread(table("documents").select("doc_id", "text")), size=800)
    asked = table("benchmark").select(F.col("item_id").alias("doc_id"),
                                      F.lit(0).alias("chunk_no"), F.col("text").alias("chunk_text"))
    spark = asked.sparkSession
    path = scratch_path(spark, "collections")
    for name, rows in (("documents", docs), ("questions", asked)):
        retrieval.append_index(retrieval.embed(rows, "chunk_text", dim=32), path, name)
    sizes = [retrieval.read_index(spark, path, name).agg(
        F.lit(name).alias("collection"), F.count("*").alias("vectors"))
        for name in ("documents", "questions")]
    return sizes[0].unionByName(sizes[1])
