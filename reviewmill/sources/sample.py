"""Raw reviews derived from order-style tables: one order is one review, one region one app.

Review texts are whole documents behind a short phrase; every fiftieth review arrives twice.
The query is kept as one text for two engines, so that both read the very same reviews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("orders", "customer", "nation", "region", "documents")

RAW_REVIEWS_SQL = """
select 'com.' || lower(r_name) as app_id,
  r_name as app_name,
  'r' || cast(o_orderkey as {string}) as review_id,
  'u' || cast(o_custkey as {string}) as user_name,
  case when o_orderkey % 101 = 0 then null
       else cast(substring(o_orderpriority, 1, 1) as int) end as rating,
  case when o_orderkey % 89 = 0 then null else
    case o_orderkey % 12
      when 0 then 'App will CRASH on start.  '
      when 1 then 'Cannot log in, great app though! '
      when 2 then 'Charged twice, refund my money '
      when 3 then 'Love the new design '
      when 4 then 'So slow and  bad '
      when 5 then '  good good music '
      when 6 then 'not bad at all '
      when 7 then 'worst update ever!!! '
      when 8 then 'It was GREAT once but now it fails, very slow? why?? '
      when 9 then 'really awful, hardly any help '
      when 10 then 'I did not really enjoy this '
      else '' end
    || coalesce(text, '') end as review_text,
  cast(floor(o_totalprice) as bigint) % 500 + copy_no as thumbs_up,
  case when o_orderkey % 97 = 0 then null
       else cast(year(o_orderdate) as {string}) || '.' || cast(quarter(o_orderdate) as {string})
  end as app_version,
  cast({timestamp} as {naive}) as review_date,
  case when o_orderstatus = 'P' then 'thanks' end as reply_text
from (
  select *, {explode}(case when o_orderkey % 50 = 0 then {two} else {one} end) as copy_no,
    o_orderkey % (select count(*) from {documents}) as document_no
  from {orders}
) o
join {customer} on o_custkey = c_custkey
join {nation} on c_nationkey = n_nationkey
join {region} on n_regionkey = r_regionkey
left join {documents} on doc_id = document_no
"""

SPARK_WORDS = {
    "string": "string",
    "naive": "timestamp_ntz",
    "timestamp": "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)",
    "explode": "explode",
    "one": "array(0)",
    "two": "array(0, 1)",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_reviews(spark: SparkSession, folder: str) -> DataFrame:
    # {table} places are filled by spark.sql itself, from the DataFrames given.
    words = SPARK_WORDS | {name: "{" + name + "}" for name in TABLES}
    frames = {name: table(spark, folder, name) for name in TABLES}
    # The orders are one row group; spread before their texts join, they are read by many tasks.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frames["orders"] = frames["orders"].repartition(tasks, "o_orderkey")
    return spark.sql(RAW_REVIEWS_SQL.format(**words), **frames)
