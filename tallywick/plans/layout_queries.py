"""Sources, sinks and layouts: each written to the work folder, read back and summed up."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywick.operators import starjoin
from tallywick.plans.registry import query
from tallywick.session import new_path
from tallywick.sources import tables as src

_PART = "p_partkey long, p_name string, p_category string, p_size int"
_FACT = """select cast(lo_orderdate as int) lo_orderdate, cast(count(*) as bigint) n, cast(sum(lo_revenue) as bigint) revenue, cast(sum(lo_quantity) as bigint) quantity from lineorder group by 1"""
_PARTS = "select p_category, count(*) n, cast(sum(p_partkey) as bigint) keys, cast(sum(p_size) as bigint) sizes, min(p_name) first_name from ssb_part group by 1"


def _parts(t):
    return t.ssb_part.select("p_partkey", "p_name", "p_category", "p_size")


def _part_sums(df):
    return df.groupBy("p_category").agg(F.count(F.lit(1)).alias("n"), F.sum("p_partkey").alias("keys"), F.sum("p_size").alias("sizes"), F.min("p_name").alias("first_name"))


def _fact_sums(df):
    return df.groupBy("lo_orderdate").agg(F.count(F.lit(1)).alias("n"), F.sum("lo_revenue").alias("revenue"), F.sum("lo_quantity").alias("quantity"))


def _text(t, sep, **options):
    path = new_path(t.spark, "text")
    _parts(t).write.options(sep=sep, **options).csv(path)
    return path


@query("s01_pipe_delimited", "S01", views=("ssb_part",), sql=_PARTS)
def pipes(t):
    return _part_sums(src.read_delimited(t.spark, _text(t, "|"), _PART))


@query("s02_gzip_load", "S02", views=("ssb_part",), sql=_PARTS)
def gzip(t):
    return _part_sums(src.load_gzip(t.spark, _text(t, "|", compression="gzip"), _PART, new_path(t.spark, "loaded")))


@query("s06_csv", "S06", views=("ssb_part",), sql=_PARTS)
def csv(t):
    return _part_sums(src.read_csv(t.spark, _text(t, ","), _PART))


@query("s07_tsv", "S07 S11", views=("ssb_part",), sql=_PARTS)
def tsv(t):
    return _part_sums(src.read_tsv(t.spark, src.write_tsv(_parts(t), new_path(t.spark, "tsv")), _PART))


@query("s08_pagecounts_log", "S08 X15", views=("pagecounts",), sql="""
    select strftime(dt, '%Y%m%d') date, lpad(hr::varchar, 2, '0') || '0000' as hour, project, count(*) n, cast(sum(views) as bigint) views from pagecounts group by all""")
def pagecounts(t):
    path = new_path(t.spark, "pagecounts")
    name = F.concat(F.lit("pagecounts-"), F.date_format("dt", "yyyyMMdd"), F.lit("-"), F.lpad(F.col("hr").cast("string"), 2, "0"), F.lit("0000"))
    line = F.concat_ws(" ", "project", "title", F.col("views").cast("string"))
    t.pagecounts.select(line.alias("value"), name.alias("file")).repartitionByRange("file", "value").write.partitionBy("file").text(path)
    return src.read_pagecounts(t.spark, path).groupBy("date", "hour", "project").agg(F.count(F.lit(1)).alias("n"), F.sum("views").alias("views"))


@query("s09_json_tweets", "S09 X26 X27", views=("tweets",), sql="select tweet_id::varchar id_str, user_id::varchar user_id, followers_count::varchar followers_count, length(text) n_text, tag1 || ',' || tag2 tags from tweets")
def json_tweets(t):
    path = new_path(t.spark, "tweets")
    rows = t.tweets.select(
        F.col("tweet_id").cast("string").alias("id_str"), "text",
        F.struct(F.col("user_id").cast("string").alias("id_str"), F.col("followers_count").cast("string").alias("followers_count")).alias("user"),
        F.struct(F.array(F.struct(F.col("tag1").alias("text")), F.struct(F.col("tag2").alias("text"))).alias("hashtags")).alias("entities"))
    rows.write.json(path)
    flat = src.flat_tweets(src.read_tweets(t.spark, path))
    return flat.select("id_str", "user_id", "followers_count", F.length("text").cast("long").alias("n_text"), F.array_join("tags", ",").alias("tags"))


@query("s10_edge_list", "S10 S11", views=("edges",), sql="select src, count(*) n, cast(sum(dst) as bigint) total from edges group by 1")
def edge_list(t):
    path = src.write_tsv(t.edges, new_path(t.spark, "edges"))
    return src.read_edges(t.spark, path, "\t").groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.sum("dst").alias("total"))


@query("s03_parquet", "S03", views=("lineorder",), sql=_FACT)
def parquet(t):
    return _fact_sums(src.to_parquet(t.lineorder, new_path(t.spark, "lineorder")))


def by_year(t):
    fact = t.lineorder.withColumn("lo_year", F.floor(F.col("lo_orderdate") / 10000).cast("int"))
    return src.write_partitioned(fact, new_path(t.spark, "lineorder-by-year"), "lo_year", ["lo_orderdate"])


@query("s04_partitioned", "S04", views=("lineorder",), sql=_FACT)
def partitioned(t):
    return _fact_sums(by_year(t))


@query("c01_ssb_q1_stored", "C01 S04 J01", views=("lineorder", "dwdate"), sql="""
    select cast(sum(lo_extendedprice*lo_discount) as bigint) revenue from lineorder join dwdate on lo_orderdate = d_datekey
    where d_year = 1997 and lo_discount between 1 and 3 and lo_quantity < 24""")
def stored_q1(t):
    return starjoin.ssb_q1(by_year(t).where("lo_year = 1997"), t.dwdate)


@query("s05_clustered", "S05", views=("lineorder", "ssb_customer"), sql="select c_nation, count(*) n, cast(sum(lo_revenue) as bigint) revenue from lineorder join ssb_customer on lo_custkey = c_custkey group by 1")
def clustered(t):
    buckets = src.bucket_count(t.lineorder)
    fact = src.write_clustered(t.lineorder, "lineorder", ["lo_custkey"], ["lo_custkey"], buckets)
    customer = src.write_clustered(t.ssb_customer, "customer", ["c_custkey"], ["c_custkey"], buckets)
    return fact.join(customer, F.col("lo_custkey") == F.col("c_custkey")).groupBy("c_nation").agg(F.count(F.lit(1)).alias("n"), F.sum("lo_revenue").alias("revenue"))


_TABLES = ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders", "pages", "part", "region", "supplier")


@query("s18_table_counts", "S18 A03", sql=" union all ".join(f"select '{n}' as table, count(*) n from {n}" for n in _TABLES))
def table_counts(t):
    return src.count_tables({n: getattr(t, n) for n in _TABLES})


@query("s19_table_space", "S19")
def table_space(t):
    return src.table_space(t.spark, {n: f"{t.folder}/{n}.parquet" for n in _TABLES})


_PART_COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def _cents(part):
    """The price in whole cents: the engines write doubles as text in different ways."""
    return part.withColumn("p_retailprice", F.round(F.col("p_retailprice") * 100).cast("bigint"))


@query("s20_column_space", "S20", sql=" union all ".join(
    f"select '{c}' as column, cast(sum(strlen(cast({'cast(round(p_retailprice*100) as bigint)' if c == 'p_retailprice' else c} as varchar))) as bigint) bytes from part" for c in _PART_COLUMNS))
def column_space(t):
    return src.column_space(_cents(t.part), _PART_COLUMNS)


@query("a19_most_per_group", "A19", sql="select p_brand, max(p_size) most, max(p_name) last_name from part group by p_brand")
def most_per_group(t):
    return t.part.groupBy("p_brand").agg(F.max("p_size").alias("most"), F.max("p_name").alias("last_name"))


_BLOCK = 4096
_ANALYSED = {"l_orderkey": 8, "l_partkey": 8, "l_suppkey": 8, "l_linenumber": 4, "l_quantity": 8, "l_returnflag": 0, "l_linestatus": 0, "l_shipdate": 8}
_ORDER = ["l_orderkey", "l_linenumber", *[c for c in _ANALYSED if c not in ("l_orderkey", "l_linenumber")]]  # rows that tie are alike


def _encodings(column, width):
    """One column's sizes by block, then in all."""
    size = str(width) if width else f"strlen({column}) + 4"
    delta = f"max(abs({column} - lag_{column}))" if column in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber") else "null"
    bits = lambda n: f"greatest(ceil(log2({n})), 1)"
    return f"""select '{column}' as column, sum(n)::bigint n_rows, sum(nulls)::bigint n_null, sum(different)::bigint n_different, sum(runs)::bigint n_runs, sum(plain)::bigint plain_bytes,
        sum(entries + ceil(n*{bits("different::double")}/8))::bigint dictionary_bytes, sum(heads + 4*runs)::bigint run_bytes, sum(case when step is not null then {width} + ceil(n*({bits("step + 1")} + 1)/8) end)::bigint delta_bytes
      from (select block, count(*) n, count(*) filter ({column} is null) nulls, count(distinct {column}) + max(({column} is null)::int) different, count(*) filter (new_{column}) runs,
          coalesce(sum({size}) filter ({column} is not null), 0) plain, coalesce(sum({size}) filter (new_{column} and {column} is not null), 0) heads, {"0 + coalesce(" + delta + ", 0)" if delta != "null" else "null"} step
        from r group by block)
      join (select block, coalesce(sum({size}), 0) entries from (select distinct block, {column} from r where {column} is not null) group by block) using (block)"""


@query("s21_compression_advice", "S21", sql=f"""
    with o as (select *, (row_number() over (order by {", ".join(_ORDER)}) - 1) // {_BLOCK} block from lineitem),
    r as (select block, {", ".join(f"{c}, lag({c}) over w lag_{c}, row_number() over w = 1 or {c} is distinct from lag({c}) over w new_{c}" for c in _ANALYSED)}
      from o window w as (partition by block order by {", ".join(_ORDER)})),
    c as ({" union all ".join(_encodings(c, w) for c, w in _ANALYSED.items())}),
    l as (select *, least(plain_bytes, dictionary_bytes, run_bytes, coalesce(delta_bytes, plain_bytes)) low from c)
    select * exclude (low), case when plain_bytes = low then 'plain' when dictionary_bytes = low then 'dictionary' when run_bytes = low then 'run length' else 'delta' end advice from l""")
def advice(t):
    return src.analyze_compression(t.lineitem.select(*_ANALYSED), _ORDER, _BLOCK)


@query("s23_constraints", "S23 P14", sql="""
    select 'not null l_orderkey' as rule, count(*) filter (l_orderkey is null) violations from lineitem
    union all select 'not null l_shipdate', count(*) filter (l_shipdate is null) from lineitem
    union all select 'unique l_orderkey, l_linenumber', cast(sum(n - 1) as bigint) from (select count(*) n from lineitem group by l_orderkey, l_linenumber)""")
def constraints(t):
    return src.check_constraints(t.lineitem, ["l_orderkey", "l_shipdate"], ["l_orderkey", "l_linenumber"])
