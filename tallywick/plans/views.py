"""Views over the given tables in the shapes the jobs expect.

Each recipe is one SELECT that reads the same in Spark SQL and in DuckDB, so the job and
its SQL check see equal input. Names in braces are the tables or views it reads.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from tallywick.session import use_utc

VIEWS: dict[str, str] = {
    "lineorder": """
        select l_orderkey lo_orderkey, l_linenumber lo_linenumber, o_custkey lo_custkey, l_partkey lo_partkey, l_suppkey lo_suppkey,
          year(o_orderdate)*10000 + month(o_orderdate)*100 + day(o_orderdate) lo_orderdate, cast(l_quantity as int) lo_quantity,
          cast(round(l_extendedprice*100) as bigint) lo_extendedprice, cast(round(l_discount*100) as int) lo_discount,
          cast((cast(round(l_extendedprice*100) as bigint)*(100 - cast(round(l_discount*100) as int))
            - cast(round(l_extendedprice*100) as bigint)*(100 - cast(round(l_discount*100) as int)) % 100)/100 as bigint) lo_revenue
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "dwdate": """
        select distinct year(o_orderdate)*10000 + month(o_orderdate)*100 + day(o_orderdate) d_datekey, year(o_orderdate) d_year,
          year(o_orderdate)*100 + month(o_orderdate) d_yearmonthnum,
          concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(month(o_orderdate)*3 - 2 as int), 3), cast(year(o_orderdate) as string)) d_yearmonth
        from {orders}""",
    "ssb_part": """
        select p_partkey, p_name, concat('MFGR#', cast(m as string)) p_mfgr, concat('MFGR#', cast(m as string), cast(c as string)) p_category,
          concat('MFGR#', cast(m as string), cast(c as string), lpad(cast(p_size as string), 2, '0')) p_brand1, p_type, p_size
        from (select *, cast((bn - 1 - (bn - 1) % 5)/5 as int) + 1 m, (bn - 1) % 5 + 1 c
              from (select *, cast(substr(p_brand, 7) as int) bn from {part}) a) b""",
    "ssb_supplier": """
        select s_suppkey, s_name, concat(n_name, '-', cast(s_suppkey % 2 as string)) s_city, n_name s_nation, r_name s_region
        from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "ssb_customer": """
        select c_custkey, c_name, concat(n_name, '-', cast(c_custkey % 2 as string)) c_city, n_name c_nation, r_name c_region, c_mktsegment
        from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "pagecounts": """
        select case when event_id % 10 < 8 then 'en' else 'fr' end project,
          concat(case event_id % 13 when 0 then 'Talk:' when 1 then 'lower_' else '' end, upper(substr(event_type, 1, 1)), substr(event_type, 2), '_',
            cast(user_id % 20 as string), case event_id % 11 when 0 then '.jpg' when 1 then '_(2014_film)' when 2 then '_(2015_film)' else '' end) title,
          cast(ts as date) dt, hour(ts) hr, cast(ceil(value) as bigint) views
        from {events}""",
    "tweets": """
        select doc_id tweet_id, cast((doc_id - doc_id % 20)/20 as bigint) user_id, timestamp '2014-04-15 00:00:00' + doc_id*interval '17' minute created_at, text,
          doc_id*7 % 1000 followers_count, source tag1, concat('lang_', lang) tag2
        from {documents}
        union all
        select doc_id, cast((doc_id - doc_id % 20)/20 as bigint), timestamp '2014-04-15 00:00:00' + doc_id*interval '17' minute, text, doc_id*7 % 1000, source, concat('lang_', lang)
        from {documents} where doc_id % 10 = 0""",
    "songs": """
        select p_partkey track_id, p_name title, p_brand artist_id, concat(p_brand, ' ', p_type) artist_name, p_type release,
          case when p_partkey % 97 = 0 then null else p_retailprice end duration, 1950 + p_size yr
        from {part}""",
    "sales": """
        select l_partkey track_id, max(cast(l_shipdate as date)) sales_date, cast(sum(l_quantity) as bigint) sales_count
        from {lineitem} group by l_partkey""",
    "edges": """
        select distinct l_partkey*2 src, l_suppkey*2 + 1 dst from {lineitem}
        union
        select distinct l_suppkey*2 + 1, l_partkey*2 from {lineitem} where l_suppkey % 2 = 0 and l_linenumber = 1""",
    "userinfo": """
        select c_custkey id, concat('Name', cast(c_custkey % 40 as string)) name, concat(c_mktsegment, '/', cast(c_custkey as string)) profile,
          concat('pw', cast(c_custkey as string)) password
        from {customer}""",
    "follows": """
        select distinct o_custkey follower, l_suppkey followee from {lineitem} join {orders} on l_orderkey = o_orderkey where o_custkey <> l_suppkey""",
    "posts": """
        select event_id post_id, user_id, ts, event_type post from {events}""",
    "kvlog": """
        select event_id, event_id*7919 % 100003 arrival, concat(event_type, cast(user_id as string)) k,
          case when event_id % 4 = 0 then 'get' else 'put' end op, concat('v', cast(event_id as string)) v, event_id % 3 + 1 region, ts
        from {events}""",
    "probes": """
        select user_id instance, ts, event_id, event_type <> 'error' ok, value util from {events}""",
    "cab_events": """
        select event_id seq, ts, cast((user_id - user_id % 30)/30 as bigint) block_id, user_id driver_id, 1000000 + event_id rider_id,
          case event_type when 'view' then 'DRIVER_LOCATION' when 'signup' then 'ENTERING_BLOCK' when 'click' then 'RIDE_REQUEST'
            when 'error' then 'LEAVING_BLOCK' else 'RIDE_COMPLETE' end type,
          case when event_id % 2 = 0 then 'AVAILABLE' else 'BUSY' end status, cast(floor(value) as int) longitude, cast(event_id % 100 as int) latitude
        from {events}""",
    "ngram_text": """
        select text from {documents}""",
    "messages": """
        select doc_id msg_id, concat(cast(doc_id + 1 as string),
            '8271997208960872478735181815578166723519929177896558845922250595511921395049126920528021164569045773') key,
          upper(regexp_replace(text, '[^A-Za-z]', 'X'{all_matches})) message
        from {documents}""",
}


#: Where the two engines differ: regexp_replace changes only the first match in DuckDB unless told otherwise.
SPARK_FORMS = {"all_matches": ""}
CHECK_FORMS = {"all_matches": ", 'g'"}


def _reads(recipe: str) -> list[str]:
    return sorted({name for _, name, _, _ in string.Formatter().parse(recipe) if name and name not in SPARK_FORMS})


class Tables:
    """The tables of one data folder: `t.lineitem` reads a file, `t.lineorder` is a view over files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = use_utc(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in VIEWS:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        recipe = VIEWS[name]
        for form, text in SPARK_FORMS.items():
            recipe = recipe.replace(f"{{{form}}}", text)
        return self.spark.sql(recipe, **{read: getattr(self, read) for read in _reads(recipe)})


def check_sql(sql: str, *views: str) -> str:
    """`sql` for DuckDB, with the named views put in front as common table expressions."""
    sql = sql.strip()
    ctes = ", ".join(f"{v} as ({VIEWS[v].strip().format(**CHECK_FORMS, **{r: r for r in _reads(VIEWS[v])})})" for v in views)
    if not ctes:
        return sql
    for start in ("with recursive ", "with "):
        if sql.lower().startswith(start):
            return f"{start}{ctes}, {sql[len(start):]}"
    return f"with {ctes} {sql}"
