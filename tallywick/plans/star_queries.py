"""Star-schema queries: the three aggregations, each written plain and filtered-first."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywick.operators import starjoin
from tallywick.plans.registry import query

CITIES = ("NATION_3-1", "NATION_7-1")

# The public star-schema questions in their own SQL.
Q1_SQL = """
select cast(sum(lo_extendedprice*lo_discount) as bigint) revenue
from lineorder join dwdate on lo_orderdate = d_datekey
where d_year = 1997 and lo_discount between 1 and 3 and lo_quantity < 24"""

Q2_SQL = """
select cast(d_year as int) d_year, p_brand1, cast(sum(lo_revenue) as bigint) revenue
from lineorder join dwdate on lo_orderdate = d_datekey join ssb_part on lo_partkey = p_partkey join ssb_supplier on lo_suppkey = s_suppkey
where p_category = 'MFGR#12' and s_region = 'AMERICA'
group by d_year, p_brand1 order by 1, 2 limit 500"""

Q3_SQL = """
select c_city, s_city, cast(d_year as int) d_year, cast(sum(lo_revenue) as bigint) revenue
from lineorder join ssb_customer on lo_custkey = c_custkey join ssb_supplier on lo_suppkey = s_suppkey join dwdate on lo_orderdate = d_datekey
where c_city in ('NATION_3-1', 'NATION_7-1') and s_city in ('NATION_3-1', 'NATION_7-1') and d_yearmonth = 'Dec1997'
group by c_city, s_city, d_year order by 3, revenue desc, 1, 2 limit 5"""


@query("j01_ssb_q1", "J01 A01 P01 P03 C01", views=("lineorder", "dwdate"), sql=Q1_SQL)
def q1(t):
    return starjoin.ssb_q1(t.lineorder, t.dwdate)


@query("j01_ssb_q1_plain", "J01 A01 C01", views=("lineorder", "dwdate"), sql=Q1_SQL)
def q1_plain(t):
    return starjoin.ssb_q1_plain(t.lineorder, t.dwdate)


@query("j02_ssb_q2", "J02 A02 O01 P02 P04 C01", views=("lineorder", "dwdate", "ssb_part", "ssb_supplier"), sql=Q2_SQL)
def q2(t):
    return starjoin.ssb_q2(t.lineorder, t.dwdate, t.ssb_part, t.ssb_supplier)


@query("j02_ssb_q2_plain", "J02 A02 O01 C01", views=("lineorder", "dwdate", "ssb_part", "ssb_supplier"), sql=Q2_SQL)
def q2_plain(t):
    return starjoin.ssb_q2_plain(t.lineorder, t.dwdate, t.ssb_part, t.ssb_supplier)


@query("j03_ssb_q3", "J03 A02 O02 P02 P04 C01", views=("lineorder", "dwdate", "ssb_customer", "ssb_supplier"), sql=Q3_SQL)
def q3(t):
    return starjoin.ssb_q3(t.lineorder, t.ssb_customer, t.ssb_supplier, t.dwdate, CITIES)


@query("j03_ssb_q3_plain", "J03 A02 O02 C01", views=("lineorder", "dwdate", "ssb_customer", "ssb_supplier"), sql=Q3_SQL)
def q3_plain(t):
    return starjoin.ssb_q3_plain(t.lineorder, t.ssb_customer, t.ssb_supplier, t.dwdate, CITIES)


@query("x17_date_attributes", "X17", sql="""
    select distinct cast(strftime(o_orderdate, '%Y%m%d') as int) d_datekey, dayname(o_orderdate) d_dayofweek, monthname(o_orderdate) d_month,
      cast(year(o_orderdate) as int) d_year, cast(year(o_orderdate)*100 + month(o_orderdate) as int) d_yearmonthnum, strftime(o_orderdate, '%b%Y') d_yearmonth,
      cast(dayofweek(o_orderdate) + 1 as int) d_daynuminweek, cast(day(o_orderdate) as int) d_daynuminmonth, cast(dayofyear(o_orderdate) as int) d_daynuminyear,
      cast(month(o_orderdate) as int) d_monthnuminyear, cast((dayofyear(o_orderdate) - 1)//7 + 1 as int) d_weeknuminyear,
      case when month(o_orderdate) = 12 then 'Christmas' when month(o_orderdate) >= 9 then 'Fall' when month(o_orderdate) >= 6 then 'Summer'
        when month(o_orderdate) >= 3 then 'Spring' else 'Winter' end d_sellingseason,
      case when dayofweek(o_orderdate) = 6 then '1' else '0' end d_lastdayinweekfl,
      case when day(o_orderdate + interval 1 day) = 1 then '1' else '0' end d_lastdayinmonthfl,
      cast(o_orderdate as date) d_date, case when strftime(o_orderdate, '%m-%d') in ('01-01', '07-04', '12-25') then '1' else '0' end d_holidayfl,
      case when dayofweek(o_orderdate) in (0, 6) then '0' else '1' end d_weekdayfl
    from orders""")
def date_attributes(t):
    dates = t.orders.select(F.col("o_orderdate").cast("date").alias("d_date"))
    return starjoin.date_attributes(dates)
