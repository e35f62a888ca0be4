"""Star-schema aggregations: one fact table, dimensions filtered before the join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def ssb_q1(lineorder: DataFrame, dwdate: DataFrame, year: int = 1997, discount: tuple[int, int] = (1, 3), below_quantity: int = 24) -> DataFrame:
    """Revenue gained by dropping discounts in one year: sum(price * discount)."""
    days = dwdate.where(F.col("d_year") == year).select("d_datekey")
    lines = lineorder.where(F.col("lo_discount").between(*discount) & (F.col("lo_quantity") < below_quantity))
    product = F.col("lo_extendedprice").cast("long") * F.col("lo_discount")
    return lines.join((days), F.col("lo_orderdate") == F.col("d_datekey")).agg(F.sum(product).alias("revenue"))


def ssb_q2(lineorder: DataFrame, dwdate: DataFrame, part: DataFrame, supplier: DataFrame,
           category: str = "MFGR#12", region: str = "AMERICA", limit: int = 500) -> DataFrame:
    """Revenue by year and brand for one part category and one supplier region."""
    days = dwdate.select("d_datekey", "d_year")
    brands = part.where(F.col("p_category") == category).select("p_partkey", "p_brand1")
    sellers = supplier.where(F.col("s_region") == region).select("s_suppkey")
    joined = (
        lineorder.join((brands), F.col("lo_partkey") == F.col("p_partkey"))
        .join((sellers), F.col("lo_suppkey") == F.col("s_suppkey"))
        .join((days), F.col("lo_orderdate") == F.col("d_datekey"))
    )
    return (
        joined.groupBy("d_year", "p_brand1")
        .agg(F.sum(F.col("lo_revenue").cast("long")).alias("revenue"))
        .orderBy("d_year", "p_brand1")
        .limit(limit)
    )


def ssb_q3(lineorder: DataFrame, customer: DataFrame, supplier: DataFrame, dwdate: DataFrame,
           cities: Sequence[str] = ("UNITED KI1", "UNITED KI5"), yearmonth: str | None = "Dec1997", limit: int = 5) -> DataFrame:
    """Revenue by customer city, supplier city and year, for trade between the given cities."""
    joined = (
        lineorder.join((_days(dwdate, yearmonth)), F.col("lo_orderdate") == F.col("d_datekey"))
        .join((supplier.where(F.col("s_city").isin(*cities)).select("s_suppkey", "s_city")),
              F.col("lo_suppkey") == F.col("s_suppkey"))
        .join((customer.where(F.col("c_city").isin(*cities)).select("c_custkey", "c_city")),
              F.col("lo_custkey") == F.col("c_custkey"))
    )
    return _city_revenue(joined, limit)


def _days(dwdate: DataFrame, yearmonth: str | None) -> DataFrame:
    days = dwdate if yearmonth is None else dwdate.where(F.col("d_yearmonth") == yearmonth)
    return days.select("d_datekey", "d_year")


def _city_revenue(joined: DataFrame, limit: int) -> DataFrame:
    # The two cities end the sort so that equal revenues keep one order.
    return (
        joined.groupBy("c_city", "s_city", "d_year")
        .agg(F.sum(F.col("lo_revenue").cast("long")).alias("revenue"))
        .orderBy(F.asc("d_year"), F.desc("revenue"), "c_city", "s_city")
        .limit(limit)
    )


def ssb_q1_plain(lineorder: DataFrame, dwdate: DataFrame, year: int = 1997, discount: tuple[int, int] = (1, 3), below_quantity: int = 24) -> DataFrame:
    """The join written first and every predicate after it; Catalyst pushes them down."""
    joined = lineorder.join(dwdate, F.col("lo_orderdate") == F.col("d_datekey"))
    kept = joined.where((F.col("d_year") == year) & F.col("lo_discount").between(*discount) & (F.col("lo_quantity") < below_quantity))
    return kept.agg(F.sum(F.col("lo_extendedprice").cast("long") * F.col("lo_discount")).alias("revenue"))


def ssb_q2_plain(lineorder: DataFrame, dwdate: DataFrame, part: DataFrame, supplier: DataFrame,
                 category: str = "MFGR#12", region: str = "AMERICA", limit: int = 500) -> DataFrame:
    joined = (
        lineorder.join(dwdate, F.col("lo_orderdate") == F.col("d_datekey"))
        .join(part, F.col("lo_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("lo_suppkey") == F.col("s_suppkey"))
    )
    return (
        joined.where((F.col("p_category") == category) & (F.col("s_region") == region))
        .groupBy("d_year", "p_brand1")
        .agg(F.sum(F.col("lo_revenue").cast("long")).alias("revenue"))
        .orderBy("d_year", "p_brand1")
        .limit(limit)
    )


def ssb_q3_plain(lineorder: DataFrame, customer: DataFrame, supplier: DataFrame, dwdate: DataFrame,
                 cities: Sequence[str] = ("UNITED KI1", "UNITED KI5"), yearmonth: str | None = "Dec1997", limit: int = 5) -> DataFrame:
    joined = (
        customer.join(lineorder, F.col("lo_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("lo_suppkey") == F.col("s_suppkey"))
        .join(dwdate, F.col("lo_orderdate") == F.col("d_datekey"))
    )
    kept = joined.where(F.col("c_city").isin(*cities) & F.col("s_city").isin(*cities))
    if yearmonth is not None:
        kept = kept.where(F.col("d_yearmonth") == yearmonth)
    return _city_revenue(kept, limit)


HOLIDAYS = ("01-01", "07-04", "12-25")


def date_attributes(dates: DataFrame, date: str = "d_date", holidays: Sequence[str] = HOLIDAYS) -> DataFrame:
    """Calendar columns of a date dimension, one row per distinct date.

    Week days count from Sunday = 1; the week starts new on each first of January + 7n;
    holidays are given as month and day.
    """
    d = F.col(date)
    return dates.select(d).distinct().select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("d_datekey"),
        d.alias("d_date"),
        F.date_format(d, "EEEE").alias("d_dayofweek"),
        F.date_format(d, "MMMM").alias("d_month"),
        F.year(d).alias("d_year"),
        (F.year(d) * 100 + F.month(d)).alias("d_yearmonthnum"),
        F.date_format(d, "MMMyyyy").alias("d_yearmonth"),
        F.dayofweek(d).alias("d_daynuminweek"),
        F.dayofmonth(d).alias("d_daynuminmonth"),
        F.dayofyear(d).alias("d_daynuminyear"),
        F.month(d).alias("d_monthnuminyear"),
        (F.floor((F.dayofyear(d) - 1) / 7) + 1).cast("int").alias("d_weeknuminyear"),
        F.when(F.month(d) == 12, "Christmas").when(F.month(d) >= 9, "Fall").when(F.month(d) >= 6, "Summer")
        .when(F.month(d) >= 3, "Spring").otherwise("Winter").alias("d_sellingseason"),
        F.when(F.dayofweek(d) == 7, "1").otherwise("0").alias("d_lastdayinweekfl"),
        F.when(d == F.last_day(d), "1").otherwise("0").alias("d_lastdayinmonthfl"),
        F.when(F.date_format(d, "MM-dd").isin(*holidays), "1").otherwise("0").alias("d_holidayfl"),
        F.when(F.dayofweek(d).isin(1, 7), "0").otherwise("1").alias("d_weekdayfl"),
    )
