"""The sliced helpers against plain windows: null keys, NaN, text, nulls, ties, few and many slices."""

import math

import pytest
from pyspark.sql import Window, functions as F

from tallywick.operators import slices

ROWS = [(i, [None, "a", "b"][i % 3] if i % 5 else "a", [None, float("nan"), 1.5, -2.0, 7.0][i % 5], f"t{i % 7}" if i % 4 else None, None, i % 4 != 0 if i % 9 else None)
        for i in range(150)]
SCHEMA = "id long, k string, x double, s string, empty long, flag boolean"


@pytest.fixture(params=[1, 2, 13])
def frame(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.createDataFrame(ROWS, SCHEMA)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def same(got, want):
    plain = lambda rows: sorted((tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows), key=repr)
    assert plain(got.collect()) == plain(want.collect())


ORDERS = [["x", "id"], ["s", "id"], ["empty", "id"], ["id"]]


def window(order, keys=("k",)):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


@pytest.mark.parametrize("order", ORDERS)
def test_running_sums(frame, order):
    got = slices.running_sums(frame, ["k"], order, {"total": F.col("id"), "none": F.col("empty")})
    same(got, frame.select("*", F.sum("id").over(window(order)).alias("total"), F.sum("empty").over(window(order)).alias("none")))


def test_without_keys(frame):
    same(slices.numbered(frame, [], ["id"]), frame.select("*", F.row_number().over(Window.orderBy("id")).cast("long").alias("seq")))


@pytest.mark.parametrize("order", ORDERS)
def test_carried_forward(frame, order):
    value = F.when(F.col("id") % 6 == 0, F.col("id"))
    got = slices.carried_forward(frame, ["k"], order, {"last": value})
    same(got, frame.select("*", F.last(value, ignorenulls=True).over(window(order)).alias("last")))


@pytest.mark.parametrize("order", ORDERS)
def test_run_lengths(frame, order):
    got = {r["id"]: r["run"] for r in slices.run_lengths(frame, ["k"], order, {"run": F.col("flag")}).collect()}
    ranked = frame.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*order))).orderBy("k", "n").collect()
    want, key, run = {}, object(), 0
    for r in ranked:
        run = 0 if r["k"] != key else run
        key = r["k"]
        run = run + 1 if r["flag"] else 0
        want[r["id"]] = run
    assert got == want


def test_paged(frame):
    got = slices.paged(frame.where("k is not null"), ["k"], ["id"], F.col("id"), 7).orderBy("k", "page").collect()
    for k in ("a", "b"):
        pages = [r["items"] for r in got if r["k"] == k]
        assert all(len(p) == 7 for p in pages[:-1]) and sum(pages, []) == [r[0] for r in ROWS if r[1] == k]


def test_empty(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert slices.run_lengths(frame, ["k"], ["id"], {"run": F.col("flag")}).count() == 0
    assert slices.running_sums(frame, ["k"], ["id"], {"n": F.lit(1)}).count() == 0
