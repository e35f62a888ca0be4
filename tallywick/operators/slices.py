"""Ordered scans per key that hold when one key owns a large share of the rows.

A window over (key) puts all rows of a key in one task. Here the rows are range-partitioned by
(keys, order): a heavy key then spans several partitions, its slices, in order. A window
runs inside (slice, key), one summary row per (slice, key) is scanned along the slices, and what
is carried into a slice is joined back. A task holds one slice, never a whole key; slices are
as many as the session has shuffle partitions.

There is one path for every size. Rows are ordered as orderBy orders them: nulls first, NaN
last, any type that sorts. Null keys are a key like any other. Rows that tie on the whole order
may be cut apart anywhere, so end `order` with a unique column where that matters.

The sliced rows are written to the shared work folder once: the bounds of a range partitioning
are sampled, and both readers must see the same slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywick.session import cut

SLICE = "_slice"


def with_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with their slice number, which rises with (keys, order)."""
    dealt = df.repartitionByRange(*[F.col(c) for c in [*keys, *order]])
    return cut(dealt.withColumn(SLICE, F.spark_partition_id()), "slices")


def _running(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def _joined(rows: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`carried` (one row per slice and key) beside the rows; null keys meet."""
    renamed = carried.withColumnsRenamed({c: f"_of_{c}" for c in [*keys, SLICE]})
    on = F.col(SLICE) == F.col(f"_of_{SLICE}")
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    return rows.join(renamed, on, "left")


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Add, for each name in `sums`, the sum of its column over the key's rows up to this one."""
    rows = with_slices(df, keys, order)
    group = [*keys, SLICE]
    w = _running(group, order)
    local = rows.select("*", *[F.sum(c).over(w).alias(n) for n, c in sums.items()])
    totals = rows.groupBy(*group).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    before = totals.select(*group, *[F.sum(n).over(_earlier(keys)).alias(f"_before_{n}") for n in sums])
    joined = _joined(local, before, keys)
    zero = F.lit(0)
    return joined.select(*df.columns, *[
        F.when(F.col(n).isNotNull() | F.col(f"_before_{n}").isNotNull(), F.coalesce(n, zero) + F.coalesce(f"_before_{n}", zero)).alias(n) for n in sums])


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "seq") -> DataFrame:
    """Add the position of each row in its key, from 1. `order` must end in a unique column."""
    return running_sums(df, keys, order, {name: F.lit(1).cast("long")})


def carried_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Add, for each name in `values`, its latest non-null value in the key up to this row."""
    rows = with_slices(df, keys, order)
    group = [*keys, SLICE]
    w = _running(group, order)
    local = rows.select("*", *[F.last(c, ignorenulls=True).over(w).alias(n) for n, c in values.items()])
    place = F.struct(*order)
    tails = rows.groupBy(*group).agg(*[F.max_by(c, F.when(c.isNotNull(), place)).alias(n) for n, c in values.items()])
    before = tails.select(*group, *[F.last(n, ignorenulls=True).over(_earlier(keys)).alias(f"_before_{n}") for n in values])
    return _joined(local, before, keys).select(*df.columns, *[F.coalesce(F.col(n), F.col(f"_before_{n}")).alias(n) for n in values])


def run_lengths(df: DataFrame, keys: Sequence[str], order: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """Add, for each name in `flags`, how many rows in a row up to this one have the flag true.

    Zero where the flag is false. A null flag counts as false.
    """
    rows = with_slices(df, keys, order)
    group = [*keys, SLICE]
    w = _running(group, order)
    flags = {n: F.coalesce(c, F.lit(False)) for n, c in flags.items()}
    # The run is the row number less the number of the last row that broke it.
    numbers = rows.select("*", F.row_number().over(w).cast("long").alias("_n"))
    broken = numbers.select("*", *[F.max(F.when(~c, F.col("_n"))).over(w).alias(f"_broken_{n}") for n, c in flags.items()])
    tails = broken.groupBy(*group).agg(
        *[F.max(f"_broken_{n}").alias(f"_last_{n}") for n in flags], F.max("_n").alias("_rows")
    )
    # A slice without a break adds its whole length to the run that enters it.
    along = Window.partitionBy(*keys).orderBy(SLICE)
    carried = tails.select(
        *group,
        *[(F.col("_rows") - F.coalesce(F.col(f"_last_{n}"), F.lit(0))).alias(f"_tail_{n}") for n in flags],
        *[F.count(f"_last_{n}").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(f"_breaks_{n}") for n in flags],
    )
    carried = carried.select(
        *group,
        *[F.sum(f"_tail_{n}").over(_running([*keys, f"_breaks_{n}"], [SLICE])).alias(f"_out_{n}") for n in flags],
    )
    carried = carried.select(*group, *[F.lag(f"_out_{n}", 1, 0).over(along).alias(f"_in_{n}") for n in flags])
    return _joined(broken, carried, keys).select(
        *df.columns,
        *[
            F.when(F.col(f"_broken_{n}").isNull(), F.col("_n") + F.coalesce(F.col(f"_in_{n}"), F.lit(0)))
            .otherwise(F.col("_n") - F.col(f"_broken_{n}")).alias(n)
            for n in flags
        ],
    )


def paged(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: Column, page_size: int) -> DataFrame:
    """The key's items as ordered lists of at most `page_size`: columns keys, page (from 0), items.

    The pages of a key, one after the other, are its whole list; no list grows with the key. Items
    that keys and order tell are made once the rows are numbered, and are not moved with them before.
    """
    carried = [*keys, *[o for o in order if o not in keys]]
    late = set(df.columns) <= set(carried)
    seq = numbered(df.select(*carried, *([] if late else [item.alias("_item")])), keys, order, "_seq")
    page = F.floor((F.col("_seq") - 1) / page_size).cast("long")
    made = item if late else F.col("_item")
    lists = seq.groupBy(*keys, page.alias("page")).agg(F.array_sort(F.collect_list(F.struct("_seq", made.alias("_item")))).alias("_list"))
    return lists.select(*keys, "page", F.transform("_list", lambda x: x["_item"]).alias("items"))
