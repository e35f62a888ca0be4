"""A log of puts and gets by key: order numbers, version histories, as-of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywick.operators.slices import carried_forward, numbered, paged, running_sums


def write_numbers(log: DataFrame) -> DataFrame:
    """(event_id, k, seq): each put's place among the puts of its key by time."""
    return numbered(log.where("op = 'put'").select("event_id", "k", "ts"), ["k"], ["ts", "event_id"]).select("event_id", "k", "seq")


def history(log: DataFrame, order: str = "timestamp", page_size: int = 100) -> DataFrame:
    """(k, page, versions): a key's values, blank-separated, by time or by arrival, in pages of at most `page_size`."""
    by = {"timestamp": "ts", "arrival": "arrival"}[order]
    pages = paged(log.where("op = 'put'"), ["k"], [by, "event_id"], F.col("v"), page_size)
    return pages.select("k", "page", F.array_join("items", " ").alias("versions"))


def asof_values(log: DataFrame) -> DataFrame:
    """(event_id, k, n_versions, latest) for each get: the puts of its key at its time or before.

    The values themselves are the first n_versions of the key's paged history; writing them
    out for each get would be every put times every later get.
    """
    # At equal times a put comes before a get, as its time is not after the get's.
    rows = log.select("event_id", "k", "op", "ts", "v", F.when(F.col("op") == "put", 0).otherwise(1).alias("_after"))
    order = ["ts", "_after", "event_id"]
    put = F.col("op") == "put"
    counted = running_sums(rows, ["k"], order, {"n_versions": F.when(put, 1).otherwise(0).cast("long")})
    latest = carried_forward(counted, ["k"], order, {"latest": F.when(put, F.col("v"))})
    return latest.where("op = 'get'").select("event_id", "k", "n_versions", "latest")
