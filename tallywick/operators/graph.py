"""Graphs as edge tables (src, dst): degrees, ends, PageRank with dangling mass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywick.operators.slices import paged
from tallywick.session import cut
from tallywick.sources.tables import bucket_count, write_clustered

HUB_DEGREE = 100_000  # edges of a source that stay together


def nodes(edges: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Every end of an edge and every given user (id)."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return (ends if users is None else ends.unionByName(users.select("id"))).where("id is not null").distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """(id, out_degree, in_degree), zeros included."""
    pairs = edges.select(F.inline(F.array(F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
                                          F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))))
    return pairs.groupBy("id").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))


def without_followers(edges: DataFrame) -> DataFrame:
    return nodes(edges).join(edges.select(F.col("dst").alias("id")), "id", "left_anti")


def dangling(edges: DataFrame) -> DataFrame:
    return nodes(edges).join(edges.select(F.col("src").alias("id")), "id", "left_anti")


def adjacency(edges: DataFrame, page_size: int = 1000) -> DataFrame:
    """(src, page, items): neighbours in order, in lists of at most `page_size`."""
    return paged(edges, ["src"], ["dst"], F.col("dst"), page_size)


def with_parts(edges: DataFrame, out: DataFrame, hub_degree: int) -> DataFrame:
    """(src, dst, part): the edges of a source of more than `hub_degree` edges are dealt into numbered parts of about that many."""
    hubs = out.where(F.col("out_degree") > hub_degree).select("src", F.ceil(F.col("out_degree") / hub_degree).alias("n_parts"))
    part = F.when(F.col("n_parts").isNotNull(), F.pmod(F.xxhash64("dst"), F.col("n_parts"))).otherwise(0).cast("int")
    return edges.select("src", "dst").join(hubs, "src", "left").select("src", "dst", part.alias("part"))


def pagerank(edges: DataFrame, users: DataFrame | None = None, iters: int = 10, d: float = 0.85, hub_degree: int = HUB_DEGREE, buckets: int | None = None) -> DataFrame:
    """(id, rank): every node starts at 1; ranks average 1 while no mass is lost.

    The edges are written once, bucketed by source and part: a hub's edges are spread over
    buckets, and no round moves them. A round copies each source's share to its parts, joins it with the
    edges, adds up by target (first within each task) and adds the dangling mass, a scalar subquery, over
    the number of nodes. The round's ranks are written to the shared folder, so the plan never grows.
    """
    everyone = nodes(edges, users)
    out = cut(edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree")), "degrees")
    links = write_clustered(with_parts(edges, out, hub_degree), "links", ["src", "part"], ["src", "part"], buckets or bucket_count(edges))
    first = everyone.join(out.withColumnRenamed("src", "id"), "id", "left")
    ranks = cut(first.select("id", "out_degree", F.lit(1.0).alias("rank")), "ranks")
    for _ in range(iters):
        parts = F.sequence(F.lit(0), (F.greatest(F.ceil(F.col("out_degree") / hub_degree), F.lit(1)) - 1).cast("int"))
        shares = ranks.where("out_degree is not null").select(F.col("id").alias("src"), (F.col("rank") / F.col("out_degree")).alias("share"), F.explode(parts).alias("part"))
        received = links.join(shares, ["src", "part"]).groupBy(F.col("dst").alias("id")).agg(F.sum("share").alias("received"))
        mass = ranks.agg(F.coalesce(F.sum(F.when(F.col("out_degree").isNull(), F.col("rank"))), F.lit(0.0)) / F.count(F.lit(1))).scalar()
        moved = ranks.join(received, "id", "left")
        ranks = cut(moved.select("id", "out_degree", ((1 - d) + d * (F.coalesce("received", F.lit(0.0)) + mass)).alias("rank")), "ranks")
    return ranks.select("id", "rank")
