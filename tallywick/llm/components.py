"""Connected components of a table of links, by rounds of Spark joins.

Each round first hangs every larger neighbour of a node on the node's least neighbour, then
every smaller one (large star, small star); a round at least about halves the depth of what
is left. Nodes are grouped only by aggregates with partial sums, so one node may own a large
share of the links. Each round's links are written to the shared work folder: no lineage
grows with the rounds, and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywick.session import cut


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("low"))


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) of one ordered type: (node, root) for each linked node, root the least it reaches.

    Links with a null end are left out, self links say nothing; no links give no rows.
    """
    links = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _least(both).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = cut(large, "large-star")
        low = _least(large)
        hung = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = cut(hung.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "small-star")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
