"""Graph: degrees, ends without edges, adjacency, PageRank."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywick.operators import graph as ops
from tallywick.plans.registry import query

ITERS = 10
_NODES = "with n as (select src id from edges union select dst from edges)\n"


def _pagerank_sql(rounds: int) -> str:
    steps = ["with e as materialized (select src, dst, count(*) over (partition by src) deg from edges)",
             "n as materialized (select src id from edges union select dst from edges)",
             "r0 as materialized (select id, id not in (select src from e) dangles, 1.0::double rank from n)"]
    for k in range(rounds):
        steps.append(f"r{k + 1} as materialized (select r.id, dangles, 0.15 + 0.85*(coalesce(c, 0) + (select coalesce(sum(rank) filter (dangles), 0)/count(*) from r{k})) rank from r{k} r "
                     f"left join (select dst id, sum(rank/deg) c from e join r{k} on src = id group by 1) using (id))")
    return ",\n".join(steps) + f"\nselect id, round(rank, 6) rank from r{rounds}"


@query("g01_pagerank", "G01 J05 J06 U01", views=("edges",), sql=_pagerank_sql(ITERS))
def pagerank(t):
    return ops.pagerank(t.edges, iters=ITERS).select("id", F.round("rank", 6).alias("rank"))


@query("a11_degrees", "A11 F06", views=("edges",), sql=_NODES + """
    select id, (select count(*) from edges where src = id) out_degree, (select count(*) from edges where dst = id) in_degree from n""")
def degrees(t):
    return ops.degrees(t.edges)


@query("j17_without_followers", "J17", views=("edges",), sql=_NODES + "select id from n where id not in (select dst from edges)")
def without_followers(t):
    return ops.without_followers(t.edges)


@query("j17_dangling", "J17", views=("edges",), sql=_NODES + "select id from n where id not in (select src from edges)")
def dangling(t):
    return ops.dangling(t.edges)


@query("a12_adjacency", "A12 S10", views=("edges",), sql="""
    select src, cast(floor((n - 1)/16) as bigint) page, string_agg(dst::varchar, '-' order by dst) items
    from (select *, row_number() over (partition by src order by dst) n from edges) group by 1, 2""")
def adjacency(t):
    return ops.adjacency(t.edges, 16).select("src", "page", F.array_join(F.col("items").cast("array<string>"), "-").alias("items"))
