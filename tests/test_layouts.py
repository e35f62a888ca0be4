"""Clustered tables, hubs of a graph, encodings by block."""

import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tallywick.operators import graph
from tallywick.sources import tables as src


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def files_of(table):
    """(bucket, rows) of each file."""
    rows = table.select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    return sorted((int(re.search(r"_(\d+)\.c\d+", os.path.basename(r["f"]))[1]), r["count"]) for r in rows)


def test_buckets_follow_the_rows(spark):
    frame = spark.range(40_000).select((F.col("id") % 5000).alias("k"), "id")
    for bucket_rows, want in ((10_000, 4), (2_000, 32), (40_000, 4)):
        assert src.bucket_count(frame, bucket_rows) == want
        stored = src.write_clustered(frame, "sized", ["k"], ["k"], want, bucket_rows)
        assert stored.count() == 40_000
        assert len({b for b, _ in files_of(stored)}) == len(files_of(stored)) == want  # no key is heavy: a file a bucket


def test_heavy_key_lies_in_several_files(spark):
    frame = spark.range(30_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") + 8).alias("k"), "id", F.lit(None).cast("string").alias("v"))
    frame = frame.unionByName(spark.range(3000).select(F.lit(None).cast("long").alias("k"), "id", F.lit("x").alias("v")))
    stored = src.write_clustered(frame, "heavy", ["k"], ["k"], 16, 2000)
    assert sorted(map(tuple, stored.groupBy("k").count().where("count > 1").collect()), key=repr) == [(7, 15_000), (None, 3000)]
    held = [r["count"] for r in stored.where("k = 7").groupBy(F.input_file_name()).count().collect()]
    assert len(held) > 4 and max(held) < 6000
    assert len({b for b, _ in files_of(stored.where("k = 7"))}) == 1


def test_clustered_join_has_no_exchange(spark, no_broadcast):
    rng = random.Random(1)
    fact = spark.createDataFrame([(rng.randrange(900), i) for i in range(5000)] + [(5, i) for i in range(5000)], "k long, v long")
    buckets = src.bucket_count(fact, 1000)
    stored = src.write_clustered(fact, "fact", ["k"], ["k"], buckets, 1000)
    other = src.write_clustered(spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")), "dim", ["k"], ["k"], buckets)
    joined = stored.join(other, "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.agg(F.sum("w")).first()[0] == fact.agg(F.sum(F.col("k") * 2)).first()[0]


def test_ranks_of_a_graph_with_a_hub(spark, no_broadcast):
    """A node that has half of all edges: its edges lie in many parts, no bucket with over twice the median; the ranks are those of the loop."""
    rng = random.Random(2)
    pairs = {(0, i) for i in range(1, 2001)} | {(rng.randrange(1, 1500), rng.randrange(0, 2001)) for _ in range(2000)}
    edges = spark.createDataFrame(sorted(pairs), "src long, dst long")
    ranks, out = dict.fromkeys(range(2001), 1.0), {}
    for a, _ in pairs:
        out[a] = out.get(a, 0) + 1
    for _ in range(3):
        mass = sum(r for i, r in ranks.items() if i not in out) / len(ranks)
        got = dict.fromkeys(ranks, 0.0)
        for a, b in pairs:
            got[b] += ranks[a] / out[a]
        ranks = {i: 0.15 + 0.85 * (got[i] + mass) for i in ranks}
    found = {r["id"]: r["rank"] for r in graph.pagerank(edges, iters=3, hub_degree=50, buckets=8).collect()}
    assert found == pytest.approx(ranks)
    degree = edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))
    parts = graph.with_parts(edges, degree, 50)
    assert parts.where("src = 0").select("part").distinct().count() == 40 and parts.where("src > 0 and part > 0").isEmpty()
    links = src.write_clustered(parts, "links", ["src", "part"], ["src", "part"], 8)
    sizes = sorted(n for _, n in files_of(links))
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


def test_rounds_do_not_move_the_edges(spark, no_broadcast):
    edges = spark.range(4000).select((F.col("id") % 700).alias("src"), (F.col("id") * 7 % 900).alias("dst"))
    degree = edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))
    links = src.write_clustered(graph.with_parts(edges, degree, 100), "links", ["src", "part"], ["src", "part"], src.bucket_count(edges))
    shares = spark.range(700).select(F.col("id").alias("src"), (F.col("id") % 1).cast("int").alias("part"), F.lit(1.0).alias("share"))
    plan = links.join(shares, ["src", "part"]).groupBy("dst").agg(F.sum("share"))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "Bucketed: true" in line)
    depth = plan[:plan.index(scan)].splitlines()
    join = next(i for i, line in enumerate(depth) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in depth[join:])


def plain_sizes(values, width, whole):
    size = lambda v: 0 if v is None else width or len(v.encode()) + 4
    bits = lambda n: max(1, math.ceil(math.log2(n)))
    heads = [v for i, v in enumerate(values) if not i or values[i - 1] != v]
    steps = [abs(b - a) for a, b in zip(values, values[1:]) if a is not None and b is not None] if whole else []
    return {"n_rows": len(values), "n_null": values.count(None), "n_different": len(set(values)), "n_runs": len(heads), "plain_bytes": sum(map(size, values)),
            "dictionary_bytes": sum(map(size, set(values))) + math.ceil(len(values) * bits(len(set(values))) / 8), "run_bytes": sum(map(size, heads)) + 4 * len(heads),
            "delta_bytes": width + math.ceil(len(values) * (bits(max(steps, default=0) + 1) + 1) / 8) if whole else None}


def test_encodings_by_block(spark):
    rng = random.Random(5)
    rows = [(i, i * 3 + rng.randrange(2), rng.choice(["red", "blue", None]), "long run" if i < 700 else None, rng.random(), f"text {rng.random()}") for i in range(1000)]
    names, kinds = ["id", "near", "few", "run", "wild", "unlike"], ["bigint", "int", "string", "string", "double", "string"]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds))).withColumn("list", F.array("id"))
    found = {r["column"]: r for r in src.analyze_compression(frame.repartition(3), ["id"], 300).collect()}
    assert set(found) == set(names)
    for k, name in enumerate(names):
        width, whole = src.WIDTHS.get(kinds[k], 0), kinds[k] not in ("string", "double")
        blocks = [plain_sizes([r[k] for r in rows[i:i + 300]], width, whole) for i in range(0, 1000, 300)]
        for measure in blocks[0]:
            want = sum(b[measure] for b in blocks) if blocks[0][measure] is not None else None
            assert found[name][measure] == want, (name, measure)
    ends = spark.createDataFrame([(1, -(1 << 63)), (2, (1 << 63) - 1), (3, None), (4, 0), (5, -(1 << 63))], "id long, v long")
    assert {r["column"]: r["advice"] for r in src.analyze_compression(ends, ["id"]).collect()}["v"] != "delta"
    assert {n: found[n]["advice"] for n in names} == {"id": "delta", "near": "delta", "few": "dictionary", "run": "run length", "wild": "plain", "unlike": "plain"}
