"""URL filter: a blocked Bloom filter of the listed canonical URLs, then an exact hash join.

A listed URL is a host and a path, in canonical form host + path; it stands for the host and
all its subdomains, where the path starts with the listed one. A page's URL can therefore be
listed under a suffix of its host labels and a prefix of its path; tried are those with as many
labels and characters as some listed entry has. Each such pair is looked up in the filter: its hash picks one block of four
64-bit words and two bits in each, so a look-up reads one row. What passes goes to an exact
join on (host, path), which removes the filter's false positives. The longest entry decides.

The filter has a block per KEYS_PER_BLOCK listed URLs. It is broadcast while it has at most
MAX_BLOCKS blocks (under 64 MB), else joined by block number; both give the same result. Up to
MAX_SHAPES different pairs of label and path lengths are broadcast; with more, all path prefixes as
long as a listed path are tried, which only adds look-ups. The list itself is left to Spark's
join choice, which goes by its size.

Defined results: a null URL, or one without `://`, has an empty host and path and no rule; of
equally long entries allow wins, then the lesser text; a null host, path or verdict in the list is skipped;
repeated pages are judged row by row; very long hosts and paths are tried at the listed lengths
only, so they cost their length for each; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallywick.llm.common import lower_ascii

#: Host, path, verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DEFAULT = "allow"
KEYS_PER_BLOCK = 16
MAX_BLOCKS = 1 << 20
MAX_SHAPES = 1_000_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return lower_ascii(part(1)), part(2)


def n_labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def block(host: Column, path: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(host, path), F.lit(n_blocks)).alias("block")


def marks(host: Column, path: Column) -> list[Column]:
    """Two bits in each of the four words of a block."""
    key = F.xxhash64(path, F.lit("/"), host)
    bit = lambda shift: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(key, shift).bitwiseAND(F.lit(63)).cast("int"))
    return [bit(12 * k).bitwiseOR(bit(12 * k + 6)) for k in range(4)]


def bloom(listed: DataFrame, n_blocks: int) -> DataFrame:
    """(block, word_0 .. word_3): the filter's blocks that have any bit."""
    host, path = F.col("host"), F.col("path")
    made = listed.select(block(host, path, n_blocks), *[m.alias(f"word_{k}") for k, m in enumerate(marks(host, path))])
    return made.groupBy("block").agg(*[F.bit_or(f"word_{k}").alias(f"word_{k}") for k in range(4)])


def judge(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT, max_shapes: int = MAX_SHAPES, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per page; `listed` has host, path, verdict."""
    listed = listed.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict").where("host is not null and path is not null and verdict is not null")
    n_blocks = max(1, math.ceil(listed.count() / KEYS_PER_BLOCK))
    shape = listed.select(n_labels(F.col("host")).alias("labels"), F.length("path").alias("size")).distinct()
    few = shape.limit(max_shapes + 1).count() <= max_shapes
    most, longest = (shape.agg(F.coalesce(F.max(c), F.lit(1))).scalar() for c in ("labels", "size"))
    host, path = host_and_path(F.col(f"`{url_col}`"))
    urls = pages.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    tried = urls.withColumn("n", F.explode(F.sequence(F.lit(1), F.least(n_labels(F.col("host")), most))))
    if few:
        tried = tried.join(F.broadcast(shape), (F.col("n") == F.col("labels")) & (F.col("size") <= F.length("path")), "left")
    else:
        tried = tried.withColumn("size", F.explode(F.sequence(F.lit(0), F.least(F.length("path"), longest))))
    tried = tried.withColumn("a_host", F.expr("substring_index(host, '.', -n)")).withColumn("a_path", F.expr("substring(path, 1, size)"))
    blocks = bloom(listed, n_blocks)
    looked = tried.withColumn("block", block(F.col("a_host"), F.col("a_path"), n_blocks)).join(
        F.broadcast(blocks) if n_blocks <= max_blocks else blocks, "block", "left")
    passed = F.lit(True)
    for k, mark in enumerate(marks(F.col("a_host"), F.col("a_path"))):
        passed = passed & (F.col(f"word_{k}").bitwiseAND(mark) == mark)
    looked = looked.select("row", "page_id", "host", "path", F.when(passed, F.col("a_host")).alias("a_host"), F.when(passed, F.col("a_path")).alias("a_path"))
    entries = listed.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    exact = looked.join(entries, (F.col("a_host") == F.col("rule_host")) & (F.col("a_path") == F.col("rule_path")), "left")
    rule = F.concat("rule_host", "rule_path")
    best = F.min(F.when(F.col("verdict").isNotNull(), F.struct((-F.length(rule)).alias("size"), "verdict", rule.alias("rule"))))
    return exact.groupBy("row", "page_id", "host", "path").agg(best.alias("best")).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def rules_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, verdict string")


def op8_url_filter(pages: DataFrame) -> DataFrame:
    return judge(pages, rules_table(pages.sparkSession))


SQL = r"""
with p as (
  select page_id, row_number() over () r, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') path
  from pages
), rules(rh, rp, v) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
j as (select *, row_number() over (partition by r order by length(rh || rp) desc nulls last, v) k
  from p left join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp))
select page_id, host, path, rh || rp as rule, coalesce(v, 'allow') verdict from j where k = 1"""
