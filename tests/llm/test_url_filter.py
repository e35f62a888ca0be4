"""URL filter against a plain look through the list, with few and many listed URLs."""

import random
import time

from tallywick.llm import url_filter


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for mark in "?#":
        rest = rest.split(mark, 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def plain(url, rules):
    host, path = host_path(url)
    fits = [(-len(h + p), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, min(fits)[2], min(fits)[1]) if fits else (host, path, None, "allow")


URLS = [None, "", "no scheme", "http://example.net/en/1?x=1", "HTTP://Blog.Example.NET/en/", "http://example.net/EN/", "http://net/", "http://net", "http://badnet/x", "https://a.b.example.com/de/4#t",
        "https://example.com/de", "x://y://example.org/fr/1", "http://ÜBER.org/fr/é", "http://a.org?q=/fr/", "http://.net/a", "http://a..org/fr/", "http://example.net/en/#?x", "http://line\nbreak.org/fr/\nx"]


def check(spark, urls, rules, **options):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages, listed, **options).collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_rules(spark):
    check(spark, URLS + URLS[3:5], list(url_filter.RULES))


def test_many_listed(spark):
    rng = random.Random(3)
    host = lambda: ".".join(rng.choice("abcdef") + str(rng.randrange(4)) for _ in range(rng.randrange(1, 4)))
    rules = list({(host(), rng.choice(["/", "/x/", "/x/y", "", "/long/path/here"])): rng.choice(["block", "allow"]) for _ in range(400)}.items())
    check(spark, [f"http://{host()}{rng.choice(['', '/', '/x/', '/x/yz', '/q', '/long/path/here/9'])}" for _ in range(400)], [(h, p, v) for (h, p), v in rules])


def test_beyond_the_bounds(spark):
    """Many shapes of listed URLs, or many blocks of the filter: other ways with the same result."""
    rules = [("a.b", "/" + "x" * n, "block") for n in range(30)] + [("b", "/y/", "allow"), ("", "/e", "block")]
    urls = [f"http://{h}/{'x' * n}" for h in ("a.b", "q.a.b", "ab", "b") for n in (0, 3, 29, 40)] + ["http://w.b/y/1", "http:///e", None]
    for options in ({}, {"max_shapes": 5}, {"max_blocks": 1}, {"max_shapes": 5, "max_blocks": 1}):
        check(spark, urls, rules, **options)


def test_five_thousand_path_lengths(spark):
    rules = [("long.org", "/" + "p" * n, "block" if n % 2 else "allow") for n in range(5000)]
    check(spark, ["http://x.long.org/" + "p" * n + "/q" for n in (0, 1, 4998, 4999, 6000)] + ["http://long.org/q", "http://other.org/ppp"], rules)


def test_long_hosts(spark):
    """A host of very many labels costs its length for each listed number of labels."""
    host = ".".join(["a"] * 100_000)
    started = time.time()
    check(spark, [f"http://{host}.net/x", f"http://{host}.example.net/en/1", f"http://{host}/"], list(url_filter.RULES))
    assert time.time() - started < 20


def test_empty_and_null(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (None, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([(None, "/", "block"), ("net", None, "block"), ("net", "/", None)], "host string, path string, verdict string")
    assert [r["verdict"] for r in url_filter.judge(pages, none).collect()] == ["allow"] * 2
    assert url_filter.op8_url_filter(pages.limit(0)).count() == 0
    assert "Python" not in url_filter.op8_url_filter(pages)._jdf.queryExecution().executedPlan().toString()


def test_filter_has_no_false_negatives(spark):
    from pyspark.sql import functions as F

    listed = spark.range(2000).select(F.concat(F.lit("h"), F.col("id")).alias("host"), F.lit("/").alias("path"))
    blocks = url_filter.bloom(listed, 125)
    passed = listed.withColumn("block", url_filter.block(F.col("host"), F.col("path"), 125)).join(blocks, "block")
    for k, mark in enumerate(url_filter.marks(F.col("host"), F.col("path"))):
        passed = passed.where(F.col(f"word_{k}").bitwiseAND(mark) == mark)
    assert passed.count() == 2000
