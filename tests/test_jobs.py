"""Small inputs with odd cases, and plain loops for what SQL has no form for."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from tallywick.functions import scalars
from tallywick.operators import graph, kvlog, monitor, ngrams, pageviews, social, tweets
from tallywick.plans.views import Tables
from tallywick.sources import tables as src
from tallywick.streaming import matching

FOLDER = "/root/testdata/sf0.001"


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("text,kept,raw", [("", [], [""]), (" a", ["a"], ["a"]), ("123", [], [""]), ("-x y", ["x", "y"], ["", "x", "y"]), ("a  b", ["a", "b"], ["a", "b"])])
def test_words(spark, text, kept, raw):
    assert one(spark, text, lambda v: ngrams.words(ngrams.normalised(v))) == kept
    assert one(spark, text, lambda v: ngrams.words(ngrams.normalised(v), drop_empty=False)) in (raw, [""] if not kept else raw)


def test_next_words(spark):
    counts = spark.createDataFrame([("a", 8), ("a b", 4), ("a c", 4), ("a d", 1), ("z q", 5)], "phrase string, cnt long")
    got = [tuple(r) for r in ngrams.next_words(counts, 3).orderBy("prefix", "place").collect()]
    assert got == [("a", "b", 1, 0.5), ("a", "c", 2, 0.5), ("a", "d", 3, 0.13), ("z", "q", 1, 0.0)]


def test_censor(spark):
    banned = ["a", "is", "the", "never", " "]
    for text, want in (("THE end, a is it?", "T*E end, aa is it?"), ("never-Never", "n***r-N***r"), ("", ""), ("é the ñ", "é t*e ñ"), ("other", "other")):
        assert one(spark, text, lambda v: tweets.censored(v, banned)) == want
    assert one(spark, "Uryyb 9", tweets.rot13) == "Hello 9"
    assert one(spark, "a\tb\nc\rd", lambda v: tweets.unescape(tweets.escape(v))) == "a\tb\nc\rd"


def test_sentiment(spark):
    frame = spark.createDataFrame([(1, "Good good BAD"), (2, ""), (3, "none")], "id long, text string")
    lexicon = {"good": 3, "bad": -2}
    assert [r[0] for r in frame.orderBy("id").select(tweets.sentiment(F.col("text"), lexicon)).collect()] == [4, 0, 0]
    table = spark.createDataFrame(list(lexicon.items()), "word string, score long")
    assert {r["id"]: r["score"] for r in tweets.sentiment_by_join(frame, "id", "text", table).collect()} == {1: 4, 2: 0, 3: 0}


def test_hashtags(spark):
    at = datetime.datetime(2014, 4, 20, 10)
    rows = [(1, 9, at, "b", "x", None), (2, 10, at, "a", "x", None), (1, 9, at, "b", "x", None), (3, 2, at, "z", "y", "x")]
    frame = spark.createDataFrame(rows, "tweet_id long, user_id long, created_at timestamp, text string, tag1 string, tag2 string")
    assert [tuple(r) for r in tweets.hashtag_daily(frame).orderBy("tag").collect()] == [("x", "2014-04-20", 4, 3, 2, "a"), ("y", "2014-04-20", 1, 1, 3, "z")]
    assert [r["users"] for r in tweets.hashtag_users(frame, 2).orderBy("tag", "page").collect()] == ["2,9", "10", "2"]


def test_count_range(spark):
    counts = spark.createDataFrame([(i, 1) for i in (2, 4, 6)], "user_id long, n_tweets long")
    assert [tweets.count_range(counts, a, b).first()[0] for a, b in ((2, 4), (3, 5), (0, 1), (7, 9), (0, 9))] == [2, 1, 0, 0, 3]


def test_pages(spark):
    rows = [("flat", [5, 5, 5]), ("falls", [5, 4, 3]), ("last", [1, 5, 4]), ("zero", [0, 0, 0]), ("twice", [7, 1, 7])]
    frame = spark.createDataFrame([(t, sum(v), v) for t, v in rows], "title string, total long, by_day array<long>")
    assert {r["title"]: r["steps"] for r in pageviews.longest_decline(frame).collect()} == {"flat": 0, "falls": 2, "last": 1, "zero": 0, "twice": 1}
    assert {r["title"]: r["best_date"] for r in pageviews.best_day(frame, "2024-01-30").collect()} == {
        "flat": "20240130", "falls": "20240130", "last": "20240131", "zero": None, "twice": "20240130"}
    assert pageviews.days_ahead(frame, "falls", "last").first()[0] == 1
    assert pageviews.days_ahead(frame, "falls", "missing").first()[0] == 3


def test_runs(spark):
    pattern = "..xx.xxx.xxxxxxx"
    frame = spark.createDataFrame([("i", i, i, c == ".") for i, c in enumerate(pattern)], "instance string, ts long, event_id long, ok boolean")
    assert sorted(r["event_id"] for r in monitor.failure_alerts(frame).collect()) == [7, 11]
    states = [r["healthy"] for r in monitor.health_states(frame).orderBy("event_id").collect()]
    assert states == [None] + [True] * 13 + [False] * 2


def test_asof(spark):
    rows = [(1, "k", "get", 1, None, 0), (2, "k", "put", 2, "a", 0), (3, "k", "get", 2, None, 0), (4, "k", "put", 2, "b", 0), (5, "k", "get", 9, None, 0), (6, None, "get", 9, None, 0)]
    frame = spark.createDataFrame(rows, "event_id long, k string, op string, ts long, v string, arrival long")
    assert {r["event_id"]: (r["n_versions"], r["latest"]) for r in kvlog.asof_values(frame).collect()} == {1: (0, None), 3: (2, "b"), 5: (2, "b"), 6: (0, None)}


def test_pagerank_by_hand(spark):
    edges = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "src long, dst long")
    users = spark.createDataFrame([(4,)], "id long")
    ranks = {1: 1.0, 2: 1.0, 3: 1.0, 4: 1.0}
    for _ in range(2):
        mass = (ranks[3] + ranks[4]) / 4
        got = {1: 0, 2: ranks[1] / 2, 3: ranks[1] / 2 + ranks[2], 4: 0}
        ranks = {u: 0.15 + 0.85 * (got[u] + mass) for u in ranks}
    found = {r["id"]: r["rank"] for r in graph.pagerank(edges, users, iters=2).collect()}
    assert found == pytest.approx(ranks) and sum(found.values()) == pytest.approx(4)


def test_social(spark):
    info = spark.createDataFrame([(1, "n1", "p1", "x"), (2, "n2", "p2", "y")], "id long, name string, profile string, password string")
    follows = spark.createDataFrame([(1, 2), (9, 2)], "follower long, followee long")
    assert sorted(map(tuple, social.followers(follows, info).collect())) == [(1, "Unauthorized", "#"), (2, "n1", "p1")]
    asked = spark.createDataFrame([(1, "x"), (2, "x"), (7, "z")], "id long, password string")
    assert sorted(map(tuple, social.profiles(asked, info).collect())) == [(1, "n1", "p1"), (2, "Unauthorized", "#"), (7, "Unauthorized", "#")]
    posts = spark.createDataFrame([(i, 2, i // 2) for i in range(50)], "post_id long, user_id long, ts long")
    got = [r["post_id"] for r in social.timelines(follows, posts).where("id = 1").orderBy("place").collect()]
    assert got == list(range(20, 50))


def plain_decode(key, message):
    z, n, out = int(key) // scalars.DIVISOR % 25 + 1, math.isqrt(len(message)), []
    for i in range(2 * n - 1):
        for j in range(min(i, n - 1), -1, -1):
            if i - j < n:
                c = ord(message[(i - j) * n + j]) - z
                out.append(chr(c + 26 if c < 65 else c))
    return "".join(out)


def test_decode(spark):
    rows = [(1, str(scalars.DIVISOR), "B"), (2, str(scalars.DIVISOR * 30 + 7), "ABCD"), (3, str(scalars.DIVISOR * 4), "QWERTYUIOP"), (4, "5", ""), (5, None, "A"), (6, "x", "A")]
    got = {r["msg_id"]: r["message"] for r in scalars.decode_messages(spark.createDataFrame(rows, "msg_id long, key string, message string")).collect()}
    assert got == {i: plain_decode(k, m) for i, k, m in rows[:4]} | {5: None, 6: None}
    sample = Tables(spark, FOLDER).messages.limit(40)
    want = {r["msg_id"]: plain_decode(r["key"], r["message"]) for r in sample.collect()}
    assert {r["msg_id"]: r["message"] for r in scalars.decode_messages(sample).collect()} == want


def plain_matches(events):
    free, out = {}, []
    for e in sorted(events, key=lambda e: (e["ts"], e["seq"])):
        block = free.setdefault(e["block_id"], {})
        if e["type"] == "RIDE_REQUEST":
            best = min(((x - e["longitude"]) ** 2 + (y - e["latitude"]) ** 2, d) for d, (x, y) in block.items()) if block else None
            if best:
                del block[best[1]]
            out.append((e["block_id"], e["seq"], e["rider_id"], best[1] if best else None))
        elif e["type"] == "LEAVING_BLOCK":
            block.pop(e["driver_id"], None)
        elif e["type"] != "ENTERING_BLOCK" or e["status"] == "AVAILABLE":
            block[e["driver_id"]] = (e["longitude"], e["latitude"])
    return out


def test_stream_matches_the_loop(spark):
    from tallywick.plans.registry import callable_for, load_all
    from tallywick.plans.stream_queries import _cabs

    load_all()
    events = _cabs(Tables(spark, FOLDER).events).collect()
    got = sorted(map(tuple, callable_for("t03_matches")(spark, FOLDER).collect()), key=repr)
    assert got == sorted(plain_matches(events), key=repr) and any(r[3] for r in got)


def test_nearest_takes_the_first_id_as_text(spark):
    drivers = spark.createDataFrame([(1, "9", 0, 0), (1, "10", 0, 0), (1, "2", 0, 6), (10, "1", 1, 1)], "block_id long, driver_id string, longitude int, latitude int")
    asked = spark.createDataFrame([(1, "r", 1, 0, 3), (2, "s", 1, 0, 1), (3, "t", 5, 0, 0)], "seq long, rider_id string, block_id long, longitude int, latitude int")
    assert sorted((r["seq"], r["driver_id"], r["away"]) for r in matching.nearest_in_block(asked, drivers).collect()) == [(1, "10", 3.0), (2, "10", 1.0)]


def test_bad_numbers_are_skipped(spark, tmp_path):
    folder = tmp_path / "pagecounts-20240105-100000"
    folder.mkdir()
    (folder / "part.txt").write_text("en A 3 9\nen B x 9\nen C\n")
    rows = src.read_pagecounts(spark, str(folder)).orderBy("title").collect()
    assert [tuple(r) for r in rows] == [("en", "A", 3, "20240105", "100000"), ("en", "B", None, "20240105", "100000"), ("en", "C", None, "20240105", "100000")]
    scored = spark.createDataFrame([(1, 2, "7"), (2, 2, "many"), (3, 0, "7"), (4, -1, None)], "tweet_id long, score long, followers_count string")
    assert [(r["tweet_id"], r["score"]) for r in tweets.weighted(scored).collect()] == [(1, 16)]


def test_constraints(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k long, v string")
    assert {r["rule"]: r["violations"] for r in src.check_constraints(frame, ["k", "v"], ["k"]).collect()} == {"not null k": 0, "not null v": 1, "unique k": 1}
