"""Word lists of any size, many ranges, many requests, timelines, long division."""

import json
import random
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallywick.functions import scalars
from tallywick.operators import social, tweets
from tallywick.sources import tables as src


def test_lists_are_read_from_files(spark, tmp_path):
    (tmp_path / "lexicon").mkdir()
    (tmp_path / "lexicon" / "a.txt").write_text("good\t3\nbad\t-3\nno score\n\nthree\t1\t2\nhalf\t1.5\n  spaced\t2  \ngood\t4\nUpper\t1\n")
    (tmp_path / "lexicon" / "b.txt").write_text("bad\t-5\n")
    assert dict(map(tuple, src.read_lexicon(spark, str(tmp_path / "lexicon")).collect())) == {"good": 4, "bad": -5, "spaced": 2, "Upper": 1}
    (tmp_path / "banned.txt").write_text("onq\n\n  \nonq\n svyg \nA1\n")
    assert sorted(r["word"] for r in src.read_banned(spark, str(tmp_path / "banned.txt")).collect()) == ["N1", "bad", "filt"]
    path = src.write_banned(spark.createDataFrame([("bad",), ("Zoo",)], "word string"), str(tmp_path / "out"))
    assert sorted(r[0] for r in spark.read.text(path).collect()) == ["Mbb", "onq"] and sorted(r["word"] for r in src.read_banned(spark, path).collect()) == ["Zoo", "bad"]


@pytest.fixture(scope="module")
def big():
    """Twenty thousand words, and texts of them in any case with signs between."""
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 9))) for _ in range(40_000)})
    lists = words[:20_000]
    texts = [(i, "".join(rng.choice([w, w.upper(), w.title()]) + rng.choice([" ", ", ", "!", "-", "é"]) for w in rng.choices(words, k=rng.randrange(0, 60)))) for i in range(300)]
    return lists, [*texts, (300, None), (301, ""), (302, " the a I" * 3000)]


def plain_parts(text):
    out = []
    for c in text:
        if out and (c.isascii() and c.isalnum()) == (out[-1][-1].isascii() and out[-1][-1].isalnum()):
            out[-1] += c
        else:
            out.append(c)
    return out


def test_twenty_thousand_words(spark, big):
    lists, texts = big
    frame = spark.createDataFrame(texts, "tweet_id long, text string").repartition(4)
    scores = {w: len(w) % 5 - 2 for w in lists}
    banned = spark.createDataFrame([(w,) for w in [*lists[::3], "the", "a", " ", ""]], "word string")
    hidden = lambda w: w if w.lower() not in wanted else w[0] + "*" * (len(w) - 2) + w[-1]
    wanted = {*lists[::3], "the", "a"}
    masked = {i: None if t is None else "".join(map(hidden, plain_parts(t))) for i, t in texts}
    points = {i: sum(scores.get(w.lower(), 0) for w in plain_parts(t or "")) for i, t in texts}
    assert dict(map(tuple, tweets.censored_by_join(frame, "tweet_id", "text", banned).collect())) == masked
    assert dict(map(tuple, frame.select("tweet_id", tweets.censored(F.col("text"), sorted(wanted)).alias("t")).collect())) == masked
    lexicon = spark.createDataFrame(sorted(scores.items()), "word string, score long")
    assert dict(map(tuple, tweets.sentiment_by_join(frame, "tweet_id", "text", lexicon).collect())) == points
    direct = dict(map(tuple, frame.select("tweet_id", tweets.sentiment(F.col("text"), scores).alias("s")).collect()))
    assert {i: s or 0 for i, s in direct.items()} == points


def test_parts_are_read_in_one_pass(spark):
    """The parts are runs, not what a look to both sides of every character cuts; signs beyond the BMP, line ends and empty texts too."""
    texts = ["", "a", " ", "ab, c\n\nd9", "é\U0001f600x\U0001f600", "\r\n", "A1-b"]
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "text string").select("text", tweets.parts(F.col("text")).alias("p"))
    assert {r["text"]: r["p"] for r in frame.collect()} == {t: plain_parts(t) for t in texts} | {None: None}
    assert "?<=" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_scores_are_summed_by_key_alone(spark):
    """Repeated and missing keys, texts and words of the list; no aggregate holds the words of a task."""
    texts = spark.createDataFrame([(1, "a B c a"), (1, "b"), (2, None), (3, ""), (4, "none"), (None, "a a"), (5, "c")], "id long, text string")
    lexicon = spark.createDataFrame([("a", 2), ("a", 1), ("b", -5), ("c", None), (None, 9)], "word string, score long")
    got = tweets.sentiment_by_join(texts, "id", "text", lexicon)
    assert sorted(map(tuple, got.collect()), key=str) == [(1, -4), (2, 0), (3, 0), (4, 0), (5, 0), (None, 0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"keys=\[[^]]*word", plan) and plan.count("Generate explode") <= 2  # the plan may be printed twice


def test_count_ranges(spark):
    rng = random.Random(4)
    users = {u: rng.randrange(1, 9) for u in rng.sample(range(1000), 300)}
    counts = spark.createDataFrame([*users.items(), (None, 50)], "user_id long, n_tweets long").repartition(5)
    ranges = [(i, *sorted(rng.sample(range(-50, 1050), 2))) for i in range(200)] + [(500, 30, 20), (501, 7, 7), (502, None, 5), (503, 5, None), (504, -9, 2000), (505, 0, 0)]
    ranges += [(600 + u, u, u) for u in list(users)[:5]]
    asked = spark.createDataFrame(ranges, "range_id long, low long, high long")
    got = dict(map(tuple, tweets.count_ranges(counts, asked).collect()))
    assert got == {i: 0 if a is None or b is None else sum(n for u, n in users.items() if a <= u <= b) for i, a, b in ranges}
    plan = tweets.count_ranges(counts, asked)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert tweets.count_ranges(counts.limit(0), asked).agg(F.sum("n_tweets")).first()[0] == 0


def test_ranked_requests(spark):
    rng = random.Random(5)
    rows = [(i, 1 if rng.random() < 0.5 else rng.randrange(2, 6), f"2014-04-{rng.randrange(10, 20)} 10:00:00", rng.choice([-5, -3, -1, 1, 2, 4])) for i in range(500)]
    scored = spark.createDataFrame(rows, "tweet_id long, user_id long, at string, score long").withColumn("created_at", F.col("at").cast("timestamp"))
    requests = [(i, rng.randrange(1, 7), f"2014-04-{a}", f"2014-04-{b}", n) for i, (a, b, n) in enumerate([(10, 19, 3), (12, 12, 5), (15, 11, 4), (18, 19, 1), (10, 15, 200)] * 4)]
    got = sorted(map(tuple, tweets.rank_requests(scored, spark.createDataFrame(requests, "request_id long, user_id long, start string, end string, n int")).collect()))
    want = []
    for i, user, start, end, n in requests:
        for sign in ("negative", "positive"):
            best = sorted((-abs(s), str(t), t, s) for t, u, at, s in rows if u == user and start <= at[:10] <= end and (s < 0) == (sign == "negative"))[:n]
            want += [(i, sign, place, t, s) for place, (_, _, t, s) in enumerate(best, 1)]
    assert got == sorted(want) and got


def test_timelines_with_ties_and_nulls(spark):
    """Against a plain sort: equal times, times that are missing, repeated follows and posts, users without posts, a follower that is null."""
    rng = random.Random(6)
    posts = [(i, rng.choice([*range(40), None]), rng.choice([None, *range(12)]) if i % 3 else rng.randrange(500)) for i in range(3000)]
    posts += rng.choices(posts, k=200)
    follows = [(rng.choice([*range(60), None]), rng.randrange(45)) for _ in range(1500)] + [(99, 3), (98, 77), (5, None)]
    of = {}
    for post, user, ts in posts:
        of.setdefault(user, []).append((ts is None, -(ts or 0), -post))
    for n in (1, 2, 5, 30):
        want = {}
        for follower, followee in follows:
            if followee is not None:
                want.setdefault(follower, []).extend(of.get(followee, ()))
        want = {f: sorted(((None if none else -ts, -post) for none, ts, post in sorted(w)[:n]), key=lambda x: (x[0] is not None, x)) for f, w in want.items() if w}
        frames = spark.createDataFrame(follows, "follower long, followee long").repartition(3), spark.createDataFrame(posts, "post_id long, user_id long, ts long").repartition(4)
        got = {}
        for r in sorted(social.timelines(*frames, n).collect(), key=lambda r: r["place"]):
            got.setdefault(r["id"], []).append((r["ts"], r["post_id"]))
        assert got == want


def test_a_user_meets_few_posts(spark):
    """Of 200 followees with 30 posts each about 60 posts are brought, not 6,000."""
    follows = spark.range(200).select(F.lit(1).cast("long").alias("follower"), F.col("id").alias("followee"))
    posts = spark.range(200 * 30).select(F.col("id").alias("post_id"), (F.col("id") % 200).alias("user_id"), F.xxhash64("id").alias("ts"))
    assert 30 <= social.sent_posts(follows, posts, 30).count() <= 75


@pytest.mark.parametrize("name", ["j07_followers", "j07_followers_from_cells"])
def test_followers_are_dealt_out_before_they_are_counted(spark, name):
    """No aggregate by id, name and profile stands below the exchange, in the tasks that join or read the cells."""
    from tallywick.plans.registry import callable_for, load_all

    load_all()
    plan = callable_for(name)(spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    top, below = plan.split("REPARTITION_BY_NUM", 1)
    assert "count(1)" in top and "count(1)" not in below


def test_timeline_documents(spark):
    info = spark.createDataFrame([(1, "n1", 'p"1'), (2, "n2", "p2"), (3, "n2", "p0"), (4, None, "p4"), (5, None, None)], "id long, name string, profile string")
    follows = spark.createDataFrame([(2, 1), (3, 1), (4, 1), (9, 1), (1, 2), (2, 9), (1, 3)], "follower long, followee long")
    posts = spark.createDataFrame([(i, 2 if i % 2 else 3, i // 3, f"post {i}") for i in range(12)], "post_id long, user_id long, ts long, post string")
    got = {(r["id"], r["page"]): json.loads(r["document"]) for r in social.timeline_documents(info, follows, posts, 4, 2).collect()}
    last = [{"post_id": i, "post": f"post {i}"} for i in range(8, 12)]
    assert got == {
        (1, 0): {"name": "n1", "profile": 'p"1', "followers": [{"profile": "p4"}, {"name": "n2", "profile": "p0"}], "posts": last},
        (1, 1): {"followers": [{"name": "n2", "profile": "p2"}]},
        (2, 0): {"name": "n2", "profile": "p2", "followers": [{"name": "n1", "profile": 'p"1'}], "posts": []},
        (3, 0): {"name": "n2", "profile": "p0", "followers": [{"name": "n1", "profile": 'p"1'}], "posts": []},
        (4, 0): {"profile": "p4", "followers": [], "posts": []},
        (5, 0): {"followers": [], "posts": []},
    }


def test_steps_of_documents_are_stored_in_turn(spark, monkeypatch):
    """So the disk holds one step's shuffles at a time: what is returned only joins stored tables, and the follows are made once."""
    from tallywick.operators import slices
    from tallywick.session import cut

    stored = []
    for module in (social, slices):
        monkeypatch.setattr(module, "cut", lambda df, label: (stored.append((label, df._jdf.queryExecution().optimizedPlan().toString())), cut(df, label))[1])
    info = spark.range(50).select("id", F.concat(F.lit("n"), "id").alias("name"), F.concat(F.lit("p"), "id").alias("profile"))
    follows = spark.range(400).select((F.col("id") % 50).alias("follower"), (F.col("id") % 7).alias("followee")).distinct()
    posts = spark.range(500).select(F.col("id").alias("post_id"), (F.col("id") % 50).alias("user_id"), F.col("id").alias("ts"), F.lit("x").alias("post"))
    plan = social.timeline_documents(info, follows, posts, 5, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert not any(step in plan for step in ("Window", "Aggregate", "Generate"))
    assert [label for label, _ in stored] == ["follows", "slices", "follower-pages", "recent-posts", "wanted-posts", "timelines"]
    assert not any("Aggregate [follower" in p for label, p in stored if label in ("slices", "recent-posts"))
    assert "_item" not in dict(stored)["slices"] and "_item" in dict(stored)["follower-pages"]


DIVISORS = [7, 25, 10 ** 17, 10 ** 17 - 1, 99 * 10 ** 33 + 1, scalars.DIVISOR]


@settings(max_examples=15, deadline=None)
@given(st.sampled_from(DIVISORS), st.lists(st.one_of(st.integers(0, 10 ** 6), st.integers(0, 10 ** 140), st.integers(10 ** 99, 10 ** 108)), min_size=1, max_size=30), st.integers(2, 1000))
def test_long_division(spark, divisor, numbers, modulus):
    numbers += [k * divisor + d for k in (0, 1, 9, 10, 25, 10 ** 9) for d in (0, divisor - 1)]
    texts = [str(n) for n in numbers] + ["000" + str(n) for n in numbers[:3]] + ["0" * 130 + "5"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = dict(map(tuple, frame.select("i", scalars.quotient_mod(F.col("t"), divisor, modulus)).collect()))
    assert got == {i: int(t) // divisor % modulus for i, t in enumerate(texts)}


def test_what_is_no_number(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "12x"), (4, "-5"), (5, "1.0"), (6, "٣"), (7, "26")], "i long, t string")
    assert dict(map(tuple, frame.select("i", scalars.letter_shift(F.col("t"), 1)).collect())) == {1: None, 2: None, 3: None, 4: None, 5: None, 6: None, 7: 2}
