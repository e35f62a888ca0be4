"""Tweets: scoring, masking, keys, documents, rankings, hashtags, range counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywick.operators import tweets as ops
from tallywick.plans.registry import query
from tallywick.session import new_path
from tallywick.sources import tables as src

LEXICON = {"and": 1, "of": -1, "is": 2, "was": -2, "that": 3, "with": -3, "this": 2, "are": -1}
# ROT13, as the list is stored; the last entry is blank.
BANNED_STORED = ("gur", "gung", "jvgu", "vf", "n", "")
SINCE, START, END = "2014-04-16", "2014-04-16", "2014-04-18"


def unrot13(word: str) -> str:
    turned = ops.UPPER[13:] + ops.UPPER[:13] + ops.LOWER[13:] + ops.LOWER[:13]
    return word.translate(str.maketrans(ops.UPPER + ops.LOWER, turned))


BANNED = tuple(unrot13(w) for w in BANNED_STORED)
_BANNED = tuple(w for w in BANNED if w)
_SCORE = "case lower(x) " + " ".join(f"when '{w}' then {s}" for w, s in LEXICON.items()) + " else 0 end"
_TWEETS = f"""with one as (select tweet_id, min(user_id) user_id, min(created_at) created_at, min(text) text, min(followers_count) followers_count from tweets
  where tweet_id is not null and user_id is not null and created_at is not null and text is not null and created_at >= timestamp '{SINCE} 00:00:00' group by 1),
scored as (select tweet_id, user_id, created_at, followers_count, cast(list_sum(list_transform(regexp_extract_all(text, '[a-zA-Z0-9]+') || ['-'], lambda x: {_SCORE})) as bigint) score,
  array_to_string(list_transform(regexp_extract_all(text, '[a-zA-Z0-9]+|[^a-zA-Z0-9]+'), lambda w: case when lower(w) in {_BANNED} then w[1] || repeat('*', length(w) - 2) || w[-1] else w end), '') censored_text from one),
weighted as (select tweet_id, user_id, created_at, score*(1 + followers_count) score from scored where score <> 0),
tagged as (select *, tag1 tag from tweets where tag1 is not null union all select *, tag2 from tweets where tag2 is not null),
counts as (select user_id, count(distinct tweet_id) n_tweets from tweets group by 1)
"""


def scored(t):
    return ops.scored_tweets(t.tweets, LEXICON, BANNED, SINCE)


@query("j10_sentiment", "J10 F03 X05 P14 P15", views=("tweets",), sql=_TWEETS + "select tweet_id, score from scored")
def sentiment(t):
    return scored(t).select("tweet_id", "score")


@query("j10_sentiment_by_join", "J10 S15", views=("tweets",), sql=_TWEETS + "select tweet_id, score from scored")
def by_join(t):
    kept = ops.dedup_tweets(t.tweets.where(F.col("created_at") >= F.lit(SINCE).cast("timestamp")))
    return ops.sentiment_by_join(kept, "tweet_id", "text", t.spark.createDataFrame(sorted(LEXICON.items()), "word string, score long"))


@query("c05_scored_tweets", "C05 J11 F03 P14 P15 W04 X06 X07 X08 X09 X10 X14", views=("tweets",), sql=_TWEETS + """
    select tweet_id, user_id, score, censored_text, user_id || strftime(created_at, '%Y%m%d%H%M%S') stored_key,
      lpad(user_id::varchar, 16, '0') || '+' || strftime(created_at, '%Y-%m-%d %H:%M:%S') lookup_key from scored""")
def c05(t):
    user, time = F.col("user_id"), F.col("created_at")
    return scored(t).select("tweet_id", "user_id", "score", "censored_text", ops.stored_key(user, time).alias("stored_key"), ops.lookup_key(user, time).alias("lookup_key"))


@query("o08_tweets_of_user", "O08 P19 X29 X31 C05", views=("tweets",), sql=_TWEETS + """
    select tweet_id, tweet_id || ':' || score || ':' || censored_text line from scored where user_id = 15 order by tweet_id""")
def of_user(t):
    line = F.concat_ws(":", F.col("tweet_id").cast("string"), F.col("score").cast("string"), F.col("censored_text"))
    return scored(t).where("user_id = 15").orderBy("tweet_id").select("tweet_id", line.alias("line"))


@query("x30_weighted_scores", "X30 P17 P18 C06", views=("tweets",), sql=_TWEETS + "select tweet_id, user_id, cast(score as bigint) score from weighted")
def weighted(t):
    return ops.weighted(scored(t)).select("tweet_id", "user_id", "score")


@query("a10_user_documents", "A10 X27 C06", views=("tweets",), sql=_TWEETS + """
    select user_id, cast(floor((n - 1)/8) as bigint) page, '[' || string_agg('{"tweet_id":' || tweet_id || ',"score":' || cast(score as bigint) || '}', ',' order by tweet_id) || ']' as document
    from (select *, row_number() over (partition by user_id order by tweet_id) n from weighted) group by 1, 2""")
def documents(t):
    return ops.user_documents(ops.weighted(scored(t)), 8)


@query("w05_ranked_tweets", "W05 P16 C06", views=("tweets",), sql=_TWEETS + f"""
    select * from (select user_id, case when score < 0 then 'negative' else 'positive' end sign,
      cast(row_number() over (partition by user_id, score < 0 order by abs(score) desc, tweet_id::varchar) as int) place, tweet_id, cast(score as bigint) score
      from weighted where strftime(created_at, '%Y-%m-%d') between '{START}' and '{END}') where place <= 3""")
def ranked(t):
    return ops.rank_tweets(ops.weighted(scored(t)), START, END, 3)


_DAILY = _TWEETS + """, daily as (select tag, strftime(created_at, '%Y-%m-%d') date, count(*) n, count(distinct user_id) n_users,
  arg_min(tweet_id, (created_at, text, tweet_id)) tweet_id, arg_min(text, (created_at, text, tweet_id)) text from tagged group by 1, 2)
"""


@query("a09_hashtag_daily", "A09 F06 C07", views=("tweets",), sql=_DAILY + "select * from daily")
def hashtags(t):
    return ops.hashtag_daily(t.tweets)


@query("a09_hashtag_users", "A09 X24 C07", views=("tweets",), sql=_TWEETS + """
    select tag, date, cast(floor((n - 1)/5) as bigint) page, string_agg(user_id::varchar, ',' order by user_id) users
    from (select *, row_number() over (partition by tag, date order by user_id) n from (select distinct tag, strftime(created_at, '%Y-%m-%d') date, user_id from tagged)) group by all""")
def hashtag_users(t):
    return ops.hashtag_users(t.tweets, 5)


@query("o07_top_days", "O07 C07", views=("tweets",), sql=_DAILY + "select tag, date, n from daily where tag = 'lang_en' order by n desc, date limit 5")
def top_days(t):
    return ops.top_days(ops.hashtag_daily(t.tweets), "lang_en", 5)


@query("a08_tweets_per_user", "A08 C08", views=("tweets",), sql=_TWEETS + "select * from counts")
def per_user(t):
    return ops.tweets_per_user(t.tweets)


@query("w02_cumulative_counts", "W02 C08", views=("tweets",), sql=_TWEETS + "select *, cast(sum(n_tweets) over (order by user_id) as bigint) so_far from counts")
def cumulative(t):
    return ops.cumulative_counts(ops.tweets_per_user(t.tweets))


@query("a20_count_range", "A20 C08", views=("tweets",), sql=_TWEETS + "select cast(sum(n_tweets) as bigint) n_tweets from counts where user_id between 3 and 17")
def count_range(t):
    return ops.count_range(ops.tweets_per_user(t.tweets), 3, 17)


@query("a20_count_ranges", "A20 W02 C08", views=("tweets",), sql=_TWEETS + """,
    ranges as (select user_id range_id, user_id - user_id % 7 low, user_id + user_id % 11 high from counts union all select -1, 9, 3 union all select -2, -5, -1 union all select -3, null, 4)
    select range_id, coalesce(sum(n_tweets), 0)::bigint n_tweets from ranges left join counts on user_id between low and high group by range_id""")
def count_ranges(t):
    """A range about each user, and three that hold nobody."""
    counts = ops.tweets_per_user(t.tweets)
    user = F.col("user_id")
    asked = counts.select(user.alias("range_id"), (user - user % 7).alias("low"), (user + user % 11).alias("high"))
    empty = t.spark.createDataFrame([(-1, 9, 3), (-2, -5, -1), (-3, None, 4)], "range_id long, low long, high long")
    return ops.count_ranges(counts, asked.unionByName(empty))


@query("w05_ranked_requests", "W05 P16 C06", views=("tweets",), sql=_TWEETS + f""",
    requests as (select user_id * 10 + d request_id, user_id, ('2014-04-' || (15 + d)) s, ('2014-04-' || (16 + 2*d)) e, 1 + user_id % 4 n from (select distinct user_id from tweets), range(3) t(d))
    select * from (select request_id, case when score < 0 then 'negative' else 'positive' end sign,
      cast(row_number() over (partition by request_id, score < 0 order by abs(score) desc, tweet_id::varchar) as int) place, tweet_id, cast(score as bigint) score
      from requests join weighted using (user_id) where strftime(created_at, '%Y-%m-%d') between s and e
      qualify row_number() over (partition by request_id, score < 0 order by abs(score) desc, tweet_id::varchar) <= n)""")
def ranked_requests(t):
    """Three windows of days for each user."""
    d = F.col("d")
    text = lambda day: F.concat(F.lit("2014-04-"), day.cast("string"))
    users = t.tweets.select("user_id").distinct().select("user_id", F.explode(F.lit([0, 1, 2])).alias("d"))
    asked = users.select((F.col("user_id") * 10 + d).alias("request_id"), "user_id", text(15 + d).alias("start"), text(16 + 2 * d).alias("end"), (1 + F.col("user_id") % 4).cast("int").alias("n"))
    return ops.rank_requests(ops.weighted(scored(t)), asked)


_LISTS = """lists as (select distinct lower(unnest(regexp_extract_all(text, '[a-zA-Z0-9]+'))) word from benchmark),
lexicon as (select word, length(word) % 5 - 2 score from lists), banned as (select word from lists where length(word) % 3 = 0),
"""


@query("s15_word_lists", "S15 J10 J11 F03 X08 C05", views=("tweets",), sql="with " + _LISTS + f"""
    one as (select tweet_id, min(created_at) created_at, min(text) text from tweets where created_at >= timestamp '{SINCE} 00:00:00' group by 1),
    parts as (select tweet_id, unnest(regexp_extract_all(text, '[a-zA-Z0-9]+|[^a-zA-Z0-9]+')) w, generate_subscripts(regexp_extract_all(text, '[a-zA-Z0-9]+|[^a-zA-Z0-9]+'), 1) i from one),
    found as (select p.*, l.score, b.word banned from parts p left join lexicon l on lower(w) = l.word left join banned b on lower(w) = b.word)
    select tweet_id, coalesce(sum(score), 0)::bigint score,
      md5(string_agg(case when banned is null then w else w[1] || repeat('*', length(w) - 2) || w[-1] end, '' order by i)) censored_md5 from found group by 1""")
def word_lists(t):
    """A lexicon and a banned list of the benchmark's words, written in their stored forms and read back."""
    words = t.benchmark.select(F.explode(ops.tokens(F.col("text"))).alias("word")).select(F.lower("word").alias("word")).distinct()
    scores = words.select("word", (F.length("word") % 5 - 2).alias("score"))
    lexicon = src.read_lexicon(t.spark, src.write_tsv(scores, new_path(t.spark, "lexicon")))
    banned = src.read_banned(t.spark, src.write_banned(words.where("length(word) % 3 = 0"), new_path(t.spark, "banned")))
    return ops.scored_by_lists(t.tweets, lexicon, banned, SINCE).select("tweet_id", "score", F.md5("censored_text").alias("censored_md5"))


@query("w04_deduplicated", "W04 A22 U04", views=("tweets",), sql="select distinct tweet_id, user_id, created_at::varchar created from tweets")
def deduplicated(t):
    return ops.dedup_tweets(t.tweets).select("tweet_id", "user_id", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created"))
