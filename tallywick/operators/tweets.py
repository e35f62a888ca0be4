"""Text-feed jobs: sentiment, masking, de-duplication, per-user rankings, hashtag roll-ups, range counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywick.functions.scalars import LOWER, UPPER, rot13  # noqa: F401
from tallywick.operators.slices import paged, running_sums
from tallywick.session import cut


# Fixed values of the feed's escapes for tab, line feed and carriage return.
ESCAPES = (("\t", "&#TAB;"), ("\n", "&#LF;"), ("\r", "&#CR;"))

TWEET_TIME = "MMM dd HH:mm:ss Z yyyy"


def tokens(text: Column) -> Column:
    """Runs of ASCII letters and digits."""
    return F.regexp_extract_all(text, F.lit("([a-zA-Z0-9]+)"), F.lit(1))


def parts(text: Column) -> Column:
    """Tokens and what stands between them, in turn; together they are the text. An empty text has none."""
    return F.regexp_extract_all(text, F.lit("[a-zA-Z0-9]+|[^a-zA-Z0-9]+"), F.lit(0))


def masked(word: Column) -> Column:
    """First and last letter, stars between; a single letter is doubled."""
    return F.concat(F.left(word, F.lit(1)), F.repeat(F.lit("*"), F.length(word) - 2), F.right(word, F.lit(1)))


def censored(text: Column, banned: Sequence[str]) -> Column:
    """The text with the inside of banned words masked, in any case; blank entries ban nothing. `censored_by_join` takes a table."""
    words = sorted({w.lower() for w in banned if w.strip()})
    if not words:
        return text
    return F.array_join(F.transform(parts(text), lambda w: F.when(F.lower(w).isin(words), masked(w)).otherwise(w)), "")


def censored_by_join(df: DataFrame, key: str, text: str, banned: DataFrame) -> DataFrame:
    """(key, text) with the inside of banned words masked, by a list (word) of any size; `key` is unique.

    A text's different parts are semi-joined with the list; what is left, a text's own banned words,
    comes back to it as one array. A frequent word is the key of many rows on the text's side only, which Spark splits.
    """
    own = df.select(F.col(key).alias("_key"), F.explode(F.array_distinct(F.transform(parts(F.col(text)), F.lower))).alias("word"))
    found = own.join(banned.select("word").where("trim(word) <> ''"), "word", "left_semi").groupBy("_key").agg(F.collect_list("word").alias("_banned"))
    joined = df.select(key, text).join(found, F.col(key) == F.col("_key"), "left")
    hidden = F.array_join(F.transform(parts(F.col(text)), lambda w: F.when(F.array_contains("_banned", F.lower(w)), masked(w)).otherwise(w)), "")
    return joined.select(key, F.when(F.col("_banned").isNull(), F.col(text)).otherwise(hidden).alias(text))


def sentiment(text: Column, lexicon: Mapping[str, int]) -> Column:
    """The summed scores of the tokens that the lexicon has, in any case; none give 0. `sentiment_by_join` takes a table.

    Words of one score are one set, so a token is looked up once for each different score.
    """
    of: dict[int, list[str]] = {}
    for word, score in sorted(lexicon.items()):
        of.setdefault(score, []).append(word)
    lowered = F.transform(tokens(text), F.lower)
    value = lambda w: sum((F.when(w.isin(words), score).otherwise(0) for score, words in of.items()), F.lit(0)).cast("long")
    return F.aggregate(lowered, F.lit(0).cast("long"), lambda total, w: total + value(w))


def sentiment_by_join(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """(key, score) with a lexicon table (word, score) of any size; rows without a key have 0.

    The tokens meet the lexicon as they come and are summed by key alone, so a task that reads texts
    holds a sum for each of its keys, never its different words.
    """
    words = df.select(key, F.explode_outer(tokens(F.col(text))).alias("word")).select(key, F.lower("word").alias("word"))
    found = words.join(lexicon.select("word", "score"), "word", "left").groupBy(key).agg(F.sum("score").cast("long").alias("score"))
    return found.select(key, F.when(F.col(key).isNotNull() & F.col("score").isNotNull(), F.col("score")).otherwise(F.lit(0).cast("long")).alias("score"))


def complete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(required))


def dedup_tweets(df: DataFrame) -> DataFrame:
    """One row of each tweet id: the earliest, then the least text."""
    first = F.min(F.struct("created_at", *[c for c in sorted(df.columns) if c not in ("tweet_id", "created_at")])).alias("t")
    return df.groupBy("tweet_id").agg(first).select("tweet_id", "t.*")


def kept_tweets(df: DataFrame, since: str) -> DataFrame:
    """Complete tweets from `since` (UTC) on, one per id."""
    return dedup_tweets(complete(df, ["tweet_id", "user_id", "created_at", "text"]).where(F.col("created_at") >= F.lit(since).cast("timestamp")))


def scored_tweets(df: DataFrame, lexicon: Mapping[str, int], banned: Sequence[str], since: str) -> DataFrame:
    """Complete tweets from `since` (UTC) on, one per id, with score and censored text."""
    return kept_tweets(df, since).select("tweet_id", "user_id", "created_at", "followers_count",
                                         sentiment(F.col("text"), lexicon).alias("score"), censored(F.col("text"), banned).alias("censored_text"))


def scored_by_lists(df: DataFrame, lexicon: DataFrame, banned: DataFrame, since: str) -> DataFrame:
    """The same with a lexicon (word, score) and a list (word) of any size."""
    kept = cut(kept_tweets(df, since).select("tweet_id", "user_id", "created_at", "followers_count", "text"), "kept-tweets")
    masked_text = censored_by_join(kept, "tweet_id", "text", banned).withColumnRenamed("text", "censored_text")
    scores = sentiment_by_join(kept, "tweet_id", "text", lexicon)
    return kept.drop("text").join(scores, "tweet_id").join(masked_text, "tweet_id")


def stored_key(user_id: Column, time: Column) -> Column:
    return F.concat(user_id.cast("string"), F.date_format(time, "yyyyMMddHHmmss"))


def lookup_key(user_id: Column, time: Column) -> Column:
    return F.concat(F.lpad(user_id.cast("string"), 16, "0"), F.lit("+"), F.date_format(time, "yyyy-MM-dd HH:mm:ss"))


def requested_time(text: Column) -> Column:
    return F.replace(text, F.lit("+"), F.lit(" "))


def escape(text: Column) -> Column:
    for raw, written in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for raw, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


def parse_tweet_time(text: Column) -> Column:
    """'Sun Apr 20 07:08:09 +0000 2014' as a timestamp; the day of the week is cut off."""
    return F.to_timestamp(F.substring(text, 5, 40), TWEET_TIME)


def weighted(scored: DataFrame) -> DataFrame:
    """Scores times one more than the followers; zero scores and follower counts that are no number go."""
    followers = F.col("followers_count").cast("string").try_cast("long")
    kept = scored.where("score <> 0").withColumn("_followers", followers).where("_followers is not null")
    return kept.withColumn("score", F.col("score") * (1 + F.col("_followers"))).drop("_followers")


def user_documents(scored: DataFrame, page_size: int = 100) -> DataFrame:
    """(user_id, page, document): a user's tweets in order of id as JSON arrays of at most `page_size`."""
    item = F.to_json(F.struct("tweet_id", "score"))
    pages = paged(scored, ["user_id"], ["tweet_id"], item, page_size)
    return pages.select("user_id", "page", F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("document"))


def rank_tweets(scored: DataFrame, start: str, end: str, n: int) -> DataFrame:
    """Each user's n most positive and n most negative tweets between two days, both included; ties by id as text."""
    day = F.date_format("created_at", "yyyy-MM-dd")
    inside = scored.where(day.between(start, end)).withColumn("sign", F.when(F.col("score") < 0, "negative").otherwise("positive"))
    order = Window.partitionBy("user_id", "sign").orderBy(F.desc(F.abs("score")), F.col("tweet_id").cast("string"))
    return inside.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).select("user_id", "sign", "place", "tweet_id", "score")


def rank_requests(scored: DataFrame, requests: DataFrame) -> DataFrame:
    """(request_id, sign, place, tweet_id, score) for requests (request_id, user_id, start, end, n), days both included.

    Only a day's own best can be among a request's best: of each user, day and sign the rows past
    the greatest n go before the join, so a request meets n rows a day at most.
    """
    dated = scored.select("user_id", F.date_format("created_at", "yyyy-MM-dd").alias("day"), F.when(F.col("score") < 0, "negative").otherwise("positive").alias("sign"), "tweet_id", "score")
    best = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(F.abs("score")), F.col("tweet_id").cast("string")))
    most = requests.agg(F.max("n")).scalar()
    daily = dated.withColumn("place", best("user_id", "day", "sign")).where(F.col("place") <= most).drop("place")
    met = requests.join(daily, "user_id").where(F.col("day").between(F.col("start"), F.col("end")))
    return met.withColumn("place", best("request_id", "sign")).where("place <= n").select("request_id", "sign", "place", "tweet_id", "score")


def tagged(df: DataFrame) -> DataFrame:
    """One row per tweet and tag."""
    return df.select("tweet_id", "user_id", "created_at", "text", F.explode(F.array("tag1", "tag2")).alias("tag")).where("tag is not null")


def hashtag_daily(df: DataFrame) -> DataFrame:
    """(tag, date, n, n_users, tweet_id, text): rows as they come, repeats too; the text is the earliest, then the least."""
    rows = tagged(df).withColumn("date", F.date_format("created_at", "yyyy-MM-dd"))
    grouped = rows.groupBy("tag", "date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("n_users"),
                                              F.min(F.struct("created_at", "text", "tweet_id")).alias("first"))
    return grouped.select("tag", "date", "n", "n_users", "first.tweet_id", "first.text")


def hashtag_users(df: DataFrame, page_size: int = 1000) -> DataFrame:
    """(tag, date, page, users): the distinct users in order of number, as comma-separated pages."""
    users = tagged(df).select("tag", F.date_format("created_at", "yyyy-MM-dd").alias("date"), "user_id").distinct()
    pages = paged(users, ["tag", "date"], ["user_id"], F.col("user_id"), page_size)
    return pages.select("tag", "date", "page", F.array_join(F.col("items").cast("array<string>"), ",").alias("users"))


def top_days(daily: DataFrame, tag: str, n: int) -> DataFrame:
    return daily.where(F.col("tag") == tag).orderBy(F.desc("n"), "date").limit(n).select("tag", "date", "n")


def tweets_per_user(df: DataFrame) -> DataFrame:
    return df.groupBy("user_id").agg(F.count_distinct("tweet_id").alias("n_tweets"))


def cumulative_counts(counts: DataFrame) -> DataFrame:
    """(user_id, n_tweets, so_far): the counts of all users up to this one."""
    return running_sums(counts, [], ["user_id"], {"so_far": F.col("n_tweets")})


def count_range(counts: DataFrame, low: int, high: int) -> DataFrame:
    """The tweets of the users in the range, both ends included; 0 if there are none."""
    inside = counts.where(F.col("user_id").between(low, high))
    return inside.agg(F.coalesce(F.sum("n_tweets"), F.lit(0).cast("long")).alias("n_tweets"))


def count_ranges(counts: DataFrame, ranges: DataFrame) -> DataFrame:
    """(range_id, n_tweets): the tweets of the users in each range (range_id, low, high), both ends included.

    A range is what is summed up to its end less what is summed up before its start. Both ends
    go as rows without tweets among the users and read the running sum there, in one
    sliced scan; no range is joined with the users in it. A range whose end lies before its start, or
    with a null end, has none.
    """
    ends = ranges.select("range_id", F.inline(F.array(
        F.struct(F.col("low").alias("user_id"), F.lit(0).alias("kind"), F.lit(-1).alias("sign")), F.struct(F.col("high").alias("user_id"), F.lit(2).alias("kind"), F.lit(1).alias("sign")))))
    users = counts.where("user_id is not null").select(F.lit(None).cast(dict(ranges.dtypes)["range_id"]).alias("range_id"), "user_id", F.lit(1).alias("kind"), F.lit(0).alias("sign"), "n_tweets")
    both = users.unionByName(ends.withColumn("n_tweets", F.lit(0).cast("long")))
    read = running_sums(both, [], ["user_id", "kind", "range_id"], {"so_far": F.col("n_tweets")}).where("kind <> 1")
    found = read.groupBy("range_id").agg(F.sum(F.col("sign") * F.col("so_far")).cast("long").alias("n_tweets"), F.count("user_id").alias("n_ends"))
    return found.select("range_id", F.when(F.col("n_ends") == 2, F.greatest("n_tweets", F.lit(0))).otherwise(0).cast("long").alias("n_tweets"))
