"""Social graph: profiles, followers, timelines, home pages; each for all users in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywick.operators.slices import paged
from tallywick.session import cut

NO_NAME, NO_PROFILE = "Unauthorized", "#"


def followers(follows: DataFrame, info: DataFrame) -> DataFrame:
    """(id, name, profile): each user's followers that have a profile; one row of defaults for a user of `info` without any follower."""
    known = follows.join(info.select(F.col("id").alias("follower"), "name", "profile"), "follower").select(F.col("followee").alias("id"), "name", "profile")
    alone = info.select("id").join(follows.select(F.col("followee").alias("id")), "id", "left_anti")
    return known.unionByName(alone.select("id", F.lit(NO_NAME).alias("name"), F.lit(NO_PROFILE).alias("profile")))


def follower_cells(follows: DataFrame, page_size: int = 1000) -> DataFrame:
    """(id, page, cell): follower ids in order, as cells separated by dashes, of at most `page_size` ids."""
    pages = paged(follows, ["followee"], ["follower"], F.col("follower"), page_size)
    return pages.select(F.col("followee").alias("id"), "page", F.array_join(F.col("items").cast("array<string>"), "-").alias("cell"))


def cell_ids(cells: DataFrame) -> DataFrame:
    """(followee, follower) from cells."""
    return cells.select(F.col("id").alias("followee"), F.explode(F.split("cell", "-").cast("array<long>")).alias("follower"))


def profiles(requests: DataFrame, info: DataFrame) -> DataFrame:
    """(id, name, profile) for requests (id, password): the defaults where id and password are not on file together."""
    known = info.select("id", "password", "name", "profile")
    return requests.join(known, ["id", "password"], "left").select("id", F.coalesce("name", F.lit(NO_NAME)).alias("name"), F.coalesce("profile", F.lit(NO_PROFILE)).alias("profile"))


def sent_posts(follows: DataFrame, posts: DataFrame, n: int) -> DataFrame:
    """(follower, post_id, ts): posts of those a user follows, among them the latest n.

    Only a followee's own latest n can be among them, and of the followees only the n with the
    newest latest posts. A follow first brings its followee's marks alone, the times of its 1st, 2nd, 4th, 8th ... latest
    post: they tell of a time since which a user has been sent n posts. Posts before that time stay
    where they are, so a user meets about 2n posts, however many it follows (more only if they are of one time).
    """
    latest = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("post_id")))
    own = posts.where("user_id is not null").withColumn("_place", latest).where(F.col("_place") <= n)
    recent = cut(own.select(F.col("user_id").alias("followee"), "_place", "post_id", "ts"), "recent-posts")
    places = [1 << k for k in range(n.bit_length())]
    at = lambda place, column: F.max(F.when(F.col("_place") == place, F.col(column)))
    marks = recent.where(F.col("_place").isin(places)).groupBy("followee").agg(at(1, "post_id").alias("_newest"), *[at(p, "ts").alias(f"_at{p}") for p in places])
    newest = F.row_number().over(Window.partitionBy("follower").orderBy(F.desc("_at1"), F.desc("_newest")))
    nearest = follows.select("follower", "followee").join(marks, "followee").withColumn("_rank", newest).where(F.col("_rank") <= n)
    asked = nearest.groupBy("follower").agg(F.collect_list(F.struct("followee", *[f"_at{p}" for p in places])).alias("_asked"))  # at most n
    posted = lambda e: F.array(*[F.struct(e[f"_at{p}"].alias("ts"), F.lit(p - p // 2).alias("n")) for p in places])
    known = F.sort_array(F.filter(F.flatten(F.transform("_asked", posted)), lambda m: m["ts"].isNotNull()), asc=False)
    none = F.struct(F.lit(0).alias("n"), F.lit(None).cast(posts.schema["ts"].dataType).alias("since"))
    step = lambda seen, m: F.struct((seen["n"] + m["n"]).alias("n"), F.when((seen["n"] < n) & (seen["n"] + m["n"] >= n), m["ts"]).otherwise(seen["since"]).alias("since"))
    dated = asked.select("follower", F.aggregate(known, none, step)["since"].alias("_since"), "_asked").select("follower", "_since", F.inline("_asked"))
    wanted = cut(dated.where("_since is null or _at1 >= _since").select("follower", "followee", "_since"), "wanted-posts")
    return wanted.join(recent.drop("_place"), "followee").where("_since is null or ts >= _since").select("follower", "post_id", "ts")


def timelines(follows: DataFrame, posts: DataFrame, n: int = 30) -> DataFrame:
    """(id, place, post_id, ts): the latest n posts of those a user follows, the oldest first."""
    latest = F.row_number().over(Window.partitionBy("follower").orderBy(F.desc("ts"), F.desc("post_id")))
    seen = sent_posts(follows, posts, n).withColumn("_place", latest).where(F.col("_place") <= n)
    oldest = F.row_number().over(Window.partitionBy("follower").orderBy("ts", "post_id"))
    return seen.select(F.col("follower").alias("id"), oldest.alias("place"), "post_id", "ts")


def home_pages(posts: DataFrame, page_size: int = 100) -> DataFrame:
    """(user_id, page, document): a user's posts in order of time as JSON arrays of at most `page_size`."""
    item = F.to_json(F.struct("post_id", "post"))
    pages = paged(posts, ["user_id"], ["ts", "post_id"], item, page_size)
    return pages.select("user_id", "page", F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("document"))


def timeline_documents(info: DataFrame, follows: DataFrame, posts: DataFrame, n: int = 30, page_size: int = 100) -> DataFrame:
    """(id, page, document): each user's timeline in pages of bounded size, all users in one job.

    The first page has the user's name, profile, first followers and the latest n posts of those the
    user follows, the oldest first; the others go on with the followers, in order of name and
    profile, `page_size` a page. Followers without a profile are left out; a user without
    followers or posts has empty lists. The follows, the pages and the timelines are stored one after the other, so that
    the disk holds the shuffles of one of them at a time.
    """
    follows = cut(follows.select("follower", "followee"), "follows")
    person = F.to_json(F.struct("name", "profile"))
    known = follows.join(info.select(F.col("id").alias("follower"), "name", "profile"), "follower").join(info.select(F.col("id").alias("followee")), "followee", "left_semi")
    named = known.select(F.col("followee").alias("id"), "name", "profile", "follower")
    listed = paged(named, ["id"], ["name", "profile", "follower"], person, page_size)
    listed = cut(listed.select("id", "page", F.array_join("items", ",").alias("followers")), "follower-pages")
    recent = timelines(follows, posts, n).join(posts.select("post_id", "post"), "post_id")
    last = recent.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("place", F.to_json(F.struct("post_id", "post")).alias("item")))).alias("items"))  # at most n
    shown = cut(last.select("id", F.array_join(F.transform("items", lambda x: x["item"]), ",").alias("posts")), "timelines")
    first = info.select("id", F.lit(0).cast("long").alias("page"), F.to_json(F.struct("name", "profile")).alias("head")).join(shown, "id", "left")
    both = first.join(listed, ["id", "page"], "full")
    people = F.concat(F.lit('"followers":['), F.coalesce("followers", F.lit("")), F.lit("]"))
    opening = F.concat(F.regexp_replace("head", "}$", ""), F.when(F.col("head") == "{}", "").otherwise(","), people, F.lit(',"posts":['), F.coalesce("posts", F.lit("")), F.lit("]}"))
    return both.select("id", "page", F.when(F.col("head").isNotNull(), opening).otherwise(F.concat(F.lit("{"), people, F.lit("}"))).alias("document"))


def returned(json: Column) -> Column:
    """The callback form in which results are sent."""
    return F.concat(F.lit("returnRes("), json, F.lit(")"))
