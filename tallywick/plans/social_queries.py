"""Social graph: followers, profiles, timelines, home pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywick.operators import social as ops
from tallywick.plans.registry import query

_FOLLOWERS = """
    with f as (select followee id, name, profile from follows join userinfo on follower = id),
    a as (select id, 'Unauthorized' as name, '#' as profile from userinfo where id not in (select followee from follows))
    select id, name, profile, count(*) n from (select * from f union all select * from a) group by all order by id, name, profile"""


def _counted(df):
    """Nearly all rows differ, so they are dealt out by content, as wide as the session says, before they are counted: the
    tasks that join hold no map of them, and no task gets more of them because they are small when packed."""
    wide = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(wide, "id", "name", "profile").groupBy("id", "name", "profile").agg(F.count(F.lit(1)).alias("n")).orderBy("id", "name", "profile")


@query("j07_followers", "J07 O09", views=("follows", "userinfo"), sql=_FOLLOWERS)
def followers(t):
    return _counted(ops.followers(t.follows, t.userinfo))


@query("j07_followers_from_cells", "J07 X25", views=("follows", "userinfo"), sql=_FOLLOWERS)
def from_cells(t):
    return _counted(ops.followers(ops.cell_ids(ops.follower_cells(t.follows)), t.userinfo))


@query("j08_profiles", "J08 P19 X28", views=("userinfo",), sql="""
    select id, 'returnRes({"name":"' || case when id % 3 = 0 then 'Unauthorized' else name end || '","profile":"' || case when id % 3 = 0 then '#' else profile end || '"})' answer from userinfo""")
def profiles(t):
    asked = t.userinfo.select("id", F.when(F.col("id") % 3 == 0, F.lit("wrong")).otherwise(F.col("password")).alias("password"))
    return ops.profiles(asked, t.userinfo).select("id", ops.returned(F.to_json(F.struct("name", "profile"))).alias("answer"))


@query("c10_timelines", "C10 J07 J09 W08 U02 O09 X27", views=("follows", "userinfo", "posts"), sql="""
    with f as (select followee id, name, profile, row_number() over (partition by followee order by name, profile, follower) n from follows join userinfo on follower = id),
    l as (select id, (n - 1) // 20 page, string_agg('{"name":"' || name || '","profile":"' || profile || '"}', ',' order by n) followers from f group by all),
    s as (select follower id, post_id, ts, post, row_number() over (partition by follower order by ts desc, post_id desc) k from follows join posts on followee = user_id),
    p as (select id, string_agg('{"post_id":' || post_id || ',"post":"' || post || '"}', ',' order by ts, post_id) posts from s where k <= 30 group by 1),
    h as (select id, 0::bigint page, name, profile, posts from userinfo left join p using (id))
    select id, page, case when name is null then '{"followers":[' || followers || ']}' else '{"name":"' || name || '","profile":"' || profile || '","followers":[' || coalesce(followers, '')
      || '],"posts":[' || coalesce(posts, '') || ']}' end as document
    from h full join (select * from l where id in (select id from userinfo)) l using (id, page)""")
def timeline_documents(t):
    return ops.timeline_documents(t.userinfo, t.follows, t.posts, 30, 20)


@query("w08_timelines", "W08 J09 U02", views=("follows", "posts"), sql="""
    with s as (select follower id, post_id, ts, row_number() over (partition by follower order by ts desc, post_id desc) k from follows join posts on followee = user_id)
    select id, cast(row_number() over (partition by id order by ts, post_id) as int) place, post_id, epoch_us(ts) at_us from s where k <= 30""")
def timelines(t):
    return ops.timelines(t.follows, t.posts).select("id", "place", "post_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"))


@query("c11_home_pages", "C11 O10 X27", views=("posts",), sql="""
    select user_id, cast(floor((n - 1)/20) as bigint) page, '[' || string_agg('{"post_id":' || post_id || ',"post":"' || post || '"}', ',' order by n) || ']' as document
    from (select *, row_number() over (partition by user_id order by ts, post_id) n from posts) group by 1, 2""")
def home_pages(t):
    return ops.home_pages(t.posts, 20)
