"""Scalars: text, time, numbers, JSON, the letter-square codec."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywick.functions import scalars as fn
from tallywick.operators import tweets
from tallywick.plans.registry import query
from tallywick.sources import tables as src

_TURN = "'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', 'NOPQRSTUVWXYZABCDEFGHIJKLMnopqrstuvwxyzabcdefghijklm'"


@query("x08_text_scalars", "X08 X11 X12", sql=rf"""
    select doc_id, md5(translate(text, {_TURN})) turned, replace(replace(replace(text, chr(9), '&#TAB;'), chr(10), '&#LF;'), chr(13), '&#CR;') escaped, text restored,
      replace(source || '\' || lang, '\', '\\') doubled from documents""")
def text_scalars(t):
    text = F.col("text")
    return t.documents.select("doc_id", F.md5(fn.rot13(text)).alias("turned"), tweets.escape(text).alias("escaped"), tweets.unescape(tweets.escape(text)).alias("restored"),
                              fn.doubled_backslashes(F.concat("source", F.lit("\\"), "lang")).alias("doubled"))


@query("x13_time_scalars", "X13 X14 X16 X18 X31", sql="""
    select event_id, epoch_us(date_trunc('second', ts)) parsed_us, strftime(ts, '%Y-%m-%d+%H:%M:%S') wire, strftime(ts, '%Y-%m-%d %H:%M:%S') requested,
      epoch_us(ts - interval 5 hour) shifted_us, cast(date_diff('day', date '2024-01-01', cast(ts as date)) as int) day_index from events""")
def time_scalars(t):
    ts = F.col("ts").cast("timestamp")
    tweet = F.concat(F.date_format(ts, "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format(ts, "yyyy"))
    wire = F.date_format(ts, "yyyy-MM-dd+HH:mm:ss")
    return t.events.select("event_id", F.unix_micros(tweets.parse_tweet_time(tweet)).alias("parsed_us"), wire.alias("wire"), tweets.requested_time(wire).alias("requested"),
                           F.unix_micros(fn.shifted(ts, -5)).alias("shifted_us"), F.datediff(ts, F.lit("2024-01-01").cast("date")).alias("day_index"))


@query("x19_number_scalars", "X19 X20 X26", views=("cab_events",), sql="""
    select event_id, round(sqrt(pow(longitude - 50, 2) + pow(latitude - 50, 2)), 6) away, floor(value*100 + 0.5)/100 rounded, cast(props->>'$.k' as int) k
    from events join cab_events on event_id = seq""")
def number_scalars(t):
    rows = t.events.join(t.cab_events.select(F.col("seq").alias("event_id"), "longitude", "latitude"), "event_id")
    away = fn.distance(F.col("longitude"), F.col("latitude"), F.lit(50), F.lit(50))
    return rows.select("event_id", F.round(away, 6).alias("away"), fn.half_up(F.col("value")).alias("rounded"), F.from_json("props", "k int")["k"].alias("k"))


@query("x15_file_names", "X15 X29", views=("pagecounts",), sql="""
    select strftime(dt, '%Y%m%d') date, lpad(hr::varchar, 2, '0') || '0000' as hour, title || ':' || views || ',' || project line, count(*) n from pagecounts group by all""")
def file_names(t):
    path = F.concat(F.lit("/logs/pagecounts-"), F.date_format("dt", "yyyyMMdd"), F.lit("-"), F.lpad(F.col("hr").cast("string"), 2, "0"), F.lit("0000.gz"))
    line = F.concat_ws(",", F.concat_ws(":", "title", F.col("views").cast("string")), "project")
    rows = t.pagecounts.select(src.file_date(path).alias("date"), src.file_hour(path).alias("hour"), line.alias("line"))
    return rows.groupBy("date", "hour", "line").agg(F.count(F.lit(1)).alias("n"))


@query("f02_decoded_messages", "F02 X23", views=("messages",), sql="""
    with m as (
      -- The last hundred digits of a key are the divisor's own, so the quotient is that of the rest and a hundred noughts, and one.
      select msg_id, message, (floor(left(key, length(key) - 100)::decimal(10,0) * 1.20889789338507272917896585)::bigint + 1) % 25 + 1 z, floor(sqrt(length(message)))::bigint n from messages
    ), c as (select msg_id, z, p // n + p % n diagonal, p % n col, ascii(message[p + 1]) - z code from (select *, unnest(range(n * n)) p from m))
    select msg_id, coalesce(string_agg(chr((case when code < 65 then code + 26 else code end)::int), '' order by diagonal, col desc), '') message from m left join c using (msg_id) group by msg_id""")
def decoded(t):
    return fn.decode_messages(t.messages)
