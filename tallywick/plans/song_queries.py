"""Songs: the eleven questions on the catalogue and its sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywick.operators import songs as ops
from tallywick.plans.registry import query

WORD, ARTIST = "ECONOMY", "Brand#7 "


def _count(df):
    return df.agg(F.count(F.lit(1)).alias("n"))


@query("p11_any_column", "P11 C09", views=("songs",), sql=f"""
    select count(*) n from songs where concat_ws(chr(1), track_id, title, artist_id, artist_name, release, duration, yr) like '%{WORD}%'""")
def any_column(t):
    return _count(ops.grep_rows(t.songs, WORD))


@query("p12_artist_contains", "P12 C09", views=("songs",), sql=f"select count(*) n from songs where contains(artist_name, '{ARTIST}')")
def artist(t):
    return _count(t.songs.where(ops.contains(F.col("artist_name"), ARTIST)))


@query("p13_artist_any_case", "P13 C09", views=("songs",), sql=f"select count(*) n from songs where contains(lower(artist_name), lower('{ARTIST.upper()}'))")
def artist_any_case(t):
    return _count(t.songs.where(ops.contains(F.col("artist_name"), ARTIST.upper(), ignore_case=True)))


@query("a05_average_duration", "A05 C09", views=("songs",), sql="""
    select round(sum(coalesce(duration, 0))/count(*), 6) blanks_as_zero, round(avg(duration), 6) blanks_left_out from songs""")
def average(t):
    return ops.averages(t.songs, "duration").select(*[F.round(c, 6).alias(c) for c in ("blanks_as_zero", "blanks_left_out")])


@query("j04_songs_sales", "J04 C09", views=("songs", "sales"), sql="select track_id, sales_date, sales_count, title, artist_id, artist_name, release, duration, yr from sales join songs using (track_id)")
def joined(t):
    return ops.join_songs_sales(t.sales, t.songs)


@query("a17_sales_by_artist", "A17 C09", views=("songs", "sales"), sql="select artist_id, cast(sum(sales_count) as bigint) sales_count from sales join songs using (track_id) group by 1")
def by_artist(t):
    return ops.sales_by_artist(t.sales, t.songs)


@query("j14_top_artist", "J14 C09", views=("songs", "sales"), sql="""
    with b as (select artist_id, cast(sum(sales_count) as bigint) sales_count from sales join songs using (track_id) group by 1 order by 2 desc, 1 desc limit 1)
    select artist_id, sales_count, min(artist_name) artist_name from songs join b using (artist_id) group by 1, 2""")
def top(t):
    return ops.top_artist(t.sales, t.songs)


@query("o05_longest_track", "O05 C09", views=("songs",), sql="select track_id from songs order by duration desc nulls last, track_id limit 1")
def longest(t):
    return ops.longest_track(t.songs)


@query("a18_rows_by_artist", "A18 C09", views=("songs",), sql="select artist_id, count(*) n_rows, min(artist_name) artist_name from songs group by 1")
def rows(t):
    return ops.rows_by_artist(t.songs)


@query("o06_third_artist", "O06 C09", views=("songs",), sql="""
    select artist_name from (select artist_id, count(*) n, min(artist_name) artist_name from songs group by 1) order by n desc, artist_id limit 1 offset 2""")
def third(t):
    return ops.nth_artist(t.songs)
