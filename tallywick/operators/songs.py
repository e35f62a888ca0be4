"""A song catalogue and its sales: text search, averages, join, top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def grep_rows(df: DataFrame, needle: str, ignore_case: bool = False) -> DataFrame:
    """Rows of which any column contains the text; a null column contains nothing."""
    return df.where(any_contains([F.col(c).cast("string") for c in df.columns], needle, ignore_case))


def any_contains(columns: list[Column], needle: str, ignore_case: bool = False) -> Column:
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(contains(c, needle, ignore_case), F.lit(False))
    return found


def contains(column: Column, needle: str, ignore_case: bool = False) -> Column:
    return F.lower(column).contains(needle.lower()) if ignore_case else column.contains(needle)


def averages(df: DataFrame, column: str) -> DataFrame:
    """The mean with blanks as zero, and over the known values only; null for no rows."""
    total, n = F.sum(column), F.count(F.lit(1))
    return df.agg((F.coalesce(total, F.lit(0.0)) / F.when(n > 0, n)).alias("blanks_as_zero"), F.avg(column).alias("blanks_left_out"))


def join_songs_sales(sales: DataFrame, songs: DataFrame) -> DataFrame:
    """Sales with their song, sales columns first."""
    return sales.join(songs, "track_id")


def sales_by_artist(sales: DataFrame, songs: DataFrame) -> DataFrame:
    return join_songs_sales(sales, songs.select("track_id", "artist_id")).groupBy("artist_id").agg(F.sum("sales_count").alias("sales_count"))


def top_artist(sales: DataFrame, songs: DataFrame) -> DataFrame:
    """The name of the artist who sold most: the first by name of the names in use; the last id wins a tie."""
    best = sales_by_artist(sales, songs).orderBy(F.desc("sales_count"), F.desc("artist_id")).limit(1)
    return songs.join(best, "artist_id").groupBy("artist_id", "sales_count").agg(F.min("artist_name").alias("artist_name"))


def longest_track(songs: DataFrame) -> DataFrame:
    return songs.orderBy(F.desc_nulls_last("duration"), "track_id").limit(1).select("track_id")


def rows_by_artist(songs: DataFrame) -> DataFrame:
    return songs.groupBy("artist_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min("artist_name").alias("artist_name"))


def nth_artist(songs: DataFrame, n: int = 3) -> DataFrame:
    """The name of the artist with the n-th most rows; ties in order of id."""
    return rows_by_artist(songs).orderBy(F.desc("n_rows"), "artist_id").offset(n - 1).limit(1).select("artist_name")
