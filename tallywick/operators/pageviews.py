"""Page-view logs: title filters, daily roll-up, and the questions asked of an hour and a month."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Name spaces, file endings and pages that are not articles.
PREFIXES = (
    "Media:", "Special:", "Talk:", "User:", "User_talk:", "Project:", "Project_talk:", "File:", "File_talk:", "MediaWiki:",
    "MediaWiki_talk:", "Template:", "Template_talk:", "Help:", "Help_talk:", "Category:", "Category_talk:", "Portal:",
    "Wikipedia:", "Wikipedia_talk:",
)
EXTENSIONS = (".jpg", ".gif", ".png", ".JPG", ".GIF", ".PNG", ".txt", ".ico")
BOILERPLATE = ("404_error/", "Main_Page", "Hypertext_Transfer_Protocol", "Search")


def _any(tests: Sequence[Column]) -> Column:
    out = F.lit(False)
    for test in tests:
        out = out | test
    return out


def no_prefix(title: Column, prefixes: Sequence[str] = PREFIXES) -> Column:
    return ~_any([title.startswith(p) for p in prefixes])


def no_extension(title: Column, extensions: Sequence[str] = EXTENSIONS) -> Column:
    return ~_any([title.endswith(e) for e in extensions])


def no_lower_start(title: Column) -> Column:
    return ~title.rlike("^[a-z]")


def no_boilerplate(title: Column, pages: Sequence[str] = BOILERPLATE) -> Column:
    return ~title.isin(*pages)


def is_article(project: str = "en") -> Column:
    """Whether a line is an article of the project; false for a null project or title."""
    title = F.col("title")
    kept = (F.col("project") == project) & (title != "") & no_prefix(title) & no_extension(title) & no_lower_start(title) & no_boilerplate(title)
    return F.coalesce(kept, F.lit(False))


def clean_pagecounts(df: DataFrame, project: str = "en") -> DataFrame:
    """The article lines of one project."""
    return df.where(is_article(project))


def daily_views(clean: DataFrame) -> DataFrame:
    """(title, dt, views): one row per title and day that has any line; views that are no number are left out."""
    return clean.where("views is not null").groupBy("title", "dt").agg(F.sum("views").alias("views"))


def popular(daily: DataFrame, start: str, days: int, min_total: int) -> DataFrame:
    """(title, total, by_day): titles whose total over the days exceeds `min_total`; by_day has each day, missing ones 0.

    One aggregate with a conditional sum per day of the given calendar, so the pivot's width is
    `days` whatever the data.
    """
    first = datetime.date.fromisoformat(start)
    place = F.datediff("dt", F.lit(first))
    inside = daily.where((place >= 0) & (place < days)).withColumn("place", place)
    sums = [F.sum(F.when(F.col("place") == d, F.col("views")).otherwise(0)).alias(f"d{d}") for d in range(days)]
    grouped = inside.groupBy("title").agg(F.sum("views").alias("total"), *sums).where(F.col("total") > min_total)
    return grouped.select("title", "total", F.array(*[F.col(f"d{d}") for d in range(days)]).alias("by_day"))


def pivot_line(pages: DataFrame, start: str) -> DataFrame:
    """(total, title, line): the days as yyyymmdd:views, tab-separated."""
    day = lambda i: F.date_format(F.date_add(F.lit(start).cast("date"), i), "yyyyMMdd")
    line = F.array_join(F.transform("by_day", lambda v, i: F.concat(day(i), F.lit(":"), v.cast("string"))), "\t")
    return pages.select("total", "title", line.alias("line"))


def hour_answers(raw: DataFrame, project: str = "en", above: int = 2500, lists: str = "^(List_of)(.*)(episodes)$") -> DataFrame:
    """The nine answers on one hour's file, in one row and one pass.

    Of pages with equally many views the first by name counts as the most popular.
    """
    title, views, clean = F.col("title"), F.col("views"), is_article(project)
    upper = clean & title.rlike("^[A-Z]")
    total = lambda test: F.coalesce(F.sum(F.when(clean & test, views)), F.lit(0))
    films = lambda year: total(title.rlike(f"({year}_film)"))
    return raw.agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("views").alias("n_requests"), F.count_if(clean).alias("n_filtered"),
        F.min_by("title", F.when(upper, F.struct((-views).alias("v"), "title"))).alias("top_title"), F.max(F.when(upper, views)).alias("top_views"),
        F.max(F.when(clean & title.rlike("(film)"), views)).alias("top_film_views"), F.count_if((views > above) & upper).alias("n_above"),
        total(title.rlike(lists)).alias("list_views"), F.when(films(2014) > films(2015), "2014").otherwise("2015").alias("film_year"),
    )


def most_and_least(pages: DataFrame) -> DataFrame:
    """(which, title, total): the last title by name wins a tie for most, the first for least."""
    found = pages.agg(F.max(F.struct("total", "title")).alias("most"), F.min(F.struct("total", "title")).alias("least"))
    return found.selectExpr("stack(2, 'least', least, 'most', most) as (which, p)").select("which", "p.title", "p.total").where("title is not null")


def top_without_first_day(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("by_day")[0] == 0).orderBy(F.desc("total"), F.desc("title")).limit(1).select("title", "total")


def days_ahead(pages: DataFrame, first: str, second: str) -> DataFrame:
    """On how many days `first` has strictly more views than `second`; a title that is missing has none."""
    one = lambda t: F.max(F.when(F.col("title") == t, F.col("by_day")))
    both = pages.where(F.col("title").isin(first, second)).agg(one(first).alias("a"), one(second).alias("b"))
    ahead = F.filter(F.zip_with("a", F.coalesce("b", F.transform("a", lambda _: F.lit(0).cast("long"))), lambda a, b: a > b), lambda x: x)
    return both.select(F.coalesce(F.size(ahead), F.lit(0)).cast("long").alias("n_days"))


def ranked_titles(pages: DataFrame, titles: Sequence[str], measure: Column) -> DataFrame:
    """The listed titles, highest measure first, as one comma-separated text; ties in falling order of name."""
    listed = pages.where(F.col("title").isin(*titles)).select(F.struct(measure.alias("m"), "title").alias("s"))
    return listed.agg(F.array_join(F.transform(F.sort_array(F.collect_list("s"), False), lambda s: s["title"]), ",").alias("ranking"))


def best_day(pages: DataFrame, start: str) -> DataFrame:
    """(title, best_date, best_views): the earliest day of most views as yyyymmdd; null where all are zero."""
    top = F.array_max("by_day")
    at = F.array_position("by_day", top) - 1
    day = F.date_format(F.date_add(F.lit(start).cast("date"), at.cast("int")), "yyyyMMdd")
    return pages.select("title", F.when(top > 0, day).alias("best_date"), top.alias("best_views"))


def longest_decline(pages: DataFrame) -> DataFrame:
    """(title, steps): the longest run of days that each have fewer views than the day before."""
    start = F.struct(F.lit(0).cast("long").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s: Column, v: Column) -> Column:
        run = F.when(v < s["last"], s["run"] + 1).otherwise(0)
        return F.struct(v.cast("long").alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return pages.select("title", F.aggregate("by_day", start, step, lambda s: s["best"]).alias("steps"))


def declining_pages(pages: DataFrame) -> DataFrame:
    """(steps, n_titles) of the longest decline that any title has."""
    counts = longest_decline(pages).groupBy("steps").agg(F.count(F.lit(1)).alias("n_titles"))
    return counts.agg(F.max(F.struct("steps", "n_titles")).alias("m")).select("m.steps", "m.n_titles")
