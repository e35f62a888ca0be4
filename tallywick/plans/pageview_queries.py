"""Page views: the filters one by one, the roll-up, and the answers on an hour and a month."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywick.operators import pageviews as pv
from tallywick.plans.registry import query

START, DAYS, MIN_TOTAL = "2024-01-01", 30, 200
HOUR = "2024-01-05"
TITLES = ("View_3", "Click_4", "Signup_7", "Error_1", "Purchase_2")

_PREFIX = "|".join(p[:-1] for p in pv.PREFIXES)
_NO_PREFIX = f"not regexp_matches(title, '^({_PREFIX}):')"
_NO_EXTENSION = "not regexp_matches(title, '[.](jpg|gif|png|JPG|GIF|PNG|txt|ico)$')"
_NO_PAGE = "title not in ('404_error/', 'Main_Page', 'Hypertext_Transfer_Protocol', 'Search')"
_CLEAN = f"project = 'en' and title <> '' and {_NO_PREFIX} and {_NO_EXTENSION} and not regexp_matches(title, '^[a-z]') and {_NO_PAGE}"
_MONTH = f"""with clean as (select * from pagecounts where {_CLEAN}),
daily as (select title, dt, cast(sum(views) as bigint) v from clean where views is not null group by 1, 2),
days as (select cast(date '{START}' + cast(i as int) as date) dt, i from range({DAYS}) t(i)),
tot as (select title, cast(sum(v) as bigint) total from daily join days using (dt) group by 1 having sum(v) > {MIN_TOTAL}),
dense as (select title, total, days.dt, i, coalesce(v, 0) v from tot cross join days left join daily using (title, dt))
"""


def hour(t):
    return t.pagecounts.where(F.col("dt") == HOUR)


def pages(t):
    return pv.popular(pv.daily_views(pv.clean_pagecounts(t.pagecounts)), START, DAYS, MIN_TOTAL)


def _filtered(name, covers, keep, sql):
    @query(name, covers, views=("pagecounts",), sql=f"select title, cast(count(*) as bigint) n, cast(sum(views) as bigint) views from pagecounts where {sql} group by title")
    def run(t):
        return t.pagecounts.where(keep(F.col("title"))).groupBy("title").agg(F.count(F.lit(1)).alias("n"), F.sum("views").alias("views"))


_filtered("p05_no_name_space", "P05", pv.no_prefix, _NO_PREFIX)
_filtered("p06_no_file", "P06", pv.no_extension, _NO_EXTENSION)
_filtered("p07_no_lower_start", "P07", pv.no_lower_start, "not regexp_matches(title, '^[a-z]')")
_filtered("p08_no_boilerplate", "P08", pv.no_boilerplate, _NO_PAGE)
_filtered("p10_film_titles", "P10", lambda title: title.rlike("(film)"), "regexp_matches(title, '(film)')")


@query("p09_clean_pagecounts", "P09 A03 A04", views=("pagecounts",), sql=f"""
    select project, title, dt, cast(hr as int) hr, cast(count(*) as bigint) n, cast(sum(views) as bigint) views from pagecounts where {_CLEAN} group by all""")
def clean(t):
    lines = pv.clean_pagecounts(t.pagecounts)
    return lines.groupBy("project", "title", "dt", "hr").agg(F.count(F.lit(1)).alias("n"), F.sum("views").alias("views"))


@query("c02_hourly_answers", "C02 A03 A04 A15 A16 O03 P10", views=("pagecounts",), sql=f"""
    with raw as (select * from pagecounts where dt = date '{HOUR}'), clean as (select * from raw where {_CLEAN}),
    film as (select coalesce(sum(views) filter (regexp_matches(title, '(2014_film)')), 0) a, coalesce(sum(views) filter (regexp_matches(title, '(2015_film)')), 0) b from clean)
    select (select count(*) from raw) n_lines, (select cast(sum(views) as bigint) from raw) n_requests, (select count(*) from clean) n_filtered,
      (select title from clean where regexp_matches(title, '^[A-Z]') order by views desc, title limit 1) top_title,
      (select max(views) from clean where regexp_matches(title, '^[A-Z]')) top_views, (select max(views) from clean where regexp_matches(title, '(film)')) top_film_views,
      (select count(*) from clean where views > 50 and regexp_matches(title, '^[A-Z]')) n_above,
      (select coalesce(cast(sum(views) as bigint), 0) from clean where regexp_matches(title, '^(Click)(.*)(1)$')) list_views,
      (select case when a > b then '2014' else '2015' end from film) film_year""")
def hourly(t):
    return pv.hour_answers(hour(t), "en", 50, "^(Click)(.*)(1)$")


@query("a07_daily_pivot", "A07 C03 X16", views=("pagecounts",), sql=_MONTH + """
    select total, title, string_agg(strftime(dt, '%Y%m%d') || ':' || v, chr(9) order by i) line from dense group by 1, 2""")
def pivot(t):
    return pv.pivot_line(pages(t), START)


@query("c03_rows", "C03 A03", views=("pagecounts",), sql=_MONTH + "select count(*) n from tot")
def rows(t):
    return pages(t).agg(F.count(F.lit(1)).alias("n"))


@query("o03_most_and_least_popular", "O03 C03", views=("pagecounts",), sql=_MONTH + """
    select * from (select 'most' which, title, total from tot order by total desc, title desc limit 1)
    union all select * from (select 'least', title, total from tot order by total, title limit 1)""")
def most_and_least(t):
    return pv.most_and_least(pages(t))


@query("o04_top_without_first_day", "O04 C03", views=("pagecounts",), sql=_MONTH + """
    select title, total from dense where i = 0 and v = 0 order by total desc, title desc limit 1""")
def without_first_day(t):
    return pv.top_without_first_day(pages(t))


@query("a21_days_ahead", "A21 C03", views=("pagecounts",), sql=_MONTH + f"""
    select count(*) n_days from dense a join (select * from days left join (select dt, v from dense where title = '{TITLES[1]}') using (dt)) b using (dt)
    where a.title = '{TITLES[0]}' and a.v > coalesce(b.v, 0)""")
def days_ahead(t):
    return pv.days_ahead(pages(t), *TITLES[:2])


@query("w06_ranked_by_best_day", "W06 A13 J15 C03", views=("pagecounts",), sql=_MONTH + f"""
    select string_agg(title, ',' order by m desc, title desc) ranking from (select title, max(v) m from dense where title in {TITLES} group by 1)""")
def by_best_day(t):
    return pv.ranked_titles(pages(t), TITLES, F.array_max("by_day"))


@query("w06_ranked_by_total", "W06 J15 C03", views=("pagecounts",), sql=_MONTH + f"""
    select string_agg(title, ',' order by total desc, title desc) ranking from tot where title in {TITLES}""")
def by_total(t):
    return pv.ranked_titles(pages(t), TITLES, F.col("total"))


@query("a14_best_day", "A14 A13 C03", views=("pagecounts",), sql=_MONTH + """
    select title, case when max(v) > 0 then strftime(arg_min(dt, (-v, dt)), '%Y%m%d') end best_date, max(v) best_views from dense group by 1""")
def best_day(t):
    return pv.best_day(pages(t), START)


_DECLINE = _MONTH + """, falls as (select title, i, v < lag(v) over (partition by title order by i) f from dense),
runs as (select title, sum(case when f then 0 else 1 end) over (partition by title order by i) g, f from falls),
best as (select title, max(n) steps from (select title, g, count(*) filter (f) n from runs group by 1, 2) group by 1)
"""


@query("w03_longest_decline", "W03", views=("pagecounts",), sql=_DECLINE + "select title, cast(steps as int) steps from best")
def decline(t):
    return pv.longest_decline(pages(t))


@query("w03_declining_pages", "W03 C03", views=("pagecounts",), sql=_DECLINE + "select cast(steps as int) steps, count(*) n_titles from best group by 1 order by 1 desc limit 1")
def declining(t):
    return pv.declining_pages(pages(t))
