"""Monitoring: failure runs, health, alarms, latest load."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywick.operators import monitor as ops
from tallywick.plans.registry import query

_RUNS = """with g as (select *, sum(case when ok then 1 else 0 end) over (partition by instance order by ts, event_id) gb,
  sum(case when ok then 0 else 1 end) over (partition by instance order by ts, event_id) gg from probes),
r as (select *, case when ok then 0 else row_number() over (partition by instance, gb, ok order by ts, event_id) end bad,
  case when ok then row_number() over (partition by instance, gg, ok order by ts, event_id) else 0 end good from g)
"""


@query("m01_failure_alerts", "M01 W07", views=("probes",), sql=_RUNS + "select instance, event_id from r where bad = 3")
def alerts(t):
    return ops.failure_alerts(t.probes).select("instance", "event_id")


@query("m02_health_states", "M02 W07", views=("probes",), sql=_RUNS + """
    select instance, event_id, last_value(case when good >= 2 then true when bad >= 2 then false end ignore nulls) over (partition by instance order by ts, event_id) healthy from r""")
def health(t):
    return ops.health_states(t.probes, good=2, bad=2)


@query("m03_threshold_alarms", "M03 T07", views=("probes",), sql="""
    select instance, epoch_us(time_bucket(interval 1 hour, ts)) start_us, round(avg(util), 6) mean, case when avg(util) > 70 then 2 else -2 end step
    from probes group by 1, 2 having avg(util) > 70 or avg(util) < 30""")
def alarms(t):
    found = ops.threshold_alarms(t.probes, "1 hour")
    return found.select("instance", F.unix_micros(F.col("start").cast("timestamp")).alias("start_us"), F.round("mean", 6).alias("mean"), "step")


@query("m04_latest_util", "M04", views=("probes",), sql="""
    with w as (select instance, time_bucket(interval 1 hour, ts) s, avg(util) mean, max(util) most from probes where ts > (select max(ts) from probes) - interval 2 day group by 1, 2)
    select instance, round(arg_max(mean, s), 6) mean, max(most) most from w group by 1""")
def latest(t):
    return ops.latest_util(t.probes, "1 hour", "2 days").select("instance", F.round("mean", 6).alias("mean"), "most")
