"""Key-value log: write numbers, histories, as-of reads."""

from __future__ import annotations

from tallywick.operators import kvlog as ops
from tallywick.plans.registry import query


def _history(order: str) -> str:
    return f"""select k, cast(floor((n - 1)/16) as bigint) page, string_agg(v, ' ' order by n) versions
        from (select *, row_number() over (partition by k order by {order}, event_id) n from kvlog where op = 'put') group by 1, 2"""


@query("w09_write_numbers", "W09", views=("kvlog",), sql="select event_id, k, row_number() over (partition by k order by ts, event_id) seq from kvlog where op = 'put'")
def write_numbers(t):
    return ops.write_numbers(t.kvlog)


@query("k05_history_by_time", "K05 W09", views=("kvlog",), sql=_history("ts"))
def by_time(t):
    return ops.history(t.kvlog, "timestamp", 16)


@query("k05_history_by_arrival", "K05", views=("kvlog",), sql=_history("arrival"))
def by_arrival(t):
    return ops.history(t.kvlog, "arrival", 16)


@query("j16_asof_values", "J16 K06", views=("kvlog",), sql="""
    with g as (select event_id, k, ts from kvlog where op = 'get'), p as (select k, ts, event_id pid, v from kvlog where op = 'put')
    select event_id, g.k, count(v) n_versions, arg_max(v, (p.ts, pid)) latest from g left join p on g.k = p.k and p.ts <= g.ts group by 1, 2""")
def asof(t):
    return ops.asof_values(t.kvlog)
