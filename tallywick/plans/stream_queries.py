"""Streams over the events table: driver matching, window alarms; and their batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywick.operators import monitor
from tallywick.plans.registry import query
from tallywick.plans.views import VIEWS
from tallywick.session import new_path
from tallywick.streaming import matching


def _events(t):
    """The events table as a stream of files, from its first file on; the pattern takes one file or a folder of them."""
    path = f"{t.folder}/events.parquet*"
    return matching.read_stream(t.spark, "parquet", _schema(t), path)


def _schema(t) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.events.schema)


def _cabs(frame):
    rows = frame.sparkSession.sql(VIEWS["cab_events"], events=frame)
    return rows.select("seq", F.col("ts").cast("timestamp").alias("ts"), "block_id", F.col("driver_id").cast("string").alias("driver_id"),
                       F.col("rider_id").cast("string").alias("rider_id"), "type", "status", "longitude", "latitude")


def _matched(t):
    """The events as a log of files that ends with one of a later day, so that the watermark passes all of them."""
    t.spark.conf.set("spark.sql.streaming.stateStore.providerClass", matching.ROCKSDB)
    log = new_path(t.spark, "cab-log")
    _cabs(t.events).write.parquet(log)
    rows = t.spark.read.schema(matching.EVENT).parquet(log)
    closing = rows.agg(F.max("ts").alias("last")).select(
        F.lit(-1).cast("long").alias("seq"), (F.coalesce("last", F.current_timestamp()) + F.expr("interval 1 day")).alias("ts"), F.lit(-1).cast("long").alias("block_id"),
        *[F.lit("").alias(c) for c in ("driver_id", "rider_id", "type", "status")], F.lit(0).alias("longitude"), F.lit(0).alias("latitude"))
    closing.write.mode("append").parquet(log)
    cabs = matching.read_stream(t.spark, "parquet", matching.EVENT, log)
    moved = F.col("type") == "DRIVER_LOCATION"
    path = new_path(t.spark, "matches")
    matching.write_stream(matching.match_drivers(cabs.where(moved), cabs.where(~moved)), path, new_path(t.spark, "matches-state")).awaitTermination()
    return t.spark.read.schema(matching.MATCH).parquet(path)


@query("t03_matches", "T01 T02 T03 T04 J12 S13 S14 U03 F04", views=("cab_events",), sql="""
    with recursive e as (
      select *, driver_id::varchar d, row_number() over (partition by block_id order by ts, seq) n from cab_events
    ), s as (
      select block_id, 0::bigint n, [{'d': '', 'x': 0, 'y': 0}][:0] free, null::bigint seq, null::varchar rider_id, null::varchar driver_id from (select distinct block_id from e)
      union all
      select block_id, n, case when kind = 'RIDE_REQUEST' then list_filter(free, lambda f: f.d is distinct from taken)
          when kind in ('DRIVER_LOCATION', 'RIDE_COMPLETE') or kind = 'ENTERING_BLOCK' and status = 'AVAILABLE' then list_append(list_filter(free, lambda f: f.d <> d), {'d': d, 'x': x, 'y': y})
          when kind = 'LEAVING_BLOCK' then list_filter(free, lambda f: f.d <> d) else free end,
        case when kind = 'RIDE_REQUEST' then seq end, rider_id, case when kind = 'RIDE_REQUEST' then taken end
      from (
        select e.block_id, e.n, e.type kind, e.status, e.d, e.longitude x, e.latitude y, e.seq, e.rider_id::varchar rider_id, s.free,
          list_sort(list_transform(s.free, lambda f: {'away': (f.x - e.longitude)*(f.x - e.longitude) + (f.y - e.latitude)*(f.y - e.latitude), 'd': f.d}))[1].d taken
        from s join e on e.block_id = s.block_id and e.n = s.n + 1
      )
    ) select block_id, seq, rider_id, driver_id from s where seq is not null""")
def matches(t):
    return _matched(t)


@query("t03_answered_requests", "T03 T04 S13 S14", views=("cab_events",), sql="select seq, block_id, rider_id::varchar rider_id from cab_events where type = 'RIDE_REQUEST'")
def answered(t):
    return _matched(t).select("seq", "block_id", "rider_id")


@query("t01_positions", "T01", views=("cab_events",), sql="""
    select block_id, driver_id::varchar driver_id, arg_max(longitude, seq_order) longitude, arg_max(latitude, seq_order) latitude
    from (select *, (ts, seq) seq_order from cab_events where type = 'DRIVER_LOCATION') group by 1, 2""")
def positions(t):
    return matching.positions(_cabs(t.events))


@query("j13_nearest_in_block", "J13 X19", views=("cab_events",), sql="""
    with d as (select block_id, driver_id::varchar driver_id, arg_max(longitude, (ts, seq)) x, arg_max(latitude, (ts, seq)) y from cab_events where type = 'DRIVER_LOCATION' group by 1, 2),
    m as (select r.seq, r.rider_id, d.driver_id, sqrt(pow(longitude - x, 2) + pow(latitude - y, 2)) away from cab_events r join d using (block_id) where type = 'RIDE_REQUEST'),
    k as (select *, row_number() over (partition by seq, rider_id order by away, driver_id) k from m)
    select seq, rider_id::varchar rider_id, driver_id, round(away, 6) away from k where k = 1""")
def nearest(t):
    cabs = _cabs(t.events)
    found = matching.nearest_in_block(cabs.where("type = 'RIDE_REQUEST'"), matching.positions(cabs))
    return found.withColumn("away", F.round("away", 6))


@query("t07_stream_windows", "T07 S13", views=("probes",), sql="select instance, epoch_us(time_bucket(interval 1 hour, ts)) start_us, round(avg(util), 6) mean, max(util) most from probes group by 1, 2")
def stream_windows(t):
    path = new_path(t.spark, "windows")
    probes = t.spark.sql(VIEWS["probes"], events=_events(t))
    found = monitor.windows(probes, "1 hour")
    started = found.writeStream.outputMode("complete").option("checkpointLocation", new_path(t.spark, "windows-state")).trigger(availableNow=True)
    started.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path)).start().awaitTermination()
    rows = t.spark.read.parquet(path)
    return rows.select("instance", F.unix_micros(F.col("start").cast("timestamp")).alias("start_us"), F.round("mean", 6).alias("mean"), "most")
