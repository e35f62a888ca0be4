"""Drivers and riders: a keyed state machine per block, and the same question asked of a table."""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator
from math import floor

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallywick.session import cut

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: The columns of an event: order, block, what happened, who, where.
EVENT = "seq long, ts timestamp, block_id long, driver_id string, rider_id string, type string, status string, longitude int, latitude int"
MATCH = "block_id long, seq long, rider_id string, driver_id string"
#: What an event can say.
TYPES = ("DRIVER_LOCATION", "ENTERING_BLOCK", "LEAVING_BLOCK", "RIDE_REQUEST", "RIDE_COMPLETE")
SIDE = 10  # of the state's grid cells
BUCKET_MS = 900_000  # events of a block that are taken together
PART = 128  # events that wait in one entry of the state
AT_ONCE = 5000  # matches that are sent on together
MOST_CELLS = 256  # looked at for a request before all free drivers are


def read_stream(spark: SparkSession, fmt: str, schema: str | None = None, path: str | None = None, **options: str) -> DataFrame:
    """A stream from its oldest record; files need a schema and a path, Kafka its servers and topic."""
    reader = spark.readStream.format(fmt).options(**({"startingOffsets": "earliest"} if fmt == "kafka" else {}), **options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def write_stream(df: DataFrame, path: str, checkpoint: str):
    """Appends records as Parquet; state and offsets are in `checkpoint`, so a restart goes on where it was."""
    return df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(locations: DataFrame, events: DataFrame) -> DataFrame:
    """The two input streams as one, told apart by type."""
    return locations.unionByName(events)


class Grid:
    """A block's free drivers in cells of the state, read when touched and written back once."""

    def __init__(self, cells, where, box, side: int):
        self.cells, self.where, self.box, self.side = cells, where, box, side
        self.read: dict[tuple[int, int], dict[str, list[int]]] = {}
        self.places: dict[str, tuple[int, int] | None] = {}
        self.known = self.extent = tuple(box.get()) if box.exists() else None

    def cell(self, at: tuple[int, int]) -> dict[str, list[int]]:
        if at not in self.read:
            self.read[at] = json.loads(self.cells.getValue(at)[0]) if self.cells.containsKey(at) else {}
        return self.read[at]

    def cell_of(self, x: int, y: int) -> tuple[int, int]:
        return floor(x / self.side), floor(y / self.side)

    def remove(self, driver: str) -> None:
        if driver not in self.places:
            self.places[driver] = tuple(self.where.getValue((driver,))) if self.where.containsKey((driver,)) else None
        at = self.places[driver]
        if at is not None:
            del self.cell(self.cell_of(*at))[driver]
            self.places[driver] = None

    def put(self, driver: str, x: int, y: int) -> None:
        self.remove(driver)
        cx, cy = self.cell_of(x, y)
        self.cell((cx, cy))[driver] = [x, y]
        self.places[driver] = (x, y)
        low_x, high_x, low_y, high_y = self.extent or (cx, cx, cy, cy)
        self.extent = min(low_x, cx), max(high_x, cx), min(low_y, cy), max(high_y, cy)

    def nearest(self, x: int, y: int) -> str | None:
        """By rings of cells about the place, until no cell further out can hold a driver as near; first id as text of equally near ones."""
        if self.extent is None:
            return None
        low_x, high_x, low_y, high_y = self.extent
        cx, cy = self.cell_of(x, y)
        best: tuple[int, str] | None = None
        ring = max(low_x - cx, cx - high_x, low_y - cy, cy - high_y, 0)
        last, looked = max(high_x - cx, cx - low_x, high_y - cy, cy - low_y), 0
        while ring <= last:
            if looked > MOST_CELLS:  # few drivers, far apart
                places = dict((driver, tuple(at)) for (driver,), at in self.where.iterator()) | self.places
                away = [((at[0] - x) ** 2 + (at[1] - y) ** 2, driver) for driver, at in places.items() if at is not None]
                return min(away)[1] if away else None
            border = min(x - (cx - ring + 1) * self.side, (cx + ring) * self.side - x, y - (cy - ring + 1) * self.side, (cy + ring) * self.side - y)
            if best is not None and border > 0 and border * border > best[0]:
                break
            for at in self.ring(cx, cy, ring):
                looked += 1
                for driver, (dx, dy) in self.cell(at).items():
                    found = ((dx - x) ** 2 + (dy - y) ** 2, driver)
                    best = found if best is None or found < best else best
            ring += 1
        return best[1] if best else None

    def ring(self, cx: int, cy: int, r: int) -> Iterator[tuple[int, int]]:
        """The cells at distance r that lie in the extent."""
        low_x, high_x, low_y, high_y = self.extent
        for at_x in range(max(low_x, cx - r), min(high_x, cx + r) + 1):
            rows = range(max(low_y, cy - r), min(high_y, cy + r) + 1) if abs(at_x - cx) == r else {cy - r, cy + r}
            yield from ((at_x, at_y) for at_y in rows if low_y <= at_y <= high_y)

    def write(self) -> None:
        for at, drivers in self.read.items():
            if drivers:
                self.cells.updateValue(at, (json.dumps(drivers),))
            elif self.cells.containsKey(at):
                self.cells.removeKey(at)
        for driver, at in self.places.items():
            if at is not None:
                self.where.updateValue((driver,), at)
            elif self.where.containsKey((driver,)):
                self.where.removeKey((driver,))
        if self.extent is not None and self.extent != self.known:
            self.box.update(self.extent)


class Matcher(StatefulProcessor):
    """State of a block: events that wait for their time, and its free drivers in grid cells.

    An event waits until the watermark has passed its bucket of time; then the bucket's
    events are taken in order of (ts, seq). The answer doesn't depend on how the stream is cut into
    micro-batches. Events wait in parts: those of an Arrow batch in order of time, up to PART in an entry of the state
    under its first bucket, so sparse events don't cost an entry each. A task holds one Arrow batch of events, or one
    bucket of a block and the parts that reach past it, at a time.

    A position makes a driver free there, whatever was before. Leaving takes the driver out,
    entering puts it in only if it is available, a completed ride puts it in again. A request
    takes the nearest free driver, of equally near ones the first id as text, out of the block and sends the
    match; without one the match has no driver. Rows without a block, a time, a known type, or a driver
    or place where one is needed are passed over.
    """

    def __init__(self, bucket_ms: int = BUCKET_MS, side: int = SIDE):
        self.bucket_ms, self.side = bucket_ms, side

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket long, part long", "events string")
        self.parts = handle.getValueState("parts", "n long")
        self.first = handle.getValueState("first", "bucket long")
        self.cells = handle.getMapState("cells", "x int, y int", "drivers string")
        self.where = handle.getMapState("where", "driver_id string", "longitude int, latitude int")
        self.box = handle.getValueState("box", "low_x int, high_x int, low_y int, high_y int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            new = []
            for r in frame[frame["type"].isin(TYPES)].itertuples(index=False):
                if pd.isna(r.ts):
                    continue
                text = [x if isinstance(x, str) else None for x in (r.driver_id, r.rider_id, r.status)]
                place = [int(r.longitude), int(r.latitude)] if pd.notna(r.longitude) and pd.notna(r.latitude) else None
                new.append([r.ts.value, int(r.seq), r.type, *text, place])
            if new:
                new.sort(key=lambda e: e[:2])
                self.keep(new)
                self.wake(self.bucket(new[0]))
        yield pd.DataFrame([], columns=["block_id", "seq", "rider_id", "driver_id"])

    def bucket(self, event: list) -> int:
        return event[0] // 1_000_000 // self.bucket_ms

    def keep(self, events: list) -> None:
        """Sorted events into new parts."""
        n = self.parts.get()[0] if self.parts.exists() else 0
        for at in range(0, len(events), PART):
            part = events[at:at + PART]
            self.waiting.updateValue((self.bucket(part[0]), n), (json.dumps(part),))
            n += 1
        self.parts.update((n,))

    def wake(self, bucket: int) -> None:
        """One timer, at the end of the first bucket that waits."""
        set_for = self.first.get()[0] if self.first.exists() else None
        if set_for is not None and set_for <= bucket:
            return
        if set_for is not None:
            self.handle.deleteTimer((set_for + 1) * self.bucket_ms)
        self.handle.registerTimer((bucket + 1) * self.bucket_ms)
        self.first.update((bucket,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Takes the buckets that the watermark has passed, in order of time; what waits beside them in their parts waits on."""
        first, passed = expiredTimerInfo.getExpiryTimeInMs() // self.bucket_ms - 1, timerValues.getCurrentWatermarkInMs()
        self.first.clear()
        end = max(first, passed // self.bucket_ms - 1)  # the last bucket that is due
        keys = sorted(tuple(k) for k in self.waiting.keys())
        due, held = [k for k in keys if k[0] <= end], []
        grid, out = Grid(self.cells, self.where, self.box, self.side), []
        for i, part in enumerate(due):
            held += json.loads(self.waiting.getValue(part)[0])
            self.waiting.removeKey(part)
            # Whole buckets before the next part's first one stand complete.
            until = min(end + 1, due[i + 1][0]) if i + 1 < len(due) else end + 1
            if until == part[0]:
                continue
            held.sort(key=lambda e: e[:2])
            ready = bisect_left(held, until, key=self.bucket)
            out += self.taken(key[0], grid, held[:ready])
            held = held[ready:]
            if len(out) >= AT_ONCE:
                yield pd.DataFrame(out, columns=["block_id", "seq", "rider_id", "driver_id"])
                out = []
        if held:
            self.keep(held)
        later = [k[0] for k in keys if k[0] > end] + [self.bucket(e) for e in held[:1]]
        if later:
            self.wake(min(later))
        grid.write()
        yield pd.DataFrame(out, columns=["block_id", "seq", "rider_id", "driver_id"])

    @staticmethod
    def taken(block: int, grid: Grid, events: list) -> list[tuple]:
        """The matches of sorted or unsorted events of whole buckets."""
        out = []
        for _, seq, kind, driver, rider, status, place in sorted(events, key=lambda e: e[:2]):
            if kind == "RIDE_REQUEST":
                if place is not None:
                    found = grid.nearest(*place)
                    if found is not None:
                        grid.remove(found)
                    out.append((block, seq, rider, found))
            elif driver is None:
                continue
            elif kind == "LEAVING_BLOCK":
                grid.remove(driver)
            elif place is not None and (kind != "ENTERING_BLOCK" or status == "AVAILABLE"):
                grid.put(driver, *place)
        return out

    def close(self) -> None:
        pass


def match_drivers(locations: DataFrame, events: DataFrame, lateness: str = "0 seconds", bucket_ms: int = BUCKET_MS, side: int = SIDE) -> DataFrame:
    """(block_id, seq, rider_id, driver_id): a row for each request; needs the RocksDB state store.

    Events may come up to `lateness` after later ones; those that come after that are dropped. The
    events of the last bucket are answered when an event past it has come.
    """
    both = merged(locations, events).withWatermark("ts", lateness).where("block_id is not null")
    return both.groupBy("block_id").transformWithStateInPandas(Matcher(bucket_ms, side), outputStructType=MATCH, outputMode="append", timeMode="EventTime")


def positions(events: DataFrame) -> DataFrame:
    """(block_id, driver_id, longitude, latitude): each driver's last position in each block."""
    placed = events.where("type = 'DRIVER_LOCATION' and driver_id is not null")
    last = F.max_by(F.struct("longitude", "latitude"), F.struct("ts", "seq")).alias("at")
    return placed.groupBy("block_id", "driver_id").agg(last).select("block_id", "driver_id", "at.longitude", "at.latitude")


PER_CELL = 4  # spots of a cell, about


def _cell(x: Column, low: Column) -> Column:
    return F.floor((x - low) / F.col("side")).cast("long")


def nearest_in_block(requests: DataFrame, drivers: DataFrame, per_cell: float = PER_CELL) -> DataFrame:
    """(seq, rider_id, driver_id, away): the nearest driver of the block, the first id as text of equally near ones.

    Each block has a grid over its drivers, with cells that hold about `per_cell` occupied spots if
    they are spread evenly. A place asked from probes its own cell and the ring about it, or the
    nearest rings that meet the grid; places whose best driver is not nearer than what lies past
    the ring go on with the next rings, twice as many each time. So a place meets the spots of the rings it probes
    and no others. The join is on the cell, so a block with most of the rows is spread over its
    cells; equal places are asked once, and drivers on one spot are reduced to the first.
    Requests without a place or in a block without drivers have no row.
    """
    x, y = F.col("x"), F.col("y")
    spots = drivers.where("longitude is not null and latitude is not null").groupBy("block_id", F.col("longitude").cast("double").alias("x"), F.col("latitude").cast("double").alias("y"))
    spots = cut(spots.agg(F.min(F.col("driver_id").cast("string")).alias("driver_id")), "spots")
    wide, high = F.col("high_x") - F.col("low_x"), F.col("high_y") - F.col("low_y")
    longest = F.greatest(wide, high)
    side = F.greatest(F.sqrt(wide * high * per_cell / F.col("n")), longest * per_cell / F.col("n"))
    grid = spots.groupBy("block_id").agg(F.min("x").alias("low_x"), F.max("x").alias("high_x"), F.min("y").alias("low_y"), F.max("y").alias("high_y"), F.count(F.lit(1)).alias("n"))
    grid = grid.withColumn("side", F.when(longest > 0, side).otherwise(F.lit(1.0)))
    cells = spots.join(grid, "block_id").select("block_id", _cell(x, F.col("low_x")).alias("cx"), _cell(y, F.col("low_y")).alias("cy"), F.col("x").alias("sx"), F.col("y").alias("sy"), "driver_id")
    cells = cut(cells, "cells")
    asked = requests.select("seq", "rider_id", "block_id", F.col("longitude").cast("double").alias("x"), F.col("latitude").cast("double").alias("y")).where("x is not null and y is not null")
    places = asked.select("block_id", "x", "y").distinct().join(grid, "block_id")
    places = places.withColumn("px", _cell(x, F.col("low_x"))).withColumn("py", _cell(y, F.col("low_y")))
    places = places.withColumn("end_x", _cell(F.col("high_x"), F.col("low_x"))).withColumn("end_y", _cell(F.col("high_y"), F.col("low_y")))
    outside = F.greatest(-F.col("px"), F.col("px") - F.col("end_x"), -F.col("py"), F.col("py") - F.col("end_y"), F.lit(0))
    best_type = "struct<away:double,driver_id:string>"
    open_ = cut(places.select("*", outside.alias("inner"), F.lit(None).cast(best_type).alias("best")).withColumn("outer", F.col("inner") + 1), "places")
    answers = None
    while not open_.limit(1).isEmpty():
        within = lambda at, end: F.sequence(F.greatest(F.col(at) - F.col("outer"), F.lit(0)), F.least(F.col(at) + F.col("outer"), F.col(end)))
        meets = lambda at, end: (F.col(at) - F.col("outer") <= F.col(end)) & (F.col(at) + F.col("outer") >= 0)
        probes = open_.where(meets("px", "end_x") & meets("py", "end_y")).select("block_id", "x", "y", "px", "py", "inner", "outer", "end_y", F.explode(within("px", "end_x")).alias("cx"))
        probes = probes.withColumn("cy", F.explode(within("py", "end_y"))).where(F.greatest(F.abs(F.col("cx") - F.col("px")), F.abs(F.col("cy") - F.col("py"))) >= F.col("inner"))
        away = F.sqrt(F.pow(x - F.col("sx"), F.lit(2)) + F.pow(y - F.col("sy"), F.lit(2)))
        met = probes.join(cells, ["block_id", "cx", "cy"]).groupBy("block_id", "x", "y").agg(F.min(F.struct(away.alias("away"), "driver_id")).alias("new"))
        seen = open_.join(met, ["block_id", "x", "y"], "left").withColumn("best", F.coalesce(F.least("best", "new"), "best", "new")).drop("new")
        # The least distance of what is past the outer ring, less what rounding may add.
        edge = lambda c, at, low: F.least(F.col(c) - (F.col(low) + (F.col(at) - F.col("outer")) * F.col("side")), F.col(low) + (F.col(at) + F.col("outer") + 1) * F.col("side") - F.col(c))
        border = F.least(edge("x", "px", "low_x"), edge("y", "py", "low_y")) - F.col("side") * 1e-9
        whole = (F.col("px") - F.col("outer") <= 0) & (F.col("px") + F.col("outer") >= F.col("end_x")) & (F.col("py") - F.col("outer") <= 0) & (F.col("py") + F.col("outer") >= F.col("end_y"))
        judged = cut(seen.withColumn("done", whole | F.coalesce(F.col("best.away") < border, F.lit(False))), "probed")
        found = judged.where("done").select("block_id", "x", "y", "best")
        answers = found if answers is None else answers.unionByName(found)
        open_ = judged.where("not done").drop("done").withColumn("inner", F.col("outer") + 1).withColumn("outer", F.col("outer") * 2 + 1)
    if answers is None:
        return asked.limit(0).select("seq", "rider_id", F.lit("").alias("driver_id"), F.lit(0.0).alias("away"))
    return asked.join(answers, ["block_id", "x", "y"]).select("seq", "rider_id", "best.driver_id", "best.away")
