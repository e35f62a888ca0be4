"""Riders and drivers: the grid against all pairs, the stream against a loop for any cut into micro-batches."""

import datetime
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from test_jobs import plain_matches
from tallywick.session import new_path
from tallywick.streaming import matching


def plain_nearest(requests, drivers):
    out = []
    for seq, rider, block, x, y in requests:
        away = [(((x - dx) ** 2 + (y - dy) ** 2) ** 0.5, d) for b, d, dx, dy in drivers if b == block and dx is not None] if x is not None else []
        if away:
            out.append((seq, rider, min(away)[1], round(min(away)[0], 9)))
    return sorted(out)


def nearest(spark, requests, drivers, kind="double", **options):
    asked = spark.createDataFrame(requests, f"seq long, rider_id string, block_id long, longitude {kind}, latitude {kind}")
    spots = spark.createDataFrame(drivers, f"block_id long, driver_id string, longitude {kind}, latitude {kind}")
    return sorted((r["seq"], r["rider_id"], r["driver_id"], round(r["away"], 9)) for r in matching.nearest_in_block(asked, spots, **options).collect())


@pytest.mark.parametrize("shape", ["even", "corner", "line", "point", "two clusters"])
def test_grid_against_all_pairs(spark, shape):
    """Block 1 holds half the rows; requests lie inside and far outside of where the drivers are."""
    rng = random.Random(shape)
    place = {
        "even": lambda: (rng.uniform(0, 100), rng.uniform(0, 100)), "corner": lambda: (rng.betavariate(1, 30) * 100, rng.betavariate(1, 30) * 100),
        "line": lambda: (rng.uniform(0, 100), 5.0), "point": lambda: (3.0, 4.0), "two clusters": lambda: rng.choice([(rng.uniform(0, 1), rng.uniform(0, 1)), (rng.uniform(999, 1000), rng.uniform(999, 1000))]),
    }[shape]
    block = lambda: 1 if rng.random() < 0.5 else rng.randrange(2, 9)
    drivers = [(block(), str(i), *place()) for i in range(400)] + [(1, "a", None, 2.0)]
    requests = [(i, f"r{i}", block(), rng.uniform(-50, 150), rng.uniform(-50, 150)) for i in range(150)] + [(900, "r", 77, 1.0, 1.0), (901, "r", 1, None, 1.0), (902, "r", 1, 5000.0, -3000.0)]
    assert nearest(spark, requests, drivers) == plain_nearest(requests, drivers)


def test_grid_ties(spark):
    """On whole places many drivers are equally near: the first id as text."""
    rng = random.Random(1)
    drivers = [(rng.randrange(2), str(rng.randrange(10_000)), rng.randrange(12), rng.randrange(12)) for _ in range(150)]
    requests = [(i, "r", rng.randrange(2), rng.randrange(-3, 15), rng.randrange(-3, 15)) for i in range(200)]
    for per_cell in (1, 4, 1000):
        assert nearest(spark, requests, drivers, "int", per_cell=per_cell) == plain_nearest(requests, drivers)


def test_nothing_asked_or_nobody_there(spark):
    assert nearest(spark, [], [(1, "d", 1.0, 1.0)]) == [] == nearest(spark, [(1, "r", 1, 1.0, 1.0)], [])


def test_probes_stay_in_the_rings(spark):
    """Evenly spread, a request meets a few cells' drivers, not the block's."""
    rng = random.Random(2)
    drivers = spark.createDataFrame([(1, str(i), rng.uniform(0, 1), rng.uniform(0, 1)) for i in range(4000)], "block_id long, driver_id string, longitude double, latitude double")
    asked = spark.createDataFrame([(i, "r", 1, rng.uniform(0, 1), rng.uniform(0, 1)) for i in range(300)], "seq long, rider_id string, block_id long, longitude double, latitude double")
    met = []
    whole = matching.cut

    def counted(df, label):
        done = whole(df, label)
        if label == "probed":
            met.append((done.count(), done.where("not done").count()))
        return done

    matching.cut = counted
    try:
        assert matching.nearest_in_block(asked, drivers).count() == 300
    finally:
        matching.cut = whole
    assert met[0][0] == 300 and met[0][1] < 60 and len(met) <= 3


def log(n=500, seed=6):
    """Events of three blocks, the first with half of them."""
    rng, start = random.Random(seed), datetime.datetime(2024, 1, 1)
    out = []
    for seq in range(n):
        at = start + datetime.timedelta(seconds=rng.randrange(6 * 3600))
        kind = rng.choice(["DRIVER_LOCATION"] * 4 + ["ENTERING_BLOCK", "LEAVING_BLOCK", "RIDE_REQUEST", "RIDE_REQUEST", "RIDE_COMPLETE"])
        out.append((seq, at, 1 if rng.random() < 0.5 else rng.randrange(2, 4), str(rng.randrange(20)), f"r{seq}", kind, rng.choice(["AVAILABLE", "BUSY"]), rng.randrange(-40, 60), rng.randrange(100)))
    return out


def stream(spark, rows, batches, lateness="2 hours", **options):
    """The rows, up to an hour out of order, in as many files as there are micro-batches, then one event of a later day."""
    rng = random.Random(7)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", matching.ROCKSDB)
    folder = new_path(spark, "log")
    ordered = sorted(rows, key=lambda r: r[1] + datetime.timedelta(seconds=rng.randrange(3600)))
    size = -(-len(ordered) // batches)
    late = [(-1, rows[0][1] + datetime.timedelta(days=9), -1, "", "", "", "", 0, 0)]
    for part in [ordered[i:i + size] for i in range(0, len(ordered), size)] + [late]:
        spark.createDataFrame(part, matching.EVENT).coalesce(1).write.mode("append").parquet(folder)
    events = matching.read_stream(spark, "parquet", matching.EVENT, folder, maxFilesPerTrigger="1")
    moved = F.col("type") == "DRIVER_LOCATION"
    path = new_path(spark, "matches")
    matching.write_stream(matching.match_drivers(events.where(moved), events.where(~moved), lateness, **options), path, new_path(spark, "state")).awaitTermination()
    return sorted(map(tuple, spark.read.schema(matching.MATCH).parquet(path).collect()), key=repr)


def wanted(rows):
    names = ["seq", "ts", "block_id", "driver_id", "rider_id", "type", "status", "longitude", "latitude"]
    return sorted(plain_matches([dict(zip(names, r)) for r in rows]), key=repr)


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_any_cut_gives_the_same_matches(spark, batches):
    rows = log()
    got = stream(spark, rows, batches)
    assert got == wanted(rows) and sum(r[3] is not None for r in got) > 50


def test_buckets_and_cells_do_not_matter(spark):
    rows = log(200, 8)
    assert stream(spark, rows, 2, bucket_ms=60_000, side=3) == stream(spark, rows, 1, bucket_ms=7_200_000, side=500) == wanted(rows)


class Held(dict):
    """A state variable in memory."""

    exists = lambda self: "value" in self
    update = lambda self, value: self.__setitem__("value", value)
    containsKey = dict.__contains__
    getValue = dict.__getitem__
    updateValue = dict.__setitem__
    removeKey = dict.__delitem__
    iterator = dict.items

    def get(self):
        return self["value"]


class Handle:
    """The handle of a processor whose state is in memory; it counts the entries written."""

    def __init__(self):
        self.timers, self.maps, self.writes = set(), {}, 0

    def getMapState(self, name, *_):
        self.maps[name] = Held()
        self.maps[name].updateValue = lambda k, v: (setattr(self, "writes", self.writes + 1), dict.__setitem__(self.maps[name], k, v))
        return self.maps[name]

    def getValueState(self, *_):
        return Held()

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.discard(ms)


@pytest.mark.parametrize("batches,hours", [(1, 24), (1, 1), (5, 1), (40, 1)])
def test_events_wait_in_parts(batches, hours):
    """Far-apart events share entries of the state, in any order of coming, and are taken when the watermark has passed them."""
    rows = [r for r in log(600, 9) if r[2] == 1]
    random.Random(1).shuffle(rows)
    handle, matcher, got = Handle(), matching.Matcher(60_000, 10), []
    matcher.init(handle)
    columns = ["seq", "ts", "block_id", "driver_id", "rider_id", "type", "status", "longitude", "latitude"]
    for i in range(batches):
        list(matcher.handleInputRows((1,), [pd.DataFrame(rows[i::batches], columns=columns)], None))
    assert handle.writes <= len(rows) // matching.PART + 2 * batches
    start = int(datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc).timestamp() * 1000)
    for hour in range(hours, 25, hours):
        mark = start + hour * 3_600_000
        while (timers := [t for t in handle.timers if t <= mark]):
            handle.timers.discard(min(timers))
            times = SimpleNamespace(getExpiryTimeInMs=lambda: min(timers)), SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)  # noqa: B023
            for frame in matcher.handleExpiredTimer((1,), times[1], times[0]):
                got += frame.itertuples(index=False, name=None)
    assert sorted(got, key=repr) == wanted(rows) and not handle.maps["waiting"]


@pytest.mark.parametrize("most", [3, 10_000])
def test_state_grid_against_a_scan(monkeypatch, most):
    """Drivers few and far apart are found by rings or, past a number of cells, by a look at all."""
    monkeypatch.setattr(matching, "MOST_CELLS", most)
    rng, cells, where, box, plain = random.Random(3), Held(), Held(), Held(), {}
    for step in range(400):
        grid = matching.Grid(cells, where, box, 10)
        for _ in range(5):
            driver, x, y = str(rng.randrange(25)), rng.randrange(-300, 300), rng.randrange(-300, 300)
            if rng.random() < 0.5:
                grid.put(driver, x, y)
                plain[driver] = (x, y)
            elif rng.random() < 0.5:
                grid.remove(driver)
                plain.pop(driver, None)
            want = min(((dx - x) ** 2 + (dy - y) ** 2, d) for d, (dx, dy) in plain.items())[1] if plain else None
            assert grid.nearest(x, y) == want
        grid.write()
    assert {d: tuple(at) for (d,), at in where.items()} == plain
