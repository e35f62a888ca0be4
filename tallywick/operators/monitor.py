"""Fleet monitoring: alerts on runs of failed probes, health states, load alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallywick.operators.slices import carried_forward, run_lengths

ORDER = ["ts", "event_id"]


def failure_alerts(probes: DataFrame, n: int = 3) -> DataFrame:
    """(instance, ts, event_id): the n-th failed probe of each run; a success ends the run. A null result is no failure."""
    runs = run_lengths(probes, ["instance"], ORDER, {"failed": ~F.col("ok")})
    return runs.where(F.col("failed") == n).select("instance", "ts", "event_id")


def health_states(probes: DataFrame, good: int = 2, bad: int = 6) -> DataFrame:
    """(instance, event_id, healthy): true from the `good`-th success in a row, false from the `bad`-th failure, else as before; null at first."""
    runs = run_lengths(probes, ["instance"], ORDER, {"_good": F.col("ok"), "_bad": ~F.col("ok")})
    turned = F.when(F.col("_good") >= good, True).when(F.col("_bad") >= bad, False)
    return carried_forward(runs, ["instance"], ORDER, {"healthy": turned}).select("instance", "event_id", "healthy")


def windows(probes: DataFrame, width: str = "60 seconds") -> DataFrame:
    """(instance, start, mean, most) of the load in each window; works on streams too."""
    w = F.window("ts", width)
    return probes.groupBy("instance", w.alias("w")).agg(F.avg("util").alias("mean"), F.max("util").alias("most")).select("instance", F.col("w.start").alias("start"), "mean", "most")


def step(mean: Column, high: float = 70, low: float = 30) -> Column:
    """+2 machines above `high`, -2 below `low`, both strict."""
    return F.when(mean > high, 2).when(mean < low, -2).otherwise(0)


def threshold_alarms(probes: DataFrame, width: str = "60 seconds", high: float = 70, low: float = 30) -> DataFrame:
    """(instance, start, mean, step) of the windows that raise an alarm."""
    found = windows(probes, width).withColumn("step", step(F.col("mean"), high, low))
    return found.where("step <> 0").select("instance", "start", "mean", "step")


def latest_util(probes: DataFrame, width: str = "60 seconds", back: str = "30 minutes") -> DataFrame:
    """(instance, mean, most): the latest window's mean and the highest load of the span that ends with the table's last probe."""
    last = probes.agg(F.max("ts")).scalar()
    recent = probes.where(F.col("ts") > last - F.expr(f"interval {back}"))
    return windows(recent, width).groupBy("instance").agg(F.max_by("mean", "start").alias("mean"), F.max("most").alias("most"))
