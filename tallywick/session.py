"""Session set-up, the shared work folder, and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = 8, app: str = "tallywick", **conf: str) -> SparkSession:
    """Session for tests and benches; a cluster job brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return use_utc(spark)


def reach_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where the driver found it only through sys.path.

    On a cluster the package is installed or sent with --py-files.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (path, root) if x)
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """All jobs read and print times in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    A machine-local temporary folder is used only by a single-machine (local) session
    that names none: on a cluster other executors could not read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tallywick-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the work folder; nothing is ever overwritten."""
    return f"{work_dir(spark)}/tallywick/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a Parquet table in the work folder and read it back.

    Ends the lineage: a lost executor costs a re-read of the table, not a re-run of the
    plan behind it. Columnar, so later reads still prune columns and push filters. What was
    shuffled for the table is dropped once it stands, so a job's disk holds one step's shuffles.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)
