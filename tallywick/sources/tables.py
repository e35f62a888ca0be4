"""File sources and sinks: delimited text, gzip, logs named by hour, JSON lines, Parquet layouts; reports on tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallywick.functions.scalars import rot13
from tallywick.operators.slices import numbered
from tallywick.session import cut, new_path

BUCKET_ROWS = 4_000_000  # of a bucket, about
TWEET = """id_str string, text string, created_at string, user struct<id_str: string, followers_count: string>,
 entities struct<hashtags: array<struct<text: string>>>"""


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = "|") -> DataFrame:
    """Text without a header, columns by place."""
    return spark.read.schema(schema).option("sep", sep).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_delimited(spark, path, schema, ",")


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_delimited(spark, path, schema, "\t")


def read_edges(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    return read_delimited(spark, path, "src long, dst long", sep)


def load_gzip(spark: SparkSession, path: str, schema: str, target: str, sep: str = "|") -> DataFrame:
    """Gzip files to Parquet. A gzip file is read by one task, so the rows are dealt out before they are written."""
    read_delimited(spark, path, schema, sep).repartition(spark.sparkContext.defaultParallelism).write.parquet(target)
    return spark.read.parquet(target)


def file_date(path: Column) -> Column:
    return F.regexp_extract(path, r"pagecounts-(\d{8})-(\d{6})", 1)


def file_hour(path: Column) -> Column:
    return F.regexp_extract(path, r"pagecounts-(\d{8})-(\d{6})", 2)


def read_pagecounts(spark: SparkSession, path: str) -> DataFrame:
    """(project, title, views, date, hour): blank-separated lines; date and hour from the name pagecounts-yyyymmdd-hhmmss.

    Views that are no number become null.
    """
    lines = spark.read.text(path)
    field = F.split("value", " ")
    return lines.select(F.get(field, F.lit(0)).alias("project"), F.get(field, F.lit(1)).alias("title"), F.get(field, F.lit(2)).try_cast("long").alias("views"),
                        file_date(F.input_file_name()).alias("date"), file_hour(F.input_file_name()).alias("hour"))


def read_tweets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TWEET).json(path)


def flat_tweets(tweets: DataFrame) -> DataFrame:
    return tweets.select("id_str", F.col("user.id_str").alias("user_id"), F.col("user.followers_count").alias("followers_count"), "text",
                         F.col("entities.hashtags.text").alias("tags"))


def _last_lines(lines: DataFrame, key: str) -> DataFrame:
    """Of lines with one key the last in the last file, by name."""
    place = F.struct("_file", "_start", "_line")
    rest = [c for c in lines.columns if c not in (key, "_file", "_start", "_line")]
    return lines.groupBy(key).agg(*[F.max_by(c, place).alias(c) for c in rest])


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(word, score) of lines `word<tab>score`, any number of them.

    A line with more or fewer fields, or a score that is no whole number, is passed over; of
    repeated words the last line counts.
    """
    lines = spark.read.text(path).select(F.split(F.trim("value"), "\t").alias("f"), F.col("_metadata.file_path").alias("_file"),
                                         F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_line"))
    fields = lines.where("size(f) = 2").select(F.col("f")[0].alias("word"), F.trim(F.col("f")[1]).try_cast("long").alias("score"), "_file", "_start", "_line")
    return _last_lines(fields.where("score is not null"), "word")


def read_banned(spark: SparkSession, path: str) -> DataFrame:
    """(word) of a list stored in ROT13, a word a line; blank lines are passed over."""
    return spark.read.text(path).select(rot13(F.trim("value")).alias("word")).where("word <> ''").distinct()


def write_banned(words: DataFrame, path: str) -> str:
    """The column `word` in the stored form."""
    words.select(rot13(F.col("word"))).write.text(path)
    return path


def write_tsv(df: DataFrame, path: str) -> str:
    df.write.option("sep", "\t").csv(path)
    return path


def to_parquet(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_partitioned(df: DataFrame, path: str, column: str, order: Sequence[str] = ()) -> DataFrame:
    """Parquet in one folder per value of `column`; rows are dealt by it and `order`, so a large value is written by several tasks, each in order."""
    dealt = df.repartitionByRange(F.col(column), *[F.col(c) for c in order]).sortWithinPartitions(column, *order)
    dealt.write.partitionBy(column).parquet(path)
    return df.sparkSession.read.parquet(path)


def bucket_count(df: DataFrame, bucket_rows: int = BUCKET_ROWS) -> int:
    """The power of two that gives each bucket about `bucket_rows` rows, and at least the session's shuffle
    partitions: below that Spark would rather shuffle both sides of a join.
    """
    buckets, least = 1, max(df.count() / bucket_rows, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    while buckets < least:
        buckets *= 2
    return buckets


def write_clustered(df: DataFrame, label: str, by: Sequence[str], order: Sequence[str], buckets: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """A table bucketed by `by` and sorted by `order` within files; tables with the same buckets join on them without a shuffle.

    Take the `bucket_count` of the larger table for all that are joined. The rows of a key with more
    than `bucket_rows` rows are written by several tasks, each a file of the key's bucket; all
    others of a bucket by one.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    heavy = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / bucket_rows).alias("_files")).where("_files > 1")
    heavy = cut(heavy, "heavy-keys")
    tasks = heavy.agg(F.sum("_files")).first()[0]
    dealt = df.repartition(buckets, *by)
    if tasks:
        key = F.lit(True)
        renamed = heavy.withColumnsRenamed({c: f"_of_{c}" for c in by})
        for c in by:
            key = key & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
        file = F.pmod(F.xxhash64(*df.columns), F.col("_files"))
        spread = df.join(renamed, key).withColumn("_file", file).repartition(int(tasks), *by, "_file").select(*df.columns)
        dealt = df.join(renamed, key, "left_anti").repartition(buckets, *by).unionByName(spread)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    dealt.write.bucketBy(buckets, *by).sortBy(*order).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


def count_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, n)."""
    counts = [df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n")) for name, df in sorted(tables.items())]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


def table_space(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(table, bytes): what the files of each table take, in order of name; only names and sizes are read."""
    out = None
    for name, path in sorted(paths.items()):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        one = files.select(F.lit(name).alias("table"), "length")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("table").agg(F.sum("length").alias("bytes")).orderBy("table")


def _per_column(columns: Sequence[str], measures: Mapping[str, str]) -> Column:
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{m}_{i}").alias(m) for m in measures.values()]) for i, c in enumerate(columns)]
    return F.inline(F.array(*rows))


def column_space(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, bytes): the bytes of each column written as text, in one pass."""
    sums = [F.sum(F.octet_length(F.col(c).cast("string"))).alias(f"bytes_{i}") for i, c in enumerate(columns)]
    return df.agg(*sums).select(_per_column(columns, {"bytes": "bytes"}))


#: Bytes of a value that isn't text, by type; text takes its bytes and four for their number.
WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4, "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}
ADVICE = ("plain", "dictionary", "run length", "delta")


def _bits(n: Column) -> Column:
    """Bits that tell n values apart, at least one."""
    return F.greatest(F.ceil(F.log2(n.cast("double"))), F.lit(1)).cast("long")


def _step(value: Column, before: Column) -> Column:
    """How far apart two whole numbers are; the greatest long if that is no long."""
    away = F.try_subtract(value, before)
    known = value.isNotNull() & before.isNotNull()
    return F.when(known, F.coalesce(F.when(away >= 0, away).otherwise(F.try_subtract(F.lit(0), away)), F.lit((1 << 63) - 1)))


def analyze_compression(df: DataFrame, order: Sequence[str], block_rows: int = 65_536) -> DataFrame:
    """(column, n_rows, n_null, n_different, n_runs, plain_bytes, dictionary_bytes, run_bytes, delta_bytes, advice).

    The rows in `order` (which ends in a unique column) are cut into blocks, as a file's row groups
    are, by the sliced scan; in each block the different values, the runs of equal values and the
    greatest step between neighbours are counted exactly, and the sizes of the encodings follow:
    dictionary = the different values and an index for each row, run length = a value and four bytes for
    each run, delta = the first value and steps of as many bits as the greatest takes (whole numbers
    only). n_different and n_runs are sums over the blocks; a null is a value. Columns of other types
    than WIDTHS and text are left out.
    """
    kinds = {c: k for c, k in df.dtypes if k in WIDTHS or k == "string"}
    rows = numbered(df.select(*dict.fromkeys([*kinds, *order])), [], order, "_seq").withColumn("_block", F.floor((F.col("_seq") - 1) / block_rows))
    along = Window.partitionBy("_block").orderBy("_seq")
    whole = {c for c, k in kinds.items() if k in ("tinyint", "smallint", "int", "bigint")}
    value = {c: F.struct(F.col(c)) for c in kinds}  # a null is a value
    steps = rows.select("*", *[(F.coalesce(F.lag(value[c]).over(along) != value[c], F.lit(True))).alias(f"_new_{i}") for i, c in enumerate(kinds)],
                        *[_step(F.col(c).cast("long"), F.lag(c).over(along).cast("long")).alias(f"_step_{i}") for i, c in enumerate(kinds) if c in whole])
    parts = []
    for i, c in enumerate(kinds):
        known = F.when(F.col(c).isNotNull(), size_of(F.col(c), kinds[c])).otherwise(0)
        parts += [F.count_if(F.col(c).isNull()).alias(f"null_{i}"), F.count_if(f"_new_{i}").alias(f"runs_{i}"), F.sum(known).cast("long").alias(f"plain_{i}"),
                  F.sum(F.when(F.col(f"_new_{i}"), known).otherwise(0)).cast("long").alias(f"heads_{i}"), F.collect_set(value[c]).alias(f"set_{i}"),
                  (F.coalesce(F.max(f"_step_{i}"), F.lit(0)) if c in whole else F.lit(None).cast("long")).alias(f"step_{i}")]
    blocks = steps.groupBy("_block").agg(F.count(F.lit(1)).alias("n"), *parts)  # a set holds at most a block's rows
    sized = lambda i, c: F.aggregate(f"set_{i}", F.lit(0).cast("long"), lambda total, x: total + F.when(x[c].isNotNull(), size_of(x[c], kinds[c])).otherwise(0))
    entry = lambda i, c: F.struct(
        F.lit(c).alias("column"), F.col("n").alias("n_rows"), F.col(f"null_{i}").alias("n_null"), F.size(f"set_{i}").cast("long").alias("n_different"), F.col(f"runs_{i}").alias("n_runs"),
        F.col(f"plain_{i}").alias("plain_bytes"), (sized(i, c) + F.ceil(F.col("n") * _bits(F.size(f"set_{i}")) / 8)).cast("long").alias("dictionary_bytes"),
        (F.col(f"heads_{i}") + 4 * F.col(f"runs_{i}")).cast("long").alias("run_bytes"),
        F.when(F.col(f"step_{i}").isNotNull(), WIDTHS.get(kinds[c], 0) + F.ceil(F.col("n") * (_bits(F.col(f"step_{i}").cast("double") + 1) + 1) / 8)).cast("long").alias("delta_bytes"))
    cells = blocks.select(F.inline(F.array(*[entry(i, c) for i, c in enumerate(kinds)])))
    sums = ["n_rows", "n_null", "n_different", "n_runs", "plain_bytes", "dictionary_bytes", "run_bytes", "delta_bytes"]
    totals = cells.groupBy("column").agg(*[F.sum(c).cast("long").alias(c) for c in sums])
    least = F.least("plain_bytes", "dictionary_bytes", "run_bytes", "delta_bytes")
    advice = F.lit(None)
    for name in reversed(ADVICE):
        advice = F.when(F.col(f"{name.split()[0]}_bytes") == least, F.lit(name)).otherwise(advice)
    return totals.withColumn("advice", advice)


def size_of(value: Column, kind: str) -> Column:
    return F.lit(WIDTHS[kind]) if kind in WIDTHS else F.octet_length(value) + 4


def check_constraints(df: DataFrame, not_null: Sequence[str], key: Sequence[str]) -> DataFrame:
    """(rule, violations): null values of each column, and rows beyond the first of each key."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"violations_{i}") for i, c in enumerate(not_null)])
    rules = nulls.select(_per_column([f"not null {c}" for c in not_null], {"violations": "violations"})).withColumnRenamed("column", "rule")
    repeated = df.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("extra")).where("extra > 0")
    unique = repeated.agg(F.lit(f"unique {', '.join(key)}").alias("rule"), F.coalesce(F.sum("extra"), F.lit(0).cast("long")).alias("violations"))
    return rules.unionByName(unique)
