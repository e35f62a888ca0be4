"""What the operators of this subpackage share: reading tables, text pieces, code shipping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallywick.session import reach_workers

BATCH_BYTES = 8 << 20  # of rows that a Python worker gets at once; a larger row comes alone
# White space of the word rules: space and the five control characters tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ready(spark: SparkSession) -> SparkSession:
    """Workers find this package, and get texts by their size: a batch is bounded in bytes whatever the rows' length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return reach_workers(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ids_and_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under fixed names; other columns can't clash."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column, blanks: str = BLANKS) -> Column:
    """The words of a text between blanks; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), blanks), "")


def hex_sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def among_least(value: Column, n: int, total: int) -> Column:
    """True for about the 3n least of `total` evenly spread 64-bit hashes, so that a top-n reads few rows of each task."""
    share = min(1.0, 3 * n / max(1, total))
    return F.lit(True) if share == 1.0 else value < -(1 << 63) + int(share * (1 << 64))
