"""The corpus pipeline: raw documents to token ids, each stage on what the one before kept.

run() writes every stage's result as Parquet to the work folder that the cluster shares and
reads it back, so a lost executor costs a re-read and no lineage spans two stages.

A stage carries the columns of its input as one struct beside its own, so that no name can clash.
Ids to drop are written out and counted: up to MAX_SENT of them go to every task, so no text is
shuffled; more are joined by id.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession, functions as F  # noqa: E402

from tallywick.llm import byte_bpe, decontamination, pii, quality_model, simhash  # noqa: E402
from tallywick.llm.common import ready, table  # noqa: E402
from tallywick.session import cut  # noqa: E402


MAX_SENT = 2_000_000  # ids to drop, under 100 bytes each, that are sent to every task


def as_rows(docs: DataFrame) -> Column:
    """All columns of the documents as one struct."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def without(rows: DataFrame, key: str, dropped: DataFrame, max_sent: int = MAX_SENT) -> DataFrame:
    """The rows whose `key` is none of `dropped` (one column of that name; a null is a value)."""
    stored = cut(dropped.select(F.col(key).alias("_dropped")).distinct(), "dropped")
    few = stored.limit(max_sent + 1).count() <= max_sent
    return rows.join(F.broadcast(stored) if few else stored.hint("shuffle_merge"), F.col(key).eqNullSafe(F.col("_dropped")), "left_anti")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects (score under one half).

    A null text is scored as an empty one; without labels every score is one half and all stay; each of
    repeated rows is scored by itself; texts are read whole; no documents give none.
    """
    ready(spark)
    machine = quality_model.fit(quality_model.learned_part(docs), table(spark, sf_dir, "labels"))
    scored = docs.select(as_rows(docs).alias("row"), quality_model.scores(machine, docs).alias("score"))
    return scored.where("score >= 0.5").select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one of the least doc_id.

    Of rows that share that id one of each text stays; a group without any id keeps its texts
    that differ. Null, empty and blank texts are near duplicates of each other; texts are read
    whole; no documents give none.
    """
    ready(spark)
    groups = cut(simhash.near_duplicates(docs), "near-duplicates")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    rows = docs.select(as_rows(docs).alias("row"), F.col("doc_id"), F.col("text"))
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).isEmpty():
        return without(rows, "doc_id", groups.where(~kept)).select("row.*")
    stays = groups.where(kept).select(F.col("doc_id").alias("id_kept"), F.col("fp").alias("fp_kept")).distinct()
    marked = rows.withColumn("fp", simhash.fingerprint_column(F.col("text")))
    found = marked.join(stays, F.col("doc_id").eqNullSafe(F.col("id_kept")) & (F.col("fp") == F.col("fp_kept")), "left_semi")
    return found.dropDuplicates(["doc_id", "text"]).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents of which a twentieth or more stands in windows of the benchmark.

    Rows that share a doc_id go together if any of them is contaminated; a row without an id
    is judged by its text. Null and empty texts stay, and so does all without a benchmark; texts
    are read whole; no documents give none.
    """
    ready(spark)
    key = F.struct(F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    keyed = docs.select(as_rows(docs).alias("row"), F.to_json(key, {"ignoreNullFields": "false"}).alias("key"), "text")
    judged = decontamination.decontaminate(keyed.select(F.col("key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return without(keyed, "key", judged.where("contaminated").select(F.col("doc_id").alias("key"))).select("row.*")


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars, if there is one, follows the text where it was known.

    A null text stays null and an empty one empty; each of repeated rows is masked by itself; texts
    are read whole; no documents give none.
    """
    ready(spark)
    field = pii.fit(docs.select("doc_id", "text"))
    new = docs.withColumn("text", pii.masked(field, F.col("text"), spark))
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast("bigint"))
    return new.select(*[F.col(f"`{c}`") for c in docs.columns])


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, their number and digest, and whether they decode to its text.

    A null text counts as an empty one and has no ids; each of repeated rows has its own; texts are read whole; no documents give none.
    """
    ready(spark)
    bpe = byte_bpe.production(spark, cached=200_000, group=500_000)  # less than by itself: the stages share their workers
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text"), "text", "ids"), "ids", "decoded")
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("round_trip"),
    )


STAGES = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", keep_one_of_each),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal),
    ("byte_bpe", to_tokens),
]

#: SQL has no form for the trained stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
