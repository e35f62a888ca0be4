"""Factorisation machine: the identity against all pairs, held-out accuracy, defined cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from tallywick.llm import quality_model
from tallywick.llm.language_id import held_out


def corpus(n=400):
    rng = random.Random(9)
    words = ["w%d" % i for i in range(80)] + "the of and to in is".split()
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(30, 120)))
        docs.append((i, text if good else text.upper().replace(" ", "!! "), len(text)))
        labels.append((i, int(good)))
    return docs, labels


def frames(spark):
    docs, labels = corpus()
    return spark.createDataFrame(docs, "doc_id long, text string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_pairs_identity():
    rng = np.random.default_rng(3)
    size = quality_model.WORDS + quality_model.STATISTICS
    zeros, ones = np.zeros(quality_model.STATISTICS, np.float32), np.ones(quality_model.STATISTICS, np.float32)
    machine = quality_model.Machine(0.2, rng.normal(size=size).astype(np.float32), rng.normal(0, 0.3, (size, 8)).astype(np.float32), zeros, ones)
    row = quality_model.features("one two two three of them", 25)
    at, x = machine.row(*row)
    value = machine.bias + sum(machine.linear[i] * v for i, v in zip(at, x))
    for a in range(len(at)):
        for b in range(a + 1, len(at)):
            value += machine.factors[at[a]] @ machine.factors[at[b]] * x[a] * x[b]
    assert abs(machine.score(*row) - 1 / (1 + np.exp(-value))) < 1e-4


def test_held_out_accuracy(spark):
    docs, labels = frames(spark)
    got = quality_model.op5_quality_model(docs, labels).join(labels, "doc_id").where("held_out")
    assert got.count() > 50 and got.where("quality <> predicted").count() <= 0.02 * got.count()


def test_held_out_labels_do_not_count(spark):
    docs, labels = frames(spark)
    lied = labels.withColumn("quality", F.when(held_out(F.col("doc_id"), 3, 1), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(quality_model.op5_quality_model(docs, labels).collect()) == sorted(quality_model.op5_quality_model(docs, lied).collect())


def test_defined_cases(spark):
    docs, labels = frames(spark)
    odd = spark.createDataFrame([(900, None, None), (901, "", 0), (None, "no id", 5), (902, "long " * 40000, None), (903, "twice", 5), (903, "twice", 5)], docs.schema)
    more = spark.createDataFrame([(0, 0), (None, 1), (5, None), (7, 1), (7, 1)], labels.schema)
    got = quality_model.op5_quality_model(docs.unionByName(odd).withColumn("score", F.lit("x")), labels.unionByName(more)).where("doc_id is null or doc_id >= 900")
    rows = got.collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    none = quality_model.op5_quality_model(docs.limit(3), labels.limit(0)).collect()
    assert [r["score"] for r in none] == [0.5] * 3
    assert quality_model.op5_quality_model(docs.limit(0), labels).count() == 0


def test_bound_on_training_rows(spark):
    docs, labels = frames(spark)
    machine = quality_model.fit(docs, labels, rows=20)
    assert np.isfinite(machine.factors).all()
    assert np.isfinite(quality_model.fit(docs, labels, most_features=1).factors).all()


def test_one_id_on_many_rows(spark):
    """An id on 200,000 rows teaches as one row."""
    docs, labels = frames(spark)
    many = spark.range(200_000).select(F.lit(0).cast("long").alias("doc_id"), F.lit("copy").alias("text"), F.col("id").alias("n_chars"))
    got = quality_model.op5_quality_model(docs.where("doc_id > 0").unionByName(many), labels).where("doc_id > 0").join(labels, "doc_id").where("held_out")
    assert got.where("quality <> predicted").count() <= 0.02 * got.count()


def test_training_against_a_plain_gradient():
    """One step of the first batch moves every weight against the gradient of the loss, found by differences."""
    rng = np.random.default_rng(2)
    rows = [(np.sort(rng.choice(quality_model.WORDS, 6, replace=False)).astype(np.int32), rng.random(6).astype(np.float32), rng.normal(size=quality_model.STATISTICS).astype(np.float32)) for _ in range(40)]
    labels = (rng.random(40) < 0.5).astype(np.float32)
    before = lambda m: float(np.mean([-np.log(m.score(*r) if y else 1 - m.score(*r)) for r, y in zip(rows, labels)]))
    untrained = quality_model.Machine(0.0, np.zeros(quality_model.WORDS + quality_model.STATISTICS, np.float32), np.zeros((quality_model.WORDS + quality_model.STATISTICS, quality_model.RANK), np.float32),
                                      np.mean([r[2] for r in rows], axis=0), np.std([r[2] for r in rows], axis=0) + 1e-3)
    machine = quality_model.trained(rows, labels)
    assert before(machine) < 0.5 * before(untrained)
    assert np.mean([(machine.score(*r) >= 0.5) == (y == 1) for r, y in zip(rows, labels)]) == 1.0
