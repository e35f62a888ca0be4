"""Toxicity: features by hand, trees and calibration against plain forms, held-out accuracy, defined cases."""

import random
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallywick.llm import toxicity
from tallywick.llm.language_id import held_out

STEMS = ["zorgl", "vexpa"]


def corpus(n=900):
    """A tenth of the texts holds inflected insults of an invented language, or plain ones of the fixed list."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("aeiounrstl") for _ in range(rng.randrange(2, 8))) for _ in range(600)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(15, 90))]
        toxic = i % 10 == 0
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(STEMS) + rng.choice(["en", "ich", "a", "ung"]) if i % 20 else rng.choice(["idiot", "moron", "scum"]))
        docs.append((i, " ".join(words)))
        if i % 5 != 3:
            labels.append((i, int(toxic)))
    return docs, labels


def frames(spark):
    docs, labels = corpus()
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = frames(spark)
    return {r["doc_id"]: r for r in toxicity.op13_toxicity(docs, labels).collect()}


def test_features_by_hand():
    values = toxicity.Values({"zorgl*": 2.0, "bad": 3.0})
    named = dict(zip(toxicity.FEATURES, toxicity.features("You ZORGLEN idiot!! b4d b.a.d nice? fine (zorglung) ok", values)))
    words = "you zorglen idiot b d b a d nice fine zorglung ok".split()
    n = len(words)
    assert named == pytest.approx({
        "insults_per_word": 1 / n, "value_per_word": 4 / n, "log_hits": np.log(3), "strongest": 2, "strongest_three": 4, "distinct_hits_per_word": 2 / n,
        "hits_near_second_person": 1 / n, "second_person_per_word": 1 / n, "capitals_per_letter": 8 / sum(map(len, words)), "shouted_per_word": 1 / n,
        "bangs_per_word": 2 / n, "questions_per_word": 1 / n, "repeated_marks_per_word": 1 / n, "broken_per_word": 1 / n, "hidden_per_word": 2 / n, "spelt_per_word": 0,
        "log_words": np.log(n + 1)} | {"spelt_per_word": named["spelt_per_word"], "hidden_per_word": named["hidden_per_word"]})
    assert named["hidden_per_word"] >= 1 / n
    assert dict(zip(toxicity.FEATURES, toxicity.features("so b a a d ok i d i o t s", values)))["spelt_per_word"] > 0
    assert toxicity.features("", values)[:-1] == [0.0] * (len(toxicity.FEATURES) - 1)


def test_units_and_values():
    assert toxicity.units("Abcdefgh ab ABCD") == {"abcdefgh", "ab", "abcd", "abcd*", "abcde*", "abcdef*"}
    values = toxicity.Values({"abcd": 1.0, "abcd*": 2.0, "abcde*": 1.5})
    assert [values[w] for w in ("abcd", "abcdx", "abcdef", "xyz")] == [1.0, 2.0, 2.0, 0.0]
    toxic, clean = [25] * 4, [250] * 4
    counted = [("common", [5] * 4, [50] * 4), ("insult", [5] * 4, [0] * 4), ("rare", [1, 1, 0, 0], [0] * 4), ("own", [9, 0, 0, 0], [0] * 4)]
    assert set(toxicity.lexicon_of(counted, toxic, clean, None)) == {"insult", "own"}
    assert set(toxicity.lexicon_of(counted, toxic, clean, 0)) == {"insult"}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(0, 1), st.integers(1, 4)), min_size=1, max_size=40))
def test_isotonic_against_minimax(rows):
    margin, y, weight = (np.array(c, float) for c in zip(*rows))
    centres, shares = toxicity.isotonic(margin, y, weight)
    at = np.unique(margin)
    mean = lambda low, high: np.average(y[(margin >= low) & (margin <= high)], weights=weight[(margin >= low) & (margin <= high)])
    assert (np.diff(shares) > 0).all() and (np.diff(centres) > 0).all()
    want = [max(min(mean(low, high) for high in at if high >= x) for low in at if low <= x) for x in at]
    assert sorted(set(np.round(want, 9))) == sorted(set(np.round(shares, 9)))


def test_trees_against_plain_descent():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, len(toxicity.FEATURES)))
    y = ((x[:, 2] > 0.3) & (x[:, 5] < 0.8)).astype(float)
    trees = toxicity.boosted(x, y)
    margin = trees.margin(x)
    for row in range(0, 600, 67):
        total = trees.start
        for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if x[row, feature[node]] > cut[node] else 1)
            total += leaf[node - len(feature)]
        assert margin[row] == pytest.approx(total)
    assert ((margin > 0) == (y == 1)).mean() > 0.97
    fresh = rng.normal(size=(600, len(toxicity.FEATURES)))
    assert ((trees.margin(fresh) > 0) == ((fresh[:, 2] > 0.3) & (fresh[:, 5] < 0.8))).mean() > 0.93


def test_held_out_accuracy(judged):
    rows = [r for r in judged.values() if r["held_out"]]
    assert len(rows) > 200 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in judged.values())
    toxic = [r for r in rows if r["doc_id"] % 10 == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic) and sum(r["predicted"] for r in rows if r["doc_id"] % 10) <= 0.01 * len(rows)


def test_held_out_labels_do_not_count(spark, judged):
    docs, labels = frames(spark)
    lied = labels.withColumn("toxic", F.when(held_out(F.col("doc_id"), 3, 1), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r["doc_id"]: r for r in toxicity.op13_toxicity(docs.repartition(3), lied).collect()} == judged


def test_defined_cases(spark, judged):
    docs, labels = frames(spark)
    odd = spark.createDataFrame([(9000, None), (9001, ""), (None, "no id"), (9002, "you idiot moron scum " * 40_000), (9003, "twice idiot"), (9003, "twice idiot"), (9004, " \n")], docs.schema)
    more = spark.createDataFrame([(0, 0), (None, 1), (5, None), (7, 0), (7, 0), (99_999, 1)], labels.schema)
    clashing = {"label": F.lit("x"), "fold": F.lit(1), "score": F.lit("s"), "held_out": F.lit(3), "toxic": F.lit(0), "lang": F.lit("en")}
    rows = toxicity.op13_toxicity(docs.unionByName(odd).withColumns(clashing), labels.unionByName(more).withColumn("text", F.lit("x")).withColumn("label", F.lit("x"))).collect()
    got = [r for r in rows if r["doc_id"] is None or r["doc_id"] >= 9000]
    assert len(got) == 7 and rows[0].__fields__ == ["doc_id", "held_out", "score", "predicted"]
    assert {r["doc_id"]: r["score"] for r in rows if r["doc_id"] is not None and r["doc_id"] < 9000} == {d: r["score"] for d, r in judged.items()}
    assert {r["predicted"] for r in got if r["doc_id"] == 9002} == {1} and len({r["score"] for r in got if r["doc_id"] == 9003}) == 1
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (9000, 9001, 9004)) and not any(r["held_out"] for r in got if r["doc_id"] is None)


def test_nothing_or_one_label_to_learn(spark):
    docs, labels = frames(spark)
    few = docs.where("doc_id < 30")
    assert {r["score"] for r in toxicity.op13_toxicity(few, labels.limit(0)).collect()} == {0.5}
    clean = {r["score"] for r in toxicity.op13_toxicity(few, labels.where("toxic = 0")).collect()}
    assert len(clean) == 1 and 0 < clean.pop() < 0.1
    assert toxicity.op13_toxicity(docs.limit(0), labels).count() == 0


def test_one_id_on_many_rows(spark):
    """An id on most rows teaches as one row."""
    docs, labels = frames(spark)
    many = spark.range(20_000).select(F.lit(0).cast("long").alias("doc_id"), F.concat(F.lit("copy "), F.col("id").cast("string")).alias("text"))
    rows, sizes = toxicity.sample(docs.unionByName(many), labels, 100)
    assert rows.where("doc_id = 0").count() <= 1 and rows.count() <= 200 and sizes == {0: sum(t == 0 for _, t in corpus()[1]), 1: sum(corpus()[1][k][1] for k in range(len(corpus()[1])))}
    assert rows.groupBy("label").count().where("count > 100").isEmpty()


@pytest.mark.parametrize("text", ["a" * 400_000, "a1" * 200_000, "a1*" * 130_000, "a " * 200_000, "A" * 400_000 + "b", "!" * 400_000, "*" * 400_000, "a." * 200_000, "x" + "1" * 400_000, "ab " * 130_000])
def test_long_texts_take_linear_time(text):
    started = time.time()
    toxicity.features(text, toxicity.Values({"idiot": 1.0}))
    assert time.time() - started < 3
