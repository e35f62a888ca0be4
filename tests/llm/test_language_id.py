"""Language identification: the kernel against sets, held-out accuracy, defined cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from tallywick.llm import language_id

SYLLABLES = {"aa": "the er on re and in".split(), "bb": "le que ment eau ou é".split(), "cc": "ung sch der ein ü ge".split()}


def corpus(n=240):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        text = " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(20, 200)))
        rows.append((i, text, lang if i % 11 else None))
    return rows


def test_presence_is_the_set_of_hashed_grams():
    text = "Abracadabra " * 30
    whole = language_id.present(text)
    assert len(whole) <= len({text.lower()[i:i + n] for n in range(1, 5) for i in range(len(text) - n + 1)})
    assert np.array_equal(whole, language_id.present(text.upper()))
    assert len(language_id.present("")) == 0


def test_long_texts_are_read_whole(monkeypatch):
    text = "".join(random.Random(1).choice("abcdefgh ") for _ in range(5000)) + "ÿþ"
    whole = language_id.present(text)
    monkeypatch.setattr(language_id, "PIECE", 100)
    assert np.array_equal(whole, language_id.present(text))


def plain_grams(text):
    """The n-grams of a text, each as its bucket by the plain form of the rolling hash."""
    out, mask = set(), (1 << 64) - 1
    low = text.lower()
    for n in range(1, 5):
        for i in range(len(low) - n + 1):
            h = 0
            for c in low[i:i + n]:
                h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) & mask
            out.add((((h ^ h >> 29) * 0xBF58476D1CE4E5B9) & mask) >> 64 - language_id.BUCKET_BITS)
    return out


def test_kernel_map_and_ridge_against_plain_forms():
    """Kernel by sets, Nystroem map by landmarks, one ridge regression a language, and scores text by text."""
    samples = [(lang, text) for _, text, lang in corpus(60) if lang]
    model = language_id.fitted([(lang, language_id.present(text)) for lang, text in samples], landmarks=5)
    sets = [(lang, plain_grams(text)) for lang, text in samples]
    kernel = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    languages = sorted({lang for lang, _ in sets})
    marks = [g for lang in languages for g in [g for other, g in sets if other == lang][:5]]
    square = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(square)
    whiten = vectors @ np.diag(np.maximum(values, 1e-6) ** -0.5) @ vectors.T
    features = np.array([[kernel(g, m) for m in marks] for _, g in sets]) @ whiten
    solved = []
    for lang in languages:
        target = np.array([1.0 if other == lang else -1.0 for other, _ in sets])
        solved.append(np.linalg.inv(features.T @ features + language_id.RIDGE * np.eye(len(marks))) @ features.T @ target)
    texts = ["the er on", "le que ment", "x", "ung sch " * 400] + [text for _, text in samples[:7]]
    got = model.values([language_id.present(t) for t in texts])
    for row, text in zip(got, texts):
        mapped = np.array([kernel(plain_grams(text), m) for m in marks]) @ whiten
        assert np.allclose(row, [mapped @ w for w in solved], atol=2e-3)


def test_tiles_do_not_matter(monkeypatch):
    samples = [(lang, language_id.present(text)) for _, text, lang in corpus(60) if lang]
    model = language_id.fitted(samples)
    texts = [text for _, text, _ in corpus(40)] + [None, "", "12"]
    whole = model.predict(texts)
    monkeypatch.setattr(language_id, "TILE", 1)
    monkeypatch.setattr(language_id, "AT_ONCE", 7)
    assert [(a, round(b, 4)) for a, b in model.predict(texts)] == [(a, round(b, 4)) for a, b in whole]


def test_three_hundred_languages(spark):
    rng = random.Random(8)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    rows = []
    for k in range(300):
        own = letters[k * 10:k * 10 + 10]
        rows += [(k * 10 + i, " ".join("".join(rng.choice(own) for _ in range(4)) for _ in range(12)), f"l{k:03}") for i in range(6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.op4_language_id(frame).join(frame, "doc_id").where("held_out")
    learnt = frame.where(~language_id.held_out(F.col("doc_id"), 4, 2)).select("lang").distinct()
    got = got.join(learnt, "lang", "left_semi")
    assert got.count() > 300 and got.where("lang <> lang_pred").count() == 0


def test_one_id_on_many_rows(spark):
    """An id on 200,000 rows teaches as one row, and the other ids of the language still teach."""
    frame = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    many = spark.range(200_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("the er "), F.col("id").cast("string")).alias("text"), F.lit("aa").alias("lang"))
    got = language_id.op4_language_id(frame.unionByName(many)).where("doc_id <> 1").join(frame, "doc_id").where("held_out and lang is not null")
    assert got.where("lang <> lang_pred").count() == 0


def test_bound_on_the_sample(spark):
    frame = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    assert language_id.fit(frame, most_grams=1).languages == ("aa", "bb", "cc")


def test_held_out_accuracy(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.op4_language_id(frame).join(frame, "doc_id").where("held_out and lang is not null")
    assert got.count() > 20 and got.where("lang <> lang_pred").count() == 0
    assert got.where("score < 0 or score > 1").count() == 0


def test_defined_cases(spark):
    odd = [(1000, None, "aa", "x"), (1001, "", "aa", "x"), (1002, "123 !!", "bb", "x"), (None, "the and on", "aa", "x"), (1003, "the and " * 20000, None, "x"), (1003, "the and", None, "x")]
    frame = spark.createDataFrame([(*r, "x") for r in corpus()] + odd, "doc_id long, text string, lang string, score string")
    got = language_id.op4_language_id(frame).where("doc_id is null or doc_id >= 1000").orderBy("doc_id", "lang_pred").collect()
    assert [(r["doc_id"], r["lang_pred"]) for r in got] == [(None, "aa"), (1000, "und"), (1001, "und"), (1002, "und"), (1003, "aa"), (1003, "aa")]
    assert got[0]["held_out"] is False


def test_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in language_id.op4_language_id(frame).collect()] == [("und", 0.0)]
    assert language_id.op4_language_id(frame.limit(0)).count() == 0


def test_labels_of_held_out_rows_do_not_count(spark):
    frame = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    lied = frame.withColumn("lang", F.when(language_id.held_out(F.col("doc_id"), 4, 2), "zz").otherwise(F.col("lang")))
    want = sorted(language_id.op4_language_id(frame).collect(), key=repr)
    assert sorted(language_id.op4_language_id(lied).collect(), key=repr) == want
