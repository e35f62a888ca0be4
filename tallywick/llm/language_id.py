"""Language identification with string kernels.

The kernel of two texts is the number of hashed character n-grams (one to four characters,
a blended spectrum) that both contain, over the geometric mean of how many each contains;
only presence counts. A bounded sample of labelled rows gives the landmarks: with
K the kernel among them, K^(-1/2) maps a text's kernel values to Nystroem features, and one
ridge regression per language separates it from the rest there. Both maps are linear, so for
scoring they are multiplied out once into one matrix (n-gram by language), and a batch of
texts is scored by the product of its presence matrix with it.

Bounds. The training sample is at most SAMPLE_ROWS rows and SAMPLE_GRAMS n-gram numbers: an equal
share for each language, PER_LANGUAGE rows at most, those with the least hashes of their ids, one
row of each id. The LANGUAGES most frequent languages are learnt; rarer ones teach nothing.
The n-gram numbers are computed and stored by the tasks, and only chosen rows come to the driver.
The matrix has a row for each n-gram of a landmark (BUCKETS at most). Every text is scored
whole; a tile of texts by the matrix' n-grams holds at most TILE numbers.

Defined results: a null text or one without a letter is `und` with score 0; with nothing to
learn from, every text is; repeated rows are scored one by one; ids that are null are never
learned from and not held out; an empty table gives an empty result; other columns than
those named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywick.llm.common import among_least
from tallywick.session import cut

N_GRAM = 4
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
PER_LANGUAGE = 100
SAMPLE_ROWS = 6000
SAMPLE_GRAMS = 16_000_000
LANDMARKS = 40  # of each language's training rows, and at most MOST_LANDMARKS in all
MOST_LANDMARKS = 600
RIDGE = 0.1
SHARPNESS = 4.0
LANGUAGES = 400
TILE = 4_000_000
PIECE = 1 << 16  # characters that are hashed at once
AT_ONCE = 256  # texts whose n-grams are held at once
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}").search


def present(text: str) -> np.ndarray:
    """The sorted bucket numbers of the text's n-grams."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    seen = np.zeros(BUCKETS, np.bool_)
    for at in range(0, len(codes), PIECE):
        part = codes[at:at + PIECE + N_GRAM - 1]
        rolling = np.zeros(len(part), np.uint64)
        for n in range(min(N_GRAM, len(part))):
            rolling = rolling[:len(part) - n] * np.uint64(0x9E3779B97F4A7C15) + part[n:] + np.uint64(1)
            seen[((rolling ^ (rolling >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BUCKET_BITS)] = True
    return np.flatnonzero(seen)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    column: np.ndarray  # by n-gram number: its row of `weights`, or -1
    weights: np.ndarray  # landmark n-grams x languages

    def values(self, texts: list[np.ndarray]) -> np.ndarray:
        """Texts (as n-gram numbers) by languages: presence matrices, a tile of texts each, times the weights."""
        out = np.empty((len(texts), len(self.languages)), np.float32)
        step = max(1, TILE // max(1, len(self.weights)))
        for start in range(0, len(texts), step):
            tile = texts[start:start + step]
            sizes = np.array([len(grams) for grams in tile])
            at = self.column[np.concatenate(tile)]
            row = np.repeat(np.arange(len(tile)), sizes)
            presence = np.zeros((len(tile), len(self.weights)), np.float32)
            presence[row[at >= 0], at[at >= 0]] = 1
            out[start:start + step] = presence @ self.weights / np.sqrt(np.maximum(1, sizes))[:, None]
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [(UNKNOWN, 0.0)] * len(texts)
        known = [i for i, t in enumerate(texts) if self.languages and t is not None and _LETTER(t)]
        for start in range(0, len(known), AT_ONCE):
            part = known[start:start + AT_ONCE]
            values = self.values([present(texts[i]) for i in part])
            best = values.argmax(axis=1)
            top = values[np.arange(len(part)), best]
            if len(self.languages) == 1:
                sure = np.ones(len(part))
            else:
                sure = 1 / (1 + np.exp(-SHARPNESS * (top - np.partition(values, -2, axis=1)[:, -2])))
            for i, k, score in zip(part, best, sure):
                out[i] = (self.languages[k], float(score))
        return out


def kernel(marks: list[np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Texts by marks: n-grams in both over the geometric mean of how many each has."""
    sizes = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    grams = np.concatenate(texts)
    out = np.empty((len(texts), len(marks)))
    seen = np.zeros(BUCKETS, np.int32)
    for k, mark in enumerate(marks):
        seen[mark] = 1
        out[:, k] = np.add.reduceat(seen[grams], starts) / np.sqrt(sizes * float(len(mark)))
        seen[mark] = 0
    return out


def fitted(samples: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """The model of (language, n-gram numbers) rows; the first `landmarks` of each language are its landmarks."""
    rows = [(lang, grams) for lang, grams in samples if len(grams)]
    languages = tuple(sorted({lang for lang, _ in rows}))
    column = np.full(BUCKETS, -1, np.int32)
    if not languages:
        return Model((), column, np.zeros((0, 0), np.float32))
    of: dict[str, list[np.ndarray]] = {}
    for lang, grams in rows:
        of.setdefault(lang, []).append(grams)
    each = max(1, min(landmarks, MOST_LANDMARKS // len(languages)))
    marks = [grams for lang in languages for grams in of[lang][:each]]
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    whiten = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = kernel(marks, [grams for _, grams in rows]) @ whiten
    targets = np.array([[1.0 if lang == other else -1.0 for other in languages] for lang, _ in rows])
    solved = whiten @ np.linalg.solve(features.T @ features + ridge * np.eye(len(marks)), features.T @ targets)
    used = np.unique(np.concatenate(marks))
    column[used] = np.arange(len(used), dtype=np.int32)
    weights = np.zeros((len(used), len(languages)))
    for mark, share in zip(marks, solved):
        weights[column[mark]] += share / np.sqrt(len(mark))
    return Model(languages, column, weights.astype(np.float32))


def grams_column(text: Column) -> Column:
    @F.arrow_udf("binary")
    def grams(texts: pa.Array) -> pa.Array:
        return pa.array([present(t.as_py() or "").astype(np.int32).tobytes() for t in texts], pa.binary())

    return grams(text)


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, most_grams: int = SAMPLE_GRAMS) -> Model:
    """Learn from (doc_id, text, lang); rows with a null id, text or lang teach nothing."""
    usable = labelled.where("doc_id is not null and text is not null and lang is not null")
    sizes = usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return fitted([])
    each = max(1, min(per_language, SAMPLE_ROWS // len(sizes)))
    low = F.lit(False)
    for row in sizes:
        low = low | ((F.col("lang") == row["lang"]) & among_least(F.xxhash64("doc_id"), each, row["ids"]))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = usable.where(low).select("doc_id", "lang").distinct()
    chosen = ids.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    texts = usable.join(F.broadcast(chosen), ["doc_id", "lang"])  # at most SAMPLE_ROWS ids, or one a language
    one = texts.groupBy("lang", "place").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    stored = cut(one.select("lang", "place", grams_column(F.col("least.text")).alias("grams")), "language-sample")
    # Whole places are taken, so that every language keeps its share.
    by_place = stored.groupBy("place").agg(F.sum(F.octet_length("grams") / 4).alias("n")).orderBy("place").collect()  # at most per_language
    last, total = 0, 0
    for row in by_place:
        total += row["n"]
        if last and total > most_grams:
            break
        last = row["place"]
    rows = stored.where(F.col("place") <= last).orderBy("place", "lang").collect()
    return fitted([(r["lang"], np.frombuffer(r["grams"], np.int32)) for r in rows])


def predict(model: Model, text: Column, spark) -> Column:
    """A struct (lang_pred, score) for each text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def scored(texts: pa.Array) -> pa.Array:
        found = shared.value.predict(texts.to_pylist())
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["lang_pred", "score"])

    return scored(text)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % parts
    return F.coalesce(remainder == part, F.lit(False))


def op4_language_id(documents: DataFrame) -> DataFrame:
    out = held_out(F.col("doc_id"), 4, 2)
    model = fit(documents.where(~out).select("doc_id", "text", "lang"))
    judged = documents.select("doc_id", out.alias("held_out"), predict(model, F.col("text"), documents.sparkSession).alias("p"))
    return judged.select("doc_id", "held_out", "p.lang_pred", "p.score")
