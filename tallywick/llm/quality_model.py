"""Quality classifier: a factorisation machine over hashed words, structure statistics and length metadata.

The value of a text is w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j. The pair term is
half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), so a text with n features costs n
times the rank. The score is its logistic.

Features are computed on the executors, whole texts each; training takes the features of at
most TRAIN_ROWS labelled rows (those with the least hashes of their ids, one of each id) and
TRAIN_FEATURES words of them to the driver, documented bounds that don't move with the table (64 MB),
and runs mini-batch Adam there.

Defined results: a null text counts as an empty one and is scored by its statistics; with no
labels the score is 0.5; of several labels of one id the least counts (a document that
anyone marked as bad is bad); of several rows of one id the one of least hash teaches; null ids and null labels teach nothing; a null or missing
length metadata value is taken from the text; repeated rows are scored one by one; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallywick.llm.common import among_least
from tallywick.llm.language_id import held_out
from tallywick.session import cut

WORD_BITS = 14
WORDS = 1 << WORD_BITS
RANK = 8
TRAIN_ROWS = 4000
TRAIN_FEATURES = 8_000_000
EPOCHS = 20
BATCH = 128
RATE = 0.02
DECAY = 1e-4

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#*$%&|<>{}[]\\^~=_@"
_MARKS = b"!?"
_STOPS = b".,;:"
_BLANKS = b" \t\n\r\x0b\x0c"


def statistics(text: str, n_chars: int | None) -> tuple[list[float], list[bytes]]:
    """Ratios of a text's structure, its length metadata, and its words in lower case."""
    data = text.encode("utf-8", "replace")
    words = data.lower().split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    size, n = max(1, len(data) - sum(map(data.count, (b" ", b"\n")))), max(1, len(words))
    share = lambda chars: 1 - len(data.translate(None, chars)) / max(1, len(data))
    different = len(set(words))
    return [
        np.log1p(len(words)),
        np.log1p(len(text) if n_chars is None else max(0, n_chars)),
        len(data) * share(_UPPER) / size,
        len(data) * share(_DIGITS) / size,
        len(data) * share(_SYMBOLS) / n,
        len(data) * share(_MARKS) / n,
        len(data) * share(_STOPS) / n,
        size / n,
        different / n,
        different / np.sqrt(n),
        np.log1p(len(lines)),
        len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)) / 100,
        share(_BLANKS),
    ], words


STATISTICS = len(statistics("", None)[0])


def hashed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the words and their counts, scaled to length one."""
    ids, counts = np.unique(np.fromiter(map(crc32, words), np.uint32, len(words)) & np.uint32(WORDS - 1), return_counts=True)
    counts = np.sqrt(counts).astype(np.float32)
    return ids.astype(np.int32), counts / max(1e-9, np.sqrt((counts * counts).sum()))


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    stats, words = statistics(text or "", n_chars)
    ids, values = hashed(words)
    return ids, values, np.array(stats, np.float32)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray  # words, then statistics
    factors: np.ndarray  # the same by RANK
    middle: np.ndarray
    spread: np.ndarray

    def row(self, ids, values, stats):
        scaled = np.clip((stats - self.middle) / self.spread, -4, 4)
        return np.concatenate([ids, np.arange(WORDS, WORDS + len(stats))]), np.concatenate([values, scaled * 0.5]).astype(np.float32)

    def score(self, ids, values, stats) -> float:
        at, x = self.row(ids, values, stats)
        v = self.factors[at]
        mixed = x @ v
        pairs = 0.5 * (mixed @ mixed - (x * x) @ (v * v).sum(axis=1))
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.linear[at] @ x + pairs, -40, 40))))


def trained(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Machine:
    """Adam on the logistic loss; with no rows, or one label only, the share of label 1 decides."""
    rng = np.random.default_rng(seed)
    size = WORDS + STATISTICS
    stats = np.array([r[2] for r in rows], np.float32).reshape(-1, STATISTICS)
    machine = Machine(0.0, np.zeros(size, np.float32), np.zeros((size, RANK), np.float32),
                      stats.mean(axis=0) if len(rows) else np.zeros(STATISTICS, np.float32),
                      stats.std(axis=0) + 1e-3 if len(rows) else np.ones(STATISTICS, np.float32))
    if not len(rows):
        return machine
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    machine.bias = float(np.log(share / (1 - share)))
    if labels.min() == labels.max():
        return machine
    machine.factors = rng.normal(0, 0.05, (size, RANK)).astype(np.float32)
    built = [machine.row(*r) for r in rows]
    weights = np.concatenate([machine.linear[:, None], machine.factors], axis=1)
    first, second, step = np.zeros_like(weights), np.zeros_like(weights), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(built))
        for start in range(0, len(order), BATCH):
            chosen = order[start:start + BATCH]
            at = np.concatenate([built[i][0] for i in chosen])
            x = np.concatenate([built[i][1] for i in chosen])[:, None]
            sizes = np.array([len(built[i][0]) for i in chosen])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            w = weights[at]
            xv = x * w[:, 1:]
            mixed = np.add.reduceat(xv, starts)
            value = machine.bias + np.add.reduceat(w[:, 0] * x[:, 0], starts) + 0.5 * (mixed * mixed - np.add.reduceat(xv * xv, starts)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(value, -40, 40))) - labels[chosen]) / len(chosen)
            each = np.repeat(error, sizes)[:, None].astype(np.float32)
            slope = np.concatenate([each * x, each * (x * np.repeat(mixed, sizes, axis=0) - x * xv)], axis=1)
            used, where = np.unique(at, return_inverse=True)
            gradient = np.zeros((len(used), RANK + 1), np.float32)
            np.add.at(gradient, where, slope)
            gradient += DECAY * weights[used]
            step += 1
            first[used] = 0.9 * first[used] + 0.1 * gradient
            second[used] = 0.999 * second[used] + 0.001 * gradient * gradient
            weights[used] -= RATE * (first[used] / (1 - 0.9 ** step)) / (np.sqrt(second[used] / (1 - 0.999 ** step)) + 1e-8)
            machine.bias -= RATE * float(error.sum())
    machine.linear, machine.factors = weights[:, 0].copy(), weights[:, 1:].copy()
    return machine


def _length(df: DataFrame) -> Column:
    return F.col("n_chars").cast("bigint") if "n_chars" in df.columns else F.lit(None).cast("bigint")


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most_features: int = TRAIN_FEATURES) -> Machine:
    """Learn from the labels (doc_id, quality) of at most `rows` documents."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    usable = known.join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    low = among_least(F.xxhash64("doc_id"), rows, usable.count())
    chosen = usable.where(low).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    @F.arrow_udf("struct<ids:binary,x:binary,stats:binary>")
    def computed(texts: pa.Array, sizes: pa.Array) -> pa.Array:
        made = [features(t.as_py(), n.as_py()) for t, n in zip(texts, sizes)]
        return pa.StructArray.from_arrays([pa.array([m[k].tobytes() for m in made], pa.binary()) for k in range(3)], ["ids", "x", "stats"])

    wanted = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _length(documents).alias("n"))
    texts = wanted.join(F.broadcast(chosen), "doc_id")  # at most `rows` ids
    one = texts.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text", "n").alias("hash"), "text", "n")).alias("least"))
    made = one.select("doc_id", "quality", computed("least.text", "least.n").alias("f"))
    stored = cut(made.withColumn("size", F.octet_length("f.ids") / 4), "quality-sample")
    sizes = stored.select("size", F.xxhash64("doc_id").alias("hash")).orderBy("hash").collect()  # at most `rows`
    last, total = None, 0
    for r in sizes:
        total += r["size"]
        if last is not None and total > most_features:
            break
        last = r["hash"]
    found = stored.where(F.xxhash64("doc_id") <= last).orderBy("doc_id").collect() if sizes else []
    made = [(np.frombuffer(r["f"]["ids"], np.int32), np.frombuffer(r["f"]["x"], np.float32), np.frombuffer(r["f"]["stats"], np.float32)) for r in found]
    return trained(made, np.array([1.0 if r["quality"] == 1 else 0.0 for r in found], np.float32))


def scores(machine: Machine, documents: DataFrame) -> Column:
    shared = documents.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def scored(texts: pa.Array, sizes: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(*features(t.as_py(), n.as_py())) for t, n in zip(texts, sizes)], pa.float64())

    return scored(F.coalesce("text", F.lit("")), _length(documents))


def learned_part(documents: DataFrame) -> DataFrame:
    return documents.where(~held_out(F.col("doc_id"), 3, 1))


def op5_quality_model(documents: DataFrame, labels: DataFrame) -> DataFrame:
    machine = fit(learned_part(documents), labels)
    scored = documents.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), scores(machine, documents).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
