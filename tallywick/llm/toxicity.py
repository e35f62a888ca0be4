"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Lexicon. Units are lower-cased words and their beginnings of 4 to 6 letters (an insult keeps its
stem when it is inflected). A unit's value is the smoothed log-odds of its document counts among
toxic and clean sample rows; units in fewer than LEAST_TOXIC toxic rows, or not frequent enough
there to rule out chance, are left out. A word's value is the greatest of its units' values. A short fixed list of
insults stands beside it, so that a corpus with few labels has a start.

Features (FEATURES names them): densities of both lexicons, the strongest words, second-person
words and how near they are to lexicon words, capitals, punctuation, and obfuscation (letters
broken by digits or signs, letters spelt out one by one) with what it hides.

Training. The sample is at most PER_LABEL rows for each label, those with the least hashes of their
ids; it is written to the shared work folder, and its units and features are computed there by
the tasks. The driver gets at most LEXICON units with their counts and one short row of numbers
for each sample row, whatever the length of its text. The lexicon, and so the features, of a
sample row leave out the counts of the row's own fold; the calibration is fitted to values that
trees of the other folds gave, with weights that restore the labels' shares in the corpus.

Defined results: a null text counts as an empty one; empty texts are scored by their features;
without labels the score is 0.5, with one label only it is that label's smoothed share; of several
labels of one id the greatest counts; of several rows of one id the text of least hash teaches;
null ids and null labels teach nothing; repeated rows are scored one by one; an empty table gives
an empty result; other columns are not read. Texts are scored whole, in time proportional
to their length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallywick.llm.common import among_least
from tallywick.llm.language_id import held_out
from tallywick.session import cut

PER_LABEL = 4000
LEXICON = 20_000
FOLDS = 4
LEAST_TOXIC = 3
LEAST_ODDS = 1.0
LEAST_DEVIATION = 5.0  # standard deviations above the number of toxic rows that chance would give: there are very many units
SMOOTHING = 0.5
STEMS = (4, 5, 6)
NEAR = 5  # words between a lexicon word and a second-person word
REMEMBERED, LONGEST = 200_000, 64  # words whose values a worker keeps, and their letters
ROUNDS, DEPTH, RATE, BINS, RIDGE, LEAST_LEAF = 80, 3, 0.15, 32, 2.0, 3.0
THRESHOLD = 0.7

# Frequent insults and second-person words of the four languages of the corpus.
INSULTS = frozenset(
    "idiot idiots moron stupid dumb fool loser losers pathetic worthless trash garbage scum clown disgusting ugly freak jerk bastard "
    "idiotisch dumm dummkopf blöd trottel abschaum versager erbärmlich wertlos widerlich arschloch depp "
    "idiote imbécile stupide crétin abruti ordure débile minable dégoûtant connard nul "
    "idiota imbécil estúpido estúpida tonto basura escoria perdedor patético asqueroso inútil payaso".split())
SECOND_PERSON = frozenset("you your yours yourself du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())

FEATURES = (
    "insults_per_word", "value_per_word", "log_hits", "strongest", "strongest_three", "distinct_hits_per_word", "hits_near_second_person",
    "second_person_per_word", "capitals_per_letter", "shouted_per_word", "bangs_per_word", "questions_per_word", "repeated_marks_per_word",
    "broken_per_word", "hidden_per_word", "spelt_per_word", "log_words",
)

_words = re.compile(r"[^\W\d_]+").findall
_shouted = re.compile(r"(?<![^\W\d_])[A-Z]{3,}+(?![^\W\d_])").findall
_marks = re.compile(r"[!?]{2,}+").findall
_broken = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[\d@$*!|+]++[^\W\d_]++)+").findall
_spelt = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-]){3,}[^\W\d_](?!\w)").findall
_LEET = str.maketrans("01345789@$!|+", "oieastbgasiit")  # what the sign stands for
_SIGNS = str.maketrans("", "", "0123456789@$*!|+")
_GAPS = str.maketrans("", "", " .-")
_UPPER = bytes(range(65, 91))


def units(text: str) -> set[str]:
    """The different words of a text and their beginnings, marked by a star."""
    found = set(_words(text.lower()))
    return found | {w[:n] + "*" for n in STEMS for w in found if len(w) > n}


class Values(dict):
    """The values of words, worked out when first asked for; zero where the lexicon has no unit of theirs."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __reduce__(self):
        return Values, (self.lexicon,)

    def __missing__(self, word: str) -> float:
        of = self.lexicon.get
        value = max(0.0, of(word, 0.0), *[of(word[:n] + "*", 0.0) for n in STEMS if len(word) > n])
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= LONGEST:
            self[word] = value
        return value


def features(text: str, values: Values) -> list[float]:
    low = text.lower()
    words = _words(low)
    n = max(1, len(words))
    each = np.fromiter(map(values.__getitem__, words), np.float64, len(words))
    at = np.flatnonzero(each)
    hits = {words[i]: each[i] for i in at}
    strongest = sorted(hits.values(), reverse=True)[:3]
    persons = np.flatnonzero(np.fromiter(map(SECOND_PERSON.__contains__, words), np.bool_, len(words)))
    near = 0
    if len(at) and len(persons):
        right = np.searchsorted(persons, at)
        after = np.abs(persons[np.minimum(right, len(persons) - 1)] - at)
        near = int((np.minimum(after, np.abs(at - persons[np.maximum(right - 1, 0)])) <= NEAR).sum())
    data = text.encode("utf-8", "replace")
    broken, spelt = _broken(low), _spelt(low)
    hidden = sum(values[t.translate(_LEET).replace("*", "")] > 0 or values[t.translate(_SIGNS)] > 0 for t in broken) + sum(values[t.translate(_GAPS)] > 0 for t in spelt)
    return [
        sum(map(INSULTS.__contains__, words)) / n,
        float(each.sum()) / n,
        float(np.log1p(len(at))),
        strongest[0] if strongest else 0.0,
        float(sum(strongest)),
        len(hits) / n,
        near / n,
        len(persons) / n,
        (len(data) - len(data.translate(None, _UPPER))) / max(1, sum(map(len, words))),
        len(_shouted(text)) / n,
        data.count(b"!") / n,
        data.count(b"?") / n,
        len(_marks(text)) / n,
        len(broken) / n,
        hidden / n,
        len(spelt) / n,
        float(np.log1p(len(words))),
    ]


def lexicon_of(counted: list[tuple[str, list[int], list[int]]], toxic: list[int], clean: list[int], without: int | None) -> dict[str, float]:
    """Units (unit, toxic rows by fold, clean rows by fold) to their log-odds, the fold `without` left out."""
    kept = [k for k in range(FOLDS) if k != without]
    n_toxic, n_clean = sum(toxic[k] for k in kept), sum(clean[k] for k in kept)
    out = {}
    for unit, bad, good in counted:
        b, g = sum(bad[k] for k in kept), sum(good[k] for k in kept)
        odds = np.log((b + SMOOTHING) / (n_toxic + 2 * SMOOTHING)) - np.log((g + SMOOTHING) / (n_clean + 2 * SMOOTHING))
        expected = n_toxic * (b + g) / max(1, n_toxic + n_clean)
        if b >= LEAST_TOXIC and odds >= LEAST_ODDS and b - expected >= LEAST_DEVIATION * np.sqrt(expected):
            out[unit] = float(odds)
    return out


@dataclass(frozen=True)
class Trees:
    """Complete trees of DEPTH levels: inner node i has children 2i+1 and 2i+2; values at or below the cut go left."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows, inner = np.arange(len(x)), (1 << DEPTH) - 1
        out = np.full(len(x), self.start)
        for feature, cuts, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cuts[node])
            out += leaf[node - inner]
        return out


def boosted(x: np.ndarray, y: np.ndarray) -> Trees:
    """Gradient boosting on the logistic loss, second-order leaf values, cuts between quantiles of each feature."""
    inner, leaves, width = (1 << DEPTH) - 1, 1 << DEPTH, x.shape[1]
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1) + np.arange(width) * BINS
    margin = np.full(len(y), start)
    chosen, cuts, values = [], [], []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = y - p, p * (1 - p)
        feature, at, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for i in range(inner):
            rows = np.flatnonzero(node == i)
            if len(rows):
                flat = binned[rows].ravel()
                g = np.bincount(flat, np.repeat(slope[rows], width), width * BINS).reshape(width, BINS).cumsum(axis=1)
                h = np.bincount(flat, np.repeat(bend[rows], width), width * BINS).reshape(width, BINS).cumsum(axis=1)
                n = np.bincount(flat, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g * g / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE) - all_g ** 2 / (all_h + RIDGE)
                gain[(n < LEAST_LEAF) | (n[:, -1:] - n < LEAST_LEAF)] = 0
                f, b = np.unravel_index(gain.argmax(), gain.shape)
                if gain[f, b] > 1e-9 and b < len(edges[f]):
                    feature[i], at[i] = f, edges[f][b]
            node = np.where(node == i, 2 * node + 1 + (x[np.arange(len(x)), feature[i]] > at[i]), node)
        place = node - inner
        leaf = RATE * np.bincount(place, slope, leaves) / (np.bincount(place, bend, leaves) + RIDGE)
        margin += leaf[place]
        chosen.append(feature)
        cuts.append(at)
        values.append(leaf)
    return Trees(start, np.array(chosen), np.array(cuts), np.array(values))


def isotonic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled neighbours: block centres and their non-decreasing shares, for interpolation."""
    at, of = np.unique(margin, return_inverse=True)
    total, good = np.bincount(of, weight), np.bincount(of, weight * y)
    blocks: list[list[float]] = []  # sums of weight, weight * y, weight * margin
    for m, v, w in zip(at, good, total):
        blocks.append([w, v, w * m])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    found = np.array(blocks)
    return found[:, 2] / found[:, 0], found[:, 1] / found[:, 0]


@dataclass(frozen=True)
class Model:
    values: Values
    trees: Trees | None
    centres: np.ndarray
    shares: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The calibrated probability; without trees the one share that was seen."""
        if self.trees is None:
            return np.full(len(x), self.shares[0])
        return np.clip(np.interp(self.trees.margin(x), self.centres, self.shares), 0.0, 1.0)


def trained(x: np.ndarray, y: np.ndarray, fold: np.ndarray, weight: np.ndarray, lexicon: dict[str, float]) -> Model:
    """The model of sample rows whose features left out their own fold."""
    if not len(y) or y.min() == y.max():
        share = (weight @ y + 0.5) / (weight.sum() + 1) if len(y) else 0.5
        return Model(Values({}), None, np.zeros(1), np.array([share]))
    margin = np.empty(len(y))
    for k in np.unique(fold):
        inside = fold == k
        margin[inside] = boosted(x[~inside], y[~inside]).margin(x[inside]) if (~inside).any() else 0.0
    return Model(Values(lexicon), boosted(x, y), *isotonic(margin, y, weight))


def sample(documents: DataFrame, labels: DataFrame, per_label: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label, fold, text) of at most `per_label` rows a label, written out; and how many ids each label has."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("label"))
    usable = known.join(documents.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    sizes = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    chosen = None
    for label, size in sorted(sizes.items()):  # two at most
        low = usable.where((F.col("label") == label) & among_least(F.xxhash64("doc_id"), per_label, size))
        least = low.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        chosen = least if chosen is None else chosen.unionByName(least)
    chosen = usable.limit(0) if chosen is None else chosen
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")  # at most 2 * per_label
    one = texts.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int")
    return cut(one.select("doc_id", "label", fold.alias("fold"), "least.text"), "toxic-sample"), sizes


def counted_units(rows: DataFrame, toxic: list[int], clean: list[int], limit: int) -> list[tuple[str, list[int], list[int]]]:
    """The units of the sample that tell the labels apart, at most `limit`, with their toxic and clean rows by fold.

    `toxic` and `clean` are the rows of each fold. The bound on the deviation is a little lower than
    the lexicon's, as a unit may pass that one without a fold.
    """

    @F.arrow_udf("array<string>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(units(t.as_py())) for t in texts], pa.list_(pa.string()))

    per_fold = [F.count_if((F.col("label") == label) & (F.col("fold") == k)).alias(f"n_{label}_{k}") for label in (1, 0) for k in range(FOLDS)]
    counts = rows.select("label", "fold", F.explode(of("text")).alias("unit")).groupBy("unit").agg(*per_fold)
    bad, good = (sum((F.col(f"n_{label}_{k}") for k in range(FOLDS)), F.lit(0)) for label in (1, 0))
    expected = (bad + good) * (sum(toxic) / max(1, sum(toxic) + sum(clean)))
    often = counts.where(bad >= LEAST_TOXIC).withColumn("deviation", (bad - expected) / F.sqrt(expected))
    telling = often.where(F.col("deviation") >= 0.8 * LEAST_DEVIATION).orderBy(F.desc("deviation"), "unit").limit(limit)
    return [(r["unit"], [r[f"n_1_{k}"] for k in range(FOLDS)], [r[f"n_0_{k}"] for k in range(FOLDS)]) for r in telling.collect()]


def fit(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Learn from labels (doc_id, toxic) of these documents."""
    rows, sizes = sample(documents, labels, per_label)
    taken = {(r["label"], r["fold"]): r["count"] for r in rows.groupBy("label", "fold").count().collect()}  # at most 2 * FOLDS
    by_fold = {label: [taken.get((label, k), 0) for k in range(FOLDS)] for label in (0, 1)}
    counted = counted_units(rows, by_fold[1], by_fold[0], LEXICON) if min(sum(by_fold[0]), sum(by_fold[1])) else []
    without = [lexicon_of(counted, by_fold[1], by_fold[0], k) for k in range(FOLDS)]
    shared = rows.sparkSession.sparkContext.broadcast([Values(lexicon) for lexicon in without])

    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array, folds: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py(), shared.value[k.as_py()]) for t, k in zip(texts, folds)], pa.list_(pa.float64()))

    found = sorted(rows.select("doc_id", "label", "fold", measured("text", "fold").alias("x")).collect(), key=lambda r: r["doc_id"])  # at most 2 * per_label
    y = np.array([r["label"] for r in found], np.float64)
    weight = np.array([sizes[r["label"]] / sum(by_fold[r["label"]]) for r in found])
    x = np.array([r["x"] for r in found]).reshape(-1, len(FEATURES))
    return trained(x, y, np.array([r["fold"] for r in found], np.int64), weight, lexicon_of(counted, by_fold[1], by_fold[0], None))


def scores(model: Model, text: Column, spark) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        held = shared.value
        return pa.array(held.scores(np.array([features(t.as_py(), held.values) for t in texts]).reshape(-1, len(FEATURES))), pa.float64())

    return scored(F.coalesce(text, F.lit("")))


def op13_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    out = held_out(F.col("doc_id"), 3, 1)
    model = fit(documents.where(~out).select("doc_id", "text"), labels)
    judged = documents.select("doc_id", out.alias("held_out"), scores(model, F.col("text"), documents.sparkSession).alias("score"))
    return judged.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
