"""N-gram counts by level-wise pruning: against plain counts, what is shuffled, the filter's promise."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tallywick.operators import ngrams, phrases
from tallywick.session import TIDY, cut


def plain(texts, n=5, least=3):
    counts = Counter()
    for text in texts:
        words = "".join(c if c.isascii() and c.isalpha() else " " for c in text.strip(" ")).lower().split()
        counts.update(" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1))
    return {p: c for p, c in counts.items() if c >= least}


def corpus(seed):
    rng = random.Random(seed)
    words = ["w" + chr(97 + int(rng.paretovariate(0.8)) % 26) + chr(97 + rng.randrange(26)) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))) for _ in range(120)]
    phrase = "One two, three four five six"
    return texts + [f"{phrase} {rng.choice(words)}" for _ in range(4)] + ["", "  ", "1 2 3", "a" * 9000, phrase, "hot " * 5000]


def test_counts(spark):
    for seed in (1, 2):
        texts = corpus(seed)
        frame = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
        got = {r["phrase"]: r["cnt"] for r in ngrams.ngram_counts(frame).collect()}
        assert got == plain(texts) and "one two three four five" in got and "hot hot hot hot hot" in got


def test_a_full_filter_holds_nothing_back(spark, monkeypatch):
    """With 64 words for thousands of phrases nearly all pass, and the counts are the same."""
    texts = corpus(3)
    monkeypatch.setattr(ngrams.blocked_filter, "__defaults__", (64,))
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r["phrase"]: r["cnt"] for r in ngrams.ngram_counts(frame, 3, 2).collect()} == plain(texts, 3, 2)


def test_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    filled = ngrams.blocked_filter(keys)
    assert ngrams.passing(keys, "key", *filled).count() == 5000
    others = spark.range(5000, 105_000).select(F.xxhash64("id").alias("key"))
    assert ngrams.passing(others, "key", *filled).count() < 5000


def test_rare_phrases_are_not_shuffled(spark):
    """Of texts of unlike words only single words and what frequent words begin is written out."""
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(50)) for _ in range(200)] + ["often said words"] * 5
    tokens = spark.createDataFrame([(t.split(),) for t in texts], "tokens array<string>")
    pairs = tokens.select(F.inline(F.transform(F.slice("tokens", 1, F.size("tokens") - 1), lambda x, i: F.struct(F.xxhash64(x).alias("first"), F.xxhash64(F.get("tokens", i + 1)).alias("second")))))
    often = spark.createDataFrame([(w,) for w in ("often", "said", "words")], "w string").select(F.xxhash64("w").alias("key"))
    filled = ngrams.blocked_filter(often)
    assert pairs.count() == 200 * 49 + 10
    assert 10 <= ngrams.passing(ngrams.passing(pairs, "first", *filled), "second", *filled).count() <= 30


def test_pieces_of_a_text(spark):
    """A long text is counted in pieces, each phrase in the one it begins in."""
    texts = corpus(5)
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for starts in (1, 3, 7):
        assert {r["phrase"]: r["cnt"] for r in ngrams.ngram_counts(frame, 5, 3, starts=starts).collect()} == plain(texts)
    long = ngrams.pieces(spark.createDataFrame([("hot " * 5000,), ("",), ("1",)], "text string"), 5)
    assert sorted(len(r["tokens"]) for r in long.collect()) == [1000] + [1004] * 4


def test_places_run_compiled(spark):
    """No step of a level after the explode is a higher-order function, which Spark would interpret place by place."""
    plans, cut = [], ngrams.cut
    ngrams.cut = lambda df, label: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), cut(df, label))[1]
    try:
        ngrams.ngram_counts(spark.createDataFrame([("a b c d e f",)] * 3, "text string")).collect()
    finally:
        ngrams.cut = cut
    assert len(plans) == 6 and not any("lambda" in p for p in plans[1:])


def test_empty_words_are_kept_when_asked(spark):
    frame = spark.createDataFrame([(" a b",), ("1a b",), ("2a b",), ("3a b",)], "text string")
    got = {r["phrase"]: r["cnt"] for r in ngrams.ngram_counts(frame, 2, 3, drop_empty=False).collect()}
    assert got == {"": 3, "a": 4, "b": 4, " a": 3, "a b": 4}


def through(texts, n=5, least=3, buckets=16, parts=3):
    """The counts, as tasks and buckets make them in one process, and the rows that each level sends."""

    class Sent:
        def __init__(self, keys):
            self.value, one = np.zeros(64, "u8"), np.uint64(1)
            for shift in (40, 46, 52):
                np.bitwise_or.at(self.value, (keys & np.uint64(63)).astype(int), one << ((keys >> np.uint64(shift)) & np.uint64(63)))

    lines = [pa.record_batch([pa.array(texts[k::parts], pa.string())], ["line"]) for k in range(parts)]
    out, rows, filters = {}, [], []
    for size in range(n):
        sent = pa.Table.from_batches([b for line in lines for b in phrases.sent(size, n, filters, 10_000, buckets, least)(iter([line]))])
        rows.append(sent.num_rows)
        keys = []
        for kind, bucket in {*zip(sent["kind"].to_pylist(), sent["bucket"].to_pylist(), strict=True)}:
            got = phrases.added(least)(sent.filter((pc.field("kind") == kind) & (pc.field("bucket") == bucket)))
            out |= {p: c for p, c in zip(got["phrase"].to_pylist(), got["cnt"].to_pylist(), strict=True) if p is not None}
            keys += got["key"].drop_null().to_pylist()
        filters = [Sent(np.array(keys, "i8").view("u8"))]
    return out, rows


def as_lines(texts):
    return [" ".join("".join(c if c.isascii() and c.isalpha() else " " for c in t).lower().split()) for t in texts]


def test_a_level_sends_rows_by_the_bucket():
    """Not one for each phrase: hashes and phrases go packed, so a shuffle has some rows a task however many phrases there are."""
    lines = [x for x in as_lines(corpus(6)) if x]
    got, rows = through(lines)
    assert got == plain(lines) and max(rows) <= 3 * 2 * 16 < len(got)


def test_phrases_of_one_hash_are_told_apart(monkeypatch):
    """Hashes choose what is counted; what is counted are the phrases, byte by byte, the long ones too."""
    lines = [x for x in as_lines(corpus(7)) if x] + ["a" * 300 + " b", "a" * 299 + "c b"] * 3 + ["q" * 40 + x + "q" * 40 for x in "xyz"] * 4
    monkeypatch.setattr(phrases, "_mixed", lambda x: x * np.uint64(0) + np.uint64(5))
    assert through(lines)[0] == plain(lines)


def test_shuffles_of_a_table_are_dropped_once_it_stands(spark):
    tracked = lambda: spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    before = tracked()
    stored = cut(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "tidied")
    assert stored.count() == 10 and spark.conf.get(TIDY, None) != "true"
    assert tracked() <= before + 1  # that of count()


def test_last_words_of_wide_phrases(spark):
    frame = spark.createDataFrame([("a  b c",), ("a b  c",), ("a b ",), (" a",), ("a",), ("",), ("é b",), ("  ",)], "phrase string")
    split = F.split("phrase", " +")
    new = frame.select(F.struct(*ngrams.split_last(F.col("phrase")))).collect()
    old = frame.select(F.struct(F.array_join(F.slice(split, 1, F.size(split) - 1), " "), F.element_at(split, -1))).collect()
    assert [tuple(r[0]) for r in new] == [tuple(r[0]) for r in old]
