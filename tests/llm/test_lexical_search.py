"""Ranked search: the whole query against plain loops and SQL, exact tiles, ties, defined cases."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallywick.llm import lexical_search as ops

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=20):
    counted = [(d, Counter(plain_terms(t)), len(plain_terms(t))) for d, t in docs]
    counted = [c for c in counted if c[2]]
    n_docs, n_terms = len(counted), sum(c[2] for c in counted)
    df = Counter(term for _, c, _ in counted for term in c)
    out = []
    for item, text in items:
        found = []
        for doc, tf, n in counted:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in plain_terms(text) if tf[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocabulary = ["w%d" % int(rng.paretovariate(0.7)) for _ in range(400)] + ["Ünder", "ÜNDER", "don't", "x_y", "a1", "日本"]
    text = lambda low, high: " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(low, high)))
    docs = [(i, text(1, 60)) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(60)]  # equal scores beyond the twentieth place
    return docs, [(i, text(1, 25)) for i in range(30)]


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_loops(spark, seed):
    docs, items = corpus(seed)
    items[3] = (3, docs[3][1])
    assert rows(ops.op11_lexical_search(*frames(spark, docs, items))) == plain(docs, items)


def test_defined_cases(spark):
    docs, items = corpus(5, 80)
    docs += [(None, docs[3][1]), (None, docs[4][1]), (7, None), (8, ""), (9, " .,!\n"), (3, docs[3][1]), (3, docs[3][1]), (900, "long " * 100_000 + "w1"), (901, "x" * 200_000)]
    items += [(None, "w1 w2"), (2, "w3"), (2, "w3"), (50, None), (51, ""), (52, "..."), (53, "nowhere"), (54, "x" * 200_000), (55, "w1 " * 50_000)]
    documents, benchmark = frames(spark, docs, items)
    clashing = documents.withColumn("row", F.lit("r")).withColumn("terms", F.lit(1)).withColumn("score", F.lit(2.5)).withColumn("n", F.lit(0)).withColumn("item_id", F.lit(0))
    named = benchmark.withColumn("grp", F.lit("g")).withColumn("doc_id", F.lit(9)).withColumn("rank", F.lit(9)).withColumn("size", F.lit(9))
    assert rows(ops.op11_lexical_search(clashing, named)) == plain(docs, items)


def test_empty_tables(spark):
    docs, items = corpus(6, 10)
    documents, benchmark = frames(spark, docs, items)
    for d, b in ((documents.limit(0), benchmark), (documents, benchmark.limit(0)), (documents.withColumn("text", F.lit("..")), benchmark)):
        got = ops.op11_lexical_search(d, b)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0
        assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint"]


def test_groups_of_items_give_the_same(spark):
    docs, items = corpus(7, 100)
    documents, benchmark = frames(spark, docs, items)
    assert rows(ops.search(documents, benchmark, group_bytes=600)) == plain(docs, items)


def test_sql(spark):
    docs, items = corpus(8, 120)
    docs += [(7, None), (8, ""), (3, docs[3][1])]
    items += [(2, "w3"), (50, None)]
    documents, benchmark = (df.toPandas() for df in frames(spark, docs, items))
    con = duckdb.connect()
    con.register("documents", documents)
    con.register("benchmark", benchmark)
    got = con.execute("select item_id, rank, doc_id, score from (" + ops.SQL + ")").fetchall()
    assert sorted((tuple(int(x) for x in r) for r in got), key=repr) == plain(docs, items)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=80))
def test_terms_of_bytes(data):
    text = data.decode("utf-8", "ignore")
    assert [t.decode() for t in ops.terms(text.encode())] == plain_terms(text)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(0, 30), st.dictionaries(st.integers(0, 5), st.integers(1, 10 ** 6), min_size=1), min_size=1), st.integers(1, 7), st.sampled_from([1 << 53, 1 << 45, 1 << 36]))
def test_vocabulary_tiles_are_exact(counts, width, exact):
    weights = np.arange(31, dtype=np.int64) * 97
    total = Counter()
    for tile in ops.vocab_tiles(counts, weights, width, exact):
        assert len(set(tile.terms.tolist())) == len(tile.terms) <= width
        most = np.zeros(len(tile.terms), object)
        for i, k, c in zip(tile.item, tile.column, tile.count):
            most[k] = max(most[k], int(c))
            total[int(tile.terms[k]), int(i)] += int(c)
        assert sum(int(c) * max(1, int(weights[t])) * ops.LARGEST for t, c in zip(tile.terms, most)) < exact
    assert total == {(t, i): c for t, of in counts.items() for i, c in of.items()}


def test_counts_beyond_exact_doubles():
    """One term 10^12 times in an item: the score passes 2^53 and is still the integer it should be."""
    weights = np.array([20_000, 13], np.int64)
    tiles = ops.item_tiles([(0, [0, 1], [10 ** 8, 3])], weights)
    scorer = ops.Scorer(tiles, weights, 10, 1000, 5)
    impact = scorer.impacts(np.array([0, 1]), np.array([999, 7]), np.array([100, 100]))
    got = scorer.scores(tiles[0], 1, np.zeros(2, np.int64), np.array([0, 1]), impact)
    assert len(tiles[0].tiles) > 1 and int(got[0, 0]) == 10 ** 8 * int(impact[0]) + 3 * int(impact[1]) > 1 << 53


def test_best_keeps_ties_by_id():
    rng = np.random.default_rng(4)
    scores, docs = rng.integers(0, 4, (500, 3)), rng.permutation(500)
    best = ops.Best(3, 20)
    for at in range(0, 500, 64):
        best.add(scores[at:at + 64], docs[at:at + 64])
    for i in range(3):
        want = sorted((-s, d) for s, d in zip(scores[:, i], docs) if s > 0)[:20]
        assert [(-s, d) for s, d in zip(best.score[best.item == i], best.doc[best.item == i])] == want
