"""Decontamination against brute force, with the filter and by the shuffled join."""

import hashlib
import random
import re

import pytest

from tallywick.llm import decontamination

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if w else ():
            if item is not None:
                windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    sizes = {len(x) for x in windows}
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def tables():
    rng = random.Random(12)
    prose = lambda n: " ".join(rng.choice("the of and über to x1 river stone Été walk".split()) + str(rng.randrange(9)) for _ in range(n))
    items = [(i, prose(rng.randrange(13, 50))) for i in range(30)]
    items += [(30, "Short one"), (31, "word"), (32, ""), (33, None), (None, prose(20)), (5, prose(20)), (40, items[3][1]), (41, items[3][1] + " more words here"), (42, "a b")]
    docs = []
    for i in range(120):
        parts = [prose(rng.randrange(0, 120))]
        if i % 2:
            parts.append(rng.choice(items[:30])[1].upper().replace(" ", ", "))
        parts.append(prose(rng.randrange(0, 200)))
        docs.append((i, "\n".join(parts)))
    docs += [(200, None), (201, ""), (202, "short ONE"), (203, "word " * 3000), (204, "a b a b"), (None, items[0][1]), (205, items[4][1]), (205, items[4][1])]
    return docs, items


@pytest.mark.parametrize("bound", [decontamination.MAX_WINDOWS, 3])
def test_against_brute_force(spark, bound):
    docs, items = tables()
    documents = spark.createDataFrame([(*d, 7, "x") for d in docs], "doc_id long, text string, row int, items string")
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, window string")
    from pyspark.sql import functions as F

    got = decontamination.decontaminate(documents, benchmark, max_windows=bound).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long"), F.sha2(F.array_join("items", ","), 256), "contaminated")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(docs, items), key=repr)


def test_empty_tables(spark):
    documents, benchmark = spark.createDataFrame([(1, "some text")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in decontamination.op6_decontamination(documents, benchmark).collect()] == [(2, 0, False)]
    assert decontamination.op6_decontamination(documents.limit(0), benchmark).count() == 0


def test_native(spark):
    documents, benchmark = spark.createDataFrame([(1, "some text")], "doc_id long, text string"), spark.createDataFrame([(1, "some text")], "item_id long, text string")
    plan = decontamination.op6_decontamination(documents, benchmark)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("most", [decontamination.MAX_WINDOWS, 1])
def test_a_very_long_text(spark, most):
    """Passages at both ends and in the middle of a text of a hundred thousand words."""
    rng = random.Random(31)
    word = lambda: "w%d" % rng.randrange(5000)
    items = [(i, " ".join(word() for _ in range(40))) for i in range(5)] + [(5, "w1 w2")]
    long = f"{items[0][1]} {' '.join(word() for _ in range(50_000))} {items[1][1].upper()} {' '.join(word() for _ in range(50_000))} {items[2][1]}"
    docs = [(1, long), (2, items[3][1]), (3, "x" * 1_000_000)]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontaminate(*frames, max_windows=most)
    rows = [(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["contaminated"]) for r in got.collect()]
    assert sorted(rows) == sorted(plain(docs, items))
