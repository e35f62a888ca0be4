"""Filter audit against plain loops over every order, against SQL, and in its defined cases."""

import random
from collections import Counter
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from tallywick.llm import filter_audit as ops

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
BLANKS = " \t\n\x0b\x0c\r"


def plain(docs, labels):
    """docs (doc_id, text, lang), labels (doc_id, quality, toxic)."""
    docs = [(d, t or "", p or "") for d, t, p in docs]
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, x in labels if d is not None and x == 1}
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t] = min(least.get(t, d), d)
    fails = []
    for d, t, _ in docs:
        words = "".join(" " if c in BLANKS else c for c in t).split(" ")
        words = [w for w in words if w]
        fails.append({f for f, bad in (
            ("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)), ("C", 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t)),
            ("D", any(c in "#$%&*|" for c in t)), ("E", d is not None and least[t] < d)) if bad})
    out = []
    for part in {p for _, _, p in docs}:
        of = [i for i, (_, _, p) in enumerate(docs) if p == part]
        rows, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = set(of)
            for step, f in enumerate(order, 1):
                removed = {i for i in left if f in fails[i]}
                redundant = sum(f in fails[i] for i in of) - len(removed)
                left -= removed
                shapley[f] += len(removed)
                alone = sum(fails[i] == {f} for i in of)
                rows.append((part, "".join(order), step, len(left), len(removed), redundant, alone, sum(docs[i][0] in good for i in removed), sum(docs[i][0] in toxic for i in removed), f))
        out += [(*r[:-1], shapley[r[-1]]) for r in rows]
    return sorted(out)


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(500)]
    docs = []
    for i in range(n):
        words = [rng.choice(vocabulary[:rng.choice([60, 500])]) for _ in range(rng.choice([20, 99, 100, 150]))]
        text = rng.choice([" ", "\n", "\t "]).join(words)
        if rng.random() < 0.3:
            text = text.upper()
        if rng.random() < 0.3:
            text += " " + rng.choice("#$%&*|+")
        if rng.random() < 0.4 and docs:
            text = rng.choice(docs[-8:])[1]
        docs.append((i, text, rng.choice(["en", "de", None])))
    rng.shuffle(docs)
    return docs, [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, n, 2)]


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_loops(spark, seed):
    docs, labels = corpus(seed)
    assert rows(ops.op12_filter_audit(*frames(spark, docs, labels))) == plain(docs, labels)


ODD = [(None, "none", "en"), (None, "none", "en"), (0, "none", None), (400, None, "en"), (401, "", "en"), (402, None, None), (5, "five", "en"), (5, "five", "en"), (5, "other", "de"),
       (403, "five", "xx"), (404, "É" * 89 + "A" * 11, "fr"), (405, "É" * 90 + "A" * 10, "fr"), (406, "word " * 60_000, "fr"), (407, " ".join(map(str, range(50_000))), "fr")]


def test_defined_cases(spark):
    docs, labels = corpus(9, 40)
    docs, labels = docs + ODD, labels + [(None, 1, 1), (2, None, None), (4, 0, None), (4, 1, 0), (6, None, 1), (400, 1, 1), (5, 1, 1), (5, 1, 1), (777, 1, 1)]
    documents, marks = frames(spark, docs, labels)
    extra = {"part": F.lit("p"), "digest": F.lit(1), "n": F.lit(7), "A": F.lit("a"), "good": F.lit(False), "quality": F.lit(0), "seen": F.lit(3)}
    assert rows(ops.op12_filter_audit(documents.withColumns(extra), marks.withColumn("text", F.lit("x")).withColumn("good", F.lit("y")))) == plain(docs, labels)


def test_empty_tables(spark):
    docs, labels = corpus(4, 30)
    documents, marks = frames(spark, docs, labels)
    assert rows(ops.op12_filter_audit(documents.limit(0), marks)) == []
    assert rows(ops.op12_filter_audit(documents, marks.limit(0))) == plain(docs, [])
    clean = [(i, " ".join(f"w{i}x{k}" for k in range(120)), "en") for i in range(3)]
    got = rows(ops.op12_filter_audit(*frames(spark, clean, labels)))
    assert got == plain(clean, labels) and {r[3] for r in got} == {3}


def test_sql(spark):
    docs, labels = corpus(11, 60)
    labels += [(4, 0, 1), (None, 1, 1)]
    con = duckdb.connect()
    documents, marks = (df.toPandas() for df in frames(spark, docs + ODD, labels))
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    marks["doc_id"] = marks["doc_id"].astype("Int64")
    con.register("documents", documents)
    con.register("labels", marks)
    assert sorted(con.execute(f"select {', '.join(COLUMNS)} from ({ops.SQL})").fetchall()) == plain(docs + ODD, labels)


def test_thirty_megabytes_of_capitals(spark):
    """A hundred times their number is past an integer."""
    frame = spark.createDataFrame([(1, "en"), (2, "en")], "doc_id long, lang string").withColumn("text", F.repeat(F.lit("ABC DEF "), F.when(F.col("doc_id") == 1, 4_000_000).otherwise(1)))
    got = ops.judged(frame, "lang").orderBy("doc_id").select("A", "B", "C", "D").collect()
    assert [tuple(r) for r in got] == [(False, True, True, False), (True, False, True, False)]


def test_orders():
    table = ops.orders("ABCDE")
    assert len(table) == 600 and len({o for o, _, _, _ in table}) == 120
    assert ("BDACE", 3, "A", 0b01010) in table


def test_copies_are_no_join_key(spark):
    """A text on half the rows: the anti join that finds the copies is on ids."""
    docs, labels = corpus(12, 40)
    docs += [(1000 + i, docs[0][1], "en") for i in range(2000)]
    documents, marks = frames(spark, docs, labels)
    assert rows(ops.op12_filter_audit(documents, marks)) == plain(docs, labels)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ops.copies(ops.judged(documents, "lang"))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in plan
