"""Quality rules against brute force."""

import random
import re
from collections import Counter

from tallywick.llm import quality_rules


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), n < 50 or 100 * len(inside) > 50 * n


def texts():
    rng = random.Random(4)
    vocabulary = "the of and to été über niño a b c x1 # $$ | <b> and so".split(" ")
    made = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (0, 1, 2, 3, 49, 50, 51, 200, 3000)]
    made += ["\n".join(rng.choice(["the one line", " ", "", "another of them", "\t"]) for _ in range(80)) for _ in range(4)]
    made += ["word " * 5000, "a\x0bb\x0cc\rd\x1fe\x85f " * 30, " ".join(str(i) for i in range(20000)), "q w e r " + " ".join(map(str, range(100))) + " q w e r"]
    return [None, "", *made, *made[:3]]


def test_against_brute_force(spark):
    rows = [(i, t, "kept", 0) for i, t in enumerate(texts())] + [(None, "no id", "x", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    got = {r["doc_id"]: tuple(r)[1:7] for r in quality_rules.op2_quality_rules(frame).collect()}
    assert got == {i: plain(t) for i, t, *_ in rows}


def test_verdict(spark):
    rng = random.Random(2)
    clean = " ".join(rng.choice("the and of tree river stone house walk sing light under over green blue".split()) + rng.choice(["", "s", "ly"]) for _ in range(150))
    bad = [clean.replace(" ", "*** "), clean.replace(" ", "!! "), " ".join("zq%d" % i for i in range(90)), "same line of the text\n" * 20]
    frame = spark.createDataFrame([(0, clean)] + [(i, t) for i, t in enumerate(bad, 1)], "doc_id long, text string")
    got = {r["doc_id"]: r["kept"] for r in quality_rules.op2_quality_rules(frame).collect()}
    assert got == {0: True, 1: False, 2: False, 3: False, 4: False}


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = quality_rules.op2_quality_rules(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert quality_rules.op2_quality_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0
