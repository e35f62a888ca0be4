"""Fingerprints and components against brute force."""

import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallywick.llm import simhash


def plain_fingerprint(text, shingle=4):
    table = {c: c + 32 for c in range(65, 91)}
    blanks = " \t\n\x0b\x0c\r"
    words = "".join(" " if c in blanks else c for c in (text or "").translate(table)).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [words] if len(words) < shingle else [words[i:i + shingle] for i in range(len(words) - shingle + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, codes, distance):
    parent = list(range(len(codes)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= distance:
                parent[top(i)] = top(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [least.get(top(i)) for i in range(len(ids))]


TEXTS = ["", None, " \t\n", "One two", "a b c d", "A b C d e f", "É é É x y z w", "w " * 50, "the end.\nthe end of the line " * 300, "  odd  space\x0b here ok yes no"]


def test_fingerprint():
    for text in TEXTS:
        assert simhash.fingerprint(text or "") % (1 << 64) == plain_fingerprint(text)


@pytest.mark.parametrize("distance,size", [(4, 40), (4, 700), (0, 50), (9, 300)])
def test_index_finds_every_link(distance, size):
    rng = random.Random(size + distance)
    codes = [rng.getrandbits(64) for _ in range(size // 4)]
    while len(codes) < size:
        code = rng.choice(codes)
        for _ in range(rng.randrange(1, 8)):
            code ^= 1 << rng.randrange(64)
        codes.append(code)
    codes = list(dict.fromkeys(codes))
    index = simhash.GrayIndex(np.array(codes, np.uint64))
    got = index.roots(distance)
    want = plain_components(list(range(len(codes))), [int(c) for c in index.codes], distance)
    assert got.tolist() == want


def test_differences_add_up_to_those_of_the_codes():
    """Down the tree the added differences sum up: at each node to those among its shared bits, at the codes to all."""
    rng = np.random.default_rng(3)
    index = simhash.GrayIndex(np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) & np.uint64(0x00FF00FF00FF0F0F)))
    for _ in range(200):
        x, y = rng.integers(0, len(index.codes), 2)
        total = 0
        for level in range(len(index.levels) - 1, -1, -1):
            a, b = (index.nodes(level, np.array([i // simhash.FAN ** level])) for i in (x, y))
            total += int(simhash.differing(a, b)[0])
            assert total == int(np.bitwise_count((a[0] & b[1]) | (a[1] & b[0]))[0])
        assert total == int(np.bitwise_count(index.codes[x] ^ index.codes[y]))


def test_masks_cover_the_bits():
    for distance in range(12):
        parts = simhash.masks(distance)
        assert len(parts) == distance + 1 and sum(parts) == (1 << 64) - 1 and all(parts)


@pytest.mark.parametrize("taken", [1, 2, 3, 4])
def test_linked_codes_share_a_masked_pattern(taken):
    rng = random.Random(taken)
    parts = simhash.masks(4, taken)
    assert len(parts) == math.comb(4 + taken, taken)
    for _ in range(2000):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randrange(5)))
        assert any(not flips & m for m in parts)


def test_nodes_stay_small_as_the_table_grows():
    assert [simhash.runs_taken(n, 4) for n in (0, 10 ** 6, 10 ** 9, 10 ** 11, 10 ** 13)] == [1, 1, 2, 3, 4]
    assert all(n <= simhash.NODE_CODES * 2 ** (64 * simhash.runs_taken(n, 4) // (4 + simhash.runs_taken(n, 4))) for n in (10 ** 6, 10 ** 9, 10 ** 11, 10 ** 13))


@pytest.mark.parametrize("options", [{"node_codes": 0}, {"max_sent": 0, "hot": 3}, {"max_sent": 0, "hot": 10 ** 6}])
def test_other_sizes_give_the_same(spark, options):
    """Longer masks, and documents joined with their fingerprint's component, as a far larger table would have them."""
    rng = random.Random(9)
    rows = []
    for i in range(40):
        base = " ".join(f"w{rng.randrange(40)}" for _ in range(150))
        rows += [(4 * i, base), (4 * i + 1, base if i % 3 else base + " more"), (4 * i + 2, "same text for all of them here"), (4 * i + 3, base.replace("w1 ", "x "))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, simhash.near_duplicates(frame, **options).collect())) == sorted(map(tuple, simhash.near_duplicates(frame).collect()))


def test_a_very_long_text(spark):
    text = " ".join(f"word{i % 9973}" for i in range(200_000))
    frame = spark.createDataFrame([(1, text), (2, text + " end"), (3, "short")], "doc_id long, text string")
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.op3_simhash(frame).collect()}
    assert got == {1: (plain_fingerprint(text), 1), 2: (plain_fingerprint(text + " end"), 1), 3: (plain_fingerprint("short"), 3)}


def test_query(spark):
    rng = random.Random(5)
    texts = list(TEXTS)
    for _ in range(25):
        base = " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randrange(30)) for _ in range(200))
        texts += [base, base, base + " tail", base.replace("alpha", "omega", 1)]
    rows = [(i if i % 17 else None, t, "a", 1) for i, t in enumerate(texts)]
    rows += [rows[20], rows[20]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp string, node int")
    got = [tuple(r) for r in simhash.op3_simhash(frame).collect()]
    codes = [plain_fingerprint(t) for _, t, *_ in rows]
    ids = [r[0] for r in rows]
    want = [(d, f"{c:016x}", k) for d, c, k in zip(ids, codes, plain_components(ids, codes, 4))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert simhash.op3_simhash(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_chain(spark):
    from tallywick.llm.components import components

    chain = spark.range(400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(chain)
    assert got.count() == 401 and got.where("root <> 0").count() == 0
