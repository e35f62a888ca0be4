"""SimHash near-duplicates over a Gray-order hierarchical index.

A text's fingerprint has a bit for each bit that over half the hashes of its word shingles
set. Two fingerprints link when they differ in at most `distance` bits.

The index finds every link and looks at few pairs:

* Upper nodes. The 64 bits fall into distance + e runs. Linked fingerprints agree on at
  least e whole runs, so each fingerprint stands below one node for each choice of e runs (a mask), the
  node of all that share its masked pattern; only fingerprints of one node meet. More fingerprints
  get a greater e, hence longer patterns: nodes hold NODE_CODES or so at any size of the table, if
  bits are spread evenly. Nodes are spread over the cluster by (mask, pattern). Equal fingerprints
  are one entry from the start, so exact copies don't make a node heavy.
* Inside a node the fingerprints are sorted by Gray rank, where neighbours share most bits.
  Runs of FAN form lower nodes, runs of those the next level; each keeps the bits on which
  all below it agree, and which of them it adds to its parent's. Going down, a pair of nodes adds the
  differences among the added bits to those counted above; past `distance` it is dropped with
  all pairs below it; so are nodes that are already one component.
* Out of a node come at most as many links as it has fingerprints (each with the least of its
  component there), never all pairs.

Documents get the component of their fingerprint from a table of fingerprints: sent to every task while
it has at most MAX_SENT rows; beyond that only the fingerprints of over HOT documents are sent, and the
others, none of which has many documents, are joined.

Defined results: null and blank texts have fingerprint zero, which links like any other; the
component id is the least doc_id that is not null (null if there is none); repeated rows and
ids are each returned; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallywick.llm.common import ids_and_texts
from tallywick.llm.components import components
from tallywick.session import cut

SHINGLE = 4
DISTANCE = 4
SEED = 42
FAN = 32
AT_ONCE = 2048  # node pairs that are compared at once
NODE_CODES = 4096  # fingerprints of an upper node, about
MOST_RUNS = 4  # that a mask takes
MAX_SENT = 100_000  # rows of 16 bytes
HOT = 100_000  # documents of one fingerprint
ROWS_AT_ONCE = 4096  # hashes whose bits are unpacked at once


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8", "replace").lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), ">u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, ROWS_AT_ONCE):
        bits = np.unpackbits(hashes[at:at + ROWS_AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint16)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The 64 bits as a signed long."""

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py() or "", shingle) for t in texts], pa.int64())

    return of(F.coalesce(text, F.lit("")))


def fingerprints(df: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp)."""
    return df.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp"))


def masks(distance: int, taken: int = 1) -> list[int]:
    """All choices of `taken` of distance + taken runs of bits that make up all 64."""
    runs = distance + taken
    ends = [64 * k // runs for k in range(runs + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(ends, ends[1:])]
    return [sum(chosen) for chosen in combinations(parts, taken)]


def runs_taken(n: int, distance: int, node_codes: int = NODE_CODES) -> int:
    """How many runs a mask takes, so that n evenly spread fingerprints make nodes of at most `node_codes`."""
    taken = 1
    while taken < min(MOST_RUNS, 64 - distance) and n > node_codes * 2 ** (64 * taken // (distance + taken)):
        taken += 1
    return taken


def gray_rank(codes: np.ndarray) -> np.ndarray:
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def joined_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`root` after the links (a, b): each entry points to the least index of its component."""
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (nearer := root[root]).tobytes() != root.tobytes():
            root = nearer
    return root


def differing(a: tuple, b: tuple) -> np.ndarray:
    """Differences between nodes that their parents don't show: places that at least one of the two adds, with unlike values.

    Each is (ones, zeros, added ones, added zeros): the places on which all below it agree, by value, and
    those of them on which the parent's don't all agree.
    """
    return np.bitwise_count((a[2] & b[1]) | (a[3] & b[0]) | (b[2] & a[1]) | (b[3] & a[0]))


class GrayIndex:
    """The tree over the fingerprints of one upper node; `levels[0]` are the fingerprints, `levels[1]` their runs, and so on."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        shared = [(self.codes, ~self.codes)]
        while len(shared[-1][0]) > 1 or len(shared) == 1:
            starts = np.arange(0, len(shared[-1][0]), FAN)
            shared.append(tuple(np.bitwise_and.reduceat(x, starts) for x in shared[-1]))
        self.levels = []
        for (ones, zeros), above in zip(shared, [*shared[1:], None]):
            parent = np.arange(len(ones)) // FAN
            open_ = ~(above[0] | above[1])[parent] if above else ~np.zeros(len(ones), np.uint64)
            self.levels.append((ones, zeros, ones & open_, zeros & open_))

    def nodes(self, level: int, at: np.ndarray) -> tuple:
        return tuple(x[at] for x in self.levels[level])

    def roots(self, distance: int) -> np.ndarray:
        """For each code, the index of the least code (in Gray order) of its component.

        A pair of nodes carries the differences counted above it; what its own shared bits add is added up,
        and a pair past `distance` is dropped with all pairs below it.
        """
        n = len(self.codes)
        root = np.arange(n)
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.uint8))]
        step = np.arange(FAN)
        while stack:
            level, a, b, count = stack.pop()
            if len(a) > AT_ONCE:  # the nearest pairs first: they join most
                stack.append((level, a[AT_ONCE:], b[AT_ONCE:], count[AT_ONCE:]))
                a, b, count = a[:AT_ONCE], b[:AT_ONCE], count[:AT_ONCE]
            below = len(self.levels[level - 1][0])
            if level == 1 and n > FAN:
                starts = np.arange(0, n, FAN)
                low, high = np.minimum.reduceat(root, starts), np.maximum.reduceat(root, starts)
                open_ = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
                a, b, count = a[open_], b[open_], count[open_]
            for at in range(0, len(a), 64):
                part = slice(at, at + 64)
                x, y = a[part, None] * FAN + step, b[part, None] * FAN + step
                left, right = np.minimum(x, below - 1)[:, :, None], np.minimum(y, below - 1)[:, None, :]
                if level == 1:  # all places of a fingerprint are shared: the sum is what the two differ in
                    total = np.bitwise_count(self.codes[left] ^ self.codes[right])
                else:
                    total = count[part, None, None] + differing(self.nodes(level - 1, left), self.nodes(level - 1, right))
                kept = (total <= distance) & (x < below)[:, :, None] & (y < below)[:, None, :]
                pair, i, j = np.nonzero(kept & ((left < right) if level == 1 else (left <= right)))
                x, y = x[pair, i], y[pair, j]
                if level == 1:
                    root = joined_roots(root, x, y)
                else:
                    order = np.argsort(y - x, kind="stable")
                    stack.append((level - 1, x[order], y[order], total[pair, i, j][order]))
        return root


def node_links(codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Each linked code of one node with the head of its component there."""
    if len(codes) <= FAN:
        near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= distance
        if near.sum() == len(codes):
            return codes[:0], codes[:0]
    index = GrayIndex(codes)
    root = index.roots(distance)
    hung = root != np.arange(len(root))
    return index.codes[hung], index.codes[root[hung]]


def links(distinct: DataFrame, distance: int = DISTANCE, taken: int = 1) -> DataFrame:
    """(a, b): links between the distinct fingerprints `fp` that join the same components as all links do."""
    patterns = [F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("pattern"))
                for k, m in enumerate(masks(distance, taken))]
    below = distinct.select("fp", F.inline(F.array(*patterns))).repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, key = [], None

        def out(pairs):
            a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in zip(*pairs)) if pairs else ([], [])
            return pd.DataFrame({"a": np.asarray(a, np.uint64).view(np.int64), "b": np.asarray(b, np.uint64).view(np.int64)})

        for batch in batches:
            mask, pattern = batch["mask"].to_numpy(), batch["pattern"].to_numpy()
            codes = batch["fp"].to_numpy().view(np.uint64)
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])) + 1
            found = []
            for codes_of, at in zip(np.split(codes, cuts), [0, *cuts]):
                now = (mask[at], pattern[at])
                if now != key and held:
                    found.append(node_links(np.concatenate(held), distance))
                    held = []
                key = now
                held.append(codes_of)
            yield out(found)
        if held:
            yield out([node_links(np.concatenate(held), distance)])

    return below.mapInPandas(linked, "a bigint, b bigint")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, node_codes: int = NODE_CODES, max_sent: int = MAX_SENT, hot: int = HOT) -> DataFrame:
    """(doc_id, fp, component_id), one row per input row."""
    docs = cut(fingerprints(ids_and_texts(df, id_col, text_col), shingle), "fingerprints")
    firsts = cut(docs.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_docs")), "distinct-fingerprints")
    n = firsts.count()
    roots = components(links(firsts.select("fp"), distance, runs_taken(n, distance, node_codes)))
    heads = roots.join(firsts, roots["node"] == firsts["fp"])
    least = heads.groupBy("root").agg(F.min("first").alias("component_id"))
    joined = roots.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    of = firsts.join(joined, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"), "n_docs")
    wanted = ["doc_id", "fp", "component_id"]
    if n <= max_sent:
        return docs.join(F.broadcast(of.drop("n_docs")), "fp").select(*wanted)
    of = cut(of, "fingerprint-components")
    heavy, light = of.where(F.col("n_docs") > hot), of.where(F.col("n_docs") <= hot)
    many = docs.join(F.broadcast(heavy.drop("n_docs")), "fp").select(*wanted)  # at most a row for `hot` documents
    few = docs.join(F.broadcast(heavy.select("fp")), "fp", "left_anti").join(light, "fp").select(*wanted)
    return many.unionByName(few)


def op3_simhash(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
