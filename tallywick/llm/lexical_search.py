"""Ranked lexical search: item tiles times document tiles as dense float64 products.

A stated set of items (the queries) is ranked against every document. One scan splits each
text into terms and keeps, for the terms that some item has, their numbers and how often they
occur; that table is narrow and is all that later passes read. From it come the statistics of
the whole corpus (documents with a term N, terms L, documents per term df) and then the impacts
weight * ((10^9 tf) div (1000 tf + 12 m)) in 64-bit integers.

Scoring. Items go into tiles of ITEM_TILE with a compact vocabulary of their own, cut into
vocabulary tiles of at most VOCAB_TILE columns; documents go into tiles of DOC_TILE. A tile of
scores is the product of a documents x vocabulary tile of impacts and a vocabulary x items tile
of counts, by BLAS in float64. An impact is below 10^6 times its weight, so the sum over the
columns of (largest count * weight * 10^6) bounds every partial sum; a vocabulary tile is closed
before that passes 2^53, and a count too large for that is spread over several tiles. Each
product is therefore exact, and the tiles are added up in 64-bit integers.

Top-k. A task keeps each item's k best so far; of a new tile all scores at or above the k-th are
merged in, so equal scores are told apart by doc_id and never by their place. The tasks' lists
are merged twice: by item and one of SALTS parts, then by item.

Bounds. Items are taken in groups by the size of their different terms, at most GROUP_BYTES and one
item; each group is one pass over the documents, and only a group's terms, counts and weights
are held by the driver and sent to the tasks. Items beyond one group make more passes.

Defined results: a null or termless document is not counted and found by nothing; an item
without terms finds nothing; rows of the items that repeat, or share an item_id, are ranked one by
one; repeated documents count and are found row by row; ids are read as 64-bit integers, a null
doc_id comes after all others of its score; empty tables give an empty result; other columns are
not read. Texts are split whole, in time and memory proportional to their length.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallywick.llm.common import ids_and_texts, lower_ascii, words
from tallywick.operators.slices import running_sums
from tallywick.session import cut

TOP = 20
ITEM_TILE = 256
VOCAB_TILE = 2048
DOC_TILE = 512
SALTS = 64
GROUP_BYTES = 8 * 1024 * 1024
EXACT = 1 << 53
LARGEST = 10 ** 6  # every impact is below this times its term's weight
NOT_A_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LAST = np.iinfo(np.int64).max

# Letters and digits as they are, A-Z lower-cased, bytes of other characters as they are, the rest blank.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class VocabTile:
    """Counts of some terms in the items of a tile: entry i says item[i] has the term of column[i] count[i] times."""

    terms: np.ndarray
    item: np.ndarray
    column: np.ndarray
    count: np.ndarray


@dataclass(frozen=True)
class ItemTile:
    rows: np.ndarray  # numbers of the items
    tiles: list[VocabTile]


def vocab_tiles(counts: dict[int, dict[int, int]], weights: np.ndarray, width: int = VOCAB_TILE, exact: int = EXACT) -> list[VocabTile]:
    """Tiles of the counts {term: {item: count}}, none with a partial sum that could reach `exact`.

    A term whose largest count would pass it alone is spread over several tiles.
    """
    out, pending = [], sorted(counts.items())
    while pending:
        left, chosen, bound = [], [], 0
        for term, of in pending:
            unit = max(1, int(weights[term])) * LARGEST
            most = max(of.values())
            fits = (exact - 1) // unit
            if fits < 1:
                raise OverflowError("a weight too large for exact sums")
            taken = min(most, fits)
            if len(chosen) == width or bound + taken * unit >= exact:
                left.append((term, of))
                continue
            bound += taken * unit
            chosen.append((term, {i: min(c, taken) for i, c in of.items()}))
            rest = {i: c - taken for i, c in of.items() if c > taken}
            if rest:
                left.append((term, rest))
        entries = [(i, k, c) for k, (_, of) in enumerate(chosen) for i, c in of.items()]
        item, column, count = (np.array(x, np.int64) for x in zip(*entries))
        out.append(VocabTile(np.array([t for t, _ in chosen], np.int64), item, column, count))
        pending = left
    return out


def item_tiles(items: list[tuple[int, list[int], list[int]]], weights: np.ndarray, size: int = ITEM_TILE) -> list[ItemTile]:
    """Tiles of items (number, terms, counts)."""
    out = []
    for at in range(0, len(items), size):
        part = items[at:at + size]
        counts: dict[int, dict[int, int]] = {}
        for i, (_, of, repeats) in enumerate(part):
            for term, n in zip(of, repeats):
                counts.setdefault(term, {})[i] = n
        out.append(ItemTile(np.array([row for row, _, _ in part], np.int64), vocab_tiles(counts, weights)))
    return out


class Best:
    """Each item's k best documents of those seen: highest scores first, equal scores by id."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.least = np.ones(n_items, np.int64)  # scores below it are out
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """`scores` is documents x items; `docs` are the ids."""
        if len(scores) > self.k:
            kth = np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k]
            least = np.maximum(self.least, kth)
        else:
            least = self.least
        row, item = np.nonzero(scores >= least)
        if not len(row):
            return
        item_all = np.concatenate([self.item, item])
        score_all = np.concatenate([self.score, scores[row, item]])
        doc_all = np.concatenate([self.doc, docs[row]])
        order = np.lexsort((doc_all, -score_all, item_all))
        item_all, score_all, doc_all = item_all[order], score_all[order], doc_all[order]
        starts = np.flatnonzero(np.concatenate([[True], item_all[1:] != item_all[:-1]]))
        place = np.arange(len(item_all)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(item_all)]])))
        kept = place < self.k
        full = place == self.k - 1
        self.least[item_all[full]] = score_all[full]
        self.item, self.score, self.doc = item_all[kept], score_all[kept], doc_all[kept]


@dataclass(frozen=True)
class Scorer:
    """What a task needs to rank its documents for a group of items."""

    tiles: list[ItemTile]
    weights: np.ndarray  # by number of the term
    n_docs: int
    n_terms: int
    k: int

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """By posting: n is the number of terms of the posting's document."""
        m = 75 + (25 * n * self.n_docs) // self.n_terms
        return self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))

    def scores(self, tile: ItemTile, size: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Scores of `size` documents: documents x items."""
        out = np.zeros((size, len(tile.rows)), np.int64)
        column_of = np.full(len(self.weights), -1, np.int64)
        for part in tile.tiles:
            column_of[part.terms] = np.arange(len(part.terms))
            at = column_of[term]
            column_of[part.terms] = -1
            known = at >= 0
            documents = np.zeros((size, len(part.terms)))
            documents[doc[known], at[known]] = impact[known]
            counts = np.zeros((len(part.terms), len(tile.rows)))
            counts[part.column, part.item] = part.count
            out += (documents @ counts).astype(np.int64)
        return out

    def rank(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(len(t.rows), self.k) for t in self.tiles]
        for batch in batches:
            ids = batch.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            lists, tfs = batch.column("terms"), batch.column("tfs")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            term = lists.flatten().to_numpy(zero_copy_only=False)
            impact = self.impacts(term, tfs.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(n, np.diff(ends)))
            for start in range(0, len(ids), DOC_TILE):
                stop = min(len(ids), start + DOC_TILE)
                inside = slice(ends[start], ends[stop])
                doc = np.repeat(np.arange(stop - start), np.diff(ends[start:stop + 1]))
                for tile, found in zip(self.tiles, best):
                    found.add(self.scores(tile, stop - start, doc, term[inside], impact[inside]), ids[start:stop])
        for tile, found in zip(self.tiles, best):
            docs = pa.array(found.doc, pa.int64(), mask=found.doc == LAST)
            yield pa.RecordBatch.from_arrays([pa.array(tile.rows[found.item]), docs, pa.array(found.score)], ["item_row", "doc_id", "score"])


def postings(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of documents with a term: n counts all their terms, the lists only those of the vocabulary."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            ids, n, ends, term, tf = [], [], [0], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(text.as_buffer().to_pybytes())
                if not found:
                    continue
                counted = Counter(map(number, found))
                counted.pop(None, None)
                term.extend(counted.keys())
                tf.extend(counted.values())
                ids.append(doc_id)
                n.append(len(found))
                ends.append(len(term))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind)) for values, kind in ((term, pa.int32()), (tf, pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), *lists], schema=schema)

    texts = documents.where("text is not null").select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(split, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")


def numbered_items(items: DataFrame, id_col: str, text_col: str, group_bytes: int) -> DataFrame:
    """(row, item_id, terms, grp): the rows of the items that have terms, numbered, in groups by the size of their terms."""
    tokens = words(lower_ascii(F.col(f"`{text_col}`").cast("string")), NOT_A_TERM)
    rows = items.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("item_id"), tokens.alias("terms")).where("size(terms) > 0")
    different = F.array_distinct("terms")
    size = F.aggregate(different, F.lit(0).cast("long"), lambda total, x: total + 16 + F.octet_length(x))
    sized = running_sums(cut(rows.withColumn("size", size), "items"), [], ["row"], {"so_far": F.col("size")})
    return cut(sized.select("row", "item_id", "terms", F.floor((F.col("so_far") - F.col("size")) / group_bytes).cast("long").alias("grp")), "item-groups")


def top_of(found: DataFrame, k: int) -> DataFrame:
    """The k best documents of each item, merged by parts of the tasks first."""
    best = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    salted = found.withColumn("salt", F.spark_partition_id() % SALTS)
    part = salted.withColumn("rank", best("item_row", "salt")).where(F.col("rank") <= k).drop("rank")
    return part.withColumn("rank", best("item_row")).where(F.col("rank") <= k).select("item_row", "rank", "doc_id", "score")


def search(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = TOP, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above zero for each row of `items`."""
    spark = documents.sparkSession
    docs = ids_and_texts(documents, id_col, text_col)
    asked = numbered_items(items, item_col, item_text_col, group_bytes)
    out = None
    for group in sorted(r["grp"] for r in asked.select("grp").distinct().collect()):  # one pass for each
        rows = asked.where(F.col("grp") == group).select("row", "terms").orderBy("row").collect()  # at most group_bytes and one item
        vocabulary = {t: i for i, t in enumerate(sorted({t.encode() for r in rows for t in r["terms"]}))}
        counted = cut(postings(docs, vocabulary), "postings")
        n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        df = np.zeros(len(vocabulary), np.int64)
        for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most a row a term of the group
            df[r["term"]] = r["count"]
        weights = np.array([weight(n_docs, int(d)) if d else 0 for d in df], np.int64)
        entries = [(r["row"], Counter(vocabulary[t.encode()] for t in r["terms"])) for r in rows]
        # Terms that no document has can't add to a score.
        tiles = item_tiles([(row, [t for t in c if df[t]], [n for t, n in c.items() if df[t]]) for row, c in entries], weights)
        scorer = spark.sparkContext.broadcast(Scorer(tiles, weights, n_docs, n_terms, k))
        found = counted.where("size(terms) > 0").mapInArrow(_ranker(scorer), "item_row bigint, doc_id bigint, score bigint")
        best = top_of(found, k)
        out = best if out is None else out.unionByName(best)
    named = asked.select(F.col("row").alias("item_row"), "item_id")
    if out is None:
        return named.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return out.join(named, "item_row").select("item_id", "rank", "doc_id", "score")


def _ranker(scorer):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from scorer.value.rank(batches)

    return rank


def op11_lexical_search(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(documents, benchmark)


SQL = r"""
with d as (
  select row_number() over () r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w from documents where text is not null
), b as (
  select row_number() over () b, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w from benchmark where text is not null
), q as (select b, term, count(*) c from (select b, unnest(w) term from b) group by all),
s as (select count(*)::bigint n_docs, sum(len(w))::bigint n_terms from d where len(w) > 0),
p as (select r, term, count(*) tf from (select r, unnest(w) term from d) where term in (select term from q) group by all),
t as (select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double))::bigint w from p, s group by term),
m as (select r, doc_id, (75 + (25 * len(w) * n_docs) // n_terms)::bigint m from d, s where len(w) > 0),
x as (
  select b, r, any_value(doc_id) doc_id, sum(c * (t.w * ((1000000000 * tf) // (1000 * tf + 12 * m))))::bigint score
  from q join p using (term) join t using (term) join m using (r) group by b, r
), k as (select *, row_number() over (partition by b order by score desc, doc_id nulls last) k from x where score > 0)
select item_id, k::int as rank, doc_id, score from k join b using (b) where k <= 20"""
