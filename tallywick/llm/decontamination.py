"""Benchmark decontamination: a hash set of normalised test n-grams against every text window.

Every WINDOW consecutive words of a test item are one window; a shorter item is one window of
its own length. Windows with equal words are one entry with the set of items they occur in.

Scan. A text is split into words once. A place is a candidate if a Bloom filter over the
windows' first PROBE words holds the words there; the filter is a constant of the plan, so
the test runs inside the scan and no text leaves its task. Only candidates are written out as
window texts, and a broadcast hash join on the whole window text verifies them. What is
shuffled is one row per document with its word count and its verified places.

Bounds. Filter and broadcast set are used while the test set has at most MAX_WINDOWS windows
(counted first); beyond that all windows of the texts go through a shuffled join on the same
window text, with the same result.

Defined results: a null text has no words; items with a null or wordless text have no
windows; a null item_id is left out of the list; a repeated item_id counts once; repeated
documents are judged row by row; empty tables give empty results or no hits; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallywick.llm.common import ids_and_texts, lower_ascii, words

WINDOW = 13
PROBE = 3
MAX_WINDOWS = 200_000
BITS_PER_WINDOW = 16
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAST_SHARE = 20  # contaminated: a hit word for every so many words, at least


def item_words(text: Column) -> Column:
    return words(lower_ascii(F.coalesce(text, F.lit(""))), NOT_A_WORD)


def probe(tokens: Column, at: Column, length: int) -> Column:
    """A hash of the first words of the window that starts at `at` (from 0)."""
    return F.xxhash64(*[F.get(tokens, at + k) for k in range(min(PROBE, length))])


def window_text(tokens: Column, at: Column, length: int) -> Column:
    return F.array_join(F.slice(tokens, at + 1, length), " ")


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(length, window, probe, items): each different window once, with the sorted items that have it."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), item_words(F.col("text")).alias("tokens"))
    items = items.where("item is not null and size(tokens) > 0")
    length = F.least(F.size("tokens"), F.lit(window))
    starts = F.sequence(F.lit(0), F.size("tokens") - length)
    placed = items.select("item", "tokens", length.alias("length"), F.explode(starts).alias("at"))
    texts = placed.select(
        "item", "length", F.expr("array_join(slice(tokens, at + 1, length), ' ')").alias("window"),
        F.when(F.col("length") == 1, probe(F.col("tokens"), F.col("at"), 1))
        .when(F.col("length") == 2, probe(F.col("tokens"), F.col("at"), 2))
        .otherwise(probe(F.col("tokens"), F.col("at"), PROBE)).alias("probe"),
    )
    return texts.groupBy("length", "window", "probe").agg(F.sort_array(F.collect_set("item")).alias("items"))


def filter_words(probes: list[int], n_bits: int) -> list[int]:
    """The 64-bit words of a Bloom filter with two bits per probe."""
    out = [0] * (n_bits // 64)
    for p in probes:
        for bit in (p % n_bits, (p >> 32) % n_bits):
            out[bit // 64] |= 1 << bit % 64
    return [w - (1 << 64) if w >> 63 else w for w in out]


def maybe(key: Column, bits: Column, n_bits: int) -> Column:
    """Whether the filter `bits` (a power of two of them) may hold `key`."""

    def is_set(bit: Column) -> Column:
        word = F.get(bits, F.shiftright(bit, 6).cast("int"))
        return F.get(F.lit(SINGLE), bit.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(word) != 0

    low = F.lit(n_bits - 1).cast("bigint")
    return is_set(key.bitwiseAND(low)) & is_set(F.shiftright(key, 32).bitwiseAND(low))


SINGLE = [(1 << k) - (1 << 64) if k == 63 else 1 << k for k in range(64)]


def longs(values: list[int]) -> Column:
    """A constant array, given as one text that is folded when the plan is optimised."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """(row, doc_id, text, n_words, places, item_sets): one row per document; places are (at, length)."""
    known = test_windows(benchmark, window)
    probes = known.select("length", "probe").limit(max_windows + 1).collect()  # bounded by max_windows
    small = len(probes) <= max_windows
    lengths = sorted({r["length"] for r in (probes if small else known.select("length").distinct().collect())})  # at most `window`
    docs = ids_and_texts(documents, "doc_id", "text")
    docs = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", item_words(F.col("text")).alias("tokens"))
    tokens = F.col("tokens")
    found = []
    for length in lengths:
        places = F.sequence(F.lit(0), F.size("tokens") - length)
        if small:
            keys = [r["probe"] for r in probes if r["length"] == length]
            n_bits = 64
            while n_bits < BITS_PER_WINDOW * len(keys):
                n_bits *= 2
            bits = longs(filter_words([k & (1 << 64) - 1 for k in keys], n_bits))
            places = F.filter(places, lambda i: maybe(probe(tokens, i, length), bits, n_bits))  # noqa: B023
        made = F.transform(places, lambda i: F.struct(i.alias("at"), F.lit(length).alias("length"), window_text(tokens, i, length).alias("window")))  # noqa: B023
        found.append(F.when(F.size("tokens") >= length, made))
    none = F.array().cast("array<struct<at:int,length:int,window:string>>")
    candidates = F.flatten(F.array(none, *[F.coalesce(c, none) for c in found]))
    rows = docs.select("row", "doc_id", F.size("tokens").cast("long").alias("n_words"), candidates.alias("candidates"))
    rows = rows.select("row", "doc_id", "n_words", F.explode_outer("candidates").alias("c"))
    rows = rows.select("row", "doc_id", "n_words", "c.at", "c.length", "c.window")
    entries = known.select(F.col("window").alias("known_window"), F.col("length").alias("known_length"), "items")
    entries = F.broadcast(entries) if small else entries
    verified = rows.join(entries, (F.col("window") == F.col("known_window")) & (F.col("length") == F.col("known_length")), "left")
    place = F.when(F.col("items").isNotNull(), F.struct("at", "length"))
    return verified.groupBy("row", "doc_id", "n_words").agg(
        F.sort_array(F.collect_list(place)).alias("places"), F.collect_set("items").alias("item_sets"))


def spans(places: Column) -> Column:
    """Sorted disjoint (start, end) word spans, end exclusive, of sorted (at, length) places."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def add(done: Column, p: Column) -> Column:
        end = p["at"] + p["length"]
        meets = (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= p["at"])
        grown = F.struct(F.get(done, F.size(done) - 1)["start"].alias("start"), F.greatest(F.get(done, F.size(done) - 1)["end"], end).alias("end"))
        return F.when(meets, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(
            F.concat(done, F.array(F.struct(p["at"].alias("start"), end.alias("end")))))

    return F.aggregate(places, none, add)


def covered(places: Column) -> Column:
    """How many words lie in any of the sorted (at, length) places."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def add(done: Column, p: Column) -> Column:
        end = F.greatest(done["end"], p["at"] + p["length"])
        return F.struct((done["n"] + end - F.greatest(done["end"], p["at"])).cast("long").alias("n"), end.alias("end"))

    return F.aggregate(places, start, add, lambda done: done["n"])


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """(doc_id, n_words, n_hit, items, places, contaminated), one row per document; items are sorted as text."""
    judged = hits(documents, benchmark, window, max_windows).select(
        "doc_id", "n_words", covered(F.col("places")).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("item_sets"))).alias("items"), "places")
    return judged.withColumn("contaminated", (F.col("n_hit") > 0) & (LEAST_SHARE * F.col("n_hit") >= F.col("n_words")))


def op6_decontamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate(documents, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


SQL = r"""
with d as (
  select row_number() over () r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents
), b as (
  select item_id::varchar item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark
), k as (
  select distinct item, least(13, len(w)) n, array_to_string(w[i + 1 : i + least(13, len(w))], ' ') g
  from (select item, w, unnest(range(len(w) - least(13, len(w)) + 1)) i from b where len(w) > 0)
), g as (
  select r, n, i, array_to_string(w[i + 1 : i + n], ' ') g
  from (select r, w, n, unnest(range(len(w) - n + 1)) i from d, (select distinct n from k) where len(w) >= n)
), h as (select r, i, n, item from g join k using (n, g)),
c as (select r, count(distinct i + o) n_hit from h, range(13) t(o) where o < n group by r),
t as (select r, count(distinct item) n_items, string_agg(distinct item, ',' order by item) items from h group by r)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) contaminated
from d left join c using (r) left join t using (r)"""
