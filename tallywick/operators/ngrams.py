"""Word n-grams and the likeliest next words."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywick.operators import phrases
from tallywick.session import cut

FILTER_WORDS = 1 << 22  # 64-bit words of a filter, at most
BUCKETS = 2  # ranges of hashes for each shuffle partition, or more; a task counts one at a time
BATCH_BYTES = 8 << 20  # of lines that a Python worker gets at once
STARTS = 1000  # words of a text in one row
LEAST_TOTAL = 10_000_000  # the total of a prefix that was not counted


def normalised(text: Column) -> Column:
    """Trimmed, then everything but ASCII letters as blanks, in lower case."""
    return F.lower(F.regexp_replace(F.trim(text), "[^A-Za-z]", " "))


def words(text: Column, drop_empty: bool = True) -> Column:
    """Split on runs of blanks. `drop_empty=False` keeps a leading empty word and one for an empty line."""
    parts = F.split(text, " +")
    if drop_empty:
        return F.array_remove(parts, "")
    return F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def ngrams(tokens: Column, n: int = 5) -> Column:
    """All runs of one to n words, blank-joined."""
    of = lambda k: F.transform(F.slice(tokens, 1, F.greatest(F.size(tokens) - (k - 1), F.lit(0))), lambda _, i: F.array_join(F.slice(tokens, i + 1, k), " "))
    return F.flatten(F.array(*[of(k) for k in range(1, n + 1)]))


def _bits(key: Column) -> Column:
    """Three bits of a 64-bit word."""
    one = lambda shift: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(key, shift).bitwiseAND(F.lit(63)).cast("int"))
    return one(40).bitwiseOR(one(46)).bitwiseOR(one(52))


def blocked_filter(keys: DataFrame, most_words: int = FILTER_WORDS) -> tuple[DataFrame, int]:
    """A blocked Bloom filter of the 64-bit column `key`: (block, bits), each block one 64-bit word, and the number of blocks.

    Four keys a block, until there would be more than `most_words` blocks (32 MB): beyond that the
    filter gets fuller and lets more through, but never holds a key back.
    """
    n_words = 64
    n_keys = keys.count()
    while n_words < most_words and n_words * 4 < n_keys:
        n_words *= 2
    return keys.groupBy(_block(F.col("key"), n_words).alias("block")).agg(F.bit_or(_bits(F.col("key"))).alias("bits")), n_words


def _block(key: Column, n_words: int) -> Column:
    return key.bitwiseAND(F.lit(n_words - 1)).cast("int")


def collected(filled: DataFrame, n_words: int) -> np.ndarray:
    """A blocked filter as an array with the word of each block."""
    rows = filled.toArrow()
    blocks = np.zeros(n_words, "u8")
    blocks[rows.column("block").to_numpy()] = rows.column("bits").to_numpy().view("u8")
    return blocks


def passing(rows: DataFrame, key: str, filled: DataFrame, n_words: int) -> DataFrame:
    """The rows whose `key` the filter may hold; the filter is sent to every task."""
    blocks = rows.sparkSession.sparkContext.broadcast(collected(filled, n_words))  # FILTER_WORDS at most
    return rows.mapInArrow(phrases.kept(key, blocks), rows.schema)


def dealt(texts: DataFrame) -> DataFrame:
    """Over as many tasks as the session has shuffle partitions, if a small file would leave cores idle."""
    spark = texts.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return texts.repartition(wanted) if texts.rdd.getNumPartitions() < min(wanted, spark.sparkContext.defaultParallelism) else texts


def pieces(texts: DataFrame, n: int, drop_empty: bool = True, starts: int = STARTS) -> DataFrame:
    """(tokens): each text's words in pieces of `starts` words, each with the n - 1 words after it, so that every phrase begins in one piece."""
    found = texts.select(words(normalised(F.col("text")), drop_empty).alias("all"))
    last = F.floor((F.size("all") - 1) / starts).cast("int")
    cells = F.when(F.size("all").between(1, starts), F.array("all")).when(F.size("all") > 0, F.transform(F.sequence(F.lit(0), last), lambda c: F.slice("all", c * starts + 1, starts + n - 1)))
    return found.select(F.explode(cells).alias("tokens"))


def ngram_counts(texts: DataFrame, n: int = 5, min_count: int = 3, drop_empty: bool = True, starts: int = STARTS) -> DataFrame:
    """(phrase, cnt) of phrases of one to n words that occur `min_count` times or more.

    A phrase that occurs so often has only parts that do, and its hash occurs as often. So the hashes of one length are
    counted before those of the next, of which only those are sent whose first and last words but one pass a filter
    of the frequent shorter ones. Phrases are made where the filter of their length lets them pass (the longest: where their parts
    pass), and are counted themselves, beside the hashes of the next length; what a filter lets through wrongly is counted and dropped like any
    other. Places are hashed and tested as arrays, over bounded pieces of texts; equal hashes and equal phrases
    of a task are added up before the shuffle.
    """
    spark = texts.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    buckets = 1 << (BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    lines = cut(pieces(dealt(texts.where("text is not null")), n, drop_empty, starts).select(F.array_join("tokens", " ").alias("line")), "lines")
    levels, filters = [], []
    for size in range(0 if n > 1 else 1, max(n, 2)):
        sent = lines.mapInArrow(phrases.sent(size, n, filters, starts, buckets, min_count), "kind int, bucket int, data binary, sizes binary, counts binary")
        found = cut(sent.groupBy("kind", "bucket").applyInArrow(phrases.added(min_count), "phrase string, cnt bigint, key bigint"), f"phrases-{size}")
        for filled in filters:
            filled.destroy()
        if size:
            levels.append(found.where("phrase is not null").select("phrase", "cnt"))
        if size < n - 1:
            filters = [spark.sparkContext.broadcast(collected(*blocked_filter(found.where("key is not null").select("key"))))]
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def split_last(phrase: Column) -> tuple[Column, Column]:
    """All but the last word, and the last word."""
    parts = F.split(phrase, " +")
    last = F.substring_index(phrase, " ", -1)
    wide = F.instr(phrase, "  ") > 0  # only then are there blanks to split on runs of
    return (
        F.when(wide, F.array_join(F.slice(parts, 1, F.size(parts) - 1), " ")).otherwise(F.substring(phrase, F.lit(1), F.length(phrase) - F.length(last) - 1)),
        F.when(wide, F.element_at(parts, -1)).otherwise(last),
    )


def next_words(counts: DataFrame, k: int = 5) -> DataFrame:
    """(prefix, word, place, prob): at most k rows a prefix, most frequent first, ties by word.

    prob is rounded half up to two places; a prefix without a count has LEAST_TOTAL.
    """
    prefix, word = split_last(F.col("phrase"))
    longer = counts.where(F.instr("phrase", " ") > 0).select(prefix.alias("prefix"), word.alias("word"), "cnt")
    order = Window.partitionBy("prefix").orderBy(F.desc("cnt"), "word")
    best = longer.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    totals = counts.select(F.col("phrase").alias("prefix"), F.col("cnt").alias("total"))
    share = F.col("cnt") / F.coalesce("total", F.lit(LEAST_TOTAL))
    return best.join(totals, "prefix", "left").select("prefix", "word", "place", (F.floor(share * 100 + 0.5) / 100).alias("prob"))


def to_wide(df: DataFrame, key: str, column: str, value: str) -> DataFrame:
    """(key, cells): one map per key. Give it a bounded number of rows a key."""
    return df.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(column, value)))).alias("cells"))
