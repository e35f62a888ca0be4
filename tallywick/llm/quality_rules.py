"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Every rule is a named measure of one text with the least and the most it may be. The
measures are lengths, symbol, stop-word and line ratios and repeated word windows, computed
with Spark's array and string functions alone; a document never leaves its row, so there is
no shuffle and one hot source or one very long text costs only its own length.

Defined results: a null text counts as an empty one, has no words and fails `base`; an empty
table gives an empty result; repeated rows are judged one by one, each on its own; other
columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallywick.llm.common import ids_and_texts, words

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
REPEAT_WINDOW = 3
FEW = 16

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the and of to in is that it for on with as was be by this are from at or "
    "le la les de des du et un une que qui dans en pour par sur au est pas "
    "der die das und ein eine in den von zu mit auf für im nicht ist des sich "
    "el los las del y que una por con para se no su al lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """`measure` is a column of `measures`; null bounds are open."""

    measure: str
    least: float | None = None
    most: float | None = None


#: The verdict past the base rules. Ratios are per word, or per line with a word.
RULES = (
    Rule("mean_word_chars", 1.5, 30.0),
    Rule("symbols_per_word", None, 0.1),
    Rule("bangs_per_word", None, 0.5),
    Rule("stop_word_ratio", 0.01, None),
    Rule("dup_line_ratio", None, 0.5),
)


def compiled(rules: tuple[Rule, ...]) -> Column:
    """True where every measure lies within its bounds."""
    tests = [F.col(r.measure) >= r.least for r in rules if r.least is not None]
    tests += [F.col(r.measure) <= r.most for r in rules if r.most is not None]
    verdict = F.lit(True)
    for test in tests:
        verdict = verdict & test
    return verdict


def window_keys(words: Column) -> Column:
    """A 64-bit hash of each window of three words, by its first word's place.

    Windows are compared only within one text, so a false match takes two windows of the
    same text with equal hashes: about one in 10^14 for a text of a thousand words.
    """
    starts = F.slice(words, 1, F.greatest(F.size(words) - (REPEAT_WINDOW - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))


def repeated_places(keys: Column, twice: Column, pairs: Column) -> Column:
    """The sorted places of windows found twice or more; `twice` are their hashes.

    A few repeated windows are looked up one by one. For a text with many, `pairs` holds
    its (key, place) sorted: equal windows are neighbours, so the cost stays n log n.
    """
    looked_up = F.filter(F.transform(keys, lambda x, i: F.when(F.array_contains(twice, x), i)), lambda i: i.isNotNull())
    same = lambda x, other: F.coalesce(x["key"] == other["key"], F.lit(False))
    neighbours = F.filter(pairs, lambda x, i: same(x, F.get(pairs, i + 1)) | same(x, F.get(pairs, i - 1)))
    return (
        F.when(F.size(twice) == 0, F.array().cast("array<int>"))
        .when(pairs.isNull(), looked_up)
        .otherwise(F.sort_array(F.transform(neighbours, lambda x: x["place"])))
    )


def measures(df: DataFrame) -> DataFrame:
    """From (doc_id, text): the measures that rules can name."""
    text = F.coalesce("text", F.lit(""))
    split = df.select("doc_id", text.alias("text"), words(F.col("text")).alias("words"))
    split = split.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    counted = split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"!")).cast("long").alias("n_bangs"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        window_keys(F.col("words")).alias("keys"),
    )
    ordered = counted.withColumn("ordered", F.sort_array("keys"))
    twice = F.filter("ordered", lambda x, i: x == F.get("ordered", i + 1))
    found = ordered.withColumn("twice", F.array_distinct(twice)).drop("ordered")
    pairs = F.sort_array(F.transform("keys", lambda x, i: F.struct(x.alias("key"), i.alias("place"))))
    found = found.withColumn("pairs", F.when(F.size("twice") > FEW, pairs))
    placed = found.withColumn("places", repeated_places(F.col("keys"), F.col("twice"), F.col("pairs"))).drop("keys", "twice", "pairs")
    places = F.col("places")
    gaps = F.transform(places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(REPEAT_WINDOW)), F.lit(REPEAT_WINDOW)))
    per_word = lambda c: F.col(c) / F.greatest("n_words", F.lit(1))
    return placed.select(
        "*",
        F.aggregate(gaps, F.lit(0).cast("long"), lambda total, x: total + x).alias("n_repeat_words"),
        per_word("word_chars").alias("mean_word_chars"),
        per_word("n_symbols").alias("symbols_per_word"),
        per_word("n_bangs").alias("bangs_per_word"),
        per_word("n_stop_words").alias("stop_word_ratio"),
        (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_line_ratio"),
    ).drop("places")


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: doc_id, the measures, base_failed and kept."""
    judged = measures(ids_and_texts(df, id_col, text_col))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & compiled(rules))


def op2_quality_rules(documents: DataFrame) -> DataFrame:
    return quality_rules(documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
SQL = rf"""
with w as (
  select row_number() over () r, doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) l
  from documents
), g as (
  select r, unnest(range(1, len(w) - 1)) i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) g from w where len(w) >= 3
), d as (select r, i from g qualify count(*) over (partition by r, g) > 1),
c as (select r, count(distinct i + k) n from d, range(3) t(k) group by r),
m as (
  select doc_id, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint n_symbols, len(regexp_extract_all(t, '!')) n_bangs,
    (len(l) - len(list_distinct(l)))::bigint n_dup_lines, len(l) n_lines, coalesce(n, 0)::bigint n_repeat_words,
    len(list_filter(w, lambda x: lower(x) in ({_STOP}))) n_stop
  from w left join c using (r)
), f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed, greatest(n_words, 1) nw from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and word_chars / nw between 1.5 and 30 and n_symbols / nw <= 0.1 and n_bangs / nw <= 0.5 and n_stop / nw >= 0.01
    and n_dup_lines / greatest(n_lines, 1) <= 0.5 kept
from f"""
