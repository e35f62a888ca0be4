"""N-grams: counts, next words, wide rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywick.operators import ngrams as ops
from tallywick.plans.registry import query

_COUNTS = """with w as (select list_filter(string_split_regex(lower(regexp_replace(trim(text), '[^A-Za-z]', ' ', 'g')), ' +'), lambda x: x <> '') w from ngram_text where text is not null),
g as (select unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) phrase from w, range(1, 6) t(n) where len(w) >= n),
c as materialized (select phrase, count(*) cnt from g group by 1 having count(*) > 2)
"""
_NEXT = _COUNTS + """, p as (select array_to_string(string_split(phrase, ' ')[:-2], ' ') prefix, string_split(phrase, ' ')[-1] word, cnt from c where contains(phrase, ' ')),
r as (select *, row_number() over (partition by prefix order by cnt desc, word) place from p),
n as (select prefix, word, cast(place as int) place, floor(r.cnt/coalesce(c.cnt, 10000000)*100 + 0.5)/100 prob from r left join c on prefix = phrase where place <= 5)
"""


@query("a06_ngram_counts", "A06 C04 X01 X02 X03 F06", views=("ngram_text",), sql=_COUNTS + "select phrase, cnt from c")
def counts(t):
    return ops.ngram_counts(t.ngram_text)


@query("w01_next_words", "W01 C04 X04 X20", views=("ngram_text",), sql=_NEXT + "select * from n")
def following(t):
    return ops.next_words(ops.ngram_counts(t.ngram_text))


@query("s12_wide_rows", "S12 C04", views=("ngram_text",), sql=_NEXT + "select prefix, string_agg(word || '=' || cast(cast(round(prob*100) as int) as varchar), ' ' order by word) cells from n group by 1")
def wide(t):
    cells = ops.to_wide(ops.next_words(ops.ngram_counts(t.ngram_text)), "prefix", "word", "prob")
    entry = lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"] * 100).cast("int").cast("string"))
    return cells.select("prefix", F.array_join(F.transform(F.map_entries("cells"), entry), " ").alias("cells"))
