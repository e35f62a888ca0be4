"""Filter interaction audit: what each filter removes after each prefix of every order of the filters.

Texts are read once, into a row of flags and a text digest for each document. From there on the
job works on ids. Each filter has one table of the ids that fail it, written to the shared work
folder. What a filter does after a prefix depends on the set of filters in the prefix only, so
the tables of all filters, each row once for each set of the other filters, are joined with the
failing ids of those sets: left-anti gives what the filter removes there (no filter of the set
removed it before), left-semi what was redundant. The survivors of a prefix are the
documents less what its steps removed. Label losses are counted on the same relations, whose
rows carry whether their id has the label.

Repeated text. The ids that fail as copies are all ids less the least id of each text, by an
anti join on the id; a text on a third of all rows is one row of a partial aggregate and never a
join key.

Cost. Five filters make 16 rows of ids and flags of each failing (document, filter); a document
that passes all takes part in no prefix join. Rows that agree in id, part and text are one row
with a count, so no key of any join can be hot.

Defined results: a null text is empty; a null part is the empty text; a null doc_id fails no
comparison with smaller ids, is none itself and has no label; of several labels of one id, any
that is set counts; repeated rows count one by one, and rows that share an id and a text aren't
copies of each other; empty tables give an empty result, no labels no losses; other columns
are not read. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywick.llm.common import UPPER, words
from tallywick.session import cut

KEY = ("doc_id", "part", "digest")


def failures(text: Column) -> dict[str, Column]:
    """The failure conditions that a text decides by itself."""
    tokens = words(text)
    n_words, n_different, n_chars = (x.cast("long") for x in (F.size(tokens), F.size(F.array_distinct(tokens)), F.length(text)))
    capitals = n_chars - F.length(F.translate(text, UPPER, ""))
    return {
        "A": n_words < 100,
        "B": 100 * n_different < 80 * n_words,
        "C": 100 * capitals > 10 * n_chars,
        "D": text.rlike(r"[#$%&*|]"),
    }


def judged(documents: DataFrame, part_col: str) -> DataFrame:
    """(doc_id, part, digest, A..D, n): each different id, part and text once, with its number of rows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select("doc_id", F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    flagged = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[c.alias(f) for f, c in failures(F.col("text")).items()])
    return flagged.groupBy(*KEY).agg(*[F.first(f).alias(f) for f in "ABCD"], F.count(F.lit(1)).alias("n"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds good and toxic: whether any label of the id says so."""
    marked = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    none = F.lit(False)
    return rows.join(marked, F.col("doc_id") == F.col("labelled"), "left").select(*rows.columns, F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic"))


def copies(rows: DataFrame) -> DataFrame:
    """The rows whose text a smaller id has: all with an id, less the least id of each text."""
    first = rows.where("doc_id is not null").groupBy(F.col("digest").alias("of")).agg(F.min("doc_id").alias("least"))
    return rows.where("doc_id is not null").join(first, (F.col("doc_id") == F.col("least")) & (F.col("digest") == F.col("of")), "left_anti")


def prefix_effects(failing: dict[str, DataFrame]) -> DataFrame:
    """(part, filter, seen, removed, good_lost, toxic_lost, redundant) from one table of failing ids per filter.

    `seen` is the set of filters before it, as a number with bit i for the i-th filter.
    """
    names = list(failing)
    bit = {f: 1 << i for i, f in enumerate(names)}
    steps = None
    for f in names:
        others = [s for s in range(1 << len(names)) if not s & bit[f]]
        one = failing[f].withColumn("filter", F.lit(f)).withColumn("seen", F.explode(F.lit(others)))
        steps = one if steps is None else steps.unionByName(one)
    earlier = None
    for f in names:
        one = failing[f].select(*[F.col(c).alias(f"_{c}") for c in KEY], F.lit(bit[f]).alias("_bit"))
        earlier = one if earlier is None else earlier.unionByName(one)
    before = F.col("seen").bitwiseAND(F.col("_bit")) != 0
    for c in KEY:
        before = before & F.col(c).eqNullSafe(F.col(f"_{c}"))
    count = lambda c, name: F.sum(F.when(c, F.col("n")).otherwise(0)).alias(name)
    keys = ("part", "filter", "seen")
    removed = steps.join(earlier, before, "left_anti").groupBy(*keys).agg(F.sum("n").alias("removed"), count(F.col("good"), "good_lost"), count(F.col("toxic"), "toxic_lost"))
    redundant = steps.join(earlier, before, "left_semi").groupBy(*keys).agg(F.sum("n").alias("redundant"))
    return removed.join(redundant, list(keys), "full")


def orders(names: Sequence[str]) -> list[tuple[str, int, str, int]]:
    """(order, step, filter, seen) of all orders."""
    out = []
    for order in permutations(names):
        seen = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(order), step, f, seen))
            seen |= 1 << names.index(f)
    return out


def audit(sizes: DataFrame, effects: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every order's steps from the documents of each part (part, total) and the effects after each set."""
    names = list(names)
    table = F.lit([f"{order}:{step}:{f}:{seen}" for order, step, f, seen in orders(names)])
    cell = F.split("cell", ":")
    steps = sizes.select("part", "total", F.explode(table).alias("cell")).select(
        "part", "total", cell[0].alias("filter_order"), cell[1].cast("int").alias("step"), cell[2].alias("filter"), cell[3].cast("int").alias("seen"))
    full = (1 << len(names)) - 1
    alone = full - F.element_at(F.create_map(*[F.lit(x) for i, f in enumerate(names) for x in (f, 1 << i)]), F.col("filter"))
    # A set of s filters comes right before the filter in s! (4 - s)! of the 120 orders.
    ways = F.lit([factorial(s) * factorial(len(names) - 1 - s) for s in range(len(names))])
    share = F.sum(F.col("removed") * F.get(ways, F.bit_count("seen")))
    totals = effects.groupBy("part", "filter").agg(F.max(F.when(F.col("seen") == alone, F.col("removed"))).alias("unique_fails"), share.alias("shapley"))
    joined = steps.join(effects, ["part", "filter", "seen"], "left").join(totals, ["part", "filter"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    return joined.select("part", "filter_order", "step", (F.col("total") - F.sum(F.coalesce("removed", F.lit(0))).over(so_far)).cast("long").alias("kept"),
                         *[zero(c) for c in ("removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])


def op12_filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    rows = cut(with_labels(judged(documents, "lang"), labels), "audit-rows")
    failing = {f: rows.where(f) for f in "ABCD"} | {"E": copies(rows)}
    stored = {f: cut(df.select(*KEY, "n", "good", "toxic"), f"fails-{f}") for f, df in failing.items()}
    sizes = rows.groupBy("part").agg(F.sum("n").alias("total"))
    return audit(sizes, cut(prefix_effects(stored), "effects"), list(stored))


SQL = r"""
with d as (
  select row_number() over () r, doc_id, coalesce(lang, '') part, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents
), l as (select doc_id, max(quality = 1) g, max(toxic = 1) x from labels where doc_id is not null group by doc_id),
e as (select t, min(doc_id) least from d group by t),
f as (
  select d.r, part, coalesce(g, false) g, coalesce(x, false) x, {
    'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w), 'C': 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(d.doc_id > least, false)} f
  from d join e using (t) left join l on l.doc_id = d.doc_id
), m as (
  select part, g, x, (case when f.A then 1 else 0 end + case when f.B then 2 else 0 end + case when f.C then 4 else 0 end + case when f.D then 8 else 0 end + case when f.E then 16 else 0 end) mask, count(*) n
  from f group by all
), c as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(c, b)),
o as (
  select v.c || w.c || x.c || y.c || z.c filter_order, [v.b, w.b, x.b, y.b, z.b] b from c v, c w, c x, c y, c z
  where v.b + w.b + x.b + y.b + z.b = 31 and len(list_distinct([v.b, w.b, x.b, y.b, z.b])) = 5
), s as (select filter_order, step, b[step] own, coalesce(list_sum(b[:step - 1]), 0)::int seen from o, range(1, 6) t(step)),
a as (
  select part, filter_order, step, own, sum(n) filter (mask & (seen | own) = 0) kept, sum(n) filter (mask & own <> 0 and mask & seen = 0) removed,
    sum(n) filter (mask & own <> 0 and mask & seen <> 0) redundant, sum(n) filter (mask = own) unique_fails,
    sum(n) filter (g and mask & own <> 0 and mask & seen = 0) good_lost, sum(n) filter (x and mask & own <> 0 and mask & seen = 0) toxic_lost
  from m, s group by all
)
select part, filter_order, step::int step, coalesce(kept, 0)::bigint kept, coalesce(removed, 0)::bigint removed, coalesce(redundant, 0)::bigint redundant,
  coalesce(unique_fails, 0)::bigint unique_fails, coalesce(good_lost, 0)::bigint good_lost, coalesce(toxic_lost, 0)::bigint toxic_lost,
  sum(coalesce(removed, 0)) over (partition by part, own)::bigint shapley
from a"""
