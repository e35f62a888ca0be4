"""Secret scan: a trigram inverted index picks the texts that a rule's regex is run on.

From each rule's regex a Boolean query over trigrams is derived: the literal strings that any
match must contain, alternatives joined by OR, pieces by AND, on lower-cased text. The index
holds postings (trigram, text) for the trigrams that some rule asks for. Postings of a query
are intersected by counting, per text and alternative, how many of its trigrams are there.
The surviving (text, rule) pairs are candidates; the regex itself verifies them. Rules without
a mandatory trigram (a run of hex digits) are run on every text.

Texts are keyed by a 64-bit hash in the index: equal texts have one posting, so copies don't
make it heavy, and a clash of hashes only adds a candidate, which the regex rejects. The
candidates (a hash and a bit for each rule) are written out and counted: up to MAX_SENT of them go
to every task, and no text is shuffled; more are joined by hash, where Spark splits a hash with
very many copies.

Long texts. No rule has a repeated group (Java's matcher recurses once a round), and one that may
fail after a long run starts only where the run does, possessively, so a run is read once; the
text between the words of a private key's header is at most 64 characters.

Positions come from Spark's own functions: the pieces between matches and the matches, in
turn, make up the text, so a running sum of their lengths is each match's start.

Defined results: a null text counts as an empty one and has no spans; repeated rows are
scanned row by row; texts are scanned whole, in time proportional to their length; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re._constants as op
import re._parser as regex_parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywick.llm.common import ids_and_texts
from tallywick.session import cut

MAX_SENT = 1_000_000  # candidates of 12 bytes each that are sent to every task
MOST_STRINGS = 64  # alternatives of one literal piece that are kept apart


@dataclass(frozen=True)
class Rule:
    """`group` must have `least` characters, else the match is dropped."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0


#: Fixed values of the base rules, in their order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # runs are maximal, so this finds the runs of 24 or more
)
#: Well-known public forms of other credentials.
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,64}PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
)
RULES = BASE + ADDED

#: AND over clauses, OR over alternatives, AND over trigrams.
Query = list[list[frozenset[str]]]


def trigram_query(regex: str) -> Query:
    """What any match must contain; an empty list asks for nothing."""
    strings, query = _walk(list(regex_parser.parse(regex)))
    return query + _clause(strings)


def _clause(strings: set[str]) -> Query:
    if not strings or any(len(s) < 3 for s in strings):
        return []
    wanted = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    # What asks for more than another alternative adds nothing to the OR.
    return [sorted((w for w in wanted if not any(other < w for other in wanted)), key=sorted)]


def _choices(node) -> set[str] | None:
    """The strings one node may match, lower-cased; None if there are too many to keep apart."""
    code, value = node
    if code is op.LITERAL:
        return {chr(value).lower()}
    if code is op.IN:
        found = set()
        for kind, x in value:
            if kind is not op.LITERAL:
                return None
            found.add(chr(x).lower())
        return found if len(found) <= 8 else None
    return None


def _walk(nodes: list) -> tuple[set[str], Query]:
    """The exact strings of the tail that is still open, and the clauses closed before it."""
    strings, query = {""}, []
    for node in nodes:
        code, value = node
        part = _choices(node)
        if code is op.ASSERT_NOT:  # looks at what stands beside a match and has no length
            continue
        if code is op.SUBPATTERN:
            inner, closed = _walk(list(value[3]))
            if closed:
                query += _clause(strings) + closed
                strings = inner
                continue
            part = inner
        elif code is op.BRANCH:
            part = set()
            for branch in value[1]:
                inner, closed = _walk(list(branch))
                part = None if closed or part is None else part | inner
        elif code in (op.MAX_REPEAT, op.POSSESSIVE_REPEAT):
            low, high, inside = value
            inner, closed = _walk(list(inside))
            if (low, high) == (0, 1) and not closed:
                part = inner | {""}
            elif low == high and not closed and len(inner) == 1 and low <= 64:
                part = {next(iter(inner)) * low}
            else:
                part = None
                if low >= 1:
                    query += closed
        if part is None:
            query += _clause(strings)
            strings = {""}
        elif len(strings) * len(part) > MOST_STRINGS:
            query += _clause(strings)
            strings = part if len(part) <= MOST_STRINGS else {""}
        else:
            strings = {a + b for a, b in product(strings, part)}
    return strings, query


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, key): the inverted index of the distinct texts for the given trigrams."""
    lowered = texts.select("key", F.lower("text").alias("low"))
    there = F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(F.col("low"), t))
    return lowered.select("key", F.explode(there).alias("trigram")).distinct()


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(key, kinds): the rules whose query the postings satisfy, as bits in the queries' order, for each text that has any."""
    asked = [(kind, c, a, t, len(alternative)) for kind, query in enumerate(queries.values()) for c, clause in enumerate(query)
             for a, alternative in enumerate(clause) for t in sorted(alternative)]
    terms = index.sparkSession.createDataFrame(asked, "kind int, clause int, alternative int, trigram string, need long")
    clauses = index.sparkSession.createDataFrame([(kind, len(q)) for kind, q in enumerate(queries.values())], "kind int, n_clauses long")
    matched = index.join(F.broadcast(terms), "trigram")  # one row per trigram of the rules
    whole = matched.groupBy("key", "kind", "clause", "alternative", "need").count().where("count = need")
    met = whole.select("key", "kind", "clause").distinct().groupBy("key", "kind").count()
    kept = met.join(F.broadcast(clauses), "kind").where("count = n_clauses")
    return kept.groupBy("key").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("kind"))).alias("kinds"))


def matches(text: Column, rule: Rule) -> Column:
    """For each match in turn: the length of the text before it since the last one, its own length, and whether it counts."""
    found = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    checked = found if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))
    pieces = F.split(text, rule.regex, -1)
    made = F.zip_with(F.arrays_zip(found.alias("found"), checked.alias("checked")), F.slice(pieces, 1, F.size(found)),
                      lambda m, piece: F.struct(F.lit(rule.kind).alias("kind"), F.length(piece).alias("gap"), F.length(m["found"]).alias("size"),
                                                (F.length(m["checked"]) >= rule.least).alias("counts")))
    return F.transform(made, lambda m, i: F.struct(m["kind"].alias("kind"), i.alias("place"), m["gap"].alias("gap"), m["size"].alias("size"), m["counts"].alias("counts")))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, max_sent: int = MAX_SENT) -> DataFrame:
    """(doc_id, spans), one row per input row; spans are (start, rank, kind, end) in order, in code points."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    indexed = {kind: query for kind, query in queries.items() if query}
    docs = ids_and_texts(df, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("key", F.xxhash64("text"))
    trigrams = sorted({t for query in indexed.values() for clause in query for alternative in clause for t in alternative})
    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    if indexed:
        passed = cut(candidates(postings(docs, trigrams), indexed), "secret-candidates")
        few = passed.limit(max_sent + 1).count() <= max_sent
        numbered = numbered.join(F.broadcast(passed) if few else passed.hint("shuffle_merge"), "key", "left")
    none = F.array().cast("array<struct<kind:string,place:int,gap:int,size:int,counts:boolean>>")
    bit = {kind: 1 << i for i, kind in enumerate(indexed)}
    found = [matches(F.col("text"), r) if r.kind not in indexed else F.when(F.col("kinds").bitwiseAND(F.lit(bit[r.kind])) != 0, matches(F.col("text"), r)) for r in rules]
    all_found = F.flatten(F.array(*[F.coalesce(m, none) for m in found]))
    rows = numbered.select("row", "doc_id", all_found.alias("m")).select("row", "doc_id", F.explode_outer("m").alias("m")).select("row", "doc_id", "m.*")
    along = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(along).cast("int"))
    rank = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind"))
    span = F.when(F.col("counts"), F.struct((F.col("end") - F.col("size")).alias("start"), rank.cast("int").alias("rank"), "kind", "end"))
    return placed.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(span)).alias("spans")).drop("row")


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_secrets_scan(documents: DataFrame) -> DataFrame:
    found = scan(documents)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["rank"] <= len(BASE))
    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
