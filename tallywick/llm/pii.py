"""Personal data: exact patterns, and a skip-chain conditional random field that carries their labels on.

Base spans are the matches of four patterns with a check of their digits; they always stay.
The field labels every token that holds a digit or an at sign (any other token is none of the
kinds, so it is observed and cuts the chain). Its factors are

* a token's own: a multinomial logistic model of its shape, size and neighbouring words;
* chain edges between tokens that stand side by side;
* skip edges between distant tokens of one document that repeat or resemble each other, each kind
  with a factor of its own: equal up to case and punctuation; the same digits, whatever letters
  stand with them; addresses of one domain; the same end after the last separator. Occurrences are
  linked one to the next, so a token that a document repeats n times has n - 1 edges of a kind.

Tokens in a base span are observed with its label. In every document with a token outside them,
loopy message passing makes labels agree: a number that one place gives away as a card is one in the
other places too, however it is written there, and what the patterns drop since two numbers stand side
by side (a phone, a blank and a card) is told apart. Neighbouring tokens of one kind whose
marginals reach CONFIDENCE become spans, the longest first that have the form of their kind:
a Luhn number, four bytes, ten to fifteen digits, an at sign inside.

Training is piecewise, on the base spans as labels; tokens of a match that was dropped over several
tokens are left out, as their label is open: the tokens' own factors on at most
TRAIN_TOKENS tokens (those with the least hashes, a documented bound); the edge factors
from label counts of all edges of all documents.

A token's shape is that of the whole token, its neighbours are the blank-separated words beside it,
whatever their length; time and memory are in proportion to the text.

Defined results: a null text counts as an empty one and has no spans; repeated rows are
searched one by one; an empty table gives an empty result and an untrained model adds nothing;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallywick.llm.common import among_least, ids_and_texts

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1
FEATURE_BITS = 12
FEATURES = 10  # of a token
TRAIN_TOKENS = 20_000
EPOCHS = 12
BATCH = 128
RATE = 0.05
DECAY = 1e-4
ROUNDS = 12
CONFIDENCE = 0.5
LEAST_SHARE, FEW_EDGES = 0.1, 5
MOST_DIGITS = 19  # of a span that is put together
OBSERVED = 12.0

# The four patterns. Look-behinds and possessive repeats only spare starts inside a run that
# has failed from its beginning; the matches are those of the plain patterns.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_SIGN = re.compile(r"[0-9@]")
_BLANK = re.compile(r"\s")
_WORD = re.compile(r"\S+")
_SEPARATOR = re.compile(r"[-/_.:,;|#*]")
_EDGES = " .,;:!?()[]{}<>\"'"

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """The first at sign after a match's start is its own, so each one is looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, 0, done
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """All base matches by start, then kind."""
    out = list(emails(text))
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return sorted(out)


def dropped_spans(text: str) -> list[Span]:
    """Matches over several tokens that fail the check of their digits: they may hold numbers that would pass alone."""
    out = [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if " " in m.group()]
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if " " in m.group()]
    return sorted(set(out) - set(base_spans(text)))


def tokens(text: str) -> list[tuple[int, int]]:
    """The blank-separated tokens with a digit or an at sign, trimmed of punctuation at their ends."""
    out, done = [], 0
    sign = _SIGN.search(text)
    while sign:
        start = sign.start()
        while start > done and not text[start - 1].isspace():
            start -= 1
        blank = _BLANK.search(text, sign.end())
        end = done = blank.start() if blank else len(text)
        while text[start] in _EDGES:
            start += 1
        while text[end - 1] in _EDGES:
            end -= 1
        out.append((start, end))
        sign = _SIGN.search(text, done)
    return out


def shape(word: str) -> str:
    """Digits as 9, letters as a or A, runs over four cut to four."""
    out, last, run = [], "", 0
    for c in word:
        kind = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        run = run + 1 if kind == last else 1
        last = kind
        if run <= 4:
            out.append(kind)
    return "".join(out)


def word_before(text: str, start: int) -> str:
    """The blank-separated word that ends at or before `start`, as far as it lies there."""
    while start and text[start - 1].isspace():
        start -= 1
    end = start
    while start and not text[start - 1].isspace():
        start -= 1
    return text[start:end]


def word_after(text: str, end: int) -> str:
    found = _WORD.search(text, end)
    return found.group() if found else ""


def possible(word: str, kind: int) -> bool:
    """Whether a text has the form of a kind, with any separators."""
    digits = _NOT_DIGIT.sub("", word)
    if kind == 0:
        return "@" in word.strip("@")
    if kind == 1:
        parts = _DIGITS.findall(word)
        return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 14 <= len(digits) <= MOST_DIGITS and luhn(digits)
    return 10 <= len(digits) <= 15


def features(text: str, start: int, end: int) -> list[int]:
    word = text[start:end]
    before, after = word_before(text, start), word_after(text, end)
    digits = len(_NOT_DIGIT.sub("", word))
    named = (
        "s" + shape(word), "c" + re.sub(r"(.)\1+", r"\1", shape(word)), f"d{min(digits, 24)}", f"l{min(end - start, 40) // 4}",
        f"a{word.count('@')}.{min(word.count('.'), 4)}.{min(word.count('-'), 4)}", f"p{text[start - 1:start]}{word[:1] if not word[:1].isalnum() else ''}",
        "b" + shape(before), "f" + shape(after), f"x{digits}.{end - start == digits}",
        "k" + "".join(str(int(possible(word, kind))) for kind in range(len(KINDS))),
    )
    return [crc32(x.encode("utf-8", "replace")) & ((1 << FEATURE_BITS) - 1) for x in named]


def skip_keys(word: str) -> tuple[str, ...]:
    """By kind of skip edge: what tokens share that it links; empty if too little is left to tell."""
    low = word.casefold()
    same = "".join(c for c in low if c.isalnum() or c == "@")
    digits = _NOT_DIGIT.sub("", low)
    domain = low.rpartition("@")[2] if "@" in low else ""
    tail = _SEPARATOR.split(low)[-1]
    return same if len(same) >= 6 else "", digits if len(digits) >= 8 else "", domain if "." in domain else "", tail if len(tail) >= 5 else ""


EDGE_KINDS = 1 + len(skip_keys(""))


def edges(text: str, spans: list[tuple[int, int]]) -> list[np.ndarray]:
    """Pairs of token numbers by kind: chain edges, then each kind of skip edge; two tokens have one skip edge, of the first kind that fits."""
    chain, skips = [], [[] for _ in range(EDGE_KINDS - 1)]
    last: list[dict[str, int]] = [{} for _ in skips]
    for i, (start, end) in enumerate(spans):
        if i and text[spans[i - 1][1]:start].strip(_EDGES + "\n\t\r+-") == "":
            chain.append((i - 1, i))
        linked = set()
        for kind, key in enumerate(skip_keys(text[start:end])):
            if key:
                other = last[kind].get(key)
                if other is not None and other not in linked:
                    skips[kind].append((other, i))
                    linked.add(other)
                last[kind][key] = i
    return [np.array(links, np.int64).reshape(-1, 2) for links in (chain, *skips)]


def observed(spans: list[tuple[int, int]], base: list[Span]) -> list[int]:
    """Each token's base label: 0 if no base span touches it."""
    out, k = [], 0
    for start, end in spans:
        while k < len(base) and base[k][2] <= start:
            k += 1
        out.append(next((kind + 1 for s, kind, e in base[k:k + 4] if s < end and e > start), 0))
    return out


def put_together(text: str, places: list[tuple[int, int]], labels: list[int], chained: set[int]) -> Iterator[Span]:
    """The longest stretches of chained tokens with one label that have the form of its kind; `chained` are tokens with an edge to the one before."""
    i = 0
    while i < len(places):
        last, j, digits = None, i, 0
        while labels[i] and j < len(places) and labels[j] == labels[i] and (j == i or j in chained):
            digits += len(_NOT_DIGIT.sub("", text[places[j][0]:places[j][1]]))
            if possible(text[places[i][0]:places[j][1]], labels[i] - 1):
                last = j
            if digits > MOST_DIGITS or labels[i] == 1:
                break
            j += 1
        if last is None:
            i += 1
            continue
        start = places[i][0]
        yield start, labels[i] - 1, places[last][1]
        i = last + 1


def training_labels(text: str, places: list[tuple[int, int]]) -> np.ndarray:
    """Each token's base label, or -1 where a dropped match leaves it open."""
    known, open_ = observed(places, base_spans(text)), observed(places, dropped_spans(text))
    return np.array([-1 if other and not label else label for label, other in zip(known, open_)], np.int64)


@dataclass
class Field:
    own: np.ndarray  # features by labels
    pairs: np.ndarray  # by kind of edge: labels by labels
    trained: bool = True

    def marginals(self, text: str, spans: list[tuple[int, int]], known: list[int], links: list[np.ndarray]) -> np.ndarray:
        unary = self.own[np.array([features(text, s, e) for s, e in spans])].sum(axis=1)
        seen = np.flatnonzero(known)
        unary[seen, np.array(known)[seen]] += OBSERVED
        belief = self.passed(unary, np.concatenate(links), np.repeat(np.arange(EDGE_KINDS), [len(x) for x in links]))
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)

    def passed(self, unary: np.ndarray, links: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Beliefs after loopy message passing, half of each message renewed a round."""
        if not len(links):
            return unary
        n = len(links)
        source, target = np.concatenate([links[:, 0], links[:, 1]]), np.concatenate([links[:, 1], links[:, 0]])
        factor = np.concatenate([self.pairs[kinds], self.pairs[kinds].transpose(0, 2, 1)])
        back = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
        message = np.zeros((2 * n, LABELS))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, target, message)
            sent = (belief[source] - message[back])[:, :, None] + factor
            top = sent.max(axis=1)
            new = top + np.log(np.exp(sent - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            if np.abs(new - message).max() < 1e-3:
                break
            message = 0.5 * message + 0.5 * new
        belief = unary.copy()
        np.add.at(belief, target, message)
        return belief

    def spans(self, text: str) -> list[tuple[int, int, int, bool]]:
        """(start, kind, end, base) by start, kind, end."""
        base = base_spans(text)
        found = [(s, k, e, True) for s, k, e in base]
        places = tokens(text) if self.trained else []
        if places:
            known, links = observed(places, base), edges(text, places)
            if not all(known):
                sure = self.marginals(text, places, known, links)
                best = sure.argmax(axis=1)
                best[(np.array(known) > 0) | (sure.max(axis=1) < CONFIDENCE)] = 0
                found += [(s, k, e, False) for s, k, e in put_together(text, places, best.tolist(), set(links[0][:, 1].tolist()))]
        return sorted(found)


UNTRAINED = Field(np.zeros((1 << FEATURE_BITS, LABELS)), np.zeros((EDGE_KINDS, LABELS, LABELS)), False)


def own_factors(rows: np.ndarray, labels: np.ndarray, seed: int = 11) -> np.ndarray:
    """Multinomial logistic regression by Adagrad; rows hold feature numbers."""
    rng = np.random.default_rng(seed)
    weights = np.zeros((1 << FEATURE_BITS, LABELS))
    grown = np.full_like(weights, 1e-3)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            chosen = order[at:at + BATCH]
            value = weights[rows[chosen]].sum(axis=1)
            value = np.exp(value - value.max(axis=1, keepdims=True))
            value /= value.sum(axis=1, keepdims=True)
            value[np.arange(len(chosen)), labels[chosen]] -= 1
            used, where = np.unique(rows[chosen].ravel(), return_inverse=True)
            slope = np.zeros((len(used), LABELS))
            np.add.at(slope, where, np.repeat(value / len(chosen), FEATURES, axis=0))
            slope += DECAY * weights[used]
            grown[used] += slope * slope
            weights[used] -= RATE * slope / np.sqrt(grown[used])
    return weights


def pair_factors(counts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """How much more often two labels meet on an edge than their shares of all tokens say, as a logarithm.

    A tenth of what the shares say is added to the counts: a pair that the base spans can't have,
    as their patterns drop it, is held to be ten times rarer and not impossible. A kind of edge that
    no document has says nothing.
    """
    both = counts + counts.transpose(0, 2, 1)
    alone = (labels + 0.5) / (labels + 0.5).sum()
    chance = alone[:, None] * alone[None, :]
    total = both.sum(axis=(1, 2), keepdims=True)
    share = np.where(total > 0, both / np.maximum(total, 1), chance)
    weight = total / (total + FEW_EDGES)  # a few edges say little
    return weight * np.log((share + LEAST_SHARE * chance) / ((1 + LEAST_SHARE) * chance))


def fit(df: DataFrame, train_tokens: int = TRAIN_TOKENS) -> Field:
    """Learn from the base spans of (doc_id, text)."""

    @F.arrow_udf("array<struct<features:binary,label:int>>")
    def labelled(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            text = t.as_py()
            places = tokens(text)
            out.append([{"features": np.array(features(text, *p), np.int32).tobytes(), "label": int(y)} for p, y in zip(places, training_labels(text, places)) if y >= 0])
        return pa.array(out, pa.list_(pa.struct([("features", pa.binary()), ("label", pa.int32())])))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n_labels = np.zeros((EDGE_KINDS, LABELS, LABELS), np.int64), np.zeros(LABELS, np.int64)
        for batch in batches:
            for t in batch["text"]:
                text = t.as_py()
                places = tokens(text)
                label = training_labels(text, places)
                n_labels += np.bincount(label[label >= 0], minlength=LABELS)
                for kind, links in enumerate(edges(text, places)):
                    links = links[(label[links] >= 0).all(axis=1)]
                    if len(links):
                        np.add.at(counts[kind], (label[links[:, 0]], label[links[:, 1]]), 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(-LABELS, counts.size), pa.int32()), pa.array(np.concatenate([n_labels, counts.ravel()]))], ["cell", "n"])

    texts = df.select("doc_id", "text").where("text rlike '[0-9@]'")
    totals = texts.select("text").mapInArrow(counted, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    by_cell = np.zeros(LABELS + EDGE_KINDS * LABELS * LABELS)
    for r in totals:
        by_cell[LABELS + r["cell"]] = r["n"]
    n_labels, counts = by_cell[:LABELS], by_cell[LABELS:].reshape(EDGE_KINDS, LABELS, LABELS)
    n_tokens = int(n_labels.sum())
    # A token's hash doesn't depend on its document alone, so no one document fills the sample.
    sample = texts.select("doc_id", F.posexplode(labelled("text")).alias("place", "t")).select("t.features", "t.label", F.xxhash64("doc_id", "place", "t.features").alias("h"))
    rows = sample.where(among_least(F.col("h"), train_tokens, n_tokens)).orderBy("h", "features", "label").limit(train_tokens).collect()
    if not rows:
        return UNTRAINED
    matrix = np.array([np.frombuffer(r["features"], np.int32) for r in rows])
    return Field(own_factors(matrix, np.array([r["label"] for r in rows])), pair_factors(counts, n_labels))


def spans_column(field: Field, text: Column, spark) -> Column:
    shared = spark.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_())]))

    @F.arrow_udf("array<struct<start:int,end:int,kind:string,base:boolean>>")
    def found(texts: pa.Array) -> pa.Array:
        field = shared.value
        return pa.array([[{"start": s, "end": e, "kind": KINDS[k], "base": b} for s, k, e, b in field.spans(t.as_py())] for t in texts], kind)

    return found(F.coalesce(text, F.lit("")))


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) with spans (start, end, kind, base) in code points, one row per input row."""
    docs = ids_and_texts(df, id_col, text_col)
    return docs.select("doc_id", spans_column(fit(docs), F.col("text"), df.sparkSession).alias("spans"))


def masked(field: Field, text: Column, spark) -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap become one, named by the first."""
    shared = spark.sparkContext.broadcast(field)

    @F.arrow_udf("string")
    def mask(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            text = t.as_py()
            if text is None:
                out.append(None)
                continue
            parts, done = [], 0
            for start, kind, end, _ in shared.value.spans(text):
                if start >= done:
                    parts += [text[done:start], f"[{KINDS[kind].upper()}]"]
                done = max(done, end)
            out.append("".join(parts) + text[done:])
        return pa.array(out, pa.string())

    return mask(text)


def op9_pii(documents: DataFrame) -> DataFrame:
    found = find(documents)
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    written = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
