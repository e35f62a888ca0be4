"""Personal data: base spans against plain patterns, the field against exact sums, labels carried over a document."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tallywick.llm import pii

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def good(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(p) <= 255 for p in text.split("."))
    if kind == 2:
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind != 3 or 10 <= len(digits) <= 15


def plain(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if good(k, m.group()))


PIECE = st.sampled_from(["a", "b.c", "@", "@@", "x@y.z", ".", "-", "+", " ", "1", "255", "256", "1.2.3.4", "4111 1111 1111 1111", "+1 (988) 555-2485", "(", ")", "\n", "é", "00", "99999", "+44"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(PIECE, max_size=25).map("".join))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


def test_long_texts():
    field = pii.Field(np.zeros((1 << pii.FEATURE_BITS, pii.LABELS)), np.zeros((pii.EDGE_KINDS, pii.LABELS, pii.LABELS)))
    for text in ("9 " * 20_000, "1" * 200_000 + " 2", "a1" * 100_000 + " 9"):
        field.spans(text)
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1 " * 100_000, "1." * 100_000, "+1" * 50_000, "a@" * 50_000, "@" * 100_000):
        pii.base_spans(text), pii.tokens(text)


def test_tokens():
    text = "see a1, (b@c) x 9\n2."
    assert [text[s:e] for s, e in pii.tokens(text)] == ["a1", "b@c", "9", "2"]


def test_messages_are_exact_on_a_tree():
    rng = np.random.default_rng(1)
    unary, pairs = rng.normal(size=(4, pii.LABELS)), rng.normal(size=(2, pii.LABELS, pii.LABELS))
    pairs = (pairs + pairs.transpose(0, 2, 1)) / 2  # two of the kinds of edge are used
    links, kinds = np.array([[0, 1], [1, 2], [1, 3]]), np.array([0, 1, 1])
    want = np.zeros((4, pii.LABELS))
    for labels in itertools.product(range(pii.LABELS), repeat=4):
        weight = np.exp(sum(unary[i, y] for i, y in enumerate(labels)) + sum(pairs[k, labels[a], labels[b]] for (a, b), k in zip(links, kinds)))
        for i, y in enumerate(labels):
            want[i, y] += weight
    field = pii.Field(np.zeros((1, 1)), pairs)
    old, pii.ROUNDS = pii.ROUNDS, 60
    belief = np.exp(field.passed(unary, links, kinds))
    pii.ROUNDS = old
    assert np.allclose(belief / belief.sum(1, keepdims=True), want / want.sum(1, keepdims=True), atol=1e-2)


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(300):
        words = ["word%s" % rng.choice(["", "s", "ed"]) for _ in range(60)]
        card = "4111111111111111" if i % 3 == 0 else ""
        mail = f"user{i}.name@mail{i}.example.com"
        for value in (card, card, mail if i % 2 else "", mail if i % 2 else "", f"10.0.{i % 256}.7" if i % 5 == 0 else "", f"v{i}" if i % 4 == 0 else "", str(i)):
            if value:
                words.insert(rng.randrange(len(words)), value)
        rows.append((i, " ".join(words)))
    return rows


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit(spark.createDataFrame(corpus(), "doc_id long, text string"))


def found(field, text):
    return [(text[s:e], pii.KINDS[k], base) for s, k, e, base in field.spans(text)]


def test_labels_are_carried_to_repeats(field):
    """A card that its first place shows to be one is one where it is written in a way the pattern doesn't take."""
    text = "pay 4111111111111111 now " + "some words " * 40 + "as said 4111/1111/1111/1111 again, v3 too"
    assert found(field, text) == [("4111111111111111", "card", True), ("4111/1111/1111/1111", "card", False)]
    assert found(field, "only words and 9870157079875996 and 9870157079875996, v3.2.1 and 1.2.3") == []


def test_skip_edges_change_the_result():
    """Tokens that say nothing by themselves get the label of a distant one that an edge links; without the edge they get none."""
    agree = np.zeros((pii.EDGE_KINDS, pii.LABELS, pii.LABELS))
    agree[1:] = 3 * np.eye(pii.LABELS)
    field, alone = (pii.Field(np.zeros((1 << pii.FEATURE_BITS, pii.LABELS)), pairs) for pairs in (agree, 0 * agree))
    for form in ("4111/1111/1111/1111", "no:4111_1111_1111_1111"):
        text = "first 4111111111111111 and later " + "w " * 50 + form
        base = (6, 2, 22, True)
        assert alone.spans(text) == [base]
        assert field.spans(text) == [base, (len(text) - len(form), 2, len(text), False)]


def test_neighbouring_numbers_are_told_apart(spark):
    """The patterns take two numbers with a blank between as one and drop it."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        phone, card = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", ""
        while not card:
            digits = "".join(rng.choice("0123456789") for _ in range(16))
            card = digits if pii.luhn(digits) else ""
        rows.append((i, f"call {phone} now or pay {card} to us, {'both ' + phone + ' ' + card if i % 20 == 0 else 'please'} v{i % 7} and {rng.randrange(10 ** 15, 10 ** 16)}"))
    field = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    text = "reach us: +1 (988) 555-2485 4111111111111111 thanks"
    assert pii.base_spans(text) == [] and found(field, text) == [("+1 (988) 555-2485", "phone", False), ("4111111111111111", "card", False)]
    assert found(field, "reach us: 9870157079875996 9870157079875995 thanks, 3.2 of 4") == []


def test_forms():
    assert [pii.possible(w, k) for w, k in (("a@b", 0), ("@", 0), ("@x", 0), ("1.2.3.4", 1), ("1.2.3.256", 1), ("1.2.3", 1), ("4111/1111 1111.1111", 2), ("4111111111111112", 2), ("4" * 20, 2), ("+1 988 555 2485", 3), ("123456789", 3))] == [
        True, False, False, True, False, False, True, False, False, True, False]
    assert list(pii.put_together("4111111111111111 4111111111111111", [(0, 16), (17, 33)], [3, 3], {1})) == [(0, 2, 16), (17, 2, 33)]
    assert list(pii.put_together("+1 988 555 2485", [(0, 2), (3, 6), (7, 10), (11, 15)], [4, 4, 4, 4], {1, 2, 3})) == [(0, 3, 15)]
    assert list(pii.put_together("+1 988 555 2485", [(0, 2), (3, 6), (7, 10), (11, 15)], [4, 4, 4, 4], {1, 3})) == []


def test_edges_of_each_kind():
    text = "a.b@mail.example.com x 4111111111111111 4111/1111/1111/1111 no4111111111111111 c@mail.example.com id-77/aab12c id-78/aab12c"
    places = pii.tokens(text)
    words = [text[s:e] for s, e in places]
    named = [{(words[a], words[b]) for a, b in links.tolist()} for links in pii.edges(text, places)]
    assert named[0] >= {("4111111111111111", "4111/1111/1111/1111")}
    assert named[1] == {("4111111111111111", "4111/1111/1111/1111")}
    assert named[2] == {("4111/1111/1111/1111", "no4111111111111111")}
    assert named[3] == {("a.b@mail.example.com", "c@mail.example.com")}
    assert named[4] == {("id-77/aab12c", "id-78/aab12c")}


def test_whole_tokens_and_neighbours():
    """No window of characters: a long token's shape and a far or long neighbour count whole."""
    assert pii.shape("a" * 100 + "9" + "-") == "aaaa9-" and len(pii.shape("a1" * 300)) == 600
    text = "x" * 500 + " " * 200 + "12" + " " * 200 + "Y" * 500
    assert pii.word_before(text, 700) == "x" * 500 and pii.word_after(text, 702) == "Y" * 500
    assert pii.features(text, 700, 702) != pii.features(text.replace("x" * 500, "x" * 499 + "7"), 700, 702)


def test_query(spark):
    rows = corpus() + [(2000, None), (2001, ""), (None, "mail a@b.cd"), (2002, "a@b.cd " * 3000), (7, "1.2.3.4"), (7, "1.2.3.4")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string")
    got = [tuple(r)[:6] for r in pii.op9_pii(frame).collect()]
    want = []
    for doc_id, text in rows:
        base = plain(text or "")
        counts = [sum(k == kind for _, kind, _ in base) for k in range(4)]
        want.append((doc_id, *counts, hashlib.sha256(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_mask_and_empty(spark):
    frame = spark.createDataFrame([(1, "mail a.b@c.de or +1 (988) 555-2485."), (2, None)], "doc_id long, text string")
    got = [r[0] for r in frame.orderBy("doc_id").select(pii.masked(pii.UNTRAINED, frame["text"], spark)).collect()]
    assert got == ["mail [EMAIL] or [PHONE].", None]
    assert pii.op9_pii(frame.limit(0)).count() == 0
