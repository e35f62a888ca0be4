"""Byte-level BPE against the reference encoder of the same ranks, and exact round trips."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from tallywick.llm import byte_bpe
from tallywick.llm.byte_bpe import Bpe, ByteBpe

RANK_FILE = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()
BPE = Bpe(RANK_FILE, public_tokenizers.PATTERN)
PEER = tiktoken.Encoding("peer", pat_str=public_tokenizers.PATTERN, special_tokens={},
                         mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, RANK_FILE.splitlines())})
PIECES = st.sampled_from(["'", "'s", "'re", "'v", "e", " ", "   ", "\n", "\t", "a", "the", "é", "1", "23", "!?", "漢字", " ", "x" * 30, "ing"])


def test_every_token_encodes_to_itself():
    assert all(BPE.merged(token) == [rank] for token, rank in BPE.ranks.items())


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=40).map("".join))
def test_matches_by_halves(text):
    assert BPE.matches(text, leaf=3) == BPE.split(text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=200), st.lists(PIECES, max_size=40).map("".join)))
def test_as_the_peer(text):
    ids = BPE.ids(text)
    assert ids == PEER.encode_ordinary(text)
    assert BPE.text_bytes(ids) == text.encode()


def test_long_matches():
    rng = random.Random(1)
    for text in ("a" * 5000, "ab" * 3000, "".join(rng.choice("abcdeinst") for _ in range(8000)), "=" * 4001, " " * 3000 + "x", "é" * 1000):
        assert BPE.ids(text) == PEER.encode_ordinary(text)


def test_query(spark, tmp_path):
    texts = [(1, None, "x"), (2, "", "y"), (3, "It's  the\n\nend 123", "z"), (3, "It's  the\n\nend 123", "z"), (4, "word " * 9000, None), (None, "no id", None)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, ids string")
    got = [tuple(row) for row in byte_bpe.op1_byte_bpe(frame).collect()]
    digest = lambda x: hashlib.sha256(x).hexdigest()
    ids = [PEER.encode_ordinary(t or "") for _, t, _ in texts]
    want = [(d, len(i), digest(" ".join(map(str, i)).encode()), digest((t or "").encode())) for (d, t, _), i in zip(texts, ids)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert byte_bpe.op1_byte_bpe(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rank_file_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MAX_RANK_FILE", 10)
    path = tmp_path / "ranks"
    path.write_bytes(b"x" * 11)
    with pytest.raises(ValueError):
        ByteBpe(spark, str(path), "x")
