"""Byte-level BPE encoding and decoding as a monoid over text halves.

A text's value is its list of matches of the splitting pattern; a match's value is its list
of token ids. Both are built by halving, encoding the halves and joining them:

* Matches. A match ending two or more characters before the end of what is seen can't change
  when text follows (the longest look-ahead of the pattern is two characters). The join
  re-splits the tail of the left half with a growing head of the right half until a fixed
  match end falls on a match end of the right half; from there on the right half stands.
* Tokens. A token list is the BPE encoding of its bytes if each neighbouring pair is the
  encoding of its own bytes. The join re-encodes a window over the seam, growing to the side
  whose outermost token changed; when both outermost tokens stay, every pair is a pair
  of one of three encodings, so the tokens outside can't change.

Decoding concatenates the bytes of id halves up the tree.

Defined results: a null text counts as an empty one and has no ids; null id lists decode to
no bytes; very long texts are halved, so no scan is longer than LEAF characters; repeated
rows are encoded one by one; an empty table gives an empty result; other columns are kept by
`encode` and `decode`, and a column of the result's name is replaced.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

LEAF = 16_384  # characters that are split at once
LEAF_BYTES = 24  # of a match that are merged without halving
NONE = 1 << 62  # above every rank
CACHED = 600_000  # matches whose ids a worker keeps, about 130 MB
TABLE_BITS = 19
ID = np.dtype(np.int32)
AT_ONCE = 8192  # matches that are merged side by side
GROUP = 2_000_000  # characters that are split before new matches are encoded
MAX_RANK_FILE = 64 * 1024 * 1024  # the ranks go to every executor


class Bpe:
    def __init__(self, rank_file: bytes, pattern: str, cached: int = CACHED):
        self.cached = cached
        lines = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.token_bytes = [b""] * (max(self.ranks.values(), default=-1) + 1)
        self.pairs: dict[int, int] = {}  # rank of the token that two neighbouring tokens make
        for token, rank in self.ranks.items():
            self.token_bytes[rank] = token
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank
        self.bytes = [self.ranks.get(bytes([b]), -1) for b in range(256)]
        self.split = regex.compile(pattern).findall
        self.tables = _tables(np.array(list(self.pairs), np.int64), np.array(list(self.pairs.values()), np.int64))
        self.byte_table = np.array(self.bytes, np.int64)
        self.known: dict[str, bytes] = {}  # packed ids by match

    # Tokens of one match.

    def merged(self, data: bytes) -> list[int]:
        """The merge loop itself: join the pair of lowest rank, leftmost first, while there is one."""
        pair = self.pairs.get
        parts = [self.bytes[b] for b in data]
        ranks = [pair(a << 32 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != NONE:
            at = ranks.index(best)
            parts[at:at + 2] = [best]
            del ranks[at]
            if at:
                ranks[at - 1] = pair(parts[at - 1] << 32 | best, NONE)
            if at < len(ranks):
                ranks[at] = pair(best << 32 | parts[at + 1], NONE)
        return parts

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left or right
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            seam = self.merged(b"".join(map(self.token_bytes.__getitem__, left[-i:] + right[:j])))
            left_stands = i == len(left) or seam[0] == left[-i]
            right_stands = j == len(right) or seam[-1] == right[j - 1]
            if left_stands and right_stands:
                return left[:-i] + seam + right[j:]
            i, j = i if left_stands else 2 * i, j if right_stands else 2 * j

    def encoded(self, data: bytes) -> list[int]:
        rank = self.ranks.get(data)
        if rank is not None:
            return [rank]
        if len(data) <= LEAF_BYTES:
            return self.merged(data)
        half = len(data) // 2
        return self.joined(self.encoded(data[:half]), self.encoded(data[half:]))

    def merged_many(self, leaves: list[bytes]) -> list[bytes]:
        """`merged` for many short strings at once: a row each, one merge in every open row per step; ids are packed."""
        sizes = np.array([len(x) for x in leaves])
        width = int(sizes.max())
        rows = np.full((len(leaves), width + 1), -1, np.int64)
        rows[np.arange(width + 1) < sizes[:, None]] = self.byte_table[np.frombuffer(b"".join(leaves), np.uint8)]
        ranks = self.pair_ranks(rows[:, :-1], rows[:, 1:])
        done: list = [None] * len(leaves)
        number, columns = np.arange(len(leaves)), np.arange(width + 1)
        while len(number):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(at)), at]
            ended = best == NONE
            whole, held = rows[ended].astype(ID).tobytes(), 4 * (width + 1)
            for k, (i, n) in enumerate(zip(number[ended].tolist(), (rows[ended] >= 0).sum(axis=1).tolist())):
                done[i] = whole[k * held:k * held + 4 * n]
            number, rows, ranks, at, best = number[~ended], rows[~ended], ranks[~ended], at[~ended], best[~ended]
            if not len(number):
                break
            each = np.arange(len(number))
            rows[each, at] = best
            take = np.minimum(columns + (columns > at[:, None]), width)
            rows = np.take_along_axis(rows, take, axis=1)
            rows[:, -1] = -1
            ranks = np.take_along_axis(ranks, np.minimum(take[:, :-1], width - 1), axis=1)
            ranks[:, -1] = NONE
            ranks[each, at] = self.pair_ranks(best, rows[each, at + 1])
            left = each[at > 0]
            ranks[left, at[left] - 1] = self.pair_ranks(rows[left, at[left] - 1], best[left])
        return done

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that each two tokens make, NONE where there is none or one is missing."""
        key = left << 32 | right
        found = np.full(key.shape, NONE, np.int64)
        for multiplier, keys, values in self.tables:
            slot = (key.view(np.uint64) * multiplier) >> np.uint64(64 - TABLE_BITS)
            found = np.where(keys[slot] == key, values[slot], found)
        return found

    # Matches of one text.

    def matches(self, text: str, leaf: int = LEAF) -> list[str]:
        if len(text) <= leaf:
            return self.split(text)
        half = len(text) // 2
        return self.joined_matches(self.matches(text[:half], leaf), self.matches(text[half:], leaf))

    def joined_matches(self, left: list[str], right: list[str]) -> list[str]:
        if not left or not right:
            return left or right
        i, seen = 1, len(left[-1])
        while i < len(left) and seen - len(left[-i]) < 2:  # match i from the end ends so far before the end
            i += 1
            seen += len(left[-i])
        tail, j = "".join(left[-i:]), 1
        while True:
            j = min(j, len(right))
            window = tail + "".join(right[:j])
            ends, place = {len(tail): 0}, len(tail)
            for n, match in enumerate(right[:j], 1):
                place += len(match)
                ends[place] = n
            last = len(window) if j == len(right) else len(window) - 2
            seam, place = self.split(window), 0
            for n, match in enumerate(seam, 1):
                place += len(match)
                if place > last:
                    break
                if place in ends:
                    return left[:-i] + seam[:n] + right[ends[place]:]
            j *= 2

    # Whole texts.

    def learn(self, matches: set[str]) -> None:
        """Encode the matches that are not known yet."""
        if len(self.known) > self.cached:
            self.known.clear()
        new = matches.difference(self.known)
        short = []
        for match in new:
            data = match.encode("utf-8")
            if len(data) <= LEAF_BYTES and data not in self.ranks:
                short.append((match, data))
            else:
                self.known[match] = np.array(self.encoded(data), ID).tobytes()
        short.sort(key=lambda x: len(x[1]))
        for at in range(0, len(short), AT_ONCE):
            part = short[at:at + AT_ONCE]
            self.known.update(zip([m for m, _ in part], self.merged_many([d for _, d in part])))

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.matches(t) for t in texts]
        self.learn(set().union(*split))
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, s)), ID) for s in split]

    def ids(self, text: str) -> list[int]:
        return self.ids_of([text])[0].tolist()

    def text_bytes(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF:
            return b"".join(map(self.token_bytes.__getitem__, ids))
        half = len(ids) // 2
        return self.text_bytes(ids[:half]) + self.text_bytes(ids[half:])


def _tables(keys: np.ndarray, values: np.ndarray) -> list[tuple[np.uint64, np.ndarray, np.ndarray]]:
    """Hash tables for arrays of keys: what clashes in one goes into the next, with another multiplier."""
    rng, out = np.random.default_rng(1), []
    while len(keys):
        multiplier = np.uint64(rng.integers(1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        slot = (keys.view(np.uint64) * multiplier) >> np.uint64(64 - TABLE_BITS)
        _, first = np.unique(slot, return_index=True)
        table, ranks = np.full(1 << TABLE_BITS, -1, np.int64), np.full(1 << TABLE_BITS, NONE, np.int64)
        table[slot[first]], ranks[slot[first]] = keys[first], values[first]
        out.append((multiplier, table, ranks))
        rest = np.ones(len(keys), np.bool_)
        rest[first] = False
        keys, values = keys[rest], values[rest]
    return out


_LOADED: dict[tuple, Bpe] = {}


def loaded(rank_file: bytes, pattern: str, cached: int = CACHED) -> Bpe:
    """One encoder for each vocabulary and worker process."""
    key = (hash(rank_file), len(rank_file), pattern, cached)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(rank_file, pattern, cached)
    return _LOADED[key]


class ByteBpe:
    """Encodes and decodes columns by the ranks in a file of the driver, sent to the executors once.

    `cached` matches (about 200 bytes each) and `group` characters are what a worker holds at once.
    """

    def __init__(self, spark: SparkSession, rank_path: str, pattern: str, cached: int = CACHED, group: int = GROUP):
        with open(rank_path, "rb") as file:
            ranks = file.read(MAX_RANK_FILE + 1)
        if len(ranks) > MAX_RANK_FILE:
            raise ValueError(f"{rank_path} is larger than {MAX_RANK_FILE} bytes")
        self.ranks, self.pattern, self.cached, self.group = spark.sparkContext.broadcast(ranks), pattern, cached, group

    def ids(self, text: Column) -> Column:
        ranks, pattern, cached, most = self.ranks, self.pattern, self.cached, self.group

        @F.arrow_udf("array<int>")
        def encode(texts: pa.Array) -> pa.Array:
            bpe = loaded(ranks.value, pattern, cached)
            ids, group, size = [], [], 0
            for t in texts:
                group.append(t.as_py())
                size += len(group[-1])
                if size >= most:
                    ids += bpe.ids_of(group)
                    group, size = [], 0
            ids += bpe.ids_of(group)
            flat = np.concatenate([np.zeros(0, ID), *ids])
            return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(flat))

        return encode(F.coalesce(text.cast("string"), F.lit("")))

    def bytes_of(self, ids: Column) -> Column:
        ranks, pattern, cached = self.ranks, self.pattern, self.cached

        @F.arrow_udf("binary")
        def decode(lists: pa.Array) -> pa.Array:
            bpe = loaded(ranks.value, pattern, cached)
            ids, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *pc.fill_null(pc.list_value_length(lists), 0).to_pylist()])
            return pa.array([bpe.text_bytes(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])], pa.binary())

        return decode(ids)

    def encode(self, df: DataFrame, text_col: str = "text", into: str = "ids") -> DataFrame:
        return df.withColumn(into, self.ids(F.col(f"`{text_col}`")))

    def decode(self, df: DataFrame, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
        return df.withColumn(into, self.bytes_of(F.col(f"`{ids_col}`")))


def production(spark: SparkSession, cached: int = CACHED, group: int = GROUP) -> ByteBpe:
    import public_tokenizers

    return ByteBpe(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, cached, group)


def op1_byte_bpe(documents: DataFrame) -> DataFrame:
    bpe = production(documents.sparkSession)
    encoded = bpe.encode(documents.select("doc_id", "text")).drop("text")
    return bpe.decode(encoded).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
