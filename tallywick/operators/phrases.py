"""Places of phrases in lines of words, as arrays: their hashes, tests by filters, counts. Runs in Python workers.

A line is words joined by single blanks. Hashes only say which places may hold a frequent
phrase; what is counted in the end are the phrases themselves. A hash has the bits of its bucket
and 32 more, of which only these are sent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LINE_BYTES = 1 << 20  # of lines that are taken at once, or one line
HELD_KEYS = 1 << 21  # hashes of a task before they are sorted and sent
HELD_PHRASES = 1 << 22  # phrases of a task before they are counted and sent, or such as lie in so many bytes of lines
HELD_BYTES = 64 << 20
LONG = 256  # bytes of a phrase; longer ones are counted one by one
HASHES, STRINGS = 0, 1
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], "u8")
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def held(keys: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Which keys a blocked filter may hold; the bits of `ngrams.blocked_filter`, one word a block."""
    one = np.uint64(1)
    of = lambda shift: one << ((keys >> np.uint64(shift)) & np.uint64(63))
    wanted = of(40) | of(46) | of(52)
    return (blocks[(keys & np.uint64(len(blocks) - 1)).astype("i8")] & wanted) == wanted


def _merged(at: np.ndarray, some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """`some` at the places `at`, the others in their order between them."""
    out, left = np.empty(len(some) + len(others), "i8"), np.ones(len(some) + len(others), bool)
    left[at] = False
    out[at], out[left] = some, others
    return out


def kept(key: str, filled) -> Callable:
    """For mapInArrow: the rows whose key the filter may hold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key)
            yield batch.filter(pc.and_(pa.array(held(keys.fill_null(0).to_numpy().view("u8"), filled.value)), keys.is_valid()))

    return rows


class Places:
    """The words of some lines. A phrase begins at one of the first `starts` words of a line and ends in it."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, starts: int, buckets: int):
        """`data` has eight bytes to spare at either end; `bounds` are the places in it where lines begin, and the end of the last."""
        self.data, self.unused, firsts = data, np.uint64(33 - buckets.bit_length()), bounds[:-1]
        blanks = np.flatnonzero(data[bounds[0]:bounds[-1]] == 32) + bounds[0]
        before = np.append(np.searchsorted(blanks, firsts) + np.arange(len(firsts)), len(firsts) + len(blanks))  # words before a line
        n, every = np.diff(before), np.arange(before[-1])
        self.begin, self.end = _merged(before[:-1], firsts, blanks + 1), _merged(before[1:] - 1, bounds[1:], blanks)
        self.left = np.repeat(before[1:], n) - every
        self.opens = every - np.repeat(before[:-1], n) < starts
        eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        size = self.end - self.begin
        # The first sixteen bytes, the last eight and the length: all there is of words up to 24 bytes.
        first = eight[self.begin] & _LOW[np.minimum(size, 8)]
        second = eight[np.minimum(self.begin + 8, len(eight) - 1)] & _LOW[np.clip(size - 8, 0, 8)]
        last = np.where(size > 16, eight[self.end - 8], 0).astype("u8")
        self.words = _mixed(_mixed(_mixed(first * _ODD[0] + size.astype("u8")) + second * _ODD[1]) + last * _ODD[2])

    def keys(self, size: int) -> np.ndarray:
        """The hash of the phrase of `size` words at each word; what leaves the line has some value."""
        found = self.words.copy()
        for k in range(1, size):
            found *= _ODD[3]
            found[:-k or None] += self.words[k:] if k < len(found) else 0
        return _mixed(found) >> self.unused

    def valid(self, size: int) -> np.ndarray:
        return self.opens & (self.left >= size)


def places(batches: Iterator[pa.RecordBatch], starts: int, buckets: int) -> Iterator[Places]:
    """Of the first column's lines, some at a time."""
    for batch in batches:
        lines = batch.column(0).cast(pa.large_binary())
        if not len(lines):
            continue
        _, offsets, values = lines.buffers()
        at = np.frombuffer(offsets, "i8")[lines.offset:lines.offset + len(lines) + 1]
        data = np.frombuffer(values, "u1") if values is not None else np.empty(0, "u1")
        row = 0
        while row < len(lines):
            to = max(row + 1, int(np.searchsorted(at, at[row] + LINE_BYTES, "right")) - 1)
            spare = np.zeros(8, "u1")
            yield Places(np.concatenate([spare, data[at[row]:at[to]], spare]), at[row:to + 1] - at[row] + 8, starts, buckets)
            row = to


class Hashes:
    """Collects the hashes of phrases that wait to be counted: at most a few million, whatever the task's size."""

    def __init__(self, buckets: int, least: int):
        self.buckets, self.least, self.kept, self.n = buckets, least, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.kept.append(keys)
        self.n += len(keys)
        if self.n >= HELD_KEYS:
            yield from self.sent()

    def sent(self) -> Iterator[pa.RecordBatch]:
        """Different hashes with how often each is there, `least` at most, a row for each bucket."""
        if not self.n:
            return
        keys = np.sort(np.concatenate(self.kept))
        first = _firsts(keys)
        counts = np.minimum(np.diff(np.append(first, len(keys))), self.least).astype(_kind(self.least))
        cuts, rest = _cuts(keys[first], self.buckets), keys[first].astype("<u4")
        yield _rows(cuts, HASHES, {"data": lambda x, y: rest[x:y].tobytes(), "counts": lambda x, y: counts[x:y].tobytes()})
        self.kept, self.n = [], 0


class Phrases:
    """Collects phrases that wait to be counted, as places in their lines."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self._empty()

    def _empty(self) -> None:
        self.data, self.keys, self.begin, self.size, self.n, self.bytes = [], [], [], [], 0, 0

    def add(self, some: Places, good: np.ndarray, words: int, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The phrases of so many words at the places that are good."""
        chosen = np.flatnonzero(good)
        if not len(chosen):
            return
        begin = some.begin[chosen]
        self.data.append(some.data)
        self.keys.append(keys[chosen])
        self.begin.append(begin + self.bytes)
        self.size.append(some.end[chosen + words - 1] - begin)
        self.n += len(chosen)
        self.bytes += len(some.data)
        if self.n >= HELD_PHRASES or self.bytes >= HELD_BYTES:
            yield from self.sent()

    def sent(self) -> Iterator[pa.RecordBatch]:
        """Different phrases end to end (packed), their lengths and how often each is there, a row for each bucket."""
        if not self.n:
            return
        data, keys, begin, size = (np.concatenate(x) for x in (self.data, self.keys, self.begin, self.size))
        self._empty()
        chosen, counts = _different(data, keys, begin, size)
        cuts, sizes, counts = _cuts(keys[chosen], self.buckets), size[chosen].astype("<i4"), counts.astype("<u4")
        at, begin = np.concatenate([[0], np.cumsum(size[chosen])]), begin[chosen]

        def made(x: int, y: int) -> bytes:
            shift = begin[x:y] - at[x:y]
            return pa.compress(data[np.repeat(shift, sizes[x:y]) + np.arange(at[x], at[y])], "zstd", asbytes=True)

        yield _rows(cuts, STRINGS, {"data": made, "sizes": lambda x, y: sizes[x:y].tobytes(), "counts": lambda x, y: counts[x:y].tobytes()})


def _kind(least: int) -> str:
    return "u1" if least < 1 << 8 else "<i8"


def _firsts(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1]))


def _cuts(sorted_keys: np.ndarray, buckets: int) -> list[int]:
    return [*np.searchsorted(sorted_keys, np.arange(buckets, dtype="u8") << np.uint64(32)).tolist(), len(sorted_keys)]


def _rows(cuts: list[int], kind: int, columns: dict) -> pa.RecordBatch:
    """(kind, bucket, data, sizes, counts), a row for each bucket that has something."""
    some = [b for b in range(len(cuts) - 1) if cuts[b] < cuts[b + 1]]
    of = lambda name: pa.array([columns[name](cuts[b], cuts[b + 1]) if name in columns else None for b in some], pa.binary())
    return pa.record_batch([pa.array([kind] * len(some), pa.int32()), pa.array(some, pa.int32()), of("data"), of("sizes"), of("counts")], ["kind", "bucket", "data", "sizes", "counts"])


def _different(data: np.ndarray, keys: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the phrases data[begin:begin + size] one of each, in order of their keys, and how often each is there.

    Those of one key are compared byte by byte with the first of them; what differs, or is long, is counted by itself.
    """
    bits, low = np.uint64(len(keys).bit_length()), np.uint64((1 << 32) - 1)
    # Keys and places are sorted as one number, with as many bits of the key as there is room for.
    unused = np.uint64(max(0, int(keys.max()).bit_length() + int(bits) - 64))
    packed = np.sort((keys >> unused) << bits | np.arange(len(keys), dtype="u8"))
    first, order = _firsts(packed >> bits), (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype("i8")
    times = np.diff(np.append(first, len(keys)))
    span = (begin.astype("u8") << np.uint64(32) | np.minimum(size, LONG + 1).astype("u8"))[order]
    model = np.repeat(span[first], times)
    same = ((span ^ model) & low == 0) & (span & low <= LONG)
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    open_ = np.flatnonzero(same & (span != model))
    for at in range(0, LONG, 8):
        left = (span[open_] & low).astype("i8") - at
        open_, left = open_[left > 0], left[left > 0]
        if not len(open_):
            break
        its = lambda spans: eight[(spans[open_] >> np.uint64(32)).astype("i8") + at]  # noqa: B023, E731
        differ = ((its(span) ^ its(model)) & _LOW[np.minimum(left, 8)]) != 0
        same[open_[differ]] = False
        open_ = open_[~differ]
    if same.all():
        return order[first], times
    counts, others = np.add.reduceat(same.astype("i8"), first), {}
    for i in order[~same].tolist():
        others.setdefault(data[begin[i]:begin[i] + size[i]].tobytes(), [i, 0])[1] += 1
    chosen, counts = order[first][counts > 0], counts[counts > 0]
    more, its_counts = (np.array(x, "i8") for x in zip(*sorted(others.values(), key=lambda x: keys[x[0]]), strict=True))
    at = np.searchsorted(keys[chosen] >> unused, keys[more] >> unused)
    return np.insert(chosen, at, more), np.insert(counts, at, its_counts)


def sent(size: int, n: int, filters: Sequence, starts: int, buckets: int, least: int) -> Callable:
    """For mapInArrow: the phrases of `size` words that the filter of their length, the last of `filters`, lets pass (all of them if there
    is none), and the hashes of those with a word more whose parts it lets pass; or, of the longest, `n` words, the phrases themselves."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, found = Hashes(buckets, least), Phrases(buckets)
        for some in places(batches, starts, buckets):
            passed = None
            if size:
                keys = some.keys(size)
                passed = held(_mixed(keys), filters[-1].value) if filters else np.ones(len(keys), bool)
                yield from found.add(some, passed & some.valid(size), size, keys)
            if size < n:
                good, keys = some.valid(size + 1), some.keys(size + 1)
                if passed is not None:
                    good &= passed
                    good[:-1] &= passed[1:]
                if size + 1 == n:
                    yield from found.add(some, good, n, keys)
                else:
                    yield from hashes.add(keys[good])
        yield from hashes.sent()
        yield from found.sent()

    return parts


def added(least: int) -> Callable:
    """For applyInArrow: (phrase, cnt) of the phrases of a bucket that are there `least` times or more over all tasks, and (key) of such hashes, as a filter takes them."""

    def totals(table: pa.Table) -> pa.Table:
        blobs = {name: table.column(name).to_pylist() for name in ("data", "sizes", "counts")}
        joined = lambda some, kind: np.frombuffer(b"".join(some), kind)
        if table.column("kind")[0].as_py() == HASHES:
            keys, counts = joined(blobs["data"], "<u4"), joined(blobs["counts"], _kind(least))
            order = np.argsort(keys)
            keys = keys[order]
            first = _firsts(keys)
            total = np.add.reduceat(counts[order].astype("i8"), first)
            whole = keys[first][total >= least].astype("u8") | np.uint64(table.column("bucket")[0].as_py() << 32)
            return pa.table({"phrase": pa.nulls(len(whole), pa.string()), "cnt": pa.nulls(len(whole), pa.int64()), "key": pa.array(_mixed(whole).view("i8"))})
        unpacked = (pa.decompress(x, int(np.frombuffer(n, "<i4").sum(dtype="i8")), "zstd") for x, n in zip(blobs["data"], blobs["sizes"], strict=True))
        sizes, counts = joined(blobs["sizes"], "<i4"), joined(blobs["counts"], "<u4")
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype="i8")])
        every = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(joined(unpacked, "u1")))
        sums = pa.table({"phrase": every, "n": counts.astype("i8")}).group_by("phrase").aggregate([("n", "sum")])
        often = sums.filter(pc.greater_equal(sums["n_sum"], least))
        return pa.table({"phrase": often["phrase"].cast(pa.string()), "cnt": often["n_sum"], "key": pa.nulls(len(often), pa.int64())})

    return totals
