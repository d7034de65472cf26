"""Elias-Fano sequences with vectorised queries, and a flat file of named arrays that can be memory-mapped."""

from __future__ import annotations

import json
import os
import uuid
from functools import cached_property

import numpy as np
from pyarrow import fs

ONE = np.uint64(1)


#: Per byte, one for each, and the highest bit of each.
BYTES, TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: Position of the k-th set bit of a byte, at 256 * k + byte.
IN_BYTE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[k] for k in range(8) for byte in range(256)], np.int64)


def _select(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th set bit (from 0) within each 64-bit word."""
    k = k.astype(np.uint64)
    # set bits up to each byte, that byte included
    sums = words - (words >> ONE & np.uint64(0x5555555555555555))
    sums = (sums & np.uint64(0x3333333333333333)) + (sums >> np.uint64(2) & np.uint64(0x3333333333333333))
    sums = (sums + (sums >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * BYTES
    place = np.bitwise_count((k * BYTES | TOPS) - sums & TOPS).astype(np.uint64) << np.uint64(3)
    before = sums << np.uint64(8) >> place & np.uint64(255)
    byte = words >> place & np.uint64(255)
    return place.astype(np.int64) + IN_BYTE[(k - before << np.uint64(8) | byte).astype(np.int64)]


def _trailing(words: np.ndarray) -> np.ndarray:
    """Zeros below the lowest set bit; 64 where there is none."""
    return np.bitwise_count(~words & words - ONE).astype(np.int64)


class Growing:
    """An Elias-Fano sequence that takes its values in pieces; the first piece decides the width of the low parts."""

    def __init__(self) -> None:
        self.n, self.shift = 0, 0
        #: Full words, and the one that the next piece goes on with.
        self.high, self.low, self.high_rest, self.low_rest = [], [], np.uint64(0), np.uint64(0)
        self.high_words = 0

    def add(self, values: np.ndarray) -> None:
        """Non-decreasing values, none below those added before."""
        values, n = values.astype(np.uint64), len(values)
        if not n:
            return
        if not self.n:
            self.shift = max(0, ((int(values[-1]) + 1) // n).bit_length() - 1)
        bits = (values >> np.uint64(self.shift)).astype(np.int64) + np.arange(self.n, self.n + n) - 64 * self.high_words
        high = np.zeros((int(bits[-1]) >> 6) * 64 + 64, bool)
        high[bits] = True
        high = np.packbits(high, bitorder="little").view(np.uint64)
        high[0] |= self.high_rest
        self.high.append(high[:-1])
        self.high_words, self.high_rest = self.high_words + len(high) - 1, high[-1]
        if self.shift:
            part = values & np.uint64((1 << self.shift) - 1)
            at = np.arange(n, dtype=np.int64) * self.shift + (self.n * self.shift & 63)
            word, off = at >> 6, (at & 63).astype(np.uint64)
            low = np.zeros((int(at[-1]) + self.shift >> 6) + 1, np.uint64)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            low[word[first]] = np.bitwise_or.reduceat(part << off, first)
            # at most one value reaches over into each word
            spill = np.flatnonzero((at & 63) + self.shift > 64)
            low[word[spill] + 1] |= part[spill] >> (np.uint64(64) - off[spill])
            low[0] |= self.low_rest
            self.low.append(low[:-1])
            self.low_rest = low[-1]
        self.n += n

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        high = np.concatenate([*self.high, np.array([self.high_rest, 0, 0], np.uint64)])
        low = np.concatenate([*self.low, np.array([self.low_rest, 0], np.uint64)])
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)[:-1]])
        kind = np.uint32 if len(high) * 64 < 1 << 32 else np.int64
        return {
            f"{name}.meta": np.array([self.n, self.shift], np.int64), f"{name}.high": high, f"{name}.ones": ones.astype(kind),
            f"{name}.zeros": (np.arange(len(high)) * 64 - ones).astype(kind), f"{name}.low": low,
        }


class EliasFano:
    """A non-decreasing sequence of unsigned integers in 2 + log2(universe / n) bits each, plus rank directories."""

    def __init__(self, n: int, shift: int, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray, low: np.ndarray) -> None:
        self.n, self.shift, self.high, self.ones, self.zeros, self.low = n, shift, high, ones, zeros, low

    @classmethod
    def arrays(cls, values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        growing = Growing()
        growing.add(values)
        return growing.arrays(name)

    @classmethod
    def opened(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, shift = (int(x) for x in arrays[f"{name}.meta"])
        return cls(n, shift, *(arrays[f"{name}.{x}"] for x in ("high", "ones", "zeros", "low")))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.shift:
            return np.zeros(len(i), np.uint64)
        at = i * self.shift
        word, off = at >> 6, (at & 63).astype(np.uint64)
        # shifted in two steps, as 64 places at once are not defined
        return (self.low[word] >> off | self.low[word + 1] << ONE << np.uint64(63) - off) & np.uint64((1 << self.shift) - 1)

    def _one(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th set bit."""
        word = np.searchsorted(self.ones, k.astype(self.ones.dtype), "right") - 1
        return (word << 6) + _select(self.high[word], k - self.ones[word])

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th clear bit."""
        word = np.searchsorted(self.zeros, k.astype(self.zeros.dtype), "right") - 1
        return (word << 6) + _select(~self.high[word], k - self.zeros[word])

    def _value(self, i: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (at - i).astype(np.uint64) << np.uint64(self.shift) | self._low(i)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Values at indices ``i``, all within 0 to n - 1."""
        i = np.asarray(i, np.int64)
        return self._value(i, self._one(i))

    def neighbours(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values at indices ``i`` and ``i + 1``, all within 0 to n - 1."""
        i = np.asarray(i, np.int64)
        at = self._one(i)
        step = _trailing(self.high[at >> 6] >> (at & 63).astype(np.uint64) >> ONE)
        then = at + 1 + step
        far = np.flatnonzero(step == 64)
        then[far] = self._one(i[far] + 1)
        return self._value(i, at), self._value(i + 1, then)

    @cached_property
    def last(self) -> np.uint64:
        return self[np.array([self.n - 1])][0]

    def _bucket(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first value whose high part is ``h`` or more, and the end of those that have it."""
        at = np.where(h > 0, self._zero(np.maximum(h, 1) - 1) + 1, 0)
        length = _trailing(~self.high[at >> 6] >> (at & 63).astype(np.uint64))
        lo = at - h
        hi = lo + length
        far = np.flatnonzero(length == 64)
        hi[far] = self._zero(h[far]) - h[far]
        return lo, hi

    def _search(self, x: np.ndarray, back: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per value the first index in its bucket, short of the last ``back`` ones, whose low part is no less; the bucket's end, the low part."""
        h, low = (x >> np.uint64(self.shift)).astype(np.int64), x & np.uint64((1 << self.shift) - 1)
        lo, end = self._bucket(h)
        some = np.flatnonzero(lo < end - back)
        a, b, want = lo[some], end[some] - back, low[some]
        while len(some):  # binary search on the low parts of the bucket
            mid = (a + b) >> 1
            less = self._low(mid) < want
            a, b = np.where(less, mid + 1, a), np.where(less, b, mid)
            lo[some] = a
            open_ = np.flatnonzero(a < b)
            some, a, b, want = some[open_], a[open_], b[open_], want[open_]
        return lo, end, low

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value >= x; n where there is none."""
        x = np.asarray(x, np.uint64)
        if not self.n:
            return np.zeros(len(x), np.int64)
        return np.where(x > self.last, self.n, self._search(np.minimum(x, self.last), 0)[0])

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value equal to x; -1 where there is none."""
        x = np.asarray(x, np.uint64)
        out = np.full(len(x), -1, np.int64)
        if self.n:
            # the last value of a bucket need not be compared twice
            lo, end, low = self._search(np.minimum(x, self.last), 1)
            some = np.flatnonzero((lo < end) & (x <= self.last))
            some = some[self._low(lo[some]) == low[some]]
            out[some] = lo[some]
        return out


def local_path(path: str) -> str | None:
    """The path on a mounted file system, None for a store that only a client reads."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if path.startswith("/") else None


def write_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Write named arrays to one file that appears at once; a repeated task replaces it by the same content."""
    arrays = {k: np.ascontiguousarray(v) for k, v in arrays.items()}
    head, at = {}, 0
    for k, v in arrays.items():
        head[k] = [v.dtype.str, at, len(v)]
        at += -(-v.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    store, name = fs.FileSystem.from_uri(path) if local_path(path) is None else (fs.LocalFileSystem(), local_path(path))
    draft = f"{os.path.dirname(name)}/_{uuid.uuid4().hex}"
    store.create_dir(os.path.dirname(name), recursive=True)
    with store.open_output_stream(draft) as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for v in arrays.values():
            out.write(v.tobytes() + b"\0" * (-v.nbytes % 8))
    store.move(draft, name)


def open_arrays(path: str) -> dict[str, np.ndarray]:
    """Arrays of a file: memory-mapped on a mounted file system, else read into memory."""
    name = local_path(path)
    if name is not None:
        data = np.asarray(np.memmap(name, np.uint8, "r"))
    else:
        store, name = fs.FileSystem.from_uri(path)
        data = np.frombuffer(store.open_input_stream(name).readall(), np.uint8)
    size = int.from_bytes(data[:8].tobytes(), "little")
    head = json.loads(data[8 : 8 + size].tobytes())
    return {k: data[8 + size + at : 8 + size + at + n * np.dtype(kind).itemsize].view(kind) for k, (kind, at, n) in head.items()}
