"""Windows of texts in Arrow batches: k code points each, taken from the
UTF-8 bytes of a block of texts at once (no string per window).

A window's id is that of ``similarity.shingle_hash``: the first 60 bits of
its md5.  Windows of up to 55 bytes are one md5 block, so a block's windows
are hashed together in numpy; longer ones go through hashlib.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20       # of texts handled at once (a longer text: alone)
LANES = 8192                # windows hashed together, so that they stay in the cache

_SHIFTS = [s for four in ([7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]) for s in four * 4]
_SINES = [int(abs(math.sin(i + 1)) * 2**32) & 0xFFFFFFFF for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_KEEP = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
_STOP = np.array([0, 0x80, 0x8000, 0x800000, 0x80000000, 0], np.uint32)
_ODD = [(0x9E3779B97F4A7C15 * (2 * i + 3) ^ 0xD1B54A32D192ED03 << i % 7 | 1) & 0xFFFFFFFFFFFFFFFF for i in range(64)]


class Block:
    """Texts as bytes, and where their k-windows stand."""

    def __init__(self, texts: pa.Array, k: int):
        at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        n = int(at[-1] - at[0])
        self.data = np.zeros(n + 4 * k + 8, np.uint8)
        if n:
            self.data[:n] = np.frombuffer(texts.buffers()[2], np.uint8, n, int(at[0]))
        points = np.flatnonzero((self.data[:n] & 0xC0) != 0x80)
        first = np.searchsorted(points, at - at[0])
        n_points = np.diff(first)
        of = np.repeat(np.arange(len(texts)), n_points)
        i = np.flatnonzero(of[:len(of) - k + 1] == of[k - 1:]) if len(of) >= k else np.empty(0, np.int64)
        self.start = points[i]
        self.length = np.append(points, n)[i + k] - self.start
        self.ends = np.concatenate([[0], np.cumsum(np.maximum(n_points - k + 1, 0))])     # of each text's windows
        d = self.data.astype(np.uint32)
        self.words = d[:-3] | d[1:-2] << 8 | d[2:-1] << 16 | d[3:] << 24

    def word(self, j: int, some: slice) -> np.ndarray:
        """Bytes 4j to 4j + 3 of windows, zero after their ends."""
        return self.words[self.start[some] + 4 * j] & _KEEP[np.clip(self.length[some] - 4 * j, 0, 4)]

    def ids(self) -> np.ndarray:
        out = np.empty(len(self.start), np.int64)
        for i in range(0, len(out), LANES):
            some = slice(i, min(i + LANES, len(out)))
            if self.length[some].max() > 55:
                found = [hashlib.md5(self.data[s:s + n].tobytes()).digest() for s, n in zip(self.start[some], self.length[some], strict=True)]
                out[some] = np.frombuffer(b"".join(found), ">u8")[::2] >> 4
            else:
                out[some] = self._md5(some)
        return out

    def marks(self, bits: int, k: int) -> np.ndarray:
        """A number of ``bits`` bits for each window, from its bytes alone: equal
        windows have equal marks in any block of windows of up to ``k`` code points."""
        out = np.empty(len(self.start), np.int64)
        for i in range(0, len(out), LANES):
            some = slice(i, min(i + LANES, len(out)))
            h = self.length[some].astype(np.uint64)
            for j in range(min(k, -(-int(self.length[some].max()) // 4))):
                h += self.word(j, some) * np.uint64(_ODD[j % len(_ODD)])      # words after a window's end are zero
            h ^= h >> np.uint64(32)
            h *= np.uint64(0x9E3779B97F4A7C15)
            out[some] = (h >> np.uint64(64 - bits)).astype(np.int64)
        return out

    def take(self, w: np.ndarray) -> pa.Array:
        """The windows ``w`` as strings."""
        start, length = self.start[w], self.length[w]
        at = np.concatenate([[0], np.cumsum(length)])
        data = self.data[np.arange(at[-1]) + np.repeat(start - at[:-1], length)]
        return pa.StringArray.from_buffers(len(w), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data))

    def owners(self, w: np.ndarray) -> np.ndarray:
        """The text that each of the windows ``w`` is of."""
        return np.searchsorted(self.ends, w, "right") - 1

    def _md5(self, some: slice) -> np.ndarray:
        length = self.length[some]
        message = {j: self.word(j, some) | _STOP[np.clip(length - 4 * j, -1, 4) + 1] for j in range(int(length.max()) // 4 + 1)}
        message[14] = (length * 8).astype(np.uint32)
        a, b, c, d = (np.full(len(length), x, np.uint32) for x in _START)
        f = np.empty_like(a)
        for i in range(64):
            if i < 16:          # (b & c) | (~b & d)
                np.bitwise_xor(c, d, out=f); f &= b; f ^= d
                g = i
            elif i < 32:        # (d & b) | (~d & c)
                np.bitwise_xor(b, c, out=f); f &= d; f ^= c
                g = (5 * i + 1) % 16
            elif i < 48:
                np.bitwise_xor(b, c, out=f); f ^= d
                g = (3 * i + 5) % 16
            else:
                np.bitwise_not(d, out=f); f |= b; f ^= c
                g = 7 * i % 16
            f += a
            f += np.uint32(_SINES[i])
            if g in message:
                f += message[g]
            np.right_shift(f, np.uint32(32 - _SHIFTS[i]), out=a)       # a is done with: it takes the new b
            f <<= np.uint32(_SHIFTS[i])
            a |= f
            a += b
            a, b, c, d = d, a, b, c
        a += np.uint32(_START[0])
        b += np.uint32(_START[1])
        return ((a.byteswap().astype(np.int64) << 32) | b.byteswap().astype(np.int64)) >> 4 & ((1 << 60) - 1)

    def distinct_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """(where each text's begin and end, the distinct ids of its windows, rising)."""
        ids, out = self.ids(), []
        for i in range(len(self.ends) - 1):
            x = np.sort(ids[self.ends[i]:self.ends[i + 1]])
            out.append(x[np.append(True, x[1:] != x[:-1])] if len(x) else x)
        return np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64), np.concatenate(out) if out else ids

    def distinct(self) -> tuple[np.ndarray, pa.Array]:
        """(the text of each, the distinct windows of every text): found by a
        sort on hashes, then told apart by their bytes."""
        n_words = -(-int(self.length.max(initial=0)) // 4)
        every = slice(0, len(self.start))
        words = [self.word(j, every) for j in range(n_words)]
        h = self.length.astype(np.uint64)
        for w in words:
            h = (h ^ w) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        kept, owner = [], []
        for i in range(len(self.ends) - 1):
            lo, hi = int(self.ends[i]), int(self.ends[i + 1])
            if lo == hi:
                continue
            order = lo + np.argsort(h[lo:hi], kind="stable")
            x = h[order]
            same = x[1:] == x[:-1]
            equal = same & (self.length[order[1:]] == self.length[order[:-1]])
            for w in words:
                equal &= w[order[1:]] == w[order[:-1]]
            if (same != equal).any():       # two windows of one hash
                seen = {self.data[self.start[w]:self.start[w] + self.length[w]].tobytes(): w for w in range(lo, hi)}
                mine = np.fromiter(seen.values(), np.int64)
            else:
                mine = order[np.append(True, ~same)]
            kept.append(mine)
            owner.append(np.full(len(mine), i))
        if not kept:
            return np.empty(0, np.int64), pa.array([], pa.string())
        return np.concatenate(owner), self.take(np.concatenate(kept))


def blocks(batches: Iterator[pa.RecordBatch], text: str, k: int) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Batches cut to blocks of about ``BLOCK_BYTES`` of text, rows with a null text left out."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if column.null_count:
            batch = batch.filter(column.is_valid())
            column = batch.column(batch.schema.get_field_index(text))
        texts = column.cast(pa.large_string())
        at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(at, at[i] + BLOCK_BYTES, "right")) - 1)
            yield batch.slice(i, j - i), Block(texts.slice(i, j - i), k)
            i = j


def per_text(text: str, k: int, columns: Callable[[Block], dict]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: the other column of (id, text) beside ``columns`` of each block, a value a text."""
    def run(batches):
        for batch, block in blocks(batches, text, k):
            found = columns(block)
            (name,) = [c for c in batch.schema.names if c != text]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(name)), *found.values()], [name, *found])
    return run


def lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def least_hashes(ends: np.ndarray, ids: np.ndarray, params: list[tuple[int, int]], prime: int) -> np.ndarray:
    """Per set (``ids`` from ends[i] to ends[i + 1]) and function the least
    (a * x + b) mod ``prime``, which is 2^31 - 1: one fold of the high bits
    leaves less than twice the prime, and ``minimum`` with the wrapped
    difference takes off the rest.  Empty sets have the prime itself."""
    p, bits = np.uint64(prime), np.uint64(31)
    a, b = (np.array(c, np.uint64)[:, None] for c in zip(*params, strict=True))
    out = np.full((len(ends) - 1, len(params)), prime, np.uint64)
    x = (ids % prime).astype(np.uint64)
    for i in range(len(out)):
        for lo in range(int(ends[i]), int(ends[i + 1]), LANES):
            some = x[lo:min(lo + LANES, int(ends[i + 1]))]
            step = max(1, LANES // len(some))
            for f in range(0, len(params), step):
                v = a[f:f + step] * some
                v += b[f:f + step]
                high = v >> bits
                v &= p
                v += high
                np.subtract(v, p, out=high)
                np.minimum(v, high, out=v)
                least = v.min(axis=1)
                np.minimum(out[i, f:f + step], least, out=out[i, f:f + step])
    return out.astype(np.int64)
