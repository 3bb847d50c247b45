"""Elias-Fano sequences and the levels of an n-gram trie over them, in flat buffers.

A sequence keeps the low bits of its values side by side and the high bits as a unary bit string
with one running count per word. Everything is read through numpy views, so a buffer may be a
memory-mapped file, and all queries take whole vectors of arguments.
"""

from __future__ import annotations

import mmap
import struct
import tempfile

import numpy as np

_ONE = np.uint64(1)


def _padded(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % 8)


class Sequence:
    """A non-decreasing sequence of integers below 2**62."""

    def __init__(self, buffer: memoryview | bytes, at: int = 0) -> None:
        self.n, self.low_bits, n_low, n_high = struct.unpack_from("<4q", buffer, at)
        at += 32
        low = np.frombuffer(buffer, np.uint8, n_low, at)
        # Any eight bytes as one little-endian number.
        self._low = np.ndarray((max(0, n_low - 7),), "<u8", low, strides=(1,))
        at += n_low
        self._high = np.frombuffer(buffer, "<u8", n_high, at)
        at += 8 * n_high
        self._ones = np.frombuffer(buffer, "<i8", n_high + 1, at)
        self._zeros = 64 * np.arange(n_high + 1) - self._ones
        self.end = at + 8 * (n_high + 1)

    @staticmethod
    def pack(values: np.ndarray, universe: int) -> bytes:
        n = len(values)
        bits = max(0, min(55, int(universe // max(n, 1)).bit_length() - 1))
        values = values.astype(np.uint64)
        low = np.zeros((n, bits), np.uint8)
        for b in range(bits):
            low[:, b] = (values >> np.uint64(b)) & _ONE
        low_raw = _padded(np.packbits(low.ravel(), bitorder="little").tobytes() + bytes(8))
        high = (values >> np.uint64(bits)).astype(np.int64)
        length = (int(high[-1]) if n else 0) + n + 1
        line = np.zeros(-(-length // 64) * 64, np.uint8)
        line[high + np.arange(n)] = 1
        words = np.packbits(line, bitorder="little").view("<u8")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
        head = struct.pack("<4q", n, bits, len(low_raw), len(words))
        return head + low_raw + words.tobytes() + ones.astype("<i8").tobytes()

    def _select(self, k: np.ndarray, counts: np.ndarray, flip: bool) -> np.ndarray:
        """Position of the k-th (from 0) set bit, or unset bit if ``flip``."""
        word = np.searchsorted(counts, k, "right") - 1
        bits = self._high[np.minimum(word, len(self._high) - 1)]
        bits = ~bits if flip else bits
        rest = k - counts[word]
        at = np.zeros(len(k), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            part = (bits >> at.astype(np.uint64)) & np.uint64((1 << step) - 1)
            inside = np.bitwise_count(part).astype(np.int64)
            over = rest >= inside
            rest -= np.where(over, inside, 0)
            at += np.where(over, step, 0)
        return 64 * word + at

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        window = self._low[bit >> 3] >> (bit & 7).astype(np.uint64)
        return window & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        high = self._select(i, self._ones, False) - i
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self._lows(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value not below x; n where there is none."""
        x = x.astype(np.uint64)
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        groups = int(self._zeros[-1])
        # Values of one high part lie between two unset bits.
        known = np.minimum(high, groups)
        start = np.zeros(len(x), np.int64)
        inner = known > 0
        before = known[inner] - 1
        start[inner] = self._select(before, self._zeros, True) - before
        stop = np.full(len(x), self.n)
        inner = known < groups
        stop[inner] = self._select(known[inner], self._zeros, True) - known[inner]
        start, stop = np.minimum(start, self.n), np.minimum(stop, self.n)
        want = x & np.uint64((1 << self.low_bits) - 1)
        live = np.flatnonzero(start < stop)
        while len(live):
            mid = (start[live] + stop[live]) >> 1
            below = self._lows(mid) < want[live]
            start[live[below]] = mid[below] + 1
            stop[live[~below]] = mid[~below]
            live = live[start[live] < stop[live]]
        return start


class Trie:
    """Last words, and under each the words before it, with quantised probabilities.

    Level one: hashes of last words with their counts. Monotone pointers lead to each word's range
    in level two. There a predecessor is its rank among the predecessors of this trie, made monotone
    over the whole level by the range it is in; a search looks for the successor of that value
    relative to the parent's range.
    """

    def __init__(self, buffer: memoryview | bytes) -> None:
        (self.n_codes,) = struct.unpack_from("<q", buffer, 0)
        self.last = Sequence(buffer, 8)
        self.pointers = Sequence(buffer, self.last.end)
        self.before = Sequence(buffer, self.pointers.end)
        self.pairs = Sequence(buffer, self.before.end)
        at = self.pairs.end
        self.counts = np.frombuffer(buffer, "<i8", self.last.n, at)
        self.codes = np.frombuffer(buffer, np.uint8, self.n_codes, at + 8 * self.last.n)

    @staticmethod
    def pack(
        last: np.ndarray,
        counts: np.ndarray,
        parents: np.ndarray,
        before: np.ndarray,
        codes: np.ndarray,
        bits: tuple[int, int],
    ) -> bytes:
        """``last`` ascending with counts; pairs ascending by (parent's index, before)."""
        known = np.unique(before)
        rank = np.searchsorted(known, before)
        starts = np.searchsorted(parents, np.arange(len(last) + 1))
        width = max(1, len(known))
        return b"".join(
            [
                struct.pack("<q", len(codes)),
                Sequence.pack(last, 1 << bits[0]),
                Sequence.pack(starts, max(1, len(codes))),
                Sequence.pack(known, 1 << bits[1]),
                Sequence.pack(parents * width + rank, max(1, len(last)) * width),
                counts.astype("<i8").tobytes(),
                codes.astype(np.uint8).tobytes(),
            ]
        )

    def find_last(self, words: np.ndarray) -> np.ndarray:
        """Index in level one, or -1."""
        return _found(self.last, words)

    def find_pairs(self, parents: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Code of each (parent's index, word before), 0 where the trie does not hold it."""
        out = np.zeros(len(parents), np.uint8)
        rank = _found(self.before, before)
        ask = np.flatnonzero((parents >= 0) & (rank >= 0))
        if not len(ask):
            return out
        parent, width = parents[ask], max(1, self.before.n)
        at = self.pairs.successor(parent * width + rank[ask])
        stop = self.pointers.get(parent + 1).astype(np.int64)
        inside = at < stop
        at, ask = at[inside], ask[inside]
        same = self.pairs.get(at).astype(np.int64) - parent[inside] * width == rank[ask]
        out[ask[same]] = self.codes[at[same]]
        return out


def _found(sequence: Sequence, values: np.ndarray) -> np.ndarray:
    at = sequence.successor(values)
    out = np.full(len(values), -1)
    real = np.flatnonzero(at < sequence.n)
    same = sequence.get(at[real]) == values[real].astype(np.uint64)
    out[real[same]] = at[real[same]]
    return out


class mapped:
    """A packed trie in a memory-mapped file that is gone when the block ends."""

    def __init__(self, packed: bytes) -> None:
        self._file = tempfile.TemporaryFile()
        self._file.write(packed)
        self._file.flush()

    def __enter__(self) -> Trie:
        self._map = mmap.mmap(self._file.fileno(), 0, access=mmap.ACCESS_READ)
        return Trie(self._map)

    def __exit__(self, *_: object) -> None:
        # Views into the map end with it when the trie is collected.
        self._file.close()
