"""Elias-Fano sequences and a two-level n-gram trie over flat buffers.

A monotone sequence keeps the low bits of each value packed, and the high bits as a unary
bit vector with a count of zeros for each word.  All parts are plain arrays in one buffer, so that a
trie is opened on bytes, an Arrow value or a memory-mapped file without being copied.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64
ONE = U(1)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits one after the other, and a word to spare."""
    out = np.zeros(len(values) * width // 64 + 2, U)
    if width and len(values):
        at = np.arange(len(values), dtype=np.int64) * width
        word, off = at >> 6, (at & 63).astype(U)
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        out[word[first]] = np.bitwise_or.reduceat(values << off, first)
        over = off.astype(np.int64) + width > 64
        out[word[over] + 1] |= values[over] >> (U(64) - off[over])
    return out


def _unpack(packed: np.ndarray, width: int, index: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(index), U)
    at = index * width
    word, off = at >> 6, (at & 63).astype(U)
    above = np.where(off == 0, U(0), packed[word + 1] << ((U(64) - off) & U(63)))
    return ((packed[word] >> off) | above) & ((ONE << U(width)) - ONE)


@dataclass
class EliasFano:
    length: int
    width: int
    low: np.ndarray
    high: np.ndarray
    zeros: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """``values``: unsigned, sorted, below 2**63."""
        values = values.astype(U)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (max(1, top) // max(1, n)).bit_length() - 1)
        highs = (values >> U(width)).astype(np.int64)
        bits = np.zeros(-(-(n + (top >> width) + 2) // 64) * 64, np.uint8)
        bits[highs + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(U)
        empty = 64 - np.bitwise_count(high).astype(np.int64)
        return cls(n, width, _pack(values & ((ONE << U(width)) - ONE), width), high, np.cumsum(empty) - empty)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero among the high bits."""
        word = np.searchsorted(self.zeros, k, side="right") - 1
        left, bits, at = k - self.zeros[word], ~self.high[word], np.zeros(len(k), U)
        for step in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count((bits >> at) & ((ONE << U(step)) - ONE)).astype(np.int64)
            over = left >= count
            left = left - np.where(over, count, 0)
            at = at + np.where(over, U(step), U(0))
        return word * 64 + at.astype(np.int64)

    def _upto(self, high: np.ndarray) -> np.ndarray:
        """How many values have at most this high part."""
        return self._zero(high) - high

    def find(self, wanted: np.ndarray, start: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Successor search within [start, end): whether each number is there, and where."""
        wanted = wanted.astype(U)
        if not self.length:
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
        last = int(self.zeros[-1] + 64 - int(np.bitwise_count(self.high[-1]))) - 1
        high = np.minimum(wanted >> U(self.width), U(last)).astype(np.int64)
        a = np.where(high > 0, self._upto(np.maximum(high - 1, 0)), 0)
        b = self._upto(high)
        a, b = np.maximum(a, start), np.minimum(b, self.length if end is None else end)
        low, stop = wanted & ((ONE << U(self.width)) - ONE), b
        while (open_ := a < b).any():
            middle = (a + b) >> 1
            less = open_ & (_unpack(self.low, self.width, np.minimum(middle, self.length - 1)) < low)
            a = np.where(less, middle + 1, a)
            b = np.where(open_ & ~less, middle, b)
        inside = a < stop
        at = np.minimum(a, self.length - 1)
        same = inside & (_unpack(self.low, self.width, at) == low) & ((wanted >> U(self.width)).astype(np.int64) == high)
        return same, at

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        """Values at some places, by a search for the unary ones."""
        ones = np.arange(len(self.zeros), dtype=np.int64) * 64 - self.zeros
        word = np.searchsorted(ones, index, side="right") - 1
        left, bits, at = index - ones[word], self.high[word], np.zeros(len(index), U)
        for step in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count((bits >> at) & ((ONE << U(step)) - ONE)).astype(np.int64)
            over = left >= count
            left = left - np.where(over, count, 0)
            at = at + np.where(over, U(step), U(0))
        high = (word * 64 + at.astype(np.int64) - index).astype(U)
        return (high << U(self.width)) | _unpack(self.low, self.width, index)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.length, self.width], np.int64), self.low, self.high, self.zeros]

    @classmethod
    def from_parts(cls, parts: list[np.ndarray]) -> EliasFano:
        (length, width), low, high, zeros = parts[0].view(np.int64), *parts[1:]
        return cls(int(length), int(width), low.view(U), high.view(U), zeros.view(np.int64))


def quantise(values: np.ndarray, bins: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """A byte for each value and the mean value of each byte; bins are equally wide, which bounds the error."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(bins)
    low, high = float(values.min()), float(values.max())
    codes = np.minimum(((values - low) * (bins / (high - low or 1.0))).astype(np.int64), bins - 1)
    counts = np.bincount(codes, minlength=bins)
    return codes.astype(np.uint8), np.bincount(codes, values, minlength=bins) / np.maximum(counts, 1)


#: Hashes keep 63 bits, so that they can be taken as signed and unsigned alike.
KEY_BITS = U((1 << 63) - 1)


@dataclass
class Trie:
    """Words, then the contexts seen before each, with a quantised logarithm at both levels.

    ``children`` holds, for each word in turn, the ranks of its contexts, raised by the word's
    rank times the number of contexts so that the whole level is monotone.  ``pointers`` says
    where each word's part begins.
    """

    words: EliasFano
    contexts: EliasFano
    pointers: EliasFano
    children: EliasFano
    codes: tuple[np.ndarray, np.ndarray]
    books: tuple[np.ndarray, np.ndarray]

    @classmethod
    def build(cls, words: np.ndarray, word_logs: np.ndarray, parent: np.ndarray, context: np.ndarray, logs: np.ndarray) -> Trie:
        """``words`` sorted; ``parent`` (rank of the word) and ``context`` sorted as pairs."""
        contexts, rank = np.unique(context, return_inverse=True)
        pointers = np.concatenate(([0], np.cumsum(np.bincount(parent, minlength=len(words)))))
        children = parent.astype(U) * U(max(1, len(contexts))) + rank.astype(U)
        one, two = quantise(word_logs), quantise(logs)
        sequences = (EliasFano.of(x) for x in (words, contexts, pointers, children))
        return cls(*sequences, (one[0], two[0]), (one[1], two[1]))

    def to_bytes(self) -> bytes:
        parts = [p for s in (self.words, self.contexts, self.pointers, self.children) for p in s.parts()]
        blocks = [np.ascontiguousarray(p).tobytes() for p in (*parts, *self.codes, *self.books)]
        blocks = [b + bytes(-len(b) % 8) for b in blocks]
        sizes = [len(self.codes[0]), len(self.codes[1]), *map(len, blocks)]
        return np.array(sizes, np.int64).tobytes() + b"".join(blocks)

    @classmethod
    def open(cls, buffer) -> Trie:
        """A trie over a buffer, which is looked at and not copied."""
        flat = np.frombuffer(buffer, np.uint8)
        sizes = flat[: 22 * 8].view(np.int64)
        ends = 22 * 8 + np.cumsum(sizes[2:])
        blocks = [flat[e - s : e] for s, e in zip(sizes[2:].tolist(), ends.tolist())]
        sequences = [EliasFano.from_parts(blocks[i : i + 4]) for i in (0, 4, 8, 12)]
        codes = (blocks[16][: int(sizes[0])], blocks[17][: int(sizes[1])])
        return cls(*sequences, codes, (blocks[18].view(np.float64), blocks[19].view(np.float64)))

    def find(self, word: np.ndarray, context: np.ndarray, unknown: float) -> np.ndarray:
        """The logarithm kept for a word after a context, or for the word, or ``unknown``."""
        known, rank = self.words.find(word)
        out = np.full(len(word), unknown)
        out[known] = self.books[0][self.codes[0][rank[known]]]
        seen, place = self.contexts.find(context)
        both = np.flatnonzero(known & seen)
        rank, place = rank[both], place[both]
        target = rank.astype(U) * U(max(1, self.contexts.length)) + place.astype(U)
        there, child = self.children.find(
            target, self.pointers[rank].astype(np.int64), self.pointers[rank + 1].astype(np.int64)
        )
        out[both[there]] = self.books[1][self.codes[1][child[there]]]
        return out
