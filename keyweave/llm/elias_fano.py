"""Elias-Fano sequences and an n-gram trie of them, in numpy, over memory-mapped arrays."""

from __future__ import annotations

import tempfile

import numpy as np

ONE = np.uint64(1)
#: Place of the n-th (from 0) set bit of each byte.
NTH = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.uint8)


def mapped(arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The arrays as read-only maps of a temporary file that goes with its last map."""
    with tempfile.TemporaryFile() as f:
        at = {}
        for name, a in arrays.items():
            f.write(bytes(-f.tell() % 8))
            at[name] = f.tell()
            f.write(np.ascontiguousarray(a).data if a.size else b"")
        f.write(bytes(8))
        f.flush()
        return {name: np.memmap(f, a.dtype, "r", at[name], a.shape) if a.size else a
                for name, a in arrays.items()}


def _set_bits(n: int, at: np.ndarray) -> np.ndarray:
    """Bytes with the given bits set (positions increase)."""
    bits = np.zeros((n // 64 + 1) * 64, np.uint8)
    bits[at] = 1
    return np.packbits(bits, bitorder="little")


class EliasFano:
    """A non-decreasing sequence of n values: low bits packed, high parts in unary.

    ``parts`` are the arrays it consists of; give the same arrays back, memory-mapped, to read.
    """

    def __init__(self, n: int, low_bits: int, parts: dict[str, np.ndarray]):
        self.n, self.low_bits, self.parts = n, low_bits, parts

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = values & np.uint64((1 << bits) - 1)
        words = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits:
            at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(words, word, low << shift)
            over = shift + np.uint64(bits) > np.uint64(64)
            np.bitwise_or.at(words, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        high = (values >> np.uint64(bits)).astype(np.int64)
        unary = _set_bits(n + (int(high[-1]) if n else 0) + 1, high + np.arange(n))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(unary), dtype=np.int64)])[:-1]
        return cls(n, bits, {"low": words, "unary": unary,  # ones before each byte
                             "ones": ones.astype(np.int32 if n < 2**31 else np.int64)})

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        out = self.parts["low"][word] >> shift
        rest = np.where(shift > 0, self.parts["low"][word + 1] << ((np.uint64(64) - shift)
                                                                 & np.uint64(63)), np.uint64(0))
        return (out | rest) & np.uint64((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at the indices."""
        ones = self.parts["ones"]
        byte = np.searchsorted(ones, i.astype(ones.dtype), side="right") - 1
        at = NTH[self.parts["unary"][byte], i - ones[byte]]
        high = (byte * 8 + at - i).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(i)

    def _below(self, high: np.ndarray, zeros: np.ndarray) -> np.ndarray:
        """How many values have a high part below ``high``; ``zeros`` before each byte."""
        k = high.astype(zeros.dtype) - 1  # the zero that ends the high part before
        up = np.maximum(k, 0)
        byte = np.searchsorted(zeros, up, side="right") - 1
        at = NTH[~self.parts["unary"][byte], up - zeros[byte]]
        return np.where(k < 0, 0, np.minimum(byte * 8 + at - k, self.n))

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value >= x (n if there is none)."""
        x = x.astype(np.uint64)
        high = x >> np.uint64(self.low_bits)
        last = (int(self.parts["ones"][-1] >= 0) and len(self.parts["unary"]) * 8 - self.n) - 1
        beyond = high >= np.uint64(max(last, 0))
        high = np.minimum(high, np.uint64(max(last - 1, 0)))
        ones = self.parts["ones"]
        zeros = np.arange(len(ones), dtype=np.int64) * 8 - ones
        lo, hi = self._below(high, zeros), self._below(high + ONE, zeros)
        low = x & np.uint64((1 << self.low_bits) - 1)
        while len(open_ := np.flatnonzero(lo < hi)):
            mid = (lo[open_] + hi[open_]) // 2
            less = self._low(mid) < low[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        return np.where(beyond, self.n, lo)


class Quantised:
    """Values as 16-bit codes of equal steps between the least and the greatest."""

    def __init__(self, values: np.ndarray):
        self.least = float(values.min()) if len(values) else 0.0
        self.step = (float(values.max()) - self.least) / 65535 if len(values) else 0.0
        codes = (values - self.least) / self.step if self.step else np.zeros(len(values))
        self.codes = np.rint(codes).astype(np.uint16)

    def at(self, i: np.ndarray) -> np.ndarray:
        return self.least + self.step * self.codes[i]


class Trie:
    """An n-gram trie. Nodes of a level are in order of their context node and word.

    A level keeps its words as one increasing Elias-Fano sequence: a node's children count on
    from the last child of the node before (its base), and where each node's children begin is
    an Elias-Fano sequence of pointers. A child is found by a successor search from the base of
    its context. Nodes have a quantised probability and, as contexts, a back-off (log10).
    """

    def __init__(self) -> None:
        self.levels: list[tuple[EliasFano, EliasFano]] = []  # of level 2 and up: words, pointers
        self.prob: list[Quantised] = []
        self.back: list[Quantised] = []

    def add_words(self, prob: np.ndarray, back: np.ndarray) -> None:
        """Level 1: word ids are the nodes."""
        self._weights(prob, back)

    def add_level(self, context: np.ndarray, word: np.ndarray, n_contexts: int,
                  prob: np.ndarray, back: np.ndarray) -> None:
        """Nodes (context node, word), in that order."""
        n = len(word)
        new = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if n else \
            np.empty(0, np.int64)
        last = np.append(new[1:], n) - 1 if n else new
        bases = np.concatenate([[0], np.cumsum(word[last] + 1)])[:-1]
        values = np.repeat(bases, last - new + 1) + word + 1
        starts = np.concatenate([[0], np.cumsum(np.bincount(context, minlength=n_contexts))])
        words, pointers = EliasFano.of(values), EliasFano.of(starts)
        for ef in (words, pointers):
            ef.parts = mapped(ef.parts)
        self.levels.append((words, pointers))
        self._weights(prob, back)

    def _weights(self, prob: np.ndarray, back: np.ndarray) -> None:
        for values, into in ((prob, self.prob), (back, self.back)):
            q = Quantised(values)
            q.codes = mapped({"codes": q.codes})["codes"]
            into.append(q)

    def child(self, level: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Nodes of ``level`` (from 2) for the words after the context nodes; -1 if absent."""
        words, pointers = self.levels[level - 2]
        out = np.full(len(word), -1, np.int64)
        ok = np.flatnonzero(context >= 0)
        if not words.n or not len(ok):
            return out
        # children and base once for equal contexts side by side
        own = context[ok]
        new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        lo = pointers.access(own[new]).astype(np.int64)
        hi = pointers.access(own[new] + 1).astype(np.int64)
        base = np.where(lo > 0, words.access(np.maximum(lo - 1, 0)), np.uint64(0))
        lo, hi, base = (np.repeat(v, np.diff(np.append(new, len(own)))) for v in (lo, hi, base))
        some = lo < hi
        ok, lo, hi, base = ok[some], lo[some], hi[some], base[some]
        target = base + word[ok].astype(np.uint64) + ONE
        at = words.successor(target)
        found = (at >= lo) & (at < hi)
        found[found] = words.access(at[found]) == target[found]
        out[ok[found]] = at[found]
        return out
        lo = pointers.access(context[ok]).astype(np.int64)
        hi = pointers.access(context[ok] + 1).astype(np.int64)
        ok, lo, hi = ok[lo < hi], lo[lo < hi], hi[lo < hi]
        base = np.where(lo > 0, words.access(np.maximum(lo - 1, 0)), np.uint64(0))
        target = base + word[ok].astype(np.uint64) + ONE
        at = words.successor(target)
        found = (at >= lo) & (at < hi)
        found[found] = words.access(at[found]) == target[found]
        out[ok[found]] = at[found]
        return out
