"""A compressed full-text index over words, searched backwards for many texts at once.

The index is a compressed suffix array: of every suffix, in sorted order, it keeps the row of the suffix one word later.
Together with the suffix's first word these rows form one increasing sequence, which is stored in Elias-Fano form (16 bits
a word for the low parts, about a bit or two for the high ones). A backward step is a count in that sequence, and following it
from a text's first row reads the text again, so the texts themselves are not kept. Two more bytes a word name the text of each suffix.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

LOW_BITS = 16


class Increasing:
    """An increasing sequence of whole numbers in Elias-Fano form."""

    def __init__(self, values: np.ndarray) -> None:
        high = (values >> LOW_BITS).astype("int64")
        self.size, self.buckets = len(values), int(high[-1]) + 1 if len(values) else 0
        self.low = (values & ((1 << LOW_BITS) - 1)).astype("uint16")
        # a one for each value, a zero at the end of each bucket of equal high parts
        bits = np.zeros(-(-(self.size + self.buckets) // 64) * 64, "uint8")
        bits[high + np.arange(self.size)] = 1
        self.bits = np.packbits(bits, bitorder="little").view("<u8")
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype="int64")]).astype("uint32")

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Places of the ``k``-th ones or zeros."""
        before = self.ones[:-1] if one else np.arange(len(self.bits), dtype="int64") * 64 - self.ones[:-1]
        at = np.searchsorted(before, k, side="right") - 1
        rest, word = k - before[at].astype("int64"), self.bits[at] if one else ~self.bits[at]
        place = at * 64
        for width in (32, 16, 8, 4, 2, 1):
            here = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype("int64")
            on = rest >= here
            rest = rest - here * on
            word = np.where(on, word >> np.uint64(width), word)
            place += on * width
        return place

    def __getitem__(self, k: np.ndarray) -> np.ndarray:
        return ((self._select(k, True) - k) << LOW_BITS) | self.low[k].astype("int64")

    def below(self, x: np.ndarray) -> np.ndarray:
        """How many values are less than each ``x``."""
        bucket, rest = x >> LOW_BITS, (x & ((1 << LOW_BITS) - 1)).astype("uint16")
        inside = np.flatnonzero(bucket < self.buckets)
        out = np.full(len(x), self.size, "int64")
        b, r = bucket[inside], rest[inside]
        stop = self._select(b, False) - b
        start = np.zeros(len(b), "int64")
        later = b > 0
        start[later] = self._select(b[later] - 1, False) - (b[later] - 1)
        open_ = np.flatnonzero(start < stop)
        while len(open_):
            middle = (start[open_] + stop[open_]) >> 1
            less = self.low[middle] < r[open_]
            start[open_] = np.where(less, middle + 1, start[open_])
            stop[open_] = np.where(less, stop[open_], middle)
            open_ = open_[start[open_] < stop[open_]]
        out[inside] = start
        return out


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the compared length; suffixes that are told apart are not compared again."""
    n, step = len(symbols), 1
    order = np.argsort(symbols, kind="stable")
    first = np.ones(n, bool)
    first[1:] = symbols[order[1:]] != symbols[order[:-1]]
    rank = np.empty(n, "int64")
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    while True:
        places = np.flatnonzero(~(first & np.append(first[1:], True)))
        if not len(places):
            return order
        suffix = order[places]
        then = np.where(suffix + step < n, rank[np.minimum(suffix + step, n - 1)] + 1, 0)
        by = np.lexsort((then, rank[suffix]))
        suffix, then = suffix[by], then[by]
        group = rank[suffix]
        fresh = np.ones(len(by), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (then[1:] != then[:-1])
        order[places], first[places] = suffix, fresh
        rank[suffix] = places[np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))]
        step *= 2


class TextIndex:
    """Full-text index of texts given as lists of words; texts are numbered by length, the shortest first."""

    def __init__(self, texts: Sequence[Sequence[str]], keys: Sequence[str] | None = None) -> None:
        by_length = sorted(range(len(texts)), key=lambda k: len(texts[k]))
        self.keys = [keys[k] if keys is not None else str(k) for k in by_length]
        ids: dict[str, int] = {}
        coded = [[ids.setdefault(w, len(ids)) for w in texts[k]] for k in by_length]
        self.vocabulary, self._ids = " ".join(ids), ids
        self.lengths = np.array([len(t) for t in coded], "int64")
        sizes = self.lengths + 1
        begin = np.cumsum(sizes) - sizes
        # each text ends in a symbol of its own, so no match runs over its end
        symbols = np.fromiter((s for k, t in enumerate(coded) for s in (*t, len(ids) + k)), "int64", int(sizes.sum()))
        order = suffix_array(symbols)
        self.rows = len(order)
        row = np.empty(self.rows, "int64")
        row[order] = np.arange(self.rows)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=len(ids) + len(coded)))]).astype("uint32")
        self.next = Increasing(symbols[order] * self.rows + row[(order + 1) % max(self.rows, 1)])
        self.text = np.repeat(np.arange(len(coded)), sizes)[order].astype("uint16" if len(coded) <= 1 << 16 else "uint32")
        self.heads = row[begin].astype("uint32")

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_ids"}

    @property
    def ids(self) -> dict[str, int]:
        if "_ids" not in self.__dict__:
            self._ids = {w: k for k, w in enumerate(self.vocabulary.split(" "))} if self.vocabulary else {}
        return self._ids

    def nbytes(self) -> int:
        """Bytes of the arrays."""
        return sum(a.nbytes for a in (self.lengths, self.starts, self.text, self.heads, self.next.low, self.next.bits, self.next.ones))

    def back(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes that begin with ``symbol`` followed by what the rows ``low`` to ``high`` begin with."""
        return self.next.below(symbol * self.rows + low), self.next.below(symbol * self.rows + high)

    def pairs_of_words(self, codes: np.ndarray, local: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word the rows that begin with the word before and the word itself; none at a text's first word or for words
        that the index lacks. Two backward steps, taken once for each different pair."""
        low, high = np.zeros(len(codes), "int64"), np.zeros(len(codes), "int64")
        where = np.flatnonzero((local > 0) & (codes >= 0))
        where = where[codes[where - 1] >= 0]
        if len(where):
            base = len(self.starts)
            pairs, which = np.unique(codes[where - 1] * base + codes[where], return_inverse=True)
            before, word = pairs // base, pairs % base
            a, b = self.back(before, self.starts[word].astype("int64"), self.starts[word + 1].astype("int64"))
            low[where], high[where] = a[which], b[which]
        return low, high

    def read(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes of ``texts`` in reading order, one text after the other, and their words."""
        sizes = self.lengths[texts]
        begin = np.cumsum(sizes) - sizes
        rows, words = np.zeros(int(sizes.sum()), "int64"), np.zeros(int(sizes.sum()), "int64")
        order = np.argsort(-sizes, kind="stable")
        row, at, left = self.heads[texts[order]].astype("int64"), begin[order], np.sort(sizes)
        for step in range(int(sizes.max()) if len(sizes) else 0):
            n = len(left) - int(np.searchsorted(left, step, side="right"))
            value = self.next[row[:n]]
            rows[at[:n] + step], words[at[:n] + step] = row[:n], value // self.rows
            row[:n] = value % self.rows
        return rows, words
