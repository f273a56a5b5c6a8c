"""Exact byte-pair token counts in linear time.

Every prefix of a text has exactly one last token in its encoding. An automaton over the vocabulary reports all
tokens that end at a position; the one that is compatible with the last token of the prefix before it is the
last token of the prefix that ends there, and the count is one more. Two neighbouring tokens are compatible if undoing
their merges, latest first, never meets a pair at the border that an earlier merge would have joined.
Token ids are never listed.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed values: how this family of tokenizers cuts a text into pieces before merging
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: the same with the standard library's classes, for texts without the characters on which they differ
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
CACHE, CACHED_LENGTH = 1_000_000, 48


class Counter(dict):
    """Token counts of pieces; a bounded memory of short ones."""

    def __init__(self, vocabulary: bytes, unit: str = "piece") -> None:
        import ahocorasick
        import regex

        super().__init__()
        entries = (line.split() for line in vocabulary.splitlines() if line.strip())
        self.rank = {base64.b64decode(token): int(rank) for token, rank in entries}
        self.tokens = sorted(self.rank, key=self.rank.__getitem__)
        if [self.rank[t] for t in self.tokens] != list(range(len(self.tokens))) or any(len(t) != 1 for t in self.tokens[:256]):
            raise ValueError("ranks must be 0, 1, ... with the single bytes first")
        self.halves = [self._halves(t) for t in self.tokens]
        self.joined = {pair: k for k, pair in enumerate(self.halves) if k >= 256}
        self.fits: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for k, token in enumerate(self.tokens):
            self.automaton.add_word(token.decode("latin-1"), (k, len(token)))
        self.automaton.make_automaton()
        self.pieces, self.plain = regex.compile(PIECES), re.compile(PLAIN)
        odd = "".join(chr(c) for c in range(0x3400) if (chr(c).isalnum() and not chr(c).isalpha() and not chr(c).isdecimal()) or 0x1C <= c <= 0x1F or (chr(c).isspace() != bool(regex.match(r"\s", chr(c)))))
        #: characters beyond the blocks of common alphabets, or on which the two classes differ
        self.odd = re.compile("[" + re.escape(odd) + "˿-ͯ҃-҉֐-\U0010ffff]")
        self.fine = re.compile("[‐-‧‰-⁞₠-⃀™←-◿]")

    def _halves(self, token: bytes) -> tuple[int, int]:
        """The two tokens whose merge makes this one; itself twice for a single byte."""
        if len(token) == 1:
            return (self.rank[token],) * 2
        limit, parts = self.rank[token], [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            ranks = [self.rank.get(a + b, limit) for a, b in zip(parts, parts[1:])]
            least = min(ranks)
            if least >= limit:
                raise ValueError(f"no merges lead to token {limit}")
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return self.rank[parts[0]], self.rank[parts[1]]

    def compatible(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= CACHE:
                self.fits.clear()
            known = self.fits[left, right] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        before = len(self.tokens)  # merges from this rank on are undone already
        while True:
            if self.joined.get((left, right), before) < before:
                return False
            # undo the later merge of the two; on a tie the right one, as the left one was made first
            if left > right and left >= 256:
                before, left = left, self.halves[left][1]
            elif right >= 256:
                before, right = right + 1, self.halves[right][0]
            elif left >= 256:
                before, left = left, self.halves[left][1]
            else:
                return True

    def encoded(self, piece: str) -> int:
        """Number of tokens of one piece."""
        data = piece.encode("utf-8")
        last, count = [-1] * (len(data) + 1), [0] * (len(data) + 1)
        for end, (token, length) in self.automaton.iter(data.decode("latin-1")):
            stop = end + 1
            if last[stop] < 0:
                start = stop - length
                if start == 0 or (last[start] >= 0 and self.compatible(last[start], token)):
                    last[stop], count[stop] = token, count[start] + 1
        return count[-1]

    def __missing__(self, piece: str) -> int:
        n = self.encoded(piece)
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        """Number of tokens of a whole text."""
        odd = self.odd.search(self.fine.sub("", text))
        return sum(map(self.__getitem__, (self.pieces if odd else self.plain).findall(text)))


@lru_cache(maxsize=4)
def _counter(vocabulary: bytes) -> Counter:
    return Counter(vocabulary)


def token_count(spark: SparkSession, text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of ``text`` under the byte-level BPE vocabulary in the file ``vocabulary`` (one base64 token
    and its rank a line); 0 for empty texts, null for null. The file is read by the driver and shipped once."""
    shipped = spark.sparkContext.broadcast(Path(vocabulary).read_bytes())

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(shipped.value)
        for texts in batches:
            yield pd.Series([None if t is None else counter.count(t) for t in texts], dtype="Int64")

    return counted(text)
