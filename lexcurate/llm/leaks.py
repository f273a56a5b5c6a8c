"""Passages of held-out items inside a corpus, word for word or with other numbers, names and units.

Words become symbols: numbers, names and units a placeholder of their type, other words themselves. Every run of 20 symbols of
the items is hashed into a table of windows, and those of the corpus are hash-joined with it. A window that matches is then read slot
by slot: if all slots agree the passage is the same, if they differ by one consistent replacement it was re-parameterised.

Which words are names is decided by the items alone for every word that occurs in them, whatever its case in
the corpus, so a passage that is repeated word for word always matches as a template too. Words that no item
has are names if they are capitalised.

However many items there are, the corpus is read once. Only bit tables travel to it (which words the items have, which windows): of 32 bits an
entry up to ``MOST_BITS``. A larger set fills its table more, which lets more windows through to the join and changes no result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcurate.plans.lineage import tabled

WINDOW, MIN_LITERALS = 20, 10
WORD = re.compile(r"[^\W_]+")
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
UNITS = frozenset(
    # fixed values: words for units, singular and plural, in five languages
    "second seconds minute minutes hour hours day days week weeks month months year years metre metres meter meters mile miles acre acres "
    "tonne tonnes ton tons pound pounds dollar dollars euro euros percent heure heures jour jours semaine semaines mois année années "
    "stunde stunden tag tage tagen woche wochen monat monate monaten jahr jahre jahren hora horas día días semana semanas mes meses año años "
    "dia dias mês ano anos".split()
)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BITS_EACH, PROBES, LEAST_BITS, MOST_BITS, PIECE = 32, 8, 1 << 16, 1 << 30, 1 << 11


def hashed(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


def window_hashes(values: np.ndarray, window: int) -> np.ndarray:
    """Hash of every run of ``window`` values, modulo 2**64."""
    n = len(values) - window + 1
    if n <= 0:
        return np.zeros(0, "uint64")
    total = np.zeros(n, "uint64")
    with np.errstate(over="ignore"):
        for k in range(window):
            total = total * BASE + values[k : k + n]
    return total


class Bits:
    """A table of bits in which every hash that was put in is found; others hardly ever."""

    def __init__(self, size: int, data: np.ndarray | None = None) -> None:
        self.size = size
        self.data = np.zeros(size >> 3, "uint8") if data is None else data

    @staticmethod
    def fitting(entries: int) -> int:
        """Bits for so many entries, a power of two within the bounds."""
        return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * max(entries, 1) - 1).bit_length()))

    def _places(self, hashes: np.ndarray, k: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) * np.uint64(2 * k + 1)
        return ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(self.size - 1)).astype("int64")

    def add(self, hashes: np.ndarray) -> None:
        for k in range(PROBES):
            at = self._places(hashes, k)
            np.bitwise_or.at(self.data, at >> 3, (1 << (at & 7)).astype("uint8"))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Places in ``hashes`` of those that are found."""
        left = np.arange(len(hashes))
        for k in range(PROBES):
            at = self._places(hashes[left], k)
            left = left[self.data[at >> 3] >> (at & 7).astype("uint8") & 1 > 0]
        return left


def _bit_table(hashes: DataFrame, entries: int) -> Bits:
    """The table of ``hashes(h)``. Tasks fill tables of their own; pieces of them that hold anything are joined and gathered, at most
    ``MOST_BITS`` in all."""
    size = Bits.fitting(entries)

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Bits(size)
        for batch in batches:
            table.add(batch["h"].to_numpy().view("uint64"))
        parts = table.data.reshape(-1, PIECE)
        for start in range(0, len(parts), 1024):
            some = np.flatnonzero(parts[start : start + 1024].any(axis=1)) + start
            yield pd.DataFrame({"piece": some, "bits": [parts[k].tobytes() for k in some]})

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.bitwise_or.reduce([np.frombuffer(b, "uint8") for b in rows["bits"]])
        return pd.DataFrame({"piece": [rows["piece"].iloc[0]], "bits": [bits.tobytes()]})

    table = Bits(size)
    for row in hashes.select("h").mapInPandas(pieces, "piece long, bits binary").groupBy("piece").applyInPandas(joined, "piece long, bits binary").toLocalIterator():
        table.data[row["piece"] * PIECE : (row["piece"] + 1) * PIECE] = np.frombuffer(row["bits"], "uint8")
    return table


class Lexicon:
    """Literal words and names of the items."""

    def __init__(self, literals: Bits, names: Bits) -> None:
        self.literals, self.names = literals, names

    def symbols(self, words: list[str]) -> list[str]:
        low = [w.lower() for w in words]
        h = np.array([hashed(w) for w in low], "uint64")
        # a word that is capitalised only where a sentence starts is literal; one that never occurs in lower case is a name
        literal, name = set(self.literals.has(h).tolist()), set(self.names.has(h).tolist())
        return [
            NUMBER if any(map(str.isdigit, w)) else UNIT if w in UNITS else w if k in literal else NAME if k in name or words[k][0].isupper() else w
            for k, w in enumerate(low)
        ]


class Codes(dict):
    """A small number for each spelling, with the hash of its symbol, its lower case and the sign of its type."""

    def __init__(self, lexicon: Lexicon, most: int = 1_000_000) -> None:
        super().__init__()
        self.lexicon, self.most = lexicon, most
        self.symbols: list[int] = []
        self.words: list[str] = []
        self.kinds: list[str] = []

    def learn(self, texts: list[list[str]]) -> None:
        new = list(set(chain.from_iterable(texts)).difference(self))
        for word, symbol in zip(new, self.lexicon.symbols(new)):
            self[word] = len(self.symbols)
            self.symbols.append(hashed(symbol))
            self.words.append(word.lower())
            self.kinds.append({NUMBER: "#", NAME: "N", UNIT: "U"}.get(symbol, "."))

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()
            for known in (self.symbols, self.words, self.kinds):
                known.clear()

    def windows(self, texts: list[str], window: int) -> tuple[np.ndarray, ...]:
        """Codes of all words; of every window its hash, text, start in the text and place among all words."""
        self.trim()
        worded = [WORD.findall(t) for t in texts]
        self.learn(worded)
        lengths = np.array([len(words) for words in worded], "int64")
        flat = np.fromiter(map(self.__getitem__, chain.from_iterable(worded)), "int64", int(lengths.sum()))
        h = window_hashes(np.array(self.symbols, "uint64")[flat] if len(flat) else np.zeros(0, "uint64"), window)
        owner = np.repeat(np.arange(len(texts)), lengths)[: len(h)]
        start = np.arange(len(h)) - (np.cumsum(lengths) - lengths)[owner]
        whole = np.flatnonzero(start + window <= lengths[owner])
        return flat, h[whole], owner[whole], start[whole], whole


def _lexicon(items: DataFrame) -> Lexicon:
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, bool]] = set()
        for batch in batches:
            seen = {(hashed(w.lower()), w[0].isupper()) for text in batch["text"] for w in WORD.findall(text)}
            yield pd.DataFrame({"h": np.array([h for h, _ in seen], "uint64").view("int64"), "capital": np.array([c for _, c in seen], bool)})

    found = tabled(items.select("text").mapInPandas(words, "h long, capital boolean").distinct())
    counts = {r["capital"]: r["n"] for r in found.groupBy("capital").agg(F.count("*").alias("n")).collect()}
    return Lexicon(*(_bit_table(found.filter(F.col("capital") == capital), counts.get(capital, 0)) for capital in (False, True)))


WINDOWS = "h long, words string, kinds string"


def _item_windows(items: DataFrame, lexicon, window: int) -> DataFrame:
    """``item_id, h, words, kinds`` of every window of the items, each once; ``kinds`` has a sign for the type of each symbol."""

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = Codes(lexicon.value)
        for batch in batches:
            flat, h, owner, _, places = codes.windows(list(batch["text"]), window)
            ids = batch["item_id"].to_numpy()
            shown = lambda of, join: [join.join([of[c] for c in flat[p : p + window]]) for p in places]
            yield pd.DataFrame({"item_id": ids[owner], "h": h.view("int64"), "words": shown(codes.words, " "), "kinds": shown(codes.kinds, "")})

    return tabled(items.mapInPandas(windows, f"item_id long, {WINDOWS}").distinct())


def template_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, start, words, item_id, kinds, theirs`` for each window of a document that matches one of an item as a template.

    Windows of the corpus that the bit table lets through are joined by hash with the table of the items' windows; adaptive execution
    splits the join at windows that many documents have.
    """
    spark = docs.sparkSession
    usable = items.filter("item_id is not null and text is not null").select("item_id", "text").distinct()
    lexicon = spark.sparkContext.broadcast(_lexicon(usable))
    theirs = _item_windows(usable, lexicon, window)
    table = spark.sparkContext.broadcast(_bit_table(theirs, theirs.count()))

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = Codes(lexicon.value)
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            flat, h, owner, start, places = codes.windows(list(batch["text"]), window)
            hits = table.value.has(h)
            words = [" ".join([codes.words[c] for c in flat[p : p + window]]) for p in places[hits]]
            yield pd.DataFrame({"doc_id": ids[owner[hits]], "start": start[hits], "h": h[hits].view("int64"), "words": words})

    texts = docs.filter("doc_id is not null and text is not null").select("doc_id", "text")
    ours = texts.mapInPandas(found, "doc_id long, start long, h long, words string")
    return ours.join(theirs.select(F.col("h").alias("__h"), "item_id", "kinds", F.col("words").alias("theirs")), F.col("h") == F.col("__h")).drop("h", "__h")


def leaked_items(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, item_id`` where at least ``window`` consecutive words of the item stand consecutively in the document.

    Words are runs of letters or digits, compared in lower case. Null and empty texts and items of fewer words have
    no pairs; repeated rows give a pair once. These are the template matches of which all slots agree.
    """
    return template_matches(docs, items, window).filter(F.col("words") == F.col("theirs")).select("doc_id", "item_id").distinct()


def reparameterised_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, min_literals: int = MIN_LITERALS) -> DataFrame:
    """``doc_id, item_id, windows`` where windows of the item stand in the document with other numbers, names or units.

    Only windows with at least ``min_literals`` words that are no slots, whose slots differ, and differ by one consistent replacement: within
    a type each word stands for one other word and back. Same rules for nulls and repeated rows as :func:`leaked_items`; ``windows``
    counts the places in the document. Each word is a symbol of its own, so a number or name must be replaced by one of as many words.
    """
    slots = F.filter(F.arrays_zip(F.split("kinds", "").alias("kind"), F.split("words", " ").alias("ours"), F.split("theirs", " ").alias("item")), lambda s: s["kind"] != ".")
    number = lambda *names: F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(*(s[n].alias(n) for n in names)))))
    matches = template_matches(docs, items, window).filter(F.col("words") != F.col("theirs"))
    literal = lambda column: F.array_join(F.transform(F.arrays_zip(F.split("kinds", "").alias("kind"), F.split(column, " ").alias("w")), lambda s: F.when(s["kind"] == ".", s["w"]).otherwise("")), " ")
    fitting = matches.filter((F.length(F.translate("kinds", "#NU", "")) >= min_literals) & (literal("words") == literal("theirs"))).withColumn("slots", slots)
    one = (number("kind", "ours") == number("kind", "ours", "item")) & (number("kind", "item") == number("kind", "ours", "item"))
    return fitting.filter(one).groupBy("doc_id", "item_id").agg(F.countDistinct("start").alias("windows"))
