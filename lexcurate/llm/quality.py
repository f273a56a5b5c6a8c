"""Text statistics per document, and which parts of it are prose.

A hidden Markov model reads the lines of a document: its states are prose, list, table and junk, it sees how many of a
line's words are among the most common of five languages, how the line begins and ends, and its shares of delimiters,
digits and symbols. The number of common words is a binomial count, so long lines speak louder than short ones and
the way a text is broken into lines matters little. The most likely states of all lines are found together, and
shares of characters by state are summed up.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcurate.llm.lines import removed_by_document
from lexcurate.plans.lineage import tabled

STATES = ("prose", "list", "table", "junk")
#: fixed values: common words of English, Spanish, French, German and Portuguese
COMMON = {
    "en": "the of a an to and in that by for was with is on it as be not or this are at from which but had has have were his her he she they what when if who will would may than no under said there their any been its",
    "es": "el la los las de del y en que un una por con se no a al lo su para como fue más o pero sus le ya este esta ha hasta porque cuando muy sin sobre también me entre era desde si según son es",
    "fr": "le la les de des du un une et en que qui à au aux dans par pour sur avec est pas ne se ce il elle son sa ses plus été était avait ont mais ou leur selon cette sont fut que qu l d n s",
    "de": "der die das den dem des und in zu von mit ist nicht ein eine einer einem einen auf für im sich als auch es an werden wird wurde aus bei nach dass er sie war hat habe sei ohne über wie trotz zum zur am oder um",
    "pt": "o a os as de do da dos das e em no na nos nas que um uma por com se não para ao à como mais foi ou mas seu sua pelo pela até sem quando também é era entre depois são num numa esta este",
}
WORDS = frozenset(w for words in COMMON.values() for w in words.split())
MIN_CHARS, MIN_SHARE, FIT_ROUNDS, PRIOR_LINES, STAY = 60, 0.5, 2, 4000, 0.9
MARKED = re.compile(r"\s*(?:[-*•·–—>+]|\(?\[?[0-9]{1,4}[.)\]]|\(?[a-zA-Z][.)]|https?://)\s*\S")
LAST_ENDED = frozenset(".!?…:")
DELIMITERS = re.compile(r"[|;\t/,=:]|\.{4,}|  +")
SIGNS = re.compile(r"[^\w\s]")
DIGITS = re.compile(r"\d")
#: number of values of each categorical feature: begins with a marker, ends a sentence, delimiters, digits, symbols
SIZES = (2, 2, 3, 3, 3)


@dataclass(frozen=True)
class Model:
    """``common``: chance that a word is a common one; ``tables``: chances of each feature's values; ``start``: of a text's first state;
    ``moves``: of each state after each."""

    common: np.ndarray
    tables: tuple[np.ndarray, ...]
    start: np.ndarray
    moves: np.ndarray

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Log chances, lines by states. Empty lines say nothing."""
        words, common = x[:, 0], x[:, 1]
        total = np.outer(common, np.log(self.common)) + np.outer(words - common, np.log1p(-self.common))
        for k, table in enumerate(self.tables):
            total += np.log(table)[:, x[:, 2 + k]].T
        total[x[:, 7] == 0] = 0
        return total


def initial() -> Model:
    """Beliefs before fitting, states in the order of ``STATES``."""
    return Model(
        np.array([0.26, 0.035, 0.02, 0.02]),
        (
            np.array([[0.9, 0.1], [0.3, 0.7], [0.9, 0.1], [0.85, 0.15]]),
            np.array([[0.5, 0.5], [0.8, 0.2], [0.95, 0.05], [0.8, 0.2]]),
            np.array([[0.5, 0.45, 0.05], [0.3, 0.4, 0.3], [0.05, 0.35, 0.6], [0.5, 0.3, 0.2]]),
            np.array([[0.8, 0.17, 0.03], [0.6, 0.25, 0.15], [0.3, 0.3, 0.4], [0.7, 0.15, 0.15]]),
            np.array([[0.65, 0.3, 0.05], [0.4, 0.4, 0.2], [0.35, 0.4, 0.25], [0.5, 0.15, 0.35]]),
        ),
        np.array([0.7, 0.1, 0.1, 0.1]),
        np.full((4, 4), (1 - STAY) / 3) + np.eye(4) * (STAY - (1 - STAY) / 3),
    )


def line_features(line: str) -> tuple[int, ...]:
    """Words, common words, marker, sentence end, delimiter, digit and symbol classes, characters."""
    bare = line.strip()
    if not bare:
        return (0, 0, 0, 0, 0, 0, 0, 0)
    words = bare.lower().replace("’", " ").replace("'", " ").split()
    n, chars = len(words), len(bare)
    delimiters, digits, signs = len(DELIMITERS.findall(bare)), len(DIGITS.findall(bare)), len(SIGNS.findall(bare))
    return (
        n, sum(map(WORDS.__contains__, words)), MARKED.match(line) is not None, bare.rstrip("\"”’)»' ")[-1:] in LAST_ENDED,
        0 if not delimiters else 1 if delimiters < 0.18 * n else 2, 0 if digits < 0.05 * chars else 1 if digits < 0.15 * chars else 2,
        0 if signs < 0.05 * chars else 1 if signs < 0.15 * chars else 2, chars,
    )


def decode(x: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """Most likely state of every line; ``lengths`` are the lines of each document, in order. All documents step together."""
    if not len(x):
        return np.zeros(0, "int64")
    scores = model.emissions(x)
    begin = np.cumsum(lengths) - lengths
    move = np.log(model.moves).T  # to each state from each
    came = np.zeros((len(x), 4), "int8")
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    active = np.searchsorted(-lengths[order], -np.arange(1, lengths.max() + 1), side="right")
    state = np.log(model.start) + scores[begin[order]]
    for t in range(1, int(lengths.max())):
        n = active[t]
        ways = state[:n, :, None] + move
        at = begin[order[:n]] + t
        came[at] = ways.argmax(axis=1)
        state[:n] = ways.max(axis=1) + scores[at]
    states = np.zeros(len(x), "int64")
    last = begin[order] + lengths[order] - 1
    states[last] = state.argmax(axis=1)
    for t in range(int(lengths.max()) - 1, 0, -1):
        at = begin[order[: active[t]]] + t
        states[at - 1] = came[at, states[at]]
    return states


def _lines(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    rows, lengths = [], []
    for text in texts:
        lines = text.split("\n") if text else []
        rows += map(line_features, lines)
        lengths.append(len(lines))
    return np.array(rows, "int64").reshape(-1, 8), np.array(lengths, "int64")


#: sums that a round of fitting needs: words, common words and lines, values of the features, moves and first states, by state
WIDTH = 3 + sum(SIZES) + 4 + 1


def _counts(x: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """States by what was seen in their lines: words, common words, lines, each value of the features, the states that came next, first states."""
    states, filled = decode(x, lengths, model), x[:, 7] > 0
    out = np.zeros((4, WIDTH), "int64")
    begin = (np.cumsum(lengths) - lengths)[lengths > 0]
    later = np.ones(len(x), bool)
    later[begin] = False
    later = np.flatnonzero(later)
    moved = np.bincount(states[later - 1] * 4 + states[later], minlength=16).reshape(4, 4)
    first = np.bincount(states[begin], minlength=4)
    for s in range(4):
        mine = x[filled & (states == s)]
        values = [np.bincount(mine[:, 2 + k], minlength=size) for k, size in enumerate(SIZES)]
        out[s] = [mine[:, 0].sum(), mine[:, 1].sum(), len(mine), *np.concatenate(values), *moved[s], first[s]]
    return out


def _updated(first: Model, counts: np.ndarray, prior_lines: int) -> Model:
    """The model of the counts; ``first`` counts like ``prior_lines`` lines of each state, and like a tenth of them in texts."""
    words = 10 * prior_lines
    common = (counts[:, 1] + first.common * words) / (counts[:, 0] + words)
    ends = 3 + np.cumsum(SIZES)
    tables = [(counts[:, e - size : e] + t * prior_lines) / (counts[:, 2:3] + prior_lines) for t, size, e in zip(first.tables, SIZES, ends)]
    moves = counts[:, -5:-1] + first.moves * prior_lines
    start = counts[:, -1] + first.start * prior_lines / 10
    return Model(common, tuple(tables), start / start.sum(), moves / moves.sum(axis=1, keepdims=True))


def fit(texts: list[str | None], rounds: int = FIT_ROUNDS, prior_lines: int = PRIOR_LINES) -> Model:
    """The model after ``rounds`` of decoding and counting, starting from :func:`initial`, which counts like ``prior_lines`` lines of
    each state."""
    x, lengths = _lines(texts)
    first = model = initial()
    for _ in range(rounds if len(x) else 0):
        model = _updated(first, _counts(x, lengths, model), prior_lines)
    return model


FEATURES = "doc_id string, text_key long, chars long, solid long, signs long, lines long, numbers binary, kinds binary"


def line_table(docs: DataFrame) -> DataFrame:
    """What the model and the statistics need of each text of ``docs(doc_id, text)``, in a table: sums of the text, and of each line three numbers
    (words, common words, characters) and five kinds. Texts are read for it once and needed no more."""

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            x, lengths = _lines(texts)
            ends = np.cumsum(lengths)
            numbers, kinds = x[:, [0, 1, 7]].astype("int32"), x[:, 2:7].astype("int8")
            part = lambda a: [a[e - n : e].tobytes() for e, n in zip(ends, lengths)]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "text_key": batch["text_key"], "chars": [len(t) for t in texts], "solid": [sum(map(len, t.split())) for t in texts],
                "signs": [len(SIGNS.findall(t)) for t in texts], "lines": lengths, "numbers": part(numbers), "kinds": part(kinds),
            })

    return tabled(docs.select(F.col("doc_id").cast("string"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_key"), "text").mapInPandas(features, FEATURES))


def _unpacked(numbers: Iterable[bytes], kinds: Iterable[bytes]) -> np.ndarray:
    n = np.frombuffer(b"".join(numbers), "int32").reshape(-1, 3)
    k = np.frombuffer(b"".join(kinds), "int8").reshape(-1, 5)
    return np.column_stack([n[:, 0], n[:, 1], k, n[:, 2]]).astype("int64").reshape(-1, 8)


def fit_on(table: DataFrame, rounds: int = FIT_ROUNDS, prior_lines: int = PRIOR_LINES) -> Model:
    """:func:`fit` on all rows of :func:`line_table` with a ``doc_id``; each round brings 88 sums to the driver."""
    seen = table.filter("doc_id is not null and lines > 0").select("lines", "numbers", "kinds")
    first = model = initial()
    for _ in range(rounds):

        def count(batches: Iterator[pd.DataFrame], model: Model = model) -> Iterator[pd.DataFrame]:
            for batch in batches:
                total = _counts(_unpacked(batch["numbers"], batch["kinds"]), batch["lines"].to_numpy(), model)
                yield pd.DataFrame({"place": np.arange(total.size), "n": total.ravel()})

        sums = {r["place"]: r["n"] for r in seen.mapInPandas(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()}
        if not sums:
            break
        model = _updated(first, np.array([sums[k] for k in range(4 * WIDTH)], "int64").reshape(4, -1), prior_lines)
    return model


SCHEMA = (
    "doc_id string, chars long, lines long, words long, mean_word_length double, symbol_ratio double, ended_lines double, common_share double, "
    "prose double, list double, table double, junk double, prose_chars long, counted_chars long"
)


def _statistics(rows: pd.DataFrame, model: Model) -> pd.DataFrame:
    """Rows of :data:`SCHEMA` for rows of :func:`line_table` with ``removed``, the numbers of lines that don't count."""
    x, lengths = _unpacked(rows["numbers"], rows["kinds"]), rows["lines"].to_numpy()
    kept = np.ones(len(x), bool)
    for b, gone in zip(np.cumsum(lengths) - lengths, rows["removed"]):
        if gone is not None and len(gone):
            kept[b + np.asarray(gone, "int64") - 1] = False
    # removed lines say nothing about their neighbours either
    seen = x * kept[:, None]
    states = decode(seen, lengths, model)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    n = len(lengths)
    total = lambda values: np.bincount(owner, weights=values, minlength=n)
    chars = np.stack([total(seen[:, 7] * (states == s)) for s in range(4)]) if len(x) else np.zeros((4, n))
    counted = chars.sum(axis=0)
    words, filled = total(x[:, 0]), total((x[:, 7] > 0).astype(float))
    share = lambda a, b: np.divide(a, b, out=np.zeros(n), where=np.asarray(b) > 0)
    size = rows["chars"].to_numpy()
    return pd.DataFrame({
        "doc_id": rows["doc_id"].to_numpy(), "chars": size, "lines": lengths, "words": words.astype("int64"), "mean_word_length": share(rows["solid"].to_numpy(), words),
        "symbol_ratio": share(rows["signs"].to_numpy(), size), "ended_lines": share(total(x[:, 3] * 1.0), filled), "common_share": share(total(x[:, 1] * 1.0), words),
        **{name: share(chars[k], counted) for k, name in enumerate(STATES)}, "prose_chars": chars[0].astype("int64"), "counted_chars": counted.astype("int64"),
    })


def text_statistics(docs: DataFrame, model: Model | None = None, without_repeated: bool = True) -> DataFrame:
    """One row per row of ``docs(doc_id, text, url)``: text statistics and the shares of characters by line label.

    ``words`` are runs without white space or apostrophes; ratios are 0 where there is nothing to count. With
    ``without_repeated`` lines that the site repeats (see :mod:`lexcurate.llm.lines`) have no label and no part in the
    shares. Null texts count like empty ones. ``model`` is fitted on all of ``docs`` if none is given.
    """
    table = line_table(docs)
    model = model or fit_on(table)
    rows = table.withColumn("removed", F.lit(None).cast("array<bigint>"))
    if without_repeated:
        removed = removed_by_document(docs.select("doc_id", "text", "url")).select(F.col("doc_id").cast("string").alias("__id"), F.col("text_key").alias("__key"), "removed")
        rows = table.join(removed, (F.col("doc_id") == F.col("__id")) & (F.col("text_key") == F.col("__key")), "left").select(*table.columns, "removed")

    def stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _statistics(batch, model)

    kind = docs.schema["doc_id"].dataType  # as text in Python, where whole numbers with nulls would become fractions
    return rows.mapInPandas(stats, SCHEMA).withColumn("doc_id", F.col("doc_id").cast(kind))


def not_prose(statistics: DataFrame, min_chars: int = MIN_CHARS, min_share: float = MIN_SHARE) -> DataFrame:
    """Rows of :func:`text_statistics` of at least ``min_chars`` characters of which more than ``min_share`` are no prose;
    a document of which no line counts isn't among them."""
    return statistics.filter((F.col("chars") >= min_chars) & (F.col("counted_chars") > 0) & (F.col("counted_chars") - F.col("prose_chars") > min_share * F.col("counted_chars")))
