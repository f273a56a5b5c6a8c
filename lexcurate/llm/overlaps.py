"""Same or nearly same records on the two sides of a split.

The evaluation side is kept in compressed full-text indexes (:mod:`lexcurate.llm.fulltext`), one per shard of texts of neighbouring
lengths, each built once. Training texts are streamed through them where they lie; only the indexes travel.

Two texts of n and m words belong together if at least ``share`` of the longer one's words stand in the same order in the other. At most
n - c and m - c words are then without a partner, c being that share in words, and every pair of neighbouring words of the training text
stands in the other one too, unless a word of it has no partner or the other text has words between: ``shared_pairs`` are left in
any case. So of its n - 1 pairs of words any ``n - 1 - shared_pairs + s`` hold at least s that the other text has, and backward search takes
the rarest ones. Texts found s times are read from the index, their maximal matches with the training text (of two words and more) are
merged to spans, and the spans must hold ``shared_pairs`` pairs. The longest common subsequence then proves each pair. None is lost.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcurate.functions.urls import site
from lexcurate.llm.fulltext import TextIndex
from lexcurate.plans.lineage import tabled

SHARE, MIN_WORDS, SEEDS = 0.85, 20, 8
SHARD_WORDS, BLOCK_BYTES = 1_000_000, 256 << 20
#: words of training texts and places of the index looked at together in a worker
CHUNK_WORDS, CHUNK_PLACES = 400_000, 4_000_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def shared_pairs(n: np.ndarray | int, m: np.ndarray | int, share: float = SHARE) -> np.ndarray:
    """Pairs of neighbouring words that texts of n and m words have in common at least if they belong together."""
    c = np.ceil(share * np.maximum(n, m) - 1e-9).astype("int64")
    return (n - 1) - 2 * (n - c) - (m - c)


@lru_cache(maxsize=100_000)
def _least_shared(n: int, share: float) -> int:
    """:func:`shared_pairs` with the partner's length that allows the fewest."""
    m = np.arange(max(1, math.ceil(share * n - 1e-9)), math.floor(n / share + 1e-9) + 1)
    least = int(shared_pairs(n, m, share).min())
    if least < 1:
        raise ValueError(f"texts of {n} words may belong together without two neighbouring words in common; raise share or min_words")
    return least


def common_words(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, with one bit per word of ``b``."""
    masks: dict[int, int] = {}
    for i, w in enumerate(b):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for w in a:
        m = row & masks.get(w, 0)
        row = (row + m | row - m) & full
    return len(b) - row.bit_count()


def _expanded(low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers ``low`` to ``low + size`` of each range, and which range each is of."""
    which = np.repeat(np.arange(len(low)), size)
    return low[which] + np.arange(len(which)) - (np.cumsum(size) - size)[which], which


def candidates(index: TextIndex, owner: np.ndarray, local: np.ndarray, lengths: np.ndarray, low: np.ndarray, high: np.ndarray, share: float, seeds: int) -> tuple[np.ndarray, np.ndarray]:
    """Training and indexed texts of fitting lengths that have enough of the training text's rarest pairs of words in common."""
    least = np.array([_least_shared(int(n), share) for n in lengths], "int64")
    enough = np.minimum(least, seeds)
    often = np.where(local > 0, high - low, -1)
    order = np.lexsort((often, owner))
    place = np.empty(len(order), "int64")
    place[order] = local  # the same numbers 0, 1, ... within each text; 0 is its first word
    chosen = np.flatnonzero((often > 0) & (place <= (lengths - 1 - least + enough)[owner]))
    first = np.searchsorted(index.lengths, np.ceil(share * lengths - 1e-9), side="left")
    last = np.searchsorted(index.lengths, np.floor(lengths / share + 1e-9), side="right")
    base, longest, keys, counts = len(index.lengths), int(lengths.max(initial=0)), [], []
    parts = np.cumsum(often[chosen]) // CHUNK_PLACES
    for part in np.split(chosen, np.flatnonzero(np.diff(parts)) + 1):
        rows, which = _expanded(low[part], often[part])
        text, ours = index.text[rows].astype("int64"), owner[part]
        near = (text >= first[ours][which]) & (text < last[ours][which])
        which = which[near]
        # a pair of words may stand in a text more than once and counts once
        key, _ = _counted(((ours * base)[which] + text[near]) * longest + local[part][which])
        key, n = _counted(key // longest, ordered=True)
        keys.append(key)
        counts.append(n)
    key, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, weights=np.concatenate(counts), minlength=len(key))
    key = key[total >= enough[key // base]]
    return key // base, key % base


def _counted(values: np.ndarray, ordered: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Different values in order and how often each occurs."""
    values = values if ordered else np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, "int64")
    return values[first], np.diff(np.append(first, len(values)))


def spans_of(index: TextIndex, ours: np.ndarray, theirs: np.ndarray, lengths: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Of each pair of texts the spans of the first that maximal matches with the second cover, and how many pairs of words they hold;
    and the words of the second texts with their numbers and starts."""
    texts, which = np.unique(theirs, return_inverse=True)
    rows, words = index.read(texts)
    sizes = index.lengths[texts]
    sorted_rows = np.sort(np.repeat(np.arange(len(texts)), sizes) * index.rows + rows)
    begin = np.cumsum(lengths) - lengths
    place, pair = _expanded(begin[ours], lengths[ours])
    offset = which[pair] * index.rows
    # a maximal match covers the places at which the rows of the pair of words hold one of the other text
    covered = np.searchsorted(sorted_rows, offset + high[place]) > np.searchsorted(sorted_rows, offset + low[place])
    start = covered & ~np.concatenate([[False], covered[:-1] & (pair[1:] == pair[:-1])])
    return np.bincount(pair[start], minlength=len(ours)), np.bincount(pair[covered], minlength=len(ours)), words, which, np.cumsum(sizes) - sizes


SCHEMA = "train_key string, eval_key string, common long, longest long, spans long, span_words long"


def matched(index: TextIndex, keys: list[str], texts: list[list[str]], share: float = SHARE, seeds: int = SEEDS) -> list[tuple]:
    """Rows of :data:`SCHEMA` for ``texts``, named by ``keys``, and the texts of the index."""
    lengths = np.array([len(t) for t in texts], "int64")
    codes = np.fromiter(map(index.ids.get, chain.from_iterable(texts), repeat(-1)), "int64", int(lengths.sum()))
    owner, begin = np.repeat(np.arange(len(texts)), lengths), np.cumsum(lengths) - lengths
    local = np.arange(len(codes)) - begin[owner]
    low, high = index.pairs_of_words(codes, local)
    ours, theirs = candidates(index, owner, local, lengths, low, high, share, seeds)
    if not len(ours):
        return []
    spans, held, words, which, starts = spans_of(index, ours, theirs, lengths, low, high)
    out = []
    for k in np.flatnonzero(held >= shared_pairs(lengths[ours], index.lengths[theirs], share)):
        a, b = int(ours[k]), int(theirs[k])
        n, m, start = int(lengths[a]), int(index.lengths[b]), int(starts[which[k]])
        common = common_words(codes[begin[a] : begin[a] + n].tolist(), words[start : start + m].tolist())
        if common >= share * max(n, m) - 1e-9:
            out.append((keys[a], index.keys[b], common, max(n, m), int(spans[k]), int(held[k] + spans[k])))
    return out


_loaded: dict[str, list[TextIndex]] = {}


def _indexes(name: str, blobs: list[bytes]) -> list[TextIndex]:
    """A block's indexes, unpacked once per worker."""
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = [pickle.loads(b) for b in blobs]  # noqa: S301 - our own bytes
    return _loaded[name]


def _stream(batches: Iterator[pd.DataFrame], indexes: list[TextIndex], share: float, seeds: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        parts = np.cumsum(batch["n"].to_numpy()) // CHUNK_WORDS
        for _, part in batch.groupby(parts, sort=False):
            sizes, texts, keys = part["n"].to_numpy(), [t.split(" ") for t in part["words"]], part["key"].tolist()
            for index in indexes:
                near = np.flatnonzero((sizes >= share * index.lengths[0] - 1e-9) & (sizes * share <= index.lengths[-1] + 1e-9))
                out += matched(index, [keys[k] for k in near], [texts[k] for k in near], share, seeds) if len(near) else []
        yield pd.DataFrame(out, columns=["train_key", "eval_key", "common", "longest", "spans", "span_words"])


def _shards(evaluation: DataFrame, share: float, shard_words: int) -> DataFrame:
    """``evaluation`` with ``shard``: neighbouring bands of lengths together up to ``shard_words``, larger bands divided by hash."""
    width = math.log(1 / share)
    band = F.floor(F.log(F.col("n").cast("double")) / width).cast("int")
    counts = evaluation.groupBy(band.alias("band")).agg(F.sum("n").alias("words")).orderBy("band").collect()  # one row per band of lengths
    plan, shard, room = [], -1, 0
    for row in counts:
        parts = -(-row["words"] // shard_words)
        if parts > 1 or row["words"] > room:
            shard, room = shard + 1, shard_words
        plan.append((row["band"], shard, parts))
        shard, room = shard + parts - 1, 0 if parts > 1 else room - row["words"]
    bands = evaluation.sparkSession.createDataFrame(plan, "of int, first long, parts long")
    placed = evaluation.withColumn("band", band).join(F.broadcast(bands), F.col("band") == F.col("of"))
    return placed.select("key", "words", (F.col("first") + F.pmod(F.xxhash64("key"), F.col("parts"))).alias("shard"))


def text_indexes(evaluation: DataFrame, share: float = SHARE, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``shard, shortest, longest, bytes, index``: the index of each shard of ``evaluation(key, words, n)``."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        index = TextIndex([t.split(" ") for t in rows["words"]], rows["key"].tolist())
        data = pickle.dumps(index, 5)
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "shortest": [index.lengths[0]], "longest": [index.lengths[-1]], "bytes": [len(data)], "index": [data]})

    return _shards(evaluation, share, shard_words).groupBy("shard").applyInPandas(build, "shard long, shortest long, longest long, bytes long, index binary")


def matching_texts(
    training: DataFrame, evaluation: DataFrame, share: float = SHARE, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES, seeds: int = SEEDS
) -> DataFrame:
    """``train_key, eval_key, common, longest, spans, span_words`` for pairs of texts ``key, words, n`` (words joined by spaces,
    each text once a side) that belong together. ``spans`` and ``span_words`` sum up the merged maximal matches.

    Each shard's index is built once and stored. Indexes are broadcast in blocks of at most ``block_bytes`` (or one index); for each
    block the training texts of fitting lengths are read where they lie. ``share`` must be high enough for two such texts to have
    neighbouring words in common (0.8 is for texts of 20 words), else a ValueError tells so.
    """
    spark = training.sparkSession
    stored = tabled(text_indexes(evaluation, share, shard_words))
    sizes = stored.select("shard", "shortest", "longest", "bytes").orderBy("shard").collect()  # one row per shard
    blocks: list[list] = []
    for row in sizes:
        if not blocks or sum(r["bytes"] for r in blocks[-1]) + row["bytes"] > block_bytes:
            blocks.append([])
        blocks[-1].append(row)
    training = tabled(training) if len(blocks) > 1 else training
    found = spark.createDataFrame([], SCHEMA)
    for block in blocks:
        shards = [r["shard"] for r in block]
        blobs = [r["index"] for r in stored.filter(F.col("shard").isin(shards)).orderBy("shard").select("index").collect()]
        shipped = spark.sparkContext.broadcast(blobs)  # at most block_bytes
        shortest, longest = min(r["shortest"] for r in block), max(r["longest"] for r in block)
        near = training.filter((F.col("n") >= share * shortest - 1e-9) & (F.col("n") * share <= longest + 1e-9))

        def stream(batches: Iterator[pd.DataFrame], shipped=shipped, name: str = uuid.uuid4().hex) -> Iterator[pd.DataFrame]:
            return _stream(batches, _indexes(name, shipped.value), share, seeds)

        found = found.unionByName(near.select("key", "words", "n").mapInPandas(stream, SCHEMA))
    return found


def _texts(rows: DataFrame, members: DataFrame, min_words: int) -> DataFrame:
    """``id, split, key, words, n`` of the ids that have a split and a long enough text, in a table; ``key`` is the same for equal words."""
    texts = rows.filter("id is not null and text is not null").groupBy("id").agg(F.min("text").alias("text"))
    worded = texts.select("id", words_of(F.col("text")).alias("w")).filter(F.size("w") >= min_words)
    split = members.filter("id is not null and split is not null").select(F.col("id").alias("__id"), "split").distinct()
    joined = worded.join(split, F.col("id") == F.col("__id")).select("id", "split", F.array_join("w", " ").alias("words"), F.size("w").alias("n"))
    return tabled(joined.withColumn("key", F.md5("words")))


def _matches(keyed: DataFrame, share: float, **options) -> DataFrame:
    once = lambda df: df.groupBy("key").agg(F.first("words").alias("words"), F.first("n").alias("n"))
    train = F.col("split") == "train"
    return tabled(matching_texts(once(keyed.filter(train)), once(keyed.filter(~train)), share, **options))


def overlapping_ids(rows: DataFrame, members: DataFrame, share: float = SHARE, min_words: int = MIN_WORDS, **options) -> DataFrame:
    """``id_a, id_b`` (in byte order), ``train_id, eval_id, split, common, longest, spans, span_words``.

    ``rows(id, text)`` are the records, ``members(id, split)`` their splits; ids of ``train`` are held against ids of any other
    split. The text of an id is its first non-null one in byte order; texts of fewer than ``min_words`` words, null ids and
    ids without a split have no pairs. Equal texts are compared once and joined back to their ids at the end.
    """
    keyed = _texts(rows, members, min_words)
    pairs = _matches(keyed, share, **options)
    is_train = F.col("split") == "train"
    train = keyed.filter(is_train).select(F.col("id").alias("train_id"), F.col("key").alias("train_key"))
    other = keyed.filter(~is_train).select(F.col("id").alias("eval_id"), "split", F.col("key").alias("eval_key"))
    found = pairs.join(train, "train_key").join(other, "eval_key").filter("train_id <> eval_id")
    return found.select(F.least("train_id", "eval_id").alias("id_a"), F.greatest("train_id", "eval_id").alias("id_b"), "train_id", "eval_id", "split", "common", "longest", "spans", "span_words")


def overlap_report(rows: DataFrame, members: DataFrame, share: float = SHARE, min_words: int = MIN_WORDS, **options) -> DataFrame:
    """``split, site, ids, overlapping, share, pairs, disagreeing`` per evaluation split and site.

    ``ids`` are the ids of the split with a row in ``rows``, ``overlapping`` those with a partner in train, ``pairs`` their number of pairs,
    ``disagreeing`` the pairs whose highest valid scores differ (or only one has a score). An id's site is its first in byte order; ids
    without one are reported under null. Pairs are counted by texts: train ids are summed by text and score first, so copies of one text are never
    paired id by id.
    """
    valid = F.when(F.col("score").between(0, 5), F.col("score"))
    facts = tabled(rows.filter("id is not null").groupBy("id").agg(F.min(site(F.col("url"))).alias("site"), F.max(valid).alias("score")))
    keyed = _texts(rows, members, min_words)
    pairs = _matches(keyed, share, **options).select("train_key", "eval_key")
    scores = facts.select(F.col("id").alias("__id"), "score")
    known = keyed.select("id", "split", "key").join(scores, F.col("id") == F.col("__id")).select("id", "key", "score", (F.col("split") == "train").alias("train"))
    trained = known.filter("train").groupBy(F.col("key").alias("train_key"), "score").agg(F.count("*").alias("n"))
    partners = pairs.join(trained, "train_key").groupBy(F.col("eval_key").alias("of"), F.col("score").alias("train_score")).agg(F.sum("n").alias("n"))
    totals = partners.groupBy("of").agg(F.sum("n").alias("all"))
    ours = known.filter("not train").select(F.col("id").alias("eval_id"), "key", "score").distinct()
    # an id that stands in both splits is no partner of itself; its text and score are its own
    itself = known.filter("train").select(F.col("id").alias("self"))
    agreeing = partners.withColumnRenamed("of", "same")
    counted = (
        ours.join(totals, F.col("key") == F.col("of"))
        .join(agreeing, (F.col("key") == F.col("same")) & F.col("score").eqNullSafe(F.col("train_score")), "left")
        .join(itself, F.col("eval_id") == F.col("self"), "left")
        .select("eval_id", (F.col("all") - F.col("self").isNotNull().cast("long")).alias("p"), (F.col("all") - F.coalesce("n", F.lit(0))).alias("d"))
        .filter("p > 0")
    )
    split = members.filter("split is not null and split <> 'train'").select(F.col("id").alias("__id"), "split").distinct()
    base = facts.join(split, F.col("id") == F.col("__id")).join(counted, F.col("id") == F.col("eval_id"), "left")
    summed = base.groupBy("split", "site").agg(
        F.count("*").alias("ids"), F.count("p").alias("overlapping"), F.coalesce(F.sum("p"), F.lit(0)).alias("pairs"), F.coalesce(F.sum("d"), F.lit(0)).alias("disagreeing")
    )
    return summed.withColumn("share", F.col("overlapping") / F.col("ids"))
