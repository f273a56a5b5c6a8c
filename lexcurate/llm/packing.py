"""Containers of fixed capacity filled with items that are cut only if they exceed it.

Minimum bin slack over lengths: a container takes the longest remaining length and then the multiset of
remaining lengths that fills it closest to capacity, found by subset sums over bitsets and traced back. Only the
number of items of each length matters, at most ``capacity`` numbers whatever the corpus, so the plan is made
on them: a filling is repeated as often as the counts allow. Items then take their places by their rank among
items of their length.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcurate.llm.bpe import VOCABULARY
from lexcurate.llm.budget import counted
from lexcurate.operators.ranking import ranked
from lexcurate.plans.lineage import tabled

CAPACITY = 2048
RESERVED = ("piece", "token_from", "token_to", "container", "position")


@dataclass(frozen=True)
class Filling:
    """``lengths`` and how many of each one container takes; made ``times`` times from container ``first`` on."""

    lengths: tuple[tuple[int, int], ...]
    times: int
    first: int


def fillings(counts: dict[int, int], capacity: int = CAPACITY) -> list[Filling]:
    """The plan for ``counts`` items of each length 1..capacity. Each filling uses up some length's count below its own
    use of it, so there are at most about ``capacity * ln(capacity)`` of them."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 1 <= n <= capacity for n in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    plan: list[Filling] = []
    first = 0
    while left:
        longest = max(left)
        use = {longest: 1}
        for n, k in _closest({n: c - (n == longest) for n, c in left.items()}, capacity - longest).items():
            use[n] = use.get(n, 0) + k
        times = min(left[n] // k for n, k in use.items())
        plan.append(Filling(tuple(sorted(use.items(), reverse=True)), times, first))
        first += times
        for n, k in use.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return plan


def _closest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length give the largest sum within ``room``; longer lengths are preferred."""
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for n in sorted((n for n, c in counts.items() if c > 0 and n <= room), reverse=True):
        remaining, block = min(counts[n], room // n), 1
        while remaining and not sums >> room & 1:
            take = min(block, remaining)
            steps.append((n, take, sums))
            sums |= (sums << (n * take)) & mask
            remaining -= take
            block *= 2
        if sums >> room & 1:
            break
    at, used = sums.bit_length() - 1, {}
    for n, take, before in reversed(steps):
        if not before >> at & 1:
            at -= n * take
            used[n] = used.get(n, 0) + take
    return used


def _places(plan: list[Filling]) -> dict[int, tuple[list[int], list[tuple[int, int, int]]]]:
    """By length: ranks at which a filling starts, and (first container, uses per container, first position)."""
    taken: dict[int, int] = {}
    places: dict[int, tuple[list[int], list[tuple[int, int, int]]]] = {}
    for f in plan:
        position = 1
        for n, k in f.lengths:
            starts, where = places.setdefault(n, ([], []))
            starts.append(taken.get(n, 0))
            where.append((f.first, k, position))
            taken[n] = taken.get(n, 0) + k * f.times
            position += k
    return places


def packed(items: DataFrame, size: str = "n_tokens", capacity: int = CAPACITY) -> DataFrame:
    """``items`` with ``piece, token_from, token_to, container, position``: one row per piece.

    An item of more than ``capacity`` is cut into full pieces, each a container of its own, and a rest that is packed
    like any other item. ``token_from`` and ``token_to`` bound the piece (0-based, end excluded); ``position`` is its
    1-based place in the container. Items without a size or of size 0 need no container: one row with nulls there.
    Repeated items are packed each for itself. Columns of these names are replaced.
    Containers are numbered from 0; those of cut pieces follow the others.
    """
    of = F.coalesce(F.col(size).cast("long"), F.lit(0))
    numbered = tabled(items.withColumn("__size", of).drop(*RESERVED))
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.floor((F.col("__size") - 1) / capacity)).cast("long")))
    cut = numbered.withColumn("__piece", pieces).withColumn("__from", F.col("__piece") * capacity)
    cut = cut.withColumn("__to", F.least(F.col("__size"), F.col("__from") + capacity)).withColumn("__length", F.col("__to") - F.col("__from"))
    lengths = {r["__length"]: r["n"] for r in cut.groupBy("__length").agg(F.count("*").alias("n")).filter("__length > 0").collect()}
    full = lengths.pop(capacity, 0)
    plan = fillings(lengths, capacity)
    containers = sum(f.times for f in plan)
    plan += [Filling(((capacity, 1),), full, containers)] if full else []
    places = items.sparkSession.sparkContext.broadcast(_places(plan))  # bounded by the number of fillings

    @F.pandas_udf("container long, position long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table, n = places.value, len(length)
        container, position = np.zeros(n, "int64"), np.zeros(n, "int64")
        for i, (size_, r) in enumerate(zip(length.to_numpy(), rank.to_numpy() - 1)):
            starts, where = table[size_]
            j = bisect_right(starts, r) - 1
            begin, uses, at = where[j]
            container[i], position[i] = begin + (r - starts[j]) // uses, at + (r - starts[j]) % uses
        return pd.DataFrame({"container": container, "position": position})

    same = [f.name for f in items.schema.fields if f.name not in RESERVED and f.dataType.typeName() not in ("map", "variant")]
    filled = ranked(cut.filter("__length > 0"), ["__length"], [F.xxhash64(*same), *map(F.col, same), F.col("__piece")], "__rank")
    filled = filled.withColumn("__at", placed("__length", "__rank"))
    columns = [*(c for c in items.columns if c not in RESERVED), F.col("__piece").alias("piece"), F.col("__from").alias("token_from"), F.col("__to").alias("token_to")]
    none = F.lit(None).cast("long")
    return filled.select(*columns, "__at.container", "__at.position").unionByName(cut.filter("__length = 0").select(*columns, none.alias("container"), none.alias("position")))


def packed_texts(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """:func:`packed` over ``doc_id, text``, sized in tokens: ``doc_id, n_tokens, piece, token_from, token_to, container, position``."""
    return packed(counted(docs.select("doc_id", "text"), vocabulary).select("doc_id", "n_tokens"), "n_tokens", capacity)
