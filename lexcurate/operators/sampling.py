"""Splits, samples and batches in an order that a seed fixes.

The order is that of ``md5(seed:key)``. Sizes are exact at any scale, as ranks come from
:func:`lexcurate.operators.ranking.ranked`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexcurate.operators.ranking import ranked
from lexcurate.plans.lineage import tabled

SEED = 42


def hash_order(key: str, seed: int = SEED) -> list[Column]:
    """Total for unique keys; equal keys follow in any order."""
    return [F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.col(key)]


def random_split(df: DataFrame, key: str, ratio: float = 0.8, seed: int = SEED, names: tuple[str, str] = ("train", "val")) -> DataFrame:
    """``df`` with ``split``: the first ``floor(n * ratio)`` rows by hash and the rest."""
    placed = ranked(df, [], hash_order(key, seed), "__rank")
    first = math.floor(df.count() * ratio + 1e-9)
    return placed.withColumn("split", F.when(F.col("__rank") <= first, names[0]).otherwise(names[1])).drop("__rank")


def ceil_split(df: DataFrame, key: str, groups: Sequence[str] = (), test_size: float = 0.1, seed: int = SEED) -> DataFrame:
    """``df`` with ``split``: in each group the first ``ceil(n * test_size)`` rows by hash are ``test``, the others ``train``."""
    placed = tabled(ranked(df, groups, hash_order(key, seed), "__rank"))
    split = lambda size: F.when(F.col("__rank") <= size, "test").otherwise("train").alias("split")
    if not groups:
        return placed.select(*df.columns, split(math.ceil(placed.count() * test_size - 1e-9)))
    sizes = placed.groupBy(*(F.col(g).alias(f"__{g}") for g in groups)).agg(F.ceil(F.count("*") * F.lit(test_size) - 1e-9).alias("__test"))
    same = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups]
    return placed.join(sizes, same).select(*df.columns, split(F.col("__test")))


def _quotas(counts: DataFrame, total: Column, size: str, want: Column, name: str) -> DataFrame:
    """``counts`` (one row per stratum) with ``name``: ``want`` rows shared in proportion to ``size`` by largest remainder."""
    everything = Window.partitionBy()
    exact = want * F.col(size) / total
    shared = counts.withColumn("__floor", F.floor(exact)).withColumn("__part", exact - F.floor(exact)).withColumn("__left", want - F.sum("__floor").over(everything))
    by_part = Window.partitionBy().orderBy(F.col("__part").desc(), F.col("stratum"))
    extra = (F.row_number().over(by_part) <= F.col("__left")).cast("long")
    return shared.withColumn(name, F.col("__floor") + extra).drop("__floor", "__part", "__left")


def stratified_split(df: DataFrame, key: str, stratum: str, holdout: float = 0.30, seed: int = SEED) -> DataFrame:
    """``df`` with ``split`` train, validation or test.

    ``ceil(n * holdout)`` rows are held out, and the larger half of them (``ceil``) is the test split; strata share each part by
    largest remainder. Null is a stratum of its own. The windows over strata see one row per stratum.
    """
    placed = tabled(ranked(df, [stratum], hash_order(key, seed), "__rank"))
    counts = placed.groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("n"))
    n = F.sum("n").over(Window.partitionBy())
    counts = counts.withColumn("__n", n).withColumn("__held", F.ceil(F.col("__n") * F.lit(holdout) - 1e-9)).withColumn("__tested", F.ceil(F.col("__held") * 0.5))
    counts = _quotas(counts, F.col("__n"), "n", F.col("__held"), "held")
    counts = _quotas(counts, F.col("__held"), "held", F.col("__tested"), "tested")
    joined = placed.join(counts, F.col(stratum).eqNullSafe(F.col("stratum")))
    split = F.when(F.col("__rank") <= F.col("tested"), "test").when(F.col("__rank") <= F.col("held"), "validation").otherwise("train")
    return joined.select(*df.columns, split.alias("split"))


def overlaps(df: DataFrame, key: Column, split: str = "split") -> DataFrame:
    """``left_split, right_split, shared``: keys that two splits share, for each pair of splits that share any. Null keys don't count."""
    keys = df.select(key.alias("k"), F.col(split).alias("s")).filter("k is not null").groupBy("k").agg(F.collect_set("s").alias("in"))
    pairs = F.explode(F.flatten(F.transform("in", lambda a: F.transform("in", lambda b: F.struct(a.alias("left_split"), b.alias("right_split"))))))
    return keys.filter(F.size("in") > 1).select(pairs.alias("p")).select("p.*").filter("left_split < right_split").groupBy("left_split", "right_split").agg(F.count("*").alias("shared"))


def sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """``min(n, rows)`` rows without replacement: each task keeps its own first ``n``."""
    return df.orderBy(*hash_order(key, seed)).limit(n)


def first_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark keeps ``n`` per task before it shuffles."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def batches(df: DataFrame, order: Sequence[Column], size: int, most: int | None = None) -> DataFrame:
    """``df`` with ``batch``: 1, 2, ... for each ``size`` rows in order; with ``most``, only so many batches."""
    placed = ranked(df, [], order, "__rank").withColumn("batch", (F.floor((F.col("__rank") - 1) / size) + 1).cast("long")).drop("__rank")
    return placed if most is None else placed.filter(F.col("batch") <= most)


def after(df: DataFrame, order: Sequence[Column], offset: int) -> DataFrame:
    """All rows but the first ``offset`` in order."""
    return ranked(df, [], order, "__rank").filter(F.col("__rank") > offset).drop("__rank")


def batches_until(sizes: DataFrame, target: int, batch: str = "batch", size: str = "n") -> DataFrame:
    """Batches taken before the running sum of their sizes reaches ``target``; the last one may overshoot. One row per batch."""
    w = Window.partitionBy().orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("before", F.coalesce(F.sum(size).over(w), F.lit(0))).filter(F.col("before") < target)
