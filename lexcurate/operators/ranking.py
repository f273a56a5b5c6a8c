"""Exact ranks within groups of any size.

A window over the group would put a whole group into one task. Here rows are range-partitioned on
(group, order), so that a large group is spread over several tasks, and sorted within each task, where a row's position is its number in the
file. Positions become ranks by two numbers for each task and group: its first position there and the group's rows in earlier tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexcurate.plans.lineage import tabled

AT, PART, FIRST, SHIFT = "__at", "__part", "__first", "__shift"
ROWS = 33  # bits of a row's position in its task; the task's number stands above them


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: 1, 2, ... within ``group`` by ``order``.

    A column of that name is replaced. ``order`` must be total for a reproducible rank; null group values form a group of their own. Equal rows get
    consecutive ranks. Empty input gives an empty result. Whole rows are exchanged once and written once, as the ranges are sampled; the numbers per
    task and group are broadcast where their measured size allows.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in group]
    placed = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order).withColumn(AT, F.monotonically_increasing_id())
    stored = tabled(placed).withColumn(PART, F.shiftrightunsigned(AT, ROWS))
    parts = stored.groupBy(PART, *group).agg(F.min(AT).alias(FIRST), F.count("*").alias("__rows"))
    before = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    theirs = {c: f"__of_{k}" for k, c in enumerate([PART, *group])}
    shifts = parts.select(*(F.col(c).alias(of) for c, of in theirs.items()), FIRST, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias(SHIFT))
    shifts = shifts if group else F.broadcast(shifts)  # a row for each of n tasks
    joined = stored.join(shifts, [F.col(c).eqNullSafe(F.col(of)) if c != PART else F.col(c) == F.col(of) for c, of in theirs.items()])
    return joined.select(*(c for c in df.columns if c != name), (F.col(AT) - F.col(FIRST) + F.col(SHIFT) + 1).cast("long").alias(name))
