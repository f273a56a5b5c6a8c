"""Score thresholds, overlapping quality tiers and their statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the least score of each tier
TIERS = {"default": 3.0, "high_quality": 4.0, "supreme": 4.8}
THRESHOLD, EXCELLENT, BORDERLINE = 3.0, 4.5, (3.0, 3.5)


def at_least(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows that score ``threshold`` or more; NaN and null don't."""
    return df.filter((F.col("score") >= threshold) & ~F.isnan("score"))


def tiered(df: DataFrame, tiers: Mapping[str, float] = TIERS) -> DataFrame:
    """A row for each tier a row belongs to, with ``tier``; rows below all tiers, NaN and null drop out."""
    names = F.array(*(F.when((F.col("score") >= least) & ~F.isnan("score"), F.lit(name)) for name, least in tiers.items()))
    return df.withColumn("tier", F.explode(F.array_compact(names)))


def tier_statistics(split: DataFrame) -> DataFrame:
    """``tier, train, test, total, least, mean`` of rows with ``tier, split, score``."""
    part = lambda s: F.sum((F.col("split") == s).cast("long")).alias(s)
    return split.groupBy("tier").agg(part("train"), part("test"), F.count("*").alias("total"), F.min("score").alias("least"), F.avg("score").alias("mean"))


def bands(df: DataFrame) -> DataFrame:
    """``df`` with ``band``: excellent, borderline or null."""
    low, high = BORDERLINE
    score = F.col("score")
    return df.withColumn("band", F.when((score >= EXCELLENT) & ~F.isnan(score), "excellent").when((score >= low) & (score < high), "borderline"))
