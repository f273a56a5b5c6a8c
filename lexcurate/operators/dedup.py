"""Exact duplicates: registries of known hashes and keep-first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order`` and then by all other columns; null keys are one key.

    A minimum is combined before the shuffle, so copies that make up most of the rows cost no more than others.
    Columns of map or variant type aren't supported.
    """
    rest = [c for c in df.columns if c not in order]
    first = df.groupBy(key.alias("__key")).agg(F.min(F.struct(*order, *rest)).alias("__row"))
    return first.select(*(F.col("__row")[c].alias(c) for c in df.columns))


def not_registered(df: DataFrame, key: Column, registry: DataFrame) -> DataFrame:
    """Rows whose hash isn't in ``registry(text_hash)``; rows with a null hash stay."""
    return df.join(registry.select(F.col("text_hash").alias("__known")), key == F.col("__known"), "left_anti")


def registered(df: DataFrame, key: Column, registry: DataFrame) -> DataFrame:
    return df.join(registry.select(F.col("text_hash").alias("__known")), key == F.col("__known"), "left_semi")


def updated_registry(registry: DataFrame, df: DataFrame, key: Column) -> DataFrame:
    """The registry with the hashes of ``df``; each hash once, nulls left out."""
    return registry.select("text_hash").union(df.select(key.alias("text_hash"))).filter("text_hash is not null").distinct()


def duplicate_groups(df: DataFrame, key: Column, ident: str = "doc_id") -> DataFrame:
    """``text_hash, copies, first_id`` of keys that occur more than once; null keys are left out."""
    groups = df.select(key.alias("text_hash"), ident).filter("text_hash is not null").groupBy("text_hash")
    return groups.agg(F.count("*").alias("copies"), F.min(ident).alias("first_id")).filter("copies > 1")
