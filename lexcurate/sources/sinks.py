"""Writing batches, tiers, registries and summaries. Writes go through Spark's commit protocol: files of a failed
task never show, and rewriting a batch replaces it."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_ROWS = 1000


def write_batch(df: DataFrame, folder: str, number: int) -> None:
    """Batch ``number`` of the table in ``folder``; written again, it replaces itself and nothing else."""
    writer = df.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch").parquet(folder)


def write_splits(df: DataFrame, folder: str, by: Sequence[str] = ("tier", "split")) -> None:
    """One folder per tier and split; earlier content is replaced, empty ones don't appear."""
    df.write.mode("overwrite").partitionBy(*by).parquet(folder)


def merge(df: DataFrame, path: str, files: int | None = None) -> int:
    """All rows in ``files`` files (as many as there are tasks if none is given); the number of rows. Raises without rows."""
    if df.isEmpty():
        raise ValueError("nothing to merge")
    (df if files is None else df.repartition(files)).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("escape", '"').option("multiLine", "true").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """A small result as JSON lines in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_registry(df: DataFrame, folder: str) -> None:
    """New ``text_hash`` rows added to a registry table."""
    df.select("text_hash").write.mode("append").parquet(folder)


def export_manifest(folder: str, required: Mapping[str, Sequence[str]], target: str) -> dict:
    """A manifest of a local export: name, files and bytes of each configuration. Raises if one lacks a required file."""
    manifest = {}
    for name, patterns in required.items():
        found = sorted(p for pattern in patterns for p in Path(folder, name).glob(pattern))
        if not all(any(Path(folder, name).glob(pattern)) for pattern in patterns):
            raise FileNotFoundError(f"{name}: {', '.join(patterns)} expected in {folder}")
        manifest[name] = {"files": [str(p.relative_to(folder)) for p in found], "bytes": sum(p.stat().st_size for p in found)}
    Path(target).write_text(json.dumps(manifest, indent=1))
    return manifest
