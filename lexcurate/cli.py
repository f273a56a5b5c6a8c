"""Commands over the operators: ``python -m lexcurate COMMAND``."""

from __future__ import annotations

import argparse
import signal
import sys
import threading
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import lexcurate
from lexcurate import settings, sources, streaming
from lexcurate.functions import text as T
from lexcurate.functions.lexicons import ANNOTATION, STAGE1, Lexicon
from lexcurate.operators import dedup, filters, learning, sampling, scoring, statistics, tiers
from lexcurate.plans.lineage import tabled
from lexcurate.plans.session import session, ship
from lexcurate.sources import sinks


def _documents(spark: SparkSession, path: str) -> DataFrame:
    df = sources.reconnecting(lambda: spark.read.parquet(path))
    return sources.documents(df, "id" if "id" in df.columns else "doc_id")


def annotate(spark: SparkSession, a: argparse.Namespace) -> int:
    """The next batch of documents that pass the filter and aren't registered, up to ``--batch-size`` rows and ``--target`` in all.

    What isn't given is taken from the environment (:mod:`lexcurate.settings`). Without ``--registry`` hashes known before are read from where
    :func:`lexcurate.sources.registry_location` finds them, and new ones are kept in ``registry`` inside the output.
    """
    s = settings.load(output_dir=a.output, batch_size=a.batch_size, target_samples=a.target)
    own = a.registry or f"{a.output.rstrip('/')}_registry"
    names = sources.batches(spark, a.output).select("batch").distinct() if sources.exists(spark, a.output) else None
    number = (names.agg(F.max("batch")).first()[0] or 0) + 1 if names is not None else 1
    have = spark.read.parquet(a.output).count() if names is not None else 0
    known = sources.registry(spark, own)
    if not a.registry:
        known = known.union(sources.registry(spark, sources.registry_location(spark, a.output)))
    key = T.text_hash(F.col("text"))
    fresh = dedup.not_registered(dedup.keep_first(_fitting(_documents(spark, a.input), s), key, ["id"]), key, known)
    room = min(s.batch_size, s.target_samples - have)
    if a.dry_run:
        print(f"batch {number}: {min(room, fresh.count())} documents would be annotated")
        return 0
    if room <= 0:
        print("the target is reached")
        return 0
    todo = fresh.orderBy("id").limit(room)
    rows = tabled(scoring.annotated(todo, scoring.TermScorer, retry=s.retry()))
    good, bad = scoring.split_errors(rows)
    sinks.write_batch(good, a.output, number)
    sinks.append_registry(good.select(T.text_hash(F.col("text")).alias("text_hash")), own)
    print(f"batch {number}: {good.count()} annotated, {bad.count()} failed")
    return 0


def _fitting(docs: DataFrame, s: settings.Settings) -> DataFrame:
    lexicon = replace(ANNOTATION, min_chars=s.min_text_length, max_chars=s.max_text_length)
    return filters.survivors(docs, lexicon) if s.keyword_filter_enabled else docs.filter(filters.right_length(F.col("text"), lexicon))


def stage1(spark: SparkSession, a: argparse.Namespace) -> int:
    """New files of ``--input`` through the filter into ``--output``; run again, only files that came since are read."""
    lexicon = Lexicon(min_chars=a.min_length, max_chars=a.max_length)
    stream = streaming.source(spark, a.input, spark.read.parquet(a.input).schema)
    query = streaming.filtered(sources.documents(stream, "id" if "id" in stream.columns else "doc_id"), a.output, a.checkpoint, lexicon)
    whole = streaming.Stop(*([signal.SIGINT, signal.SIGTERM] if threading.current_thread() is threading.main_thread() and a.signals else [])).watch(query)
    read = sum(p["numInputRows"] for p in query.recentProgress)
    print(f"{read} read" + ("" if whole else "; stopped after the current batch"))
    return 0


def stage2(spark: SparkSession, a: argparse.Namespace) -> int:
    """Rows of each file of ``--input`` that the model in ``--model`` scores at least ``--threshold``; files scored by an earlier run are left out."""
    model = learning.PipelineModel.load(a.model)

    def kept(rows: DataFrame) -> DataFrame:
        scored = learning.predict(model, rows).withColumn("score", F.col("predicted_score"))
        return sources.present(tiers.at_least(scored, a.threshold), ["id", "text", "url", "score", "date"])

    print(f"{len(streaming.by_file(spark, f'{a.input}/*.parquet', a.output, kept))} files scored")
    return 0


def merge(spark: SparkSession, a: argparse.Namespace) -> int:
    print(sinks.merge(sources.batches(spark, a.input).drop("file", "batch"), a.output, a.files), "rows")
    return 0


def stats(spark: SparkSession, a: argparse.Namespace) -> int:
    df = spark.read.parquet(a.input)
    statistics.overview(df).show(truncate=False)
    statistics.shares(df).show(truncate=False)
    if a.json:
        sinks.write_json(statistics.overview(df), a.json)
    if a.inventory:
        statistics.inventory(df, F.col("_metadata.file_name"), F.octet_length("text")).orderBy("is_total", "batch").show(1000, truncate=False)
    return 0


def validate(spark: SparkSession, a: argparse.Namespace) -> int:
    df = spark.read.parquet(a.input)
    statistics.validation(df).show(truncate=False)
    return 0 if statistics.is_valid(df) else 1


def samples(spark: SparkSession, a: argparse.Namespace) -> int:
    df = spark.read.parquet(a.input)
    chosen = df if a.score is None else df.filter(F.col("score") == a.score)
    sampling.sample(chosen, "id", a.count, a.seed).select("id", "score", "reasoning", F.left("text", F.lit(500)).alias("text")).show(a.count, truncate=False)
    return 0


def train(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = sources.require(spark.read.parquet(a.input), ["text", "score"])
    split = tabled(sampling.random_split(rows.filter("text is not null"), "id", 0.8))
    model = learning.train(split.filter("split = 'train'"), iterations=a.iterations, regularisation=a.regularisation)
    model.write().overwrite().save(a.model)
    print(learning.evaluate(model, split.filter("split = 'val'")))
    return 0


def evaluate(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = sources.require(spark.read.parquet(a.input), ["text", "score"])
    val = sampling.random_split(rows.filter("text is not null"), "id", 0.8).filter("split = 'val'")
    print(learning.evaluate(learning.PipelineModel.load(a.model), val))
    return 0


def consolidate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Sources in order, exact duplicates dropped, stratified splits written; fails if two splits share a text."""
    parts = [spark.read.parquet(p).withColumn("score", F.col("score").cast("long")) for p in a.inputs]
    columns = ["id", "text", "score", "reasoning", "url"]
    rows = sources.aligned_union(parts, columns).withColumn("text_hash", T.exact_hash(F.col("text")))
    kept = dedup.keep_first(rows, F.col("text_hash"), ["source_rank", "id"]).drop("source_rank")
    split = tabled(sampling.stratified_split(kept, "id", "score"))
    if not sampling.overlaps(split, F.col("text_hash")).isEmpty():
        print("two splits share texts")
        return 1
    sinks.write_splits(split, a.output, ["split"])
    if a.whole:
        sinks.merge(split, a.whole, 1)
    statistics.crosstab(split, "score", "split").orderBy("level", "score", "split").show(100)
    return 0


def make_tiers(spark: SparkSession, a: argparse.Namespace) -> int:
    split = tabled(sampling.ceil_split(tiers.tiered(spark.read.parquet(a.input)), "id", ["tier"], a.test_size))
    sinks.write_splits(split, a.output)
    tiers.tier_statistics(split).show(truncate=False)
    return 0


def analyse(spark: SparkSession, a: argparse.Namespace) -> int:
    df = spark.read.parquet(a.input)
    statistics.describe(df, "score").show(truncate=False)
    statistics.percentiles(df, "score", (0.5, 0.75, 0.9, 0.95, 0.99)).show()
    statistics.length_totals(df).show()
    statistics.top_domains(df).show(truncate=False)
    return 0


def funnel(spark: SparkSession, a: argparse.Namespace) -> int:
    counts = tabled(filters.funnel(_documents(spark, a.input), STAGE1))
    counts.show(truncate=False)
    if a.json:
        sinks.write_json(counts, a.json)
    return 0


def audit(spark: SparkSession, a: argparse.Namespace) -> int:
    """``--count`` documents after the first ``--skip``, scored and labelled, as CSV."""
    from lexcurate.functions.scores import label_name

    rows = sampling.after(_documents(spark, a.input), [F.col("id")], a.skip).orderBy("id").limit(a.count)
    scored = learning.predict(learning.PipelineModel.load(a.model), rows)
    out = scored.select(
        F.left("text", F.lit(200)).alias("text_snippet"), F.col("text").alias("full_text"), F.round("predicted_score", 3).alias("raw_score"), F.col("pred").alias("pred_class"), label_name(F.col("predicted_score")).alias("prediction_label")
    )
    sinks.write_csv(out, a.output)
    return 0


def ablate(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = spark.read.parquet(a.input).filter("text is not null")
    split = tabled(sampling.random_split(rows, "id", 0.8))
    options = {"regularisation": (0.001, 0.01, 0.1), "class_weights": (True, False)}
    for result in learning.grid(split.filter("split = 'train'"), split.filter("split = 'val'"), options):
        print(result)
    return 0


def publish(spark: SparkSession, a: argparse.Namespace) -> int:
    """A local manifest of an export with the preflight checks; nothing is sent anywhere."""
    names = a.configs or ["tier=default", "tier=high_quality", "tier=supreme"]
    print(sinks.export_manifest(a.input, {n: ["**/*.parquet"] for n in names}, a.output))
    return 0


COMMANDS = {
    "annotate": annotate, "resume": annotate, "stage1": stage1, "stage2": stage2, "merge": merge, "stats": stats, "validate": validate, "samples": samples,
    "train": train, "evaluate": evaluate, "consolidate": consolidate, "tiers": make_tiers, "analyse": analyse, "funnel": funnel, "audit": audit, "ablate": ablate, "publish": publish,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexcurate", description=__doc__)
    p.add_argument("--version", action="version", version=lexcurate.__version__)
    sub = p.add_subparsers(dest="command", required=True)
    for name, function in COMMANDS.items():
        c = sub.add_parser(name, help=(function.__doc__ or name).splitlines()[0])
        c.add_argument("--input", default=None)
        c.add_argument("--output", default=None)
        if name in ("annotate", "resume"):
            c.add_argument("--registry", default=None)
            c.add_argument("--batch-size", type=int, default=None)
            c.add_argument("--target", type=int, default=None)
            c.add_argument("--dry-run", action="store_true")
        if name == "stage1":
            c.add_argument("--checkpoint", required=True)
            c.add_argument("--min-length", type=int, default=STAGE1.min_chars)
            c.add_argument("--max-length", type=int, default=STAGE1.max_chars)
        if name in ("stage2", "train", "evaluate", "audit"):
            c.add_argument("--model", required=True)
        if name == "stage2":
            c.add_argument("--threshold", type=float, default=tiers.THRESHOLD)
        if name == "merge":
            c.add_argument("--files", type=int, default=None)
        if name in ("stats", "funnel"):
            c.add_argument("--json", default=None, help="folder for the figures as JSON")
        if name == "stage1":
            c.add_argument("--signals", action="store_true", help="end after the current batch on SIGINT or SIGTERM")
        if name == "stats":
            c.add_argument("--inventory", action="store_true")
        if name == "samples":
            c.add_argument("--score", type=int, default=None)
            c.add_argument("--count", type=int, default=5)
            c.add_argument("--seed", type=int, default=sampling.SEED)
        if name == "train":
            c.add_argument("--iterations", type=int, default=30)
            c.add_argument("--regularisation", type=float, default=0.01)
        if name == "consolidate":
            c.add_argument("inputs", nargs="+")
            c.add_argument("--whole", default=None, help="all rows with their splits in one file")
        if name == "tiers":
            c.add_argument("--test-size", type=float, default=0.1)
        if name == "audit":
            c.add_argument("--skip", type=int, default=0)
            c.add_argument("--count", type=int, default=50)
        if name == "publish":
            c.add_argument("--configs", nargs="*")
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or session()
    ship(spark)
    return COMMANDS[a.command](spark, a)


if __name__ == "__main__":
    sys.exit(main())
