"""Statistics, distributions and data checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexcurate.functions import text as T
from lexcurate.functions.lexicons import SCORE_NAMES
from lexcurate.functions.urls import netloc
from lexcurate.plans.lineage import tabled

SCORES, DRIFT_PERCENT = range(6), 80.0


def overview(df: DataFrame) -> DataFrame:
    """One row: samples, sums and averages of ``input_tokens`` and ``text_length`` (nulls skipped in sums, all rows in
    averages, 0 without rows) and the cost."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    one = df.agg(F.count("*").alias("samples"), total("input_tokens").alias("tokens"), total("text_length").alias("chars"))
    each = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("samples")), F.lit(0.0))
    return one.select("samples", "tokens", "chars", each("tokens").alias("avg_tokens"), each("chars").alias("avg_chars"), T.cost(F.col("tokens")).alias("cost"))


def _all_scores(df: DataFrame) -> DataFrame:
    return df.sparkSession.range(len(SCORES)).select(F.col("id").cast("int").alias("score"))


def histogram(df: DataFrame, score: str = "score") -> DataFrame:
    """``score, n`` for 0 to 5, zeros included; null, fractional and out-of-range scores aren't counted."""
    seen = df.select(F.col(score).cast("int").alias("s")).filter(F.col("s").between(0, 5)).groupBy("s").agg(F.count("*").alias("c"))
    return _all_scores(df).join(F.broadcast(seen), F.col("score") == F.col("s"), "left").select("score", F.coalesce("c", F.lit(0)).alias("n"))  # six rows at most


def shares(df: DataFrame, score: str = "score") -> DataFrame:
    """:func:`histogram` with ``percent``, a ``bar`` and the ``label`` of each score."""
    whole = F.sum("n").over(Window.partitionBy())
    names = F.array(*map(F.lit, SCORE_NAMES))
    return histogram(df, score).withColumn("percent", T.percent(F.col("n"), whole)).withColumn("bar", T.bar(F.col("percent"))).withColumn("label", F.get(names, F.col("score")))


def describe(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, sample deviation, least, quartiles and largest value. NaN and null are left out."""
    values = _numbers(df, column)
    q = percentiles(df, column, (0.25, 0.5, 0.75)).agg(*(F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))))
    one = values.agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("least"), F.max("v").alias("largest"))
    return one.withColumn("k", F.lit(1)).join(q.withColumn("k", F.lit(1)), "k").drop("k")  # one row each


def _numbers(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("double").alias("v")).filter("v is not null and not isnan(v)")


def percentiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """``p, value``: exact, with linear interpolation; no values give no rows. Equal values are counted first, so a common one is one row;
    counts are then summed up over ranges of values, so no task holds all of them."""
    spark = df.sparkSession
    counts = _numbers(df, column).groupBy("v").agg(F.count("*").alias("n"))
    stored = tabled(counts.repartitionByRange("v").withColumn("__part", F.spark_partition_id()))
    sums = stored.groupBy("__part").agg(F.sum("n").alias("part_n"))  # a row for each range
    n = sums.agg(F.sum("part_n")).first()[0]
    if not n:
        return spark.createDataFrame([], "p double, value double")
    before = Window.partitionBy().orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(F.col("__part").alias("__of"), F.coalesce(F.sum("part_n").over(before), F.lit(0)).alias("__before"))
    running = stored.join(F.broadcast(shifts), F.col("__part") == F.col("__of"))
    upto = running.select("v", (F.sum("n").over(Window.partitionBy("__part").orderBy("v")) + F.col("__before")).alias("upto"))
    ranks = {p: (int(p * (n - 1)) + 1, min(n, int(p * (n - 1)) + 2)) for p in probabilities}
    found = upto.agg(*(F.min(F.when(F.col("upto") >= r, F.col("v"))).alias(str(r)) for r in sorted({r for pair in ranks.values() for r in pair})))
    rows = [F.struct(F.lit(float(p)).alias("p"), (F.col(str(a)) + (F.col(str(b)) - F.col(str(a))) * F.lit(p * (n - 1) - (a - 1))).alias("value")) for p, (a, b) in ranks.items()]
    return found.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """``row, column, n`` with totals: a null label with level 1, 2 or 3 stands for all columns, all rows or both."""
    cube = df.cube(row, column).agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("n"))
    return cube.filter("n > 0")


def top_domains(df: DataFrame, n: int = 20) -> DataFrame:
    """``domain, n`` of the most frequent network locations; ties by name. Null URLs count as ``unknown``."""
    counts = df.groupBy(F.coalesce(netloc(F.col("url")), F.lit("unknown")).alias("domain")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), "domain").limit(n)


def length_totals(df: DataFrame) -> DataFrame:
    """One row: documents with a text, characters, words and words per document."""
    words = df.filter("text is not null").select(F.length("text").cast("long").alias("c"), T.word_count(F.col("text")).cast("long").alias("w"))
    return words.agg(F.count("*").alias("documents"), F.coalesce(F.sum("c"), F.lit(0)).alias("chars"), F.coalesce(F.sum("w"), F.lit(0)).alias("words"), F.avg("w").alias("avg_words"))


def inventory(df: DataFrame, batch: Column, size: Column) -> DataFrame:
    """``batch, n, bytes`` per batch and, with a null batch, in total."""
    return df.select(batch.alias("batch"), size.alias("size")).rollup("batch").agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("bytes"), F.grouping("batch").cast("int").alias("is_total"))


def invalid_score(score: Column) -> Column:
    return score.isNull() | ~score.between(0, 5)


def duplicate_ids(df: DataFrame, ident: str = "id") -> DataFrame:
    """One row ``duplicates``: rows beyond the first of each id; null is an id like any other."""
    per_id = df.groupBy(ident).agg((F.count("*") - 1).alias("more"))
    return per_id.agg(F.coalesce(F.sum("more"), F.lit(0)).alias("duplicates"))


def drift(df: DataFrame, limit: float = DRIFT_PERCENT) -> DataFrame:
    """Scores that make up more than ``limit`` percent of the valid ones."""
    return shares(df).filter(F.col("percent") > limit).select("score", "n", "percent")


def validation(df: DataFrame, limit: float = DRIFT_PERCENT) -> DataFrame:
    """``check, found, severity``: invalid scores are errors; blank texts, repeated ids and drifting scores warnings."""
    flags = df.agg(
        F.coalesce(F.sum(invalid_score(F.col("score")).cast("long")), F.lit(0)).alias("invalid_scores"), F.coalesce(F.sum(T.is_blank(F.col("text")).cast("long")), F.lit(0)).alias("empty_texts")
    )
    rows = flags.select(F.explode(F.array(F.struct(F.lit("invalid_scores").alias("check"), F.col("invalid_scores").alias("found")), F.struct(F.lit("empty_texts").alias("check"), F.col("empty_texts").alias("found")))).alias("r")).select("r.*")
    rows = rows.union(duplicate_ids(df).select(F.lit("duplicate_ids").alias("check"), F.col("duplicates").alias("found")))
    rows = rows.union(drift(df, limit).agg(F.count("*").alias("found")).select(F.lit("drifting_scores").alias("check"), "found"))
    return rows.withColumn("severity", F.when(F.col("found") == 0, "ok").when(F.col("check") == "invalid_scores", "error").otherwise("warning"))


def is_valid(df: DataFrame) -> bool:
    """No error among the checks; warnings don't count. Four rows reach the driver."""
    return not any(r["severity"] == "error" for r in validation(df).collect())


def pass_rate(funnel: DataFrame) -> DataFrame:
    """One row from :func:`lexcurate.operators.filters.funnel`: processed and passed documents, percent, and rejects that
    aren't by length."""
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("documents"))), F.lit(0))
    passed = F.col("reason") == "pass"
    one = funnel.agg(total(F.lit(True)).alias("processed"), total(passed).alias("passed"), total(~passed & ~F.col("reason").isin("too_short", "too_long")).alias("filtered"))
    return one.withColumn("percent", T.percent(F.col("passed"), F.col("processed")))


def running_state(batches: DataFrame, sums: Sequence[str], batch: str = "batch") -> DataFrame:
    """One row per batch with the totals of ``sums`` up to it, as ``total_<name>``; one row per batch comes in."""
    w = Window.partitionBy().orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    return batches.select(batch, *(F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"total_{c}") for c in sums))

