"""Classification metrics from ``label, pred`` rows. Rows with a null on either side are left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLASSES = 6
EPSILON = 1e-6


def _classes(df: DataFrame, name: str) -> DataFrame:
    return df.sparkSession.range(CLASSES).select(F.col("id").cast("int").alias(name))


def confusion(df: DataFrame) -> DataFrame:
    """``label, pred, n`` for all 36 pairs of classes; classes outside 0..5 aren't counted."""
    seen = df.filter("label between 0 and 5 and pred between 0 and 5").groupBy(F.col("label").cast("int").alias("l"), F.col("pred").cast("int").alias("p")).agg(F.count("*").alias("c"))
    cells = _classes(df, "label").withColumn("pred", F.explode(F.sequence(F.lit(0), F.lit(CLASSES - 1))))
    return cells.join(F.broadcast(seen), (F.col("label") == F.col("l")) & (F.col("pred") == F.col("p")), "left").select("label", "pred", F.coalesce("c", F.lit(0)).alias("n"))  # 36 rows at most


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def per_class(df: DataFrame) -> DataFrame:
    """``cls, precision, recall, f1, support, predicted`` of the six classes; 0 where undefined."""
    m = confusion(df)
    side = lambda c: m.groupBy(F.col(c).alias("cls")).agg(F.sum("n").alias(c), F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)).alias("tp"))
    both = side("label").join(side("pred").drop("tp"), "cls")
    tp, support, predicted = F.col("tp"), F.col("label"), F.col("pred")
    return both.select("cls", _ratio(tp, predicted).alias("precision"), _ratio(tp, support).alias("recall"), _ratio(2 * tp, support + predicted).alias("f1"), support.alias("support"), predicted.alias("predicted"))


def summary(df: DataFrame) -> DataFrame:
    """One row: accuracy, macro averages over classes that occur as label or prediction, support-weighted F1."""
    p = per_class(df).filter("support + predicted > 0")
    averages = [F.coalesce(F.avg(c), F.lit(0.0)).alias(f"{c}_macro") for c in ("f1", "precision", "recall")]
    hits = F.sum(F.col("recall") * F.col("support"))
    return p.agg(_ratio(hits, F.sum("support")).alias("accuracy"), *averages, _ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1_weighted"))


def binary_f1(df: DataFrame, threshold: int = 3) -> DataFrame:
    """One row ``f1``: classes from ``threshold`` on are positive; 0 if undefined."""
    a, b = F.col("label") >= threshold, F.col("pred") >= threshold
    total = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return df.filter("label is not null and pred is not null").agg(_ratio(2 * total(a & b), total(a) + total(b)).alias("f1"))


def class_weights(counts: DataFrame, missing_as_one: bool = False) -> DataFrame:
    """``score, n, weight`` from ``score, n``: inverse to the class's rows and adding up to the number of classes.

    A class without rows takes nearly the whole budget, or counts as one row with ``missing_as_one``.
    """
    c = F.greatest(F.col("n"), F.lit(1)) if missing_as_one else F.col("n")
    everything = Window.partitionBy()  # one row per class
    raw = F.sum("n").over(everything) / (CLASSES * c + F.lit(0.0 if missing_as_one else EPSILON))
    weighted = counts.withColumn("__raw", raw)
    return weighted.select("score", "n", (F.col("__raw") / F.sum("__raw").over(everything) * CLASSES).alias("weight"))


def moments(df: DataFrame, column: str = "score") -> DataFrame:
    """One row: mean and population deviation; NaN and null are left out."""
    return df.filter(F.col(column).isNotNull() & ~F.isnan(column)).agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"))


def cross_entropy(df: DataFrame, loss: Column, weight: Column, batch: Column) -> DataFrame:
    """One row ``loss``: the mean over batches of each batch's weighted mean."""
    per_batch = df.groupBy(batch.alias("__batch")).agg((F.sum(weight * loss) / F.sum(weight)).alias("l"))
    return per_batch.agg(F.avg("l").alias("loss"))


def early_stop(history: DataFrame, metric: str = "f1", epoch: str = "epoch", patience: int = 5) -> DataFrame:
    """``history`` with ``improved``, ``waited`` (epochs since the last strict improvement) and ``stop``. One row per epoch."""
    w = Window.partitionBy().orderBy(epoch)
    best = F.max(metric).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = history.withColumn("improved", best.isNull() | (F.col(metric) > best))
    last = F.max(F.when(F.col("improved"), F.col(epoch))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("waited", (F.col(epoch) - last).cast("long")).withColumn("stop", F.col("waited") >= patience)


def best_by_group(results: DataFrame, group: str, name: str, metric: str) -> DataFrame:
    """``group, name, metric`` of each group's best row; the first name on ties."""
    best = results.groupBy(group).agg(F.min(F.struct((-F.col(metric)).alias("m"), F.col(name).alias("n"))).alias("b"))
    return best.select(group, F.col("b.n").alias(name), (-F.col("b.m")).alias(metric))


def running_mean(steps: DataFrame, value: str, order: str, group: str) -> DataFrame:
    """``steps`` with ``running``: the mean so far in each group (a training run)."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return steps.withColumn("running", F.avg(value).over(w))
