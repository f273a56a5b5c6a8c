"""A text classifier with six classes, trained with Spark's own learners, and grids of its settings."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcurate.functions import scores as S
from lexcurate.operators import metrics, statistics
from lexcurate.plans.lineage import tabled

MAX_TOKENS, FEATURES = 2048, 1 << 14


def _words(df: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    split = RegexTokenizer(inputCol="__text", outputCol="__all", pattern=r"[^\p{L}\p{N}]+", minTokenLength=1)
    return split.transform(df.withColumn("__text", text)).withColumn("words", F.slice("__all", 1, MAX_TOKENS)).drop("__text", "__all")


def weighted(train: DataFrame, missing_as_one: bool = False) -> DataFrame:
    """``train`` with ``weight``, inverse to the rows of its class; six weights in all."""
    weights = metrics.class_weights(statistics.histogram(train), missing_as_one).select(F.col("score").alias("__score"), "weight")
    return train.join(F.broadcast(weights), F.col("score").cast("int") == F.col("__score")).drop("__score")


def train(rows: DataFrame, features: int = FEATURES, regularisation: float = 0.01, iterations: int = 30, class_weights: bool = True) -> PipelineModel:
    """A model from ``text, score`` (0 to 5) rows; rows with another score are left out."""
    usable = rows.filter("score between 0 and 5").select("text", F.col("score").cast("int").alias("score"))
    usable = weighted(usable, missing_as_one=True) if class_weights else usable.withColumn("weight", F.lit(1.0))
    stages = [
        HashingTF(inputCol="words", outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(labelCol="score", featuresCol="features", weightCol="weight", regParam=regularisation, maxIter=iterations, family="multinomial"),
    ]
    return Pipeline(stages=stages).fit(tabled(_words(usable)))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``pred`` (class), ``predicted_score`` (mean class) and ``logits``; classes never seen in training are missing there."""
    out = model.transform(_words(rows)).withColumn("logits", vector_to_array("rawPrediction"))
    return out.select(*rows.columns, S.argmax_class(F.col("logits")).alias("pred"), S.expected_score(F.col("logits")).alias("predicted_score"), "logits")


def evaluate(model: PipelineModel, rows: DataFrame) -> dict[str, float]:
    """Accuracy, macro and weighted averages and binary F1 on ``text, score`` rows."""
    seen = tabled(predict(model, rows.filter("score between 0 and 5").select("text", "score")).select(F.col("score").cast("int").alias("label"), "pred"))
    return metrics.summary(seen).first().asDict() | {"binary_f1_3": metrics.binary_f1(seen).first()["f1"]}


def grid(train_rows: DataFrame, val_rows: DataFrame, options: Mapping[str, Sequence], done: Mapping[str, dict] | None = None) -> list[dict]:
    """One result per combination of ``options``; combinations named in ``done`` are taken from there."""
    results = []
    for values in itertools.product(*options.values()):
        config = dict(zip(options, values))
        name = ",".join(f"{k}={v}" for k, v in config.items())
        results.append((done or {}).get(name) or {"name": name, **evaluate(train(train_rows, **config), val_rows)})
    return results
