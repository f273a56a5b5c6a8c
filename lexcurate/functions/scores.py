"""Classifier outputs as columns. Logits are arrays of doubles, one per class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

CLASSES = 6


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _exponentials(logits: Column) -> Column:
    return F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))


def softmax(logits: Column) -> Column:
    return F.transform(_exponentials(logits), lambda e: e / _sum(_exponentials(logits)))


def expected_score(logits: Column) -> Column:
    """Mean class under the softmax of the logits, between 0 and the last class."""
    e = _exponentials(logits)
    return _sum(F.transform(e, lambda x, i: x * i)) / _sum(e)


def argmax_class(logits: Column) -> Column:
    """Class of the largest logit, the lowest one on ties."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def linear_head(vector: Column, weights: Sequence[Sequence[float]], bias: Sequence[float]) -> Column:
    """Logits ``W x + b``."""
    dot = lambda row: _sum(F.zip_with(vector, F.array(*(F.lit(float(w)) for w in row)), lambda a, b: a * b))
    return F.array(*(dot(row) + F.lit(float(b)) for row, b in zip(weights, bias)))


def masked_mean(vectors: Column, mask: Column) -> Column:
    """Mean of the vectors whose mask is 1, by dimension; zeros if none is."""
    kept = F.transform(F.filter(F.arrays_zip(vectors.alias("v"), mask.alias("m")), lambda x: x["m"] == 1), lambda x: x["v"])
    total = F.aggregate(kept, F.transform(vectors[0], lambda x: x * 0.0), lambda a, v: F.zip_with(a, v, lambda p, q: p + q))
    return F.transform(total, lambda x: x / F.greatest(F.size(kept).cast("double"), F.lit(1e-9)))


def negative_log_likelihood(logits: Column, label: Column) -> Column:
    return F.log(_sum(_exponentials(logits))) - (F.get(logits, label) - F.array_max(logits))


def label_name(score: Column, threshold: float = 3.0) -> Column:
    return F.when(score >= threshold, F.lit("LEGAL")).otherwise(F.lit("NON-LEGAL"))
