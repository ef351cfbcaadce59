"""Expressions over score vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenframe.functions.pixels import map_with


def dot(features: Column, weights: list[float], bias: float) -> Column:
    """Linear score, summed in element order in double precision."""
    product = F.zip_with(features, F.lit(list(weights)).cast("array<double>"), lambda x, w: x.cast("double") * w)
    return F.aggregate(product, F.lit(0.0), lambda a, v: a + v) + F.lit(float(bias))


def softmax(logits: Column) -> Column:
    """Probabilities, shifted by the largest logit."""
    powers = map_with(logits, lambda z, s: F.exp(z - s["top"]), top=F.array_max(logits))
    total = F.aggregate(powers, F.lit(0.0), lambda a, v: a + v)
    return map_with(powers, lambda x, s: x / s["total"], total=total)


def argmax(values: Column) -> Column:
    """Zero-based index of the first largest value."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def label_of(index: Column, labels: tuple[str, ...], unknown: str = "UNKNOWN") -> Column:
    names = F.array(*[F.lit(name) for name in labels])
    return F.coalesce(F.get(names, index), F.lit(unknown))
