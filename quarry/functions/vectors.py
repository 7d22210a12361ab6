"""Array maths as built-in higher-order expressions (VEC-1..5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(arr: Column) -> Column:
    return F.transform(arr, lambda x: x.cast("double"))


def logsumexp(arr: Column) -> Column:
    m = F.array_max(arr)
    return m + F.log(F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + F.exp(x - m)))


def softmax(arr: Column) -> Column:
    """VEC-1: softmax over the array (shifted by its maximum)."""
    m = F.array_max(arr)
    z = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + F.exp(x - m))
    return F.transform(arr, lambda x: F.exp(x - m) / z)


def argmax(arr: Column) -> Column:
    """VEC-2: 0-based position of the first maximum."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def cross_entropy(logits: Column, label: Column) -> Column:
    """VEC-5: log-sum-exp minus the logit of the label (label 0-based)."""
    return logsumexp(logits) - F.element_at(logits, label.cast("int") + 1)


def concat_features(*arrays: Column) -> Column:
    """VEC-4: concatenation in argument order (probabilities first)."""
    return F.concat(*arrays)
