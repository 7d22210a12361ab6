"""User extension points (UDF-1..4), all expressed as Spark columns.

* UDF-1 custom token rules: ``quarry.functions.text.TokenRule`` lists are
  passed as ``AnalyzerOptions(rules=...)`` and compiled into one flag
  expression.
* UDF-2 custom row predicate: ``filter_with``.
* UDF-3 custom transform: any ``DataFrame -> DataFrame`` step, composed
  with ``sampling.chain``.
* UDF-4 custom metric / class weight: a function returning aggregate
  columns, run by ``custom_metric`` (partial aggregation applies).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_with(df: DataFrame, predicate: Column | Callable[[DataFrame], Column]) -> DataFrame:
    """Keep the rows accepted by ``predicate`` (a boolean Column, or a
    function of the DataFrame returning one)."""
    cond = predicate(df) if callable(predicate) else predicate
    return df.where(cond)


def custom_metric(df: DataFrame, metric: Callable[[], dict[str, Column]], by=()) -> DataFrame:
    """Evaluate a user metric given as named aggregate columns, optionally
    per group."""
    aggs = [c.alias(name) for name, c in metric().items()]
    return df.groupBy(*by).agg(*aggs)


def accuracy(pred: str = "pred", ref: str = "ref") -> Callable[[], dict[str, Column]]:
    """Example metric for ``custom_metric``: fraction of equal pairs."""
    return lambda: {"accuracy": F.avg((F.col(pred) == F.col(ref)).cast("double"))}
