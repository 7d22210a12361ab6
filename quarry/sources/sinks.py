"""Sinks: index tables (SNK-1/2 live in ``operators.index``), token dump
(SNK-3), result listing (SNK-4, ``operators.search.format_results``) and the
metric log (SNK-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.analyzer import explode_tokens
from ..operators.index import read_index, write_index  # noqa: F401  (re-exported)
from ..operators.search import format_results  # noqa: F401  (re-exported)


def token_dump(analyzed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """SNK-3: ``[term]: [flags] isFinal`` per surviving token, in order."""
    t = explode_tokens(analyzed, id_col)
    line = F.concat(F.lit("["), F.col("term"), F.lit("]: ["), F.array_join("flags", ", "), F.lit("] "),
                    F.when(F.col("is_final"), F.lit("true")).otherwise(F.lit("false")))
    return t.select(id_col, "pos", "ord", line.alias("line"))


def append_metrics(metrics: DataFrame, path: str) -> None:
    """SNK-5: append (split, metric, step, value) rows, partitioned by split."""
    need = {"split", "metric", "step", "value"}
    missing = need - set(metrics.columns)
    if missing:
        raise ValueError(f"metrics lack columns {sorted(missing)}")
    metrics.select("split", "metric", F.col("step").cast("int"), F.col("value").cast("double")).write.mode(
        "append").partitionBy("split").parquet(path)
