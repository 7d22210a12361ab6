"""Loading the driver tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..session import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if spread_rows else df
