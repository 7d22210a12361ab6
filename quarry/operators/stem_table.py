"""The stem of every term seen, as a table that only new terms are added to
(TXT-11).

A run stems the terms that the table lacks and appends them; what is known is
never stemmed again.  A run that is repeated adds nothing, so a lost executor or
a replayed batch leaves the table as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .index import _exists
from .stemmer import stem_term


def read_stems(spark: SparkSession, path: str) -> DataFrame:
    """(term, stem) of all terms so far."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "term string, stem string")
    return spark.read.parquet(path).select("term", "stem")


def update_stems(terms: DataFrame, path: str) -> DataFrame:
    """Stem the distinct ``terms(term)`` that the table at ``path`` lacks."""
    spark = terms.sparkSession
    new = terms.select("term").where("term is not null").distinct().join(read_stems(spark, path), "term", "left_anti")
    stemmed = new.select("term", stem_term("term").alias("stem"))
    stemmed.sortWithinPartitions("term").write.mode("append").parquet(f"{path}/batch={uuid.uuid4().hex}")
    return read_stems(spark, path)


def stem_rows(tokens: DataFrame, stems: DataFrame) -> DataFrame:
    """Token rows with ``term`` replaced by its stem, joined from the table."""
    known = broadcast_if_small(stems.select("term", "stem"))
    return tokens.join(known, "term", "left").withColumn("term", F.coalesce("stem", "term")).select(*tokens.columns)
