"""Exploratory aggregates (EDA-1..7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import stage_table
from .rowindex import with_row_index


def conversation_lengths(utterances: DataFrame, key: str = "conv_id") -> DataFrame:
    """EDA-1: turns per conversation."""
    return utterances.groupBy(key).agg(F.count(F.lit(1)).alias("n_turns"))


def tokens_per_utterance(utterances: DataFrame, keys=("conv_id", "turn"), text: str = "text") -> DataFrame:
    """EDA-2: word tokens per utterance."""
    return utterances.select(*keys, F.size(T.tokenize(F.col(text))).alias("n_tokens"))


def units_per_utterance(utterances: DataFrame, keys=("conv_id", "turn"), text: str = "text") -> DataFrame:
    """EDA-3: blank-split units per utterance."""
    return utterances.select(*keys, T.unit_count(F.col(text)).alias("n_units"))


def histogram(df: DataFrame, col: str) -> DataFrame:
    """EDA-4: one bin per integer value."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """EDA-5: rows per category."""
    return df.groupBy(F.col(col).alias("category")).agg(F.count(F.lit(1)).alias("count"))


def concat_text(df: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """EDA-6: texts of a group joined by one blank in row order, a group's whole
    text in one row.  For groups of any size use ``text_parts``; for word
    statistics ``top_terms``, which needs no such row."""
    g = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, text))).alias("s"))
    return g.select(key, F.array_join(F.transform("s", lambda x: x[text]), " ").alias("text"))


def text_parts(df: DataFrame, key: str, order: list[str], text: str = "text", rows_a_part: int = 1000) -> DataFrame:
    """EDA-6: texts of a group joined by one blank in row order, in numbered
    parts of ``rows_a_part`` texts: (key, part, text).  The parts joined by a
    blank are the group's whole text; a group of any size is dealt over tasks.
    ``order`` with the key is a total order."""
    numbered = with_row_index(df.select(key, *order, text), [key, *order], "_i")
    numbered = stage_table(numbered, "texts")
    first = numbered.groupBy(key).agg(F.min("_i").alias("_first"))
    parts = numbered.join(first, key).withColumn("part", F.floor((F.col("_i") - F.col("_first")) / rows_a_part).cast("long"))
    g = parts.groupBy(key, "part").agg(F.array_sort(F.collect_list(F.struct("_i", text))).alias("s"))
    return g.select(key, "part", F.array_join(F.transform("s", lambda x: x[text]), " ").alias("text"))


def top_terms(df: DataFrame, key: str, text: str = "text", k: int = 200) -> DataFrame:
    """EDA-7: the k most frequent lowercased word tokens per group (ties by
    term); counts are partially aggregated before the shuffle and the
    per-group limit runs before the final exchange."""
    t = df.select(key, F.explode(T.tokenize(F.col(text))).alias("term"))
    c = t.groupBy(key, F.lower("term").alias("term")).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(key).orderBy(F.desc("count"), F.asc("term"))
    return c.select("*", F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)
