"""Conversation JSON source (SRC-7/8).

Layout ``<data_dir>/<split>/subtask_<n>/<split>.json``; each file is one
JSON array of conversations (or a folder of such files).  The schema is
declared, so missing keys become nulls.  A large array is read by many tasks:
``splittable.json_objects`` finds its objects, each is parsed on its own.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import conversations as C
from .splittable import json_objects


def conversation_path(data_dir: str, split: str, subtask: str) -> str:
    if subtask not in P.SUBTASKS:
        raise ValueError("invalid subtask type")
    if split not in P.SPLITS:
        raise ValueError("invalid split type")
    return os.path.join(data_dir, split, f"subtask_{subtask}", f"{split}.json")


def read_conversations(spark: SparkSession, data_dir: str, split: str, subtask: str) -> DataFrame:
    """SRC-7: conversations of one split with availability flags, video
    names (subtask 2) and ``split``."""
    path = conversation_path(data_dir, split, subtask)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(path)
    parsed = json_objects(spark, path).select(F.from_json("json", C.CONVERSATION).alias("c"))
    df = parsed.select("c.*")
    df = C.add_flags(df, split, subtask)
    df = C.fill_video(df, os.path.join(os.path.dirname(path), "video"), subtask)
    return df.withColumn("split", F.lit(split))


def read_all_splits(spark: SparkSession, data_dir: str, subtask: str) -> DataFrame:
    """SRC-8: train, trial and test, keyed by ``split`` (lazy union)."""
    parts = [read_conversations(spark, data_dir, s, subtask) for s in P.SPLITS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def to_json_lines(df: DataFrame, path: str) -> None:
    """One-off rewrite of array files to splittable JSON lines."""
    df.write.mode("overwrite").json(path)
