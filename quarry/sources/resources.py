"""Stopword and synonym resources (SRC-9/10) and query files (SRC-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .splittable import read_lines

# Resources end up as literal sets inside the analyser expressions; they are
# counted first and must stay below this size.
MAX_RESOURCE_ROWS = 200_000


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_stopwords(spark: SparkSession, path: str, required: bool = True) -> DataFrame | None:
    """SRC-9: one word per line, trimmed, case-sensitive.  A missing file is
    an error unless ``required=False`` (then the filter is off: None)."""
    if not _exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return None
    t = spark.read.text(path)
    return t.select(F.trim("value").alias("word")).where(F.length("word") > 0).distinct()


def stopword_list(words: DataFrame | None) -> tuple[str, ...]:
    """Bounded resource → tuple for the analyser (size checked)."""
    if words is None:
        return ()
    n = words.count()
    if n > MAX_RESOURCE_ROWS:
        raise ValueError(f"stopword list too large: {n} rows")
    return tuple(sorted(r[0] for r in words.collect()))


def read_synonyms(spark: SparkSession, path: str, required: bool = True) -> DataFrame | None:
    """SRC-10: ``left right`` per line split on one blank; words of a
    multi-word form are joined by NUL; pairs are directed."""
    if not _exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return None
    t = spark.read.text(path)
    parts = F.split("value", " ", 2)
    return t.select(F.element_at(parts, 1).alias("term"), F.try_element_at(parts, F.lit(2)).alias("synonym")).where(
        F.col("term").isNotNull() & F.col("synonym").isNotNull() & (F.length("term") > 0))


def synonym_map(syn: DataFrame | None) -> dict[str, list[str]]:
    """Bounded resource → {left: [right, …]} (lowercased, size checked)."""
    if syn is None:
        return {}
    n = syn.count()
    if n > MAX_RESOURCE_ROWS:
        raise ValueError(f"synonym list too large: {n} rows")
    out: dict[str, list[str]] = {}
    for r in syn.select(F.lower("term").alias("t"), F.lower("synonym").alias("s")).collect():
        out.setdefault(r.t, []).append(r.s)
    return out


def read_queries(spark: SparkSession, paths) -> DataFrame:
    """SRC-11: query lines of every file under ``paths`` (files or trees);
    empty lines dropped (no trimming).  ``query_id`` is stable: a hash of
    (file, line number).  A large file is read by many tasks."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    for p in paths:
        if not _exists(spark, p):
            raise FileNotFoundError(p)
    lines = read_lines(spark, paths).withColumnRenamed("value", "query").where(F.length("query") > 0)
    return lines.select(F.xxhash64("source", "line_no").alias("query_id"), "source", "line_no", "query")
