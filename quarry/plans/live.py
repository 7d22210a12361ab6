"""Registered streaming plans (STR-1..3): each stream runs to completion
with an ``availableNow`` trigger and the registered query reads the
stream's output table.  Streamed index statistics and running means must
equal the batch results, so they share the batch SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import index as I
from ..operators.analyzer import AnalyzerOptions
from ..session import ensure_checkpoint_dir
from ..sources import resources as SR
from ..streaming import streams as ST
from . import retrieval as R
from .tables import load


def _scratch(spark, name):
    import uuid

    return ensure_checkpoint_dir(spark).rstrip("/") + f"/quarry-{name}-{uuid.uuid4().hex}"


def stream_queries(spark, sf):
    """STR-1: benchmark passages written as query files (one line = one
    query), answered micro-batch by micro-batch; each distinct line's hits."""
    qdir = _scratch(spark, "query-files")
    load(spark, sf, "benchmark").select("text").repartition(4).write.text(qdir)
    handle, out = ST.stream_queries(spark, qdir, R._index(spark, sf), stem=False)
    handle.awaitTermination()
    hits = spark.read.parquet(out).select("query_id", "rank", "doc_id", "filepath", "score", "total_hits", "status")
    return hits.join(SR.read_queries(spark, qdir).select("query_id", "query"), "query_id").drop("query_id").distinct()


def _table_stream(spark, sf, name):
    """A table as a stream of files: one file a trigger, or of a folder of part
    files as many as the cluster has cores."""
    path = f"{sf.rstrip('/')}/{name}.parquet"
    rows = spark.readStream.schema(load(spark, sf, name).schema)
    if I._is_dir(spark, path):
        return rows.option("maxFilesPerTrigger", spark.sparkContext.defaultParallelism).parquet(path)
    return rows.option("pathGlobFilter", f"{name}.parquet").option("maxFilesPerTrigger", 1).parquet(sf)


def stream_index_terms(spark, sf):
    """STR-2: index built from a document stream; its term statistics."""
    docs = _table_stream(spark, sf, "documents")
    out = _scratch(spark, "stream-index")
    ST.stream_index(spark, docs, out, AnalyzerOptions(stem=False)).awaitTermination()
    return ST.read_stream_index(spark, out).terms.select("term", "df", "ttf")


def stream_mean(spark, sf):
    """STR-3: running mean of event values per event type."""
    handle, out = ST.stream_mean(_table_stream(spark, sf, "events"), "value", ["event_type"])
    handle.awaitTermination()
    return ST.read_means(spark, out, ["event_type"]).select("event_type", F.round("value", 6).alias("value"), "n")


QUERIES = {"stream_queries": stream_queries, "stream_index_terms": stream_index_terms, "stream_mean": stream_mean}

_LINES = """qlines AS (SELECT DISTINCT line FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark)
  WHERE length(line) > 0), """

SQL = {
    "stream_queries": f"SELECT * RENAME (query_id AS query) FROM ({R.search_sql('qlines', 'line', 'line', _LINES)})",
    "stream_index_terms": R.SQL["term_stats"],
    "stream_mean": "SELECT event_type, round(avg(value), 6) AS value, count(*) AS n FROM events GROUP BY event_type",
}
