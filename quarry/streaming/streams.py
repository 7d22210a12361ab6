"""Structured Streaming re-aims (STR-1..3).

* ``stream_queries`` — query lines arrive as text files; each micro-batch
  is answered by ``run_queries`` against a static index inside
  ``foreachBatch`` and appended to a parquet result table keyed by batch.
* ``stream_index`` — documents arrive as a stream; each micro-batch's
  postings are written to their own ``batch_id`` partition with dynamic
  partition overwrite, so a replayed batch replaces itself (idempotent).
  Its term and collection statistics are written beside them as deltas that
  add up; ``compact_stream_index`` sums the deltas so far into a base.  Reading
  the index sums base and later deltas and opens no postings.
* ``stream_mean`` — running mean of a value per key, reset by each new epoch
  (streaming aggregation with state in the checkpoint, update mode); a
  micro-batch writes the keys it has changed, and no others.

Checkpoints and outputs live under the session's shared checkpoint folder
unless a path is given.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import index as I
from ..operators.analyzer import AnalyzerOptions
from ..operators.search import run_queries
from ..session import ensure_checkpoint_dir, spread
from ..sources.splittable import number_lines, text_blocks


def _scratch(spark: SparkSession, name: str) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/quarry-{name}-{uuid.uuid4().hex}"


def stream_queries(spark: SparkSession, query_dir: str, index: I.Index, out_path: str | None = None,
                   stem: bool = True, k: int = 10, max_files_per_trigger: int = 1,
                   available_now: bool = True):
    """STR-1: answer every query line of files arriving in ``query_dir``.
    Returns (streaming query handle, result path)."""
    out_path = out_path or _scratch(spark, "stream-results")
    ckpt = out_path.rstrip("/") + "-ckpt"
    lines = text_blocks(spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger).load(query_dir))

    def answer(batch: DataFrame, batch_id: int) -> None:
        numbered = number_lines(batch).withColumnRenamed("value", "query").where(F.length("query") > 0)
        queries = numbered.select(F.xxhash64("source", "line_no").alias("query_id"), "query")  # as ``read_queries``
        res = run_queries(index, queries, k=k, stem=stem).withColumn("batch_id", F.lit(batch_id))
        (res.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))

    w = lines.writeStream.foreachBatch(answer).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start(), out_path


def stream_index(spark: SparkSession, docs_stream: DataFrame, index_path: str, opts: AnalyzerOptions | None = None,
                 available_now: bool = True, id_col: str = "doc_id", text_col: str = "text"):
    """STR-2: postings and statistics of each micro-batch land in
    ``<table>/batch_id=N`` (replays overwrite their own partition).  A document
    arrives once.  Returns the query handle."""
    ckpt = index_path.rstrip("/") + "-ckpt"

    def index_batch(batch: DataFrame, batch_id: int) -> None:
        def put(df: DataFrame, name: str) -> None:
            (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(os.path.join(index_path, name)))

        src = spread(batch).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                                   F.col(id_col).cast("string").alias("filepath"))
        put(I.document_postings(src, opts).sortWithinPartitions("term", "doc_id"), "postings")
        # the rest comes from the written postings: one analysis a batch
        session = batch.sparkSession
        path = os.path.join(index_path, "postings", f"batch_id={batch_id}")
        written = session.read.parquet(path) if I._exists(session, path) else None
        if written is None:  # no tokens in the whole batch
            lengths = None
        else:
            lengths = I.lengths_from_postings(written)
            put(I.term_stats(written), "term_deltas")
            put(lengths.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("sum_ttf")), "length_deltas")
        docs = I.build_docs(src)
        columns = ("n_tokens", "n_overlap", "dl_exact", "norm", "dl")
        if lengths is not None:
            docs = docs.join(lengths, "doc_id", "left").select(*docs.columns, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in columns])
        else:
            docs = docs.select("*", *[F.lit(0).alias(c) for c in columns])
        put(docs, "docs")

    w = docs_stream.writeStream.foreachBatch(index_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


_DELTAS = {"term": (["term"], ["df", "ttf"]), "length": ([], ["n_docs", "sum_ttf"])}


def _base_batch(spark: SparkSession, index_path: str) -> int:
    """The last batch that the base holds; -1 without one.  A base counts once
    all of its tables are written."""
    fs, path = I._fs(spark, os.path.join(index_path, "base"))
    if not fs.exists(path):
        return -1
    done = [s.getPath().getName() for s in fs.listStatus(path)]
    done = [int(n.split("=")[1]) for n in done if I._exists(spark, os.path.join(index_path, "base", n, "done"))]
    return max(done, default=-1)


def _merged(spark: SparkSession, index_path: str, name: str, upto: int | None = None) -> DataFrame:
    """Base and later deltas of one statistic, summed up."""
    keys, sums = _DELTAS[name]
    base = _base_batch(spark, index_path)
    rows = spark.read.parquet(os.path.join(index_path, f"{name}_deltas")).where(F.col("batch_id") > base)
    if upto is not None:
        rows = rows.where(F.col("batch_id") <= upto)
    rows = rows.select(*keys, *sums)
    if base >= 0:
        rows = rows.unionByName(spark.read.parquet(os.path.join(index_path, "base", f"upto={base}", name)))
    return rows.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])


def compact_stream_index(spark: SparkSession, index_path: str) -> int:
    """Sum the deltas so far into a new base; returns its last batch.  Batches
    that arrive meanwhile stay deltas, and a reader sees the old base until the
    new one is whole."""
    deltas = spark.read.parquet(os.path.join(index_path, "length_deltas"))
    last = deltas.agg(F.max("batch_id").alias("last")).first().last
    if last is None or last <= _base_batch(spark, index_path):
        return _base_batch(spark, index_path)
    at = os.path.join(index_path, "base", f"upto={last}")
    for name in _DELTAS:
        _merged(spark, index_path, name, last).write.mode("overwrite").parquet(os.path.join(at, name))
    fs, done = I._fs(spark, os.path.join(at, "done"))
    fs.create(done).close()
    return last


def read_stream_index(spark: SparkSession, index_path: str) -> I.Index:
    """The streamed index; its statistics are sums of the deltas."""
    postings = spark.read.parquet(os.path.join(index_path, "postings")).drop("batch_id")
    docs = spark.read.parquet(os.path.join(index_path, "docs")).drop("batch_id")
    lengths = _merged(spark, index_path, "length")
    average = F.when(F.col("n_docs") > 0, F.col("sum_ttf") / F.col("n_docs")).otherwise(F.lit(0.0))
    return I.Index(postings, _merged(spark, index_path, "term"), docs, lengths.select("n_docs", "sum_ttf", average.alias("avgdl")))


def stream_mean(df_stream: DataFrame, value: str, by: list[str], out_path: str | None = None,
                available_now: bool = True, epoch: str | None = None):
    """STR-3: running mean of ``value`` per ``by`` (state kept by Spark in
    the checkpoint).  A trigger writes the keys it has changed to
    ``batch_id=N`` of the table at ``out_path`` (``read_means`` reads the
    latest).  ``epoch`` names a column of whole numbers: a new epoch starts
    from nothing, the state of earlier ones is dropped, and rows of an epoch
    that has ended are ignored.  Returns (query handle, out_path)."""
    spark = df_stream.sparkSession
    out_path = out_path or _scratch(spark, "stream-mean")
    keys = list(by)
    if epoch:  # epochs as event time: the watermark ends the earlier ones
        df_stream = df_stream.withColumn("_epoch", F.timestamp_seconds(F.col(epoch))).withWatermark("_epoch", "0 seconds")
        keys.append("_epoch")
    agg = df_stream.groupBy(*keys).agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n"))

    def publish(batch: DataFrame, batch_id: int) -> None:
        if epoch:
            batch = batch.withColumn("_epoch", F.unix_seconds("_epoch")).withColumnRenamed("_epoch", epoch)
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path))

    w = (agg.writeStream.outputMode("update").foreachBatch(publish)
         .option("checkpointLocation", out_path.rstrip("/") + "-ckpt"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start(), out_path


def read_means(spark: SparkSession, out_path: str, by: list[str], epoch: str | None = None) -> DataFrame:
    """The latest mean of every key (of its latest epoch)."""
    rows = spark.read.parquet(out_path)
    values = [c for c in rows.columns if c not in (*by, "batch_id")]
    order = F.struct(*([epoch] if epoch else []), "batch_id")
    return rows.groupBy(*by).agg(F.max_by(F.struct(*values), order).alias("_v")).select(*by, "_v.*")
