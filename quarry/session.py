"""Session helpers: building a session, the shared checkpoint folder and
size-checked broadcasting."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Broadcast only below this many rows (sides whose size is counted first).
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20
# Known row counts up to this are broadcast without measuring their bytes.
UNMEASURED_ROWS = 20_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    b = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    )
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, shared: str | None = None) -> str:
    """The cluster names a shared folder in ``spark.checkpoint.dir``; use it.
    Where that is unset, ``shared`` (a folder that all executors reach) is
    used; only a local master, as in tests, gets a fresh scratch folder."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or shared or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir, or pass a folder that all executors reach")
        current = tempfile.mkdtemp(prefix="quarry-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


@contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Inside, the shuffle files of an action go as soon as it has ended: what
    is needed later has been written to the shared folder."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: what follows
    sees the same rows however often it reads them."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/quarry-{name}-{uuid.uuid4().hex}"
    with shuffle_cleanup(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """Roughly the bytes of a row in memory: the lengths of texts, 32 for an
    element of an array, 8 for any other value, and 16 for the row."""
    sizes = [F.octet_length(F.col(f"`{c}`")) if t in ("string", "binary") else F.size(F.col(f"`{c}`")) * 32 if t.startswith("array") else F.lit(8) for c, t in df.dtypes]
    return reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0)).cast("long") for x in sizes], F.lit(16).cast("long"))


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, known_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` only where its rows (counted, or a proven bound passed as
    ``known_rows``) and its measured bytes allow; otherwise leave the join
    strategy to the planner (shuffle join).  A few rows are not measured."""
    if known_rows is not None and (known_rows > max_rows or known_rows <= UNMEASURED_ROWS):
        return F.broadcast(df) if known_rows <= UNMEASURED_ROWS else df
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if size.n <= max_rows and size.bytes <= BROADCAST_MAX_BYTES else df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the cluster only when its scan yields fewer
    partitions than there are cores (one big row group, a single JSON
    array file).  With many input files this is a no-op, so no shuffle is
    added at scale."""
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
