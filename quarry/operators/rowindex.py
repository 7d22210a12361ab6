"""Dense 0-based row index in a total order, without a single-partition
window.

``row_number()`` over an un-partitioned window moves every row into one
task.  Instead: range-partition by the order key (sampled bounds), sort
inside each partition, number rows locally, and write that once to the shared
folder.  Counts per partition (one small row each) and rows are both read from
there, so they belong to the same bounds.  The counts become offsets, added
through a broadcast join whose size is the number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table


def with_row_index(df: DataFrame, order: list[Column | str], name: str = "idx",
                   num_partitions: int | None = None) -> DataFrame:
    """``df`` plus a column ``name`` = position in ``order`` (ascending;
    ``order`` must be a total order, e.g. end with a unique id)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    # monotonically_increasing_id = (partition id << 33) + position in partition
    local = ranged.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    local = stage_table(local, "rowindex").select("*", (F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)).alias("_local"))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))  # one row per partition
    out = local.join(F.broadcast(offsets), "_pid").select(
        *[F.col(c) for c in df.columns], (F.col("_off") + F.col("_local")).alias(name))
    return out
