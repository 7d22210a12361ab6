"""Splitting, shuffling, batching and class weights (SMP-1..5, WGT-1..3).

Randomness is a hash of (seed, id), so every split and order is
deterministic, reproducible after executor loss and checkable in SQL.
Global positions come from the distributed row index.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from .rowindex import with_row_index


def hash_key(seed: int, id_col: Column) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.lit("|"), id_col.cast("string")))


def split_sizes(n: int, fractions: list[float]) -> list[int]:
    """floor(n·f) each, the remainder given one at a time from the first."""
    if abs(sum(fractions) - 1.0) > 1e-9:
        raise ValueError("fractions must sum to 1")
    sizes = [int(n * f) for f in fractions]
    for i in range(n - sum(sizes)):
        sizes[i % len(sizes)] += 1
    return sizes


def split_exact(df: DataFrame, fractions: list[float], seed: int = P.SEED, id_col: str = "id",
                names: list[str] | None = None) -> DataFrame:
    """SMP-1: disjoint, covering split with exact sizes; adds ``split``."""
    names = names or [str(i) for i in range(len(fractions))]
    idx = with_row_index(df, [hash_key(seed, F.col(id_col)), F.col(id_col)], "_i")
    n = df.count()
    bounds, acc = [], 0
    for s in split_sizes(n, fractions):
        acc += s
        bounds.append(acc)
    label = F.lit(names[-1])
    for b, nm in reversed(list(zip(bounds[:-1], names[:-1]))):
        label = F.when(F.col("_i") < b, F.lit(nm)).otherwise(label)
    return idx.select(*df.columns, label.alias("split"))


def shuffle(df: DataFrame, seed: int = P.SEED, id_col: str = "id", name: str = "order") -> DataFrame:
    """SMP-2: seeded permutation; ``name`` is the 0-based shuffled position."""
    return with_row_index(df, [hash_key(seed, F.col(id_col)), F.col(id_col)], name)


def assign_batches(df: DataFrame, size: int = P.BATCH_SIZE, drop_last: bool = False, order_col: str = "order") -> DataFrame:
    """SMP-3: consecutive batches of ``size`` in ``order_col`` order; with
    ``drop_last`` the short tail batch is removed."""
    out = df.select("*", F.floor(F.col(order_col) / size).cast("long").alias("batch_id"),
                    (F.col(order_col) % size).cast("int").alias("in_batch"))
    if drop_last:
        full = (df.count() // size) * size
        out = out.where(F.col(order_col) < full)
    return out


def collate(df: DataFrame, cols: list[str], batch_col: str = "batch_id", order_col: str = "in_batch") -> DataFrame:
    """SMP-4: one row per batch, each column stacked in batch order (a batch
    holds at most ``size`` rows)."""
    g = df.groupBy(batch_col).agg(F.sort_array(F.collect_list(F.struct(order_col, *cols))).alias("_rows"))
    def field(c):
        return F.transform("_rows", lambda r: r[c]).alias(c)

    return g.select(batch_col, F.size("_rows").alias("batch_len"), *[field(c) for c in cols])


def chain(*fns):
    """SMP-5 / UDF-3: compose DataFrame → DataFrame steps left to right."""
    return lambda df: reduce(lambda acc, f: acc.transform(f), fns, df)


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """WGT-1: count per label for every label 0..max (absent labels → 0)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    top = df.agg(F.max(label).alias("m"))
    labels = top.select(F.explode(F.sequence(F.lit(0), F.col("m"))).alias(label))
    return labels.join(counts, label, "left").select(label, F.coalesce("count", F.lit(0)).alias("count"))


def balanced_weights(df: DataFrame, label: str = "label", num_classes: int | None = None) -> DataFrame:
    """WGT-2: n / (classes · count) per class; every class 0..num_classes-1
    must be present, else the query fails."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    tot = counts.agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("k"))
    k_expected = F.lit(num_classes) if num_classes is not None else F.col("k")
    j = counts.crossJoin(F.broadcast(tot))  # one-row side
    w = F.col("n") / (k_expected * F.col("count"))
    checked = F.when(F.col("k") != k_expected,
                     F.raise_error(F.lit("samples_per_class does not match num_classes")).cast("double")).otherwise(w)
    return j.select(F.col(label), checked.alias("weight"))


def apply_weights(df: DataFrame, weights: DataFrame, label: str = "label") -> DataFrame:
    """WGT-3: attach each row's class weight (weights: one row per class)."""
    return df.join(F.broadcast(weights.select(label, "weight")), label, "left")
