"""Hard-negative mining by angular triangle filtering.

Every row stores its norm and its angles to a few reference directions.  For two
rows a, x and a reference r, the angle between a and x lies between
|angle(a, r) - angle(x, r)| and angle(a, r) + angle(x, r); the best of all
references gives an interval of the cosine, and times the norms one of the
score, widened by far more than rounding can move it.  Only where the interval
overlaps the scores that an anchor looks for are integer scores computed.

* **Index.** All rows are dealt by range of (nearest reference, angle to it) into
  shards of ``SHARD_BYTES`` at most, in the order of that angle.  A shard keeps
  the range of its norms and angles, and so does each ``BLOCK`` of its rows.
* **Search.** An anchor visits its own shard, which gives a first limit for the
  scores of its positives, then the shards whose intervals reach that limit, and
  with the windows of its positives the shards that overlap one of them.  Anchors
  stream past a shard in its task, so any number of them may visit; what leaves a
  task is the first few of each window, which one ranking joins.

The references are picked from ``SAMPLE`` rows with the smallest hashes of their
ids; they decide the speed, never the result.

Rows with a null id, label or vector, or with a component that is null or not
finite (also after scaling), take no part.  Shorter vectors are filled up with zeros.
Rows of one id are rows of their own; an anchor is no row of its own.  Ties go
to the smaller id, then to either of two equal rows.  A score beyond 2^53 is
computed in whole numbers; one beyond a long raises an error.  An empty table
gives no rows.  Further columns are not read."""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import Stages, table
from quarry.llm.decontaminate import measured_broadcast

REFERENCES, SAMPLE = 16, 1024
SHARD_BYTES = 64 << 20
#: Rows of a window within a shard, and anchors scored at a time.
BLOCK, GUESTS = 256, 64
#: Widening of a score's interval, as a share of the product of the norms.
SLACK = 1e-6
FAR = (1 << 63) - 1

FOUND = "anchor long, slot int, score long, row_id long, uid long"


def scaled(vector: Column) -> Column:
    """Components times 256, rounded down; null unless all are finite."""
    of = F.transform(vector, lambda x: 256 * x.cast("double"))
    bad = F.exists(of, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(of, lambda x: F.rint(x) - (F.rint(x) > x).cast("double")))


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """The vectors as rows of ``dim`` components."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes] or [sizes]).astype(int)] = flat
    return out


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` directions of the sample, each as far as can be from those before."""
    norms = np.linalg.norm(sample, axis=1)
    units = sample[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.eye(1, max(1, sample.shape[1]))[:, : sample.shape[1]]
    picked, near = [0], units @ units[0]
    while len(picked) < min(count, len(units)) and near.min() < 1 - 1e-9:
        picked.append(int(near.argmin()))
        near = np.maximum(near, units @ units[picked[-1]])
    return units[picked]


def with_angles(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """Adds ``norm``, ``angles`` to the references, the nearest one, ``ref``, and
    the angle to it, ``angle``."""
    dim = references.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vec"), dim)
            norms = np.linalg.norm(x, axis=1)
            angles = np.arccos(np.clip((x @ references.T) / np.where(norms > 0, norms, 1)[:, None], -1, 1))
            ref = angles.argmin(1) if len(x) else np.zeros(0, np.int64)
            nested = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * angles.shape[1]), pa.array(angles.ravel()))
            near = angles[np.arange(len(x)), ref]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norms), nested, pa.array(ref.astype(np.int32)), pa.array(near)], names=[*batch.schema.names, "norm", "angles", "ref", "angle"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, norm double, angles array<double>, ref int, angle double")


def bounds(norm: Column, angles: Column, low: Column, high: Column, least: Column, most: Column) -> tuple[Column, Column]:
    """The least and greatest score of a row with ``norm`` and ``angles`` and any
    of a shard with angles from ``low`` to ``high`` and norms from ``least`` to ``most``."""
    apart = F.array_max(F.zip_with(angles, F.arrays_zip(low.alias("low"), high.alias("high")), lambda a, r: F.greatest(r["low"] - a, a - r["high"], F.lit(0.0))))
    wide = F.array_min(F.zip_with(angles, F.arrays_zip(low.alias("low"), high.alias("high")), lambda a, r: F.least(a + r["high"], 2 * math.pi - a - r["low"], F.lit(math.pi))))
    up, down = F.cos(apart), F.cos(wide)
    room = SLACK * norm * most + 1
    return F.when(down > 0, down * least).otherwise(down * most) * norm - room, F.when(up > 0, up * most).otherwise(up * least) * norm + room


def block_bounds(norms: np.ndarray, angles: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for guests (rows) and blocks (columns)."""
    apart, wide = np.zeros((len(norms), len(least))), np.full((len(norms), len(least)), math.pi)
    for r in range(angles.shape[1]):
        a = angles[:, r, None]
        apart = np.maximum(apart, np.maximum(low[:, r] - a, a - high[:, r]))
        wide = np.minimum(wide, np.minimum(a + high[:, r], 2 * math.pi - a - low[:, r]))
    up, down, n = np.cos(apart), np.cos(wide), norms[:, None]
    room = SLACK * n * most + 1
    return np.where(down > 0, down * least, down * most) * n - room, np.where(up > 0, up * most, up * least) * n + room


def scores(a: np.ndarray, x: np.ndarray, limit: float) -> np.ndarray:
    """Inner products as whole numbers; ``limit`` is the greatest there can be."""
    if limit < 2**53:
        return (a @ x.T).astype(np.int64)
    whole = [[sum(int(u) * int(v) for u, v in zip(p, q, strict=True)) for q in x.tolist()] for p in a.tolist()]
    return np.array(whole, np.int64).reshape(len(a), len(x))  # raises beyond a long


class Shard:
    """The rows of one shard, by blocks with the ranges of their norms and angles."""

    def __init__(self, parts: list[pa.RecordBatch], dim: int):
        rows = pa.Table.from_batches(parts).combine_chunks()
        take = lambda name: rows[name].to_numpy()
        self.uid, self.row_id, self.label, self.norm = (take(x) for x in ("uid", "row_id", "label", "norm"))
        self.vec = np.concatenate([matrix(x, dim) for x in rows["vec"].chunks] or [np.zeros((0, dim))])
        angles = np.array(rows["angles"].to_pylist())
        at = np.arange(0, len(self.uid), BLOCK)
        self.low, self.high = (f.reduceat(angles, at) for f in (np.minimum, np.maximum))
        self.least, self.most = (f.reduceat(self.norm, at) for f in (np.minimum, np.maximum))

    def first(self, guests: pa.RecordBatch, dim: int, same: bool, k: int) -> list[tuple]:
        """The first k rows in each window of each guest."""
        vec, norms = matrix(guests.column("vec"), dim), guests.column("norm").to_numpy()
        wanted = guests.column("windows").to_pylist()
        least, most = (np.array([f(w[x] for w in windows) for windows in wanted], np.float64) for f, x in ((min, "low"), (max, "high")))
        down, up = block_bounds(norms, np.array(guests.column("angles").to_pylist()), self.low, self.high, self.least, self.most)
        overlap = (up >= least[:, None]) & (down <= most[:, None])
        table_of, known = np.zeros((len(vec), len(self.uid)), np.int64), np.zeros((len(vec), len(self.uid)), bool)
        for b in np.flatnonzero(overlap.any(0)).tolist():
            who, part = np.flatnonzero(overlap[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
            table_of[who, part] = scores(vec[who], self.vec[part], float(norms[who].max() * self.most[b]))
            known[who, part] = True
        out = []
        for g, (uid, label) in enumerate(zip(guests.column("uid").to_pylist(), guests.column("label").to_pylist(), strict=True)):
            score, fit = table_of[g], known[g] & ((self.label == label) == same) & (self.uid != uid)
            for w in wanted[g]:
                at = np.flatnonzero(fit & (score >= w["low"]) & (score <= w["high"]))
                if len(at) > k:
                    at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]
                at = at[np.lexsort((self.uid[at], self.row_id[at], -score[at]))][:k]
                out += [(uid, w["slot"], *x) for x in zip(score[at].tolist(), self.row_id[at].tolist(), self.uid[at].tolist(), strict=True)]
        return out


VISIT = ("uid", "row_id", "label", "vec", "norm", "angles")


def visit(shards: DataFrame, guests: DataFrame, n: int, dim: int, same: bool, k: int) -> DataFrame:
    """The first k rows of each window (slot, low, high) that each guest has, over
    the shards that it visits: of the guest's label, or of other labels."""
    names = [x.split()[0] for x in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, shard = None, [], None
        for batch in batches:
            keys = batch.column("shard").to_numpy() * 2 + batch.column("guest").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if keys[a] // 2 != at:
                    at, parts, shard = keys[a] // 2, [], None
                if keys[a] % 2 == 0:
                    parts.append(batch.slice(a, b - a))
                    continue
                shard = shard or Shard(parts, dim)
                for i in range(a, b, GUESTS):
                    rows = shard.first(batch.slice(i, min(GUESTS, b - i)), dim, same, k)
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if x == "slot" else pa.int64()) for x, c in zip(names, zip(*rows), strict=True)], names=names)

    windows = guests.schema["windows"].dataType
    own = shards.select("shard", F.lit(0).alias("guest"), "angle", *VISIT, F.lit(None).cast(windows).alias("windows"))
    come = guests.select("shard", F.lit(1).alias("guest"), F.lit(0.0).alias("angle"), *VISIT, "windows")
    # Shards that nobody visits stay where they are.
    visited = own.join(F.broadcast(guests.select("shard").distinct()), "shard", "left_semi") if n <= 4096 else own
    dealt = visited.unionByName(come).repartitionById(n, F.col("shard")).sortWithinPartitions("shard", "guest", "angle")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "row_id", "uid")
    return dealt.mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def window(slot: Column | int, low: Column, high: Column) -> Column:
    lit = slot if isinstance(slot, Column) else F.lit(slot)
    return F.struct(lit.cast("int").alias("slot"), low.cast("long").alias("low"), high.cast("long").alias("high"))


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """For each row that ``anchors`` holds for, and each of its first
    ``positives`` rows of its label, the first ``negatives`` rows of other labels
    whose score is ``low`` to ``high`` per cent of the positive's.  ``rows`` has
    row_id, label and vec, in whole numbers."""
    spark = rows.sparkSession
    stages = Stages(spark, "negatives")
    fit = rows.where("row_id is not null and label is not null and vec is not null").select("row_id", F.col("label").cast("long").alias("label"), "vec", F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    total = fit.agg(F.max(F.size("vec")).alias("dim"), F.sum(F.size("vec") + 8).alias("numbers")).first()
    dim = total.dim or 0
    sample = fit.select("row_id", "vec").orderBy(F.xxhash64("row_id"), "row_id", F.xxhash64("vec")).limit(SAMPLE).collect()
    references = spread(np.array([[*r.vec, *[0.0] * (dim - len(r.vec))] for r in sample], np.float64).reshape(len(sample), dim), REFERENCES)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-8 * (total.numbers or 0) // SHARD_BYTES))
    angled = with_angles(fit.withColumn("uid", F.monotonically_increasing_id()), references)
    shards = stages.write(angled.repartitionByRange(n, "ref", "angle", "uid").sortWithinPartitions("ref", "angle").withColumn("shard", F.spark_partition_id()), "shards")
    shards_of = max(n, (shards.agg(F.max("shard").alias("last")).first().last or 0) + 1)
    ranges = [F.array(*(f(F.get("angles", i)) for i in range(len(references)))).alias(x) for f, x in ((F.min, "angles_low"), (F.max, "angles_high"))]
    summary = measured_broadcast(stages.write(shards.groupBy("shard").agg(F.min("norm").alias("least"), F.max("norm").alias("most"), *ranges), "summary"))
    base = stages.write(shards.where("is_anchor").select("shard", *VISIT), "anchors")

    def guests(sought: DataFrame, home: bool) -> DataFrame:
        """The anchors at the shards that overlap one of their windows."""
        down, up = bounds(F.col("norm"), F.col("angles"), F.col("angles_low"), F.col("angles_high"), F.col("least"), F.col("most"))
        small = sought.select("uid", "norm", "angles", "windows", F.col("shard").alias("own"), F.explode(F.sequence(F.lit(0), F.lit(shards_of - 1))).alias("shard"))
        met = small.join(summary, "shard").withColumns({"down": down, "up": up})
        met = met.where(F.exists("windows", lambda w: (F.col("up") >= w.low) & (F.col("down") <= w.high)) & (F.lit(home) | (F.col("shard") != F.col("own"))))
        return met.select("uid", "shard", "windows").join(base.drop("shard"), "uid")

    open_ = base.withColumn("windows", F.array(window(0, F.lit(-FAR), F.lit(FAR))))
    near = stages.write(visit(shards, open_, shards_of, dim, True, positives), "near")
    limit = near.groupBy("anchor").agg(F.when(F.count("*") >= positives, F.min("score")).otherwise(F.lit(-FAR)).alias("limit"))
    sought = base.join(limit, F.col("anchor") == F.col("uid"), "left").withColumn("windows", F.array(window(0, F.coalesce("limit", F.lit(-FAR)), F.lit(FAR))))
    far = visit(shards, guests(sought, False), shards_of, dim, True, positives)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "row_id", "uid")
    first = near.drop("rank").unionByName(far.drop("rank")).withColumn("slot", F.row_number().over(order)).where(F.col("slot") <= positives)
    pairs = stages.write(first.select("anchor", "slot", F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    share = lambda percent: F.col("positive_score").cast("decimal(20,0)") * F.lit(Decimal(percent) / 100)
    edges = pairs.withColumns({"low": F.ceil(share(low)), "high": F.floor(share(high))}).where("low <= high")
    listed = edges.groupBy("anchor").agg(F.collect_list(window(F.col("slot"), F.col("low"), F.col("high"))).alias("windows"))
    found = visit(shards, guests(base.join(listed, F.col("anchor") == F.col("uid")).drop("anchor"), True), shards_of, dim, False, negatives)
    named = found.join(pairs, ["anchor", "slot"]).join(base.select(F.col("uid").alias("anchor"), F.col("row_id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label").cast("long") + 1, F.lit(10))).otherwise(F.col("label"))
    prepared = rows.select(F.col("vec_id").cast("long").alias("row_id"), label.cast("long").alias("label"), scaled(F.col("embedding")).alias("vec"))
    return mine(prepared, F.col("row_id") % 100 == 0)


def oracle() -> str:
    return """
WITH e AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.uid, a.vec_id AS anchor_id, x.uid AS other, x.vec_id, a.label = x.label AS same, CAST(list_inner_product(a.v, x.v) AS BIGINT) AS score
  FROM e a JOIN e x ON a.uid <> x.uid WHERE a.vec_id % 100 = 0),
p AS (SELECT uid, anchor_id, other, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id, other) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.uid, p.other ORDER BY s.score DESC, s.vec_id, s.other) AS rank,
         s.vec_id AS negative_id, positive_score, s.score AS negative_score
  FROM p JOIN s ON p.uid = s.uid AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
