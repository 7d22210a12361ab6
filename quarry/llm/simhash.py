"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a nonzero vector of ``radius + 1`` bits; table ``v``
keeps the positions whose vector has an odd product with ``v``.  Any ``radius``
positions span less than the whole space, so some ``v`` is orthogonal to all of
them: every pair within the radius agrees in at least one of the
``2 ** (radius + 1) - 1`` tables.  Nothing is missed, whatever the data.

Only distinct fingerprints enter the tables.  A bucket of up to ``BUCKET``
fingerprints gives a spanning forest of its links (never its pairs).  The
fingerprints of larger buckets are linked exactly and in linear work by
midpoints instead: two fingerprints within four bits share one within two bits
of both, and all that share a midpoint are linked; a midpoint has at most as
many as there are fingerprints within half the radius (2,081).

Null or empty text: fingerprint zero, linked like any other.  Null ids take no
part in the smallest id.  Repeated rows are rows of their own with the same
component; further columns are not read."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, Stages, byte_texts, map_batches, table
from quarry.llm.components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Fingerprints of a bucket compared with each other in one task.
BUCKET = 2048
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash, as a signed integer."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined, size = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size).tolist()
    ends = ends[shingle - 1 :].tolist() or [len(joined)]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(ends), _CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k : k + _CHUNK], ends[k : k + _CHUNK])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (long) and text_hash of every row."""
    return map_batches(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")),
        lambda b: {"doc_id": b.column(0), "fp": [fingerprint(t, shingle) for t in byte_texts(b.column(1))], "text_hash": b.column(2)},
        "doc_id long, fp long, text_hash long",
    )


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(radius: int, bits: int = 64) -> list[int]:
    """The masks of the covering tables, as signed integers."""
    space = (1 << (radius + 1)) - 1
    return [signed(sum(1 << i for i in range(bits) if ((i % space + 1) & v).bit_count() % 2)) for v in range(1, space + 1)]


def _forest(radius: int):
    """Links within a bucket: each fingerprint is taken once, with those not
    yet reached that are within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for values in batch.column(0):
                rest = np.array(values.as_py(), np.int64)
                while len(rest):
                    queue, rest = [rest[0]], rest[1:]
                    while queue and len(rest):
                        x = queue.pop()
                        near = np.bitwise_count((rest ^ x).view(np.uint64)) <= radius
                        found, rest = rest[near], rest[~near]
                        a += [int(x)] * len(found)
                        b += found.tolist()
                        queue += list(found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _flips(radius: int) -> list[int]:
    return [signed(sum(1 << i for i in c)) for k in range(radius + 1) for c in combinations(range(64), k)]


def links(stages: Stages, distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect all fingerprints (column fp, distinct) within
    the radius of each other, directly or through others within it."""
    tables = F.array(*[F.struct(F.lit(i).cast("short").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks(radius))])
    entries = distinct.select("fp", F.explode(tables).alias("e")).select("fp", "e.t", "e.key")
    sizes = entries.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    # An estimate knows nothing of the rows an explode makes: neither side may be broadcast.
    members = stages.write(entries.join(sizes.hint("merge"), ["t", "key"]), "members")
    small = members.where(F.col("n") <= bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
    edges = small.mapInArrow(_forest(radius), "a long, b long")
    large = members.where(F.col("n") > bucket).select("fp").distinct()
    if not large.isEmpty():
        # Pairs at an odd radius need one midpoint closer to one side; its ball is the larger half.
        flips = F.explode(F.array(*[F.lit(x) for x in _flips((radius + 1) // 2)]))
        middles = large.select("fp", flips.alias("flip")).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"), "fp")
        shared = middles.groupBy("middle").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1").select("fps")
        edges = edges.union(shared.mapInArrow(_forest(radius), "a long, b long"))
    return edges


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable) of every row."""
    return component_rows(docs, shingle, radius, bucket).select("doc_id", "fp", "component_id")


def component_rows(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``near_duplicates`` with text_hash and root, a name that two components
    never share (component_id they may, where an id is repeated)."""
    spark = docs.sparkSession
    stages = Stages(spark, "simhash")
    rows = stages.write(fingerprints(docs, shingle), "fingerprints")
    classes = stages.write(rows.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "classes")
    roots = components(stages, links(stages, classes.select("fp"), radius, bucket))
    rooted = stages.write(
        classes.join(roots.hint("merge"), classes.fp == roots.node, "left").select("fp", "first_doc", F.coalesce("root", "fp").alias("root")), "rooted"
    )
    stages.drop("members")
    named = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_fp = rooted.join(named.hint("merge"), "root").select("fp", "root", "component_id")
    return rows.join(by_fp.hint("merge"), "fp").select("doc_id", "fp", "text_hash", "root", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")
