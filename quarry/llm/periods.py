"""Periodic runs by scale-tiled distribution.

A run is a stretch of words with smallest period q, four periods and six words
long at least, that no neighbouring word extends.  Written as a *match stretch*
it is the interval of places i with word[i] = word[i + q].

* **Tiles.** Periods are taken by octave, 2^k up to 2^(k+1).  A document is
  exploded into tiles for its octaves: a core of words, and margins as wide as
  the octave's windows.  Octaves whose windows fit into ``TILE`` words share a
  tile; a document of up to ``TILE`` words is one tile, solved where it was cut.
  The tiles of longer documents are shuffled one by one, so that many tasks work
  on one document.
* **Boundaries.** A tile has a boundary at each multiple of 2^k.  A run of the
  octave holds two whole blocks of 2^k matches that begin at boundaries, so one
  comparison of window hashes for each word finds all (boundary, period) pairs;
  the forward and backward Z values of these pairs, up to four blocks each way,
  give the fragment of the match stretch around the boundary.  Fragments whose
  block is a power of a shorter one belong to a lower octave and are left to it.
* **Stitching.** Fragments that touch, of one document and period, are the same
  stretch: they are shuffled by (document, period) and joined there.

Hashes only propose: every fragment is compared word by word, and a tile with a
mismatch is solved again by comparing words.

Null or empty text: no words, no runs.  Repeated rows and rows without an id are
judged row by row.  A text of any length is split into tiles; the task that
reads it holds it once.  Further columns are not read."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import Stages, map_batches, mix64, table

#: Words of a tile's core; octaves of up to a quarter of it share a tile.
TILE = 1 << 14
MIN_EXPONENT, MIN_LENGTH = 4, 6
_ODD = np.uint64(0x9E3779B97F4A7C15)

FRAGMENT = "period long, first long, last long"
CUT = (
    "rid long, doc_id long, n_words long, plain_sha256 string, text string, "
    "fragments array<struct<period:long,first:long,last:long>>, lo int, hi int, origin long, start long, stop long, ids binary"
)

#: For a document's id and number of words, the words to read, in order; None for all as they stand.
Order = Callable[[int | None, int], "np.ndarray | None"]


def cut(n: int, tile: int = TILE) -> Iterator[tuple[int, int, int, int, int, int]]:
    """The tiles (lowest and highest octave, core start and stop, first and last
    word) of a document of n words."""
    if n < MIN_LENGTH:
        return
    top = (n // MIN_EXPONENT).bit_length() - 1
    shared = min(top, (tile // 4).bit_length() - 1)
    for lo, hi in [(0, shared), *((k, k) for k in range(shared + 1, top + 1))]:
        core, block = max(tile, 4 << hi), 1 << hi
        for start in range(0, n, core):
            yield lo, hi, start, min(n, start + core), max(0, start - 4 * block), min(n, start + core + 6 * block)


@lru_cache(maxsize=2)
def powers(n: int) -> np.ndarray:
    """Powers 0 to n of the base, modulo 2^64."""
    out = np.full(n + 1, _ODD)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=2)
def least_primes(n: int) -> np.ndarray:
    """The smallest prime factor of each number below n."""
    out = np.arange(n)
    for r in range(2, int(n**0.5) + 1):
        if out[r] == r:
            part = out[r * r :: r]
            part[part == np.arange(r * r, n, r)] = r
    return out


class Hashed:
    """Equality of windows by a polynomial hash over prefix sums."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.n, self.powers = n, powers(1 << n.bit_length())
        values = mix64(ids.astype(np.uint64) + _ODD) * self.powers[:n]
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))

    def same(self, i: np.ndarray, j: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Whether the windows at i and j (i <= j) of that size are equal."""
        return (self.sums[i + size] - self.sums[i]) * self.powers[j - i] == self.sums[j + size] - self.sums[j]

    def equal_blocks(self, first: int, blocks: int, block: int) -> np.ndarray:
        """For each boundary first + b * block and r < block, whether the windows
        of a block at the boundary and at block + r words behind it are equal."""
        gaps = self.sums[block:] - self.sums[:-block]
        there = gaps[first + block : first + block * (blocks + 1)]
        here = gaps[first : first + block * blocks : block]
        whole = len(there) // block
        out = there[: whole * block].reshape(whole, block) == here[:whole, None] * self.powers[block : 2 * block]
        rest = there[whole * block :] == here[whole : whole + 1] * self.powers[block : block + len(there) - whole * block]
        return np.concatenate((out.ravel(), rest))


class Compared(Hashed):
    """The same by comparing words, for tiles whose hashes collide."""

    def __init__(self, ids: np.ndarray):
        super().__init__(ids)
        self.ids = ids

    def same(self, i: np.ndarray, j: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        places = zip(*(x.tolist() for x in np.broadcast_arrays(i, j, size)), strict=True)
        return np.array([bool((self.ids[a : a + s] == self.ids[b : b + s]).all()) for a, b, s in places], bool)


def z_values(words: Hashed, c: np.ndarray, p: np.ndarray, octave: int, forward: bool) -> np.ndarray:
    """Z values of the boundaries c at the shifts p: how many words from c on
    (or before c) equal those p words further, 4 * 2^octave - 1 at most."""
    z = np.zeros(len(c), np.int64)
    for j in range(octave + 1, -1, -1):
        step = 1 << j
        at = c + z if forward else c - z - step
        inside = at + p + step <= words.n if forward else at >= 0
        found = np.flatnonzero(inside)
        z[found[words.same(at[found], (at + p)[found], step)]] += step
    return z


def primitive(words: Hashed, c: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Whether the block of p words at c is no power of a shorter block."""
    out, rest = np.ones(len(p), bool), p.copy()
    primes = least_primes(1 << int(p.max()).bit_length()) if len(p) else rest
    while (rest > 1).any():
        r = primes[rest]
        part = np.flatnonzero(rest > 1)
        q = p[part] // r[part]
        out[part[words.same(c[part], c[part] + q, p[part] - q)]] = False
        rest = np.where(rest > 1, rest // np.maximum(r, 1), rest)
    return out


def fragments(ids: np.ndarray, origin: int, start: int, stop: int, lo: int, hi: int, kind: type[Hashed] = Hashed) -> np.ndarray:
    """Rows (period, first, last) of match stretches in a tile: whole ones, and
    pieces that a window's edge has cut; places count from the document's start."""
    words, found = kind(ids), []
    for k in range(lo, hi + 1):
        block = 1 << k
        first = start - origin
        blocks = min(-(-(stop - start) // block), (len(ids) - first) // block)
        if blocks <= 0 or len(ids) < 2 * block:
            continue
        at = np.flatnonzero(words.equal_blocks(first, blocks, block))
        if not len(at):
            continue
        c, p = first + at // block * block, block + at % block
        whole = primitive(words, c, p)
        c, p = c[whole], p[whole]
        ahead, behind = (z_values(words, c, p, k, x) for x in (True, False))
        edge = 4 * block - 1
        kept = (ahead == edge) | (behind == edge) | (ahead + behind >= np.maximum((MIN_EXPONENT - 1) * p, MIN_LENGTH - p))
        found.append(np.stack([p, c - behind, c + ahead], 1)[kept])
    out = joined(np.concatenate(found)) if found else np.zeros((0, 3), np.int64)
    if any((ids[s:t] != ids[s + p : t + p]).any() for p, s, t in out.tolist()):
        return fragments(ids, origin, start, stop, lo, hi, Compared)
    return out + np.array([0, origin, origin])


def joined(rows: np.ndarray) -> np.ndarray:
    """Touching fragments of one period as one."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    far = rows[:, 0] * (rows[:, 2].max() + 2)  # periods stand apart
    reach = np.maximum.accumulate(far + rows[:, 2])
    new = np.concatenate(([True], far[1:] + rows[1:, 1] > reach[:-1]))
    heads = np.flatnonzero(new)
    return np.stack([rows[heads, 0], rows[heads, 1], np.maximum.reduceat(rows[:, 2], heads)], 1)


def as_rows(found: np.ndarray) -> list[dict]:
    return [dict(zip(("period", "first", "last"), x, strict=True)) for x in found.tolist()]


def cut_documents(docs: DataFrame, order: Order | None, tile: int, texts: bool) -> DataFrame:
    """A row for each document (its words only if they are still needed), and
    one for each tile of a document that has several."""
    names = [x.split()[0] for x in CUT.replace("<period:long,first:long,last:long>", "").split(", ")]

    def of(batch: pa.RecordBatch) -> dict:
        rows = []
        for rid, doc_id, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(2).cast(pa.binary()), strict=True):
            words = (text.as_py() or b"").split()
            n = len(words)
            at = order(doc_id, n) if order else None
            if at is not None:
                words = [words[i] for i in at.tolist()]
            numbers: dict[bytes, int] = {}
            ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int32)
            parts, found = list(cut(n, tile)), np.zeros((0, 3), np.int64)
            if len(parts) == 1:
                lo, hi, start, stop, origin, end = parts.pop()
                found = fragments(ids[origin:end], origin, start, stop, lo, hi)
            line = b" ".join(words)
            sha = hashlib.sha256(line).hexdigest()
            rows.append((rid, doc_id, n, sha, line.decode() if texts or parts or len(found) else None, as_rows(found), *[None] * 6))
            rows += [(rid, None, None, None, None, None, lo, hi, origin, start, stop, ids[origin:end].tobytes()) for lo, hi, start, stop, origin, end in parts]
        return dict(zip(names, zip(*rows), strict=True))

    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(numbered, of, CUT)


def solve_tiles(tiles: DataFrame) -> DataFrame:
    """Fragments (rid, period, first, last) of the tiles, dealt one by one."""

    def of(batch: pa.RecordBatch) -> dict:
        rows = []
        for x in batch.to_pylist():
            found = fragments(np.frombuffer(x["ids"], np.int32), x["origin"], x["start"], x["stop"], x["lo"], x["hi"])
            rows += [(x["rid"], *y) for y in found.tolist()]
        return dict(zip(("rid", "period", "first", "last"), zip(*rows) if rows else [()] * 4, strict=True))

    dealt = tiles.select("rid", "lo", "hi", "origin", "start", "stop", "ids").repartition("rid", "lo", "start")
    return map_batches(dealt, of, f"rid long, {FRAGMENT}")


def stitch(found: DataFrame) -> DataFrame:
    """Runs (rid, start, period, length) from the fragments of all tiles."""
    line = Window.partitionBy("rid", "period").orderBy("first", "last")
    before = F.max("last").over(line.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("new", F.coalesce(F.col("first") > before, F.lit(True)).cast("long"))
    pieces = marked.withColumn("stretch", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    whole = pieces.groupBy("rid", "period", "stretch").agg(F.min("first").alias("start"), F.max("last").alias("last"))
    runs = whole.select("rid", "start", "period", (F.col("last") - F.col("start") + F.col("period")).alias("length"))
    return runs.where((F.col("length") >= MIN_LENGTH) & (F.col("length") >= MIN_EXPONENT * F.col("period")))


def collapse(rows: DataFrame) -> DataFrame:
    """``kept_text``: the words of ``text`` without those that a run holds after
    its first period."""
    carried = rows.columns

    def of(batch: pa.RecordBatch) -> dict:
        out = []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
            words = text.split(" ") if text else []
            kept = np.ones(len(words), bool)
            for run in runs or ():
                kept[run["start"] + run["period"] : run["start"] + run["length"]] = False
            out.append(" ".join(words[i] for i in np.flatnonzero(kept).tolist()))
        return {**{x: batch.column(x) for x in carried}, "kept_text": out}

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return map_batches(rows, of, f"{schema}, kept_text string")


def periodic_runs(docs: DataFrame, order: Order | None = None, tile: int = TILE, texts: bool = False) -> DataFrame:
    """Per document: n_words, its runs by start and period, the SHA-256 of the
    words that stay, and the words themselves (null where a document has no
    fragment of a run, unless ``texts``)."""
    stages = Stages(docs.sparkSession, "periods")
    rows = stages.write(cut_documents(docs, order, tile, texts), "cut")
    whole = rows.where("ids is null")
    solved = solve_tiles(rows.where("ids is not null"))
    found = whole.select("rid", F.explode("fragments").alias("x")).select("rid", "x.period", "x.first", "x.last").unionByName(solved)
    runs = stitch(found).groupBy(F.col("rid").alias("r")).agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    named = whole.select("rid", "doc_id", "n_words", "plain_sha256", "text")
    held = named.where("text is not null").join(runs, F.col("rid") == F.col("r"), "left").drop("r", "rid", "plain_sha256")
    kept = collapse(held).select("doc_id", "n_words", "runs", "kept_text", F.sha2("kept_text", 256).alias("kept_sha256"))
    none = F.lit(None)
    plain = named.where("text is null").select("doc_id", "n_words", none.cast(runs.schema["runs"].dataType).alias("runs"), none.cast("string").alias("kept_text"), F.col("plain_sha256").alias("kept_sha256"))
    return plain.unionByName(kept).withColumn("runs", F.coalesce("runs", F.expr("filter(array(struct(0L start, 0L period, 0L length)), x -> false)")))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Every tenth document by the CRC of its id reads its words from place a on
    again and again with period p."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return at


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), planted)
    best = found.withColumn("best", F.expr("array_max(transform(runs, x -> struct(x.length as length, -x.start as start, -x.period as period)))"))
    lines = F.transform("runs", lambda x: F.concat_ws(",", x.start, x.length, x.period))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"), F.col("kept_sha256").alias("collapsed_sha256"),
    )


def oracle() -> str:
    """Five equal words at distance p mark a match stretch; a run has five
    matches or more, so stretches are islands of such places."""
    bits = "list_reduce(list_concat([xor(a, b)], range(8)), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)), lambda a, b: {bits}), 4294967295)"
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0b\\x0c\\r]+') AS w, {crc} AS h FROM documents),
a AS (SELECT *, len(w) AS n, h // 10 AS g FROM t),
b AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS f FROM a),
c AS (SELECT *, 1 + (n - f) // (3 + g % 8) AS p FROM b),
d AS (SELECT rid, doc_id, n, CASE WHEN f IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < f THEN i ELSE f + (i - f) % p END]) END AS w FROM c),
g AS (SELECT rid, i, hash(array_to_string(list_slice(w, i + 1, i + 5), ' ')) AS gram, n FROM (SELECT rid, w, n, unnest(range(n - 4)) AS i FROM d WHERE n >= 6)),
m AS (SELECT x.rid, x.i, y.i - x.i AS p FROM g x JOIN g y ON x.rid = y.rid AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT rid, p, min(i) AS start, count(*) + 4 + p AS length FROM (SELECT rid, p, i, i - row_number() OVER (PARTITION BY rid, p ORDER BY i) AS island FROM m) GROUP BY rid, p, island),
r AS (SELECT rid, start, length, min(p) AS period FROM s WHERE length >= greatest(6, 4 * p) GROUP BY rid, start, length),
k AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
        first(struct_pack(start := start, length := length, period := period) ORDER BY length DESC, start, period) AS best FROM r GROUP BY rid),
o AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM r),
v AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS kept FROM (SELECT rid, unnest(w) AS word, unnest(range(n)) AS i FROM d) ANTI JOIN o USING (rid, i) GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length, CAST(best.period AS BIGINT) AS period,
       CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN k USING (rid) LEFT JOIN v USING (rid)"""
