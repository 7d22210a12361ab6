"""URL filters by a sort-merge range join.

A host is written with its labels reversed, each closed by ``\\x01``, so that a
rule fits exactly the keys with its own key as prefix: an interval.  Pages and
rules are cut into the same key ranges (bounds from a bounded sample, with the
page id behind the key, so that one host can span many ranges); a rule goes to
every range that its interval meets.  Each range is sorted, and one sweep keeps
the stack of the rules whose intervals are open.  Nothing is broadcast, and a
task holds only its stack.

Null url, or one without ``://``: host and path are empty and no rule fits.
Null ids and repeated rows are kept; further columns are not read.  Of rules
that fit, the one with the longest host and path wins, then the longer host;
of rules given twice, block wins.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, table

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
RULE_SCHEMA = "host string, path string, verdict string"
#: Keys drawn for the range bounds; they decide balance only.
SAMPLE_KEYS = 20_000
#: Pages a range is meant to hold.
RANGE_ROWS = 250_000

_EVENTS = "bucket int, sort_key binary, page_id long, host string, path string, rule_path string, rule_verdict string"
SCHEMA = "page_id long, host string, path string, rule string, verdict string"


def host_key(host: bytes) -> bytes:
    return b"".join(x + b"\x01" for x in reversed(host.split(b"."))) if host else b""


def split_url(url: bytes | None) -> tuple[bytes, bytes]:
    if url is None or b"://" not in url:
        return b"", b""
    rest = url.split(b"://", 1)[1]
    for stop in (b"#", b"?"):
        rest = rest.split(stop, 1)[0]
    host, slash, path = rest.partition(b"/")
    return host.translate(LOWER), slash + path


def sort_key(host: bytes, salt: int) -> bytes:
    """The key of a page; the salt behind \\x00 spreads one host's pages."""
    return host_key(host) + b"\x00" + salt.to_bytes(8, "big", signed=True)


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema, strict=True)], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _page_events(bounds: list[bytes]):
    schema = _arrow(_EVENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, url, salt in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                host, path = split_url(url)
                key = sort_key(host, salt)
                rows.append((bisect_right(bounds, key), key, page, host, path, None, None))
            if rows:
                yield _columns(rows, schema)

    return run


def _rule_events(bounds: list[bytes]):
    schema = _arrow(_EVENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, path, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if host is None:
                    continue
                host = host.encode().translate(LOWER)
                key = host_key(host)
                last = bisect_left(bounds, key[:-1] + b"\x02") if key else len(bounds)
                rows += [(b, key, None, host, None, (path or "").encode(), verdict or "allow") for b in range(bisect_right(bounds, key), last + 1)]
            if rows:
                yield _columns(rows, schema)

    return run


def _sweep(default: str):
    schema = _arrow(SCHEMA)

    def best(stack: list[tuple], path: str) -> tuple | None:
        fits = [(len(h) + len(p), len(h), v == "block", f"{h}{p}", v) for _, h, p, v in stack if path.startswith(p)]
        return max(fits, default=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, stack = None, []
        for batch in batches:
            rows = []
            for b, key, page, host, path, rule_path, rule_verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket:
                    bucket, stack = b, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if rule_path is not None:
                    stack.append((key, host, rule_path, rule_verdict))
                else:
                    found = best(stack, path) if host else None
                    rows.append((page, host, path, found and found[3], found[4] if found else default))
            if rows:
                yield _columns(rows, schema)

    return run


def draw_limit(total: int) -> int:
    """Hashes of 62 bits below this draw about ``SAMPLE_KEYS`` of ``total`` rows."""
    return (SAMPLE_KEYS << 62) // max(total, SAMPLE_KEYS)


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The rule and verdict of every page; ``default`` where no rule fits.
    ``rules``: host, path (with its leading slash), verdict."""
    spark = pages.sparkSession
    keyed = pages.select("page_id", "url", F.xxhash64("page_id", "url").alias("salt"))
    total = keyed.count()
    ranges = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE_ROWS)
    drawn = keyed.where(F.shiftrightunsigned(F.xxhash64("salt"), 2) < draw_limit(total)).select("url", "salt").limit(2 * SAMPLE_KEYS)
    sample = sorted(sort_key(split_url(r.url.encode() if r.url is not None else None)[0], r.salt) for r in drawn.toLocalIterator())
    bounds = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []
    events = keyed.mapInArrow(_page_events(bounds), _EVENTS).unionByName(
        rules.select("host", "path", "verdict").mapInArrow(_rule_events(bounds), _EVENTS)
    )
    # A rule's key is a prefix of its pages' keys, so it sorts before them; wider rules sort first.
    dealt = events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "bucket")
    return dealt.sortWithinPartitions("bucket", "sort_key").mapInArrow(_sweep(default), SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, RULE_SCHEMA))


def oracle() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return rf"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {rules}),
rest AS (
  SELECT page_id, row_number() OVER () AS rid,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, rid,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(regexp_extract(rest, '^[^?#]*'), length(regexp_extract(rest, '^[^/?#]*')) + 1) AS path
  FROM rest),
fits AS (
  SELECT rid, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (rid)"""
