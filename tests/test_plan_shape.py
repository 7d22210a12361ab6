"""Scale-shape properties: plans that must not shuffle or funnel rows."""

from pyspark.sql import functions as F

from quarry.operators import analyzer as A
from quarry.operators import index as I
from quarry.operators.rowindex import with_row_index


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_postings_need_no_shuffle(spark):
    docs = spark.createDataFrame([(i, f"alpha beta {i} gamma alpha") for i in range(50)], "doc_id long, text string")
    p = I.build_postings(A.analyze(docs, opts=A.AnalyzerOptions(stem=False)))
    plan = _plan(p)
    assert "hashpartitioning" not in plan and "Aggregate" not in plan
    rows = {(r.term, r.doc_id): (r.tf, r.positions) for r in p.collect()}
    assert rows[("alpha", 7)] == (2, [0, 4]) and rows[("gamma", 7)] == (1, [3])


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).repartition(8).select(F.col("id"), (F.col("id") % 7).alias("k"))
    out = with_row_index(df, [F.desc("k"), F.asc("id")], "idx", num_partitions=8)
    got = out.orderBy("idx").collect()
    assert [r.idx for r in got] == list(range(5000))
    expect = sorted(range(5000), key=lambda i: (-(i % 7), i))
    assert [r.id for r in got] == expect


def test_row_index_with_payload_over_many_partitions(spark):
    df = spark.range(0, 400_000, numPartitions=8).select("id", F.xxhash64("id").alias("h"), F.concat(F.lit("payload "), "id").alias("p"))
    out = with_row_index(df, ["h", "id"], "idx", num_partitions=9)
    row = out.agg(F.count("*").alias("n"), F.countDistinct("idx").alias("d"), F.min("idx").alias("a"), F.max("idx").alias("b")).first()
    assert tuple(row) == (400_000, 400_000, 0, 399_999)


def test_broadcasts_are_measured_in_bytes(spark, monkeypatch):
    from quarry import session

    monkeypatch.setattr(session, "UNMEASURED_ROWS", 10)
    monkeypatch.setattr(session, "BROADCAST_MAX_BYTES", 100_000)
    hinted = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString().lower()
    wide = spark.range(50).select("id", F.expr("repeat('x', 5000)").alias("t"), F.array("id").alias("a"))
    narrow = spark.range(50)
    assert hinted(session.broadcast_if_small(narrow)) and not hinted(session.broadcast_if_small(wide))
    assert hinted(session.broadcast_if_small(narrow, known_rows=50)) and not hinted(session.broadcast_if_small(wide, known_rows=50))
    assert hinted(session.broadcast_if_small(wide, known_rows=9)) and not hinted(session.broadcast_if_small(narrow, known_rows=3_000_000))
