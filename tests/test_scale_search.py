"""Searches whose intermediate rows must not grow with clauses x documents."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.operators import analyzer as A
from quarry.operators import index as I
from quarry.operators import search as S
from quarry.operators import shard_rank


@pytest.fixture(scope="module")
def ix(spark):
    docs = spark.createDataFrame([(i, f"alpha beta{i % 7} abc{i % 3} abd gamma") for i in range(60)], "doc_id long, text string")
    return I.materialize_index(I.build_index(docs, A.AnalyzerOptions(stem=False)))


def test_scores_are_summed_where_the_documents_are(spark, ix):
    terms = spark.createDataFrame([(1, "alpha", 1.0), (1, "gamma", 2.0), (2, "beta3", 1.0)], "query_id long, term string, weight double")
    scored = S.score_terms(ix, terms)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(shard" in plan and "hashpartitioning(query_id" not in plan
    assert scored.groupBy("query_id").count().orderBy("query_id").collect() == [(1, 60), (2, 9)]


def test_a_shard_gives_its_first_and_its_count(spark, ix):
    rows = spark.range(1000).select((F.col("id") % 4).cast("int").alias("shard"), F.lit(7).alias("query_id"), F.col("id").alias("doc_id"), (F.col("id") % 10).cast("double").alias("score"))
    first = S.first_by_shard(rows, 3).collect()
    assert len(first) == 12 and sum(r.n for r in first) == 1000
    assert {r.score for r in first} == {9.0, 8.0}  # ids of a shard share their parity


def test_equal_clauses_are_scored_once_and_counted_for_each(spark, ix, monkeypatch):
    seen = []
    score = S._score_units
    monkeypatch.setattr(S, "_score_units", lambda index, w, n, every=None: (seen.append(n), score(index, w, n, every))[1])
    rows = [(q, c, "SHOULD", "prefix", t, float(c + 1), 0) for q in (1, 2) for c, t in enumerate(["ab", "ab", "alp"])]
    got = S.search(ix, spark.createDataFrame(rows, S.CLAUSE_SCHEMA), stem=False).collect()
    assert seen == [5]  # four terms of ab, one of alp
    assert {(r.query_id, r.score, r.total_hits) for r in got} == {(1, 6.0, 60), (2, 6.0, 60)}


def test_ranges_with_a_shared_beginning_are_joined(spark, ix, monkeypatch):
    def refuse(*_):
        raise AssertionError("a predicate for every range")

    monkeypatch.setattr(S, "_expand_by_predicates", refuse)
    ranges = spark.createDataFrame([("range", "[ab TO abz]"), ("range", "{abc1 TO abd]"), ("range", "[b TO bz}")], "kind string, text string")
    got = {}
    for r in S._expand_patterns(ix, ranges, {"range": 3}).collect():
        got.setdefault(r.text, set()).add(r.term)
    assert got == {"[ab TO abz]": {"abc0", "abc1", "abc2", "abd"}, "{abc1 TO abd]": {"abc2", "abd"}, "[b TO bz}": {f"beta{i}" for i in range(7)}}


def test_excluded_words_next_to_every_document(spark, ix):
    rows = [(1, -1, "SHOULD", "match_all", None, 1.0, 0), (1, 0, "MUST_NOT", "term", "beta0", 1.0, 0), (1, 1, "SHOULD", "term", "beta1", 2.0, 0), (2, 0, "MUST", "match_all", None, 3.0, 0),
            (2, 1, "MUST_NOT", "term", "alpha", 1.0, 0)]
    got = sorted(S.search(ix, spark.createDataFrame(rows, S.CLAUSE_SCHEMA), stem=False).collect())
    ones = [i for i in range(60) if i % 7 == 1]
    assert [r.doc_id for r in got] == [*ones, *[i for i in range(60) if i % 7 > 1][:10 - len(ones)]]
    assert {r.total_hits for r in got} == {60 - 9} and got[-1].score == 1.0


def test_a_document_and_a_query_never_meet_in_a_row(spark, ix, monkeypatch):
    rows = [(q, c, o, "term", t, b, 0) for q in (1, 2) for c, (o, t, b) in enumerate([("MUST", "alpha", 1.0), ("SHOULD", f"beta{q}", 2.0), ("MUST_NOT", "abc1", 1.0)])]
    rows += [(3, 0, "MUST", "term", "nowhere", 1.0, 0), (4, 0, "SHOULD", "prefix", "ab", 1.0, 0), (4, 1, "SHOULD", "term", "gamma", 3.0, 0), (5, 0, "MUST_NOT", "term", "alpha", 1.0, 0)]
    clauses = spark.createDataFrame(rows, S.CLAUSE_SCHEMA)
    free = spark.createDataFrame([(1, "alpha beta3 abc2 abc2"), (2, "nowhere"), (3, "www.beta3.gamma beta1")], "query_id long, query string")
    plans = []
    fetched = S._fetched
    monkeypatch.setattr(S, "_fetched", lambda index, first, *a: (plans.append(first._jdf.queryExecution().executedPlan().toString()), fetched(index, first, *a))[1])
    held = [sorted(S.search(ix, clauses, stem=False).collect()), sorted(S.run_queries(ix, free, stem=False).collect())]
    assert len(plans) == 2 and all("FlatMapGroupsInArrow [shard" in p and "hashpartitioning(shard" in p for p in plans)
    monkeypatch.setattr(S, "HELD_CLAUSES", 0)  # joined with the scores
    joined = [sorted(S.search(ix, clauses, stem=False).collect()), sorted(S.run_queries(ix, free, stem=False).collect())]
    assert held == joined and {r.query_id for r in held[0]} == {1, 2, 4} and {r.query_id for r in held[1]} == {1, 3}


def test_shards_are_cut_to_bounded_matrices(monkeypatch):
    clauses = pa.table({"unit": [7, 9, 9], "query_id": [1, 1, 2], "boost": [1.0, 2.0, 1.0], "must": [0, 1, 0], "should": [1, 0, 1], "never": [0, 0, 0]})
    rows = pa.table({"unit": [7, 9, 9, 9, 7], "doc_id": [5, 5, None, 3, 4], "score": [1.0, 1.0, 1.0, 1.0, 8.0]})
    schema = pa.schema([("query_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.float64()), ("n", pa.int64())])
    run = shard_rank.first_of_shard(SimpleNamespace(value=shard_rank.Asked(clauses)), 2, 6, schema)
    assert run(rows).to_pylist() == [dict(zip(schema.names, r)) for r in ((1, 5, 3.0, 3), (1, None, 2.0, 0), (2, None, 1.0, 3), (2, 3, 1.0, 0))]
    monkeypatch.setattr(shard_rank, "CELLS", 2)  # one document at a time
    assert sorted(r["n"] for r in run(rows).to_pylist()) == [1] * 6


def test_scores_are_rounded_as_spark_rounds(spark):
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(0, 30, 4000), rng.integers(-10**9, 10**9, 4000) / 1e6 + 5e-7, 0.0, 1.0000005, 2.5e-7, 5e-7, -5e-7, 1e18, 12345678.1234565]
    got = spark.createDataFrame([(float(v),) for v in x], "x double").select("x", F.round("x", 6).alias("r")).toPandas()
    assert (shard_rank.rounded(got.x.to_numpy(), 6) == got.r.to_numpy()).all()
