import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import analyzer as A
from quarry.operators import index as I
from quarry.operators import search as S

DOCS = [(0, "apple banana apple cherry"), (1, "banana split with cherry on top"),
        (2, "apple pie"), (3, "the green apple and the red apple and apples"), (4, "şi de la")]


@pytest.fixture(scope="module")
def idx(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    return I.build_index(df, A.AnalyzerOptions(stem=False))


def _bm25(tf, df, dl, n, avgdl, k1=1.2, b=0.75):
    return math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + k1 * (1 - b + b * dl / avgdl))


def test_bm25_against_formula(spark, idx):
    st = idx.stats.first()
    assert st.n_docs == 4  # the stopword-only document has no tokens
    q = spark.createDataFrame([(1, "apple")], "query_id long, query string")
    res = {r.doc_id: r.score for r in S.run_queries(idx, q, stem=False).collect()}
    lens = {0: 4, 2: 2, 3: 9}
    tfs = {0: 2, 2: 1, 3: 2}
    for d, tf in tfs.items():
        assert res[d] == pytest.approx(round(_bm25(tf, 3, lens[d], 4, st.avgdl), 6), abs=1e-6)


def test_ranking_total_hits_and_no_hits(spark, idx):
    q = spark.createDataFrame([(1, "apple cherry"), (2, "şi de"), (3, "zzz unknown")], "query_id long, query string")
    rows = S.run_queries(idx, q, stem=False).collect()
    assert {r.query_id for r in rows} == {1}
    r1 = sorted([r for r in rows if r.query_id == 1], key=lambda r: r.rank)
    assert [r.rank for r in r1] == list(range(1, len(r1) + 1))
    assert r1[0].total_hits == 4 and all(a.score >= b.score for a, b in zip(r1, r1[1:]))


def _clauses(spark, rows):
    return spark.createDataFrame(rows, S.CLAUSE_SCHEMA)


def test_phrase_and_subset_properties(spark, idx):
    cl_or = _clauses(spark, [(1, 0, "SHOULD", "term", "banana", 1.0, 0), (1, 1, "SHOULD", "term", "cherry", 1.0, 0)])
    cl_and = _clauses(spark, [(1, 0, "MUST", "term", "banana", 1.0, 0), (1, 1, "MUST", "term", "cherry", 1.0, 0)])
    cl_ph = _clauses(spark, [(1, 0, "SHOULD", "phrase", "apple cherry", 1.0, 0)])
    hits = lambda c: {r.doc_id for r in S.search(idx, c, stem=False).collect()}
    h_or, h_and, h_ph = hits(cl_or), hits(cl_and), hits(cl_ph)
    assert h_ph <= h_and <= h_or
    assert h_ph == {0} and h_and == {0, 1}
    near = _clauses(spark, [(1, 0, "SHOULD", "phrase", "banana cherry", 1.0, 3)])
    assert hits(near) == {0, 1}


def test_bool_prefix_wildcard_regex_range_errors(spark, idx):
    rows = [
        (1, 0, "MUST", "term", "apple", 1.0, 0), (1, 1, "MUST_NOT", "term", "pie", 1.0, 0),
        (2, 0, "SHOULD", "prefix", "app", 1.0, 0),
        (3, 0, "SHOULD", "wildcard", "ch?rr*", 2.0, 0),
        (4, 0, "SHOULD", "regex", "ban.n[a-z]", 1.0, 0),
        (5, 0, "SHOULD", "range", "[pie TO split]", 1.0, 0),
        (6, 0, "SHOULD", "wildcard", "*ple", 1.0, 0),
        (7, 0, "MUST_NOT", "term", "apple", 1.0, 0),
        (8, 0, "SHOULD", "match_all", None, 1.0, 0),
    ]
    res = S.search(idx, _clauses(spark, rows), stem=False).collect()
    by = {}
    for r in res:
        by.setdefault(r.query_id, []).append(r)
    assert {r.doc_id for r in by[1]} == {0, 3}
    assert {r.doc_id for r in by[2]} == {0, 2, 3} and {r.score for r in by[2]} == {1.0}
    assert {r.doc_id for r in by[3]} == {0, 1} and {r.score for r in by[3]} == {2.0}
    assert {r.doc_id for r in by[4]} == {0, 1}
    assert {r.doc_id for r in by[5]} == {1, 2, 3}  # pie, red, split
    assert by[6][0].status.startswith("error") and by[6][0].doc_id is None
    assert 7 not in by  # pure negative → nothing
    assert [r.doc_id for r in sorted(by[8], key=lambda r: r.rank)] == [0, 1, 2, 3, 4]
    assert by[8][0].total_hits == 5


def test_fuzzy_matches_brute_force(spark, idx):
    terms = [r.term for r in idx.terms.collect()]
    q = "aple"
    expect = {t for t in terms if S.osa_distance(q, t) <= 2 and 1 - S.osa_distance(q, t) / min(len(q), len(t)) > 0}
    got = {r.term for r in S._expand_fuzzy(idx, spark.createDataFrame([(1, 0, q)], "query_id long, clause_id int, text string"), 2).collect()}
    assert got == expect
    assert S.osa_distance("ab", "ba") == 1 and S.osa_distance("ca", "abc") == 3


def test_index_round_trip(spark, idx, tmpdir_fresh):
    import os

    path = os.path.join(tmpdir_fresh, "ix")
    I.write_index(idx, path)
    back = I.read_index(spark, path)
    assert back.postings.count() == idx.postings.count()
    assert back.stats.first().n_docs == 4
    with pytest.raises(FileNotFoundError):
        I.read_index(spark, os.path.join(tmpdir_fresh, "missing"))


def test_format_results(spark, idx):
    q = spark.createDataFrame([(1, "pie")], "query_id long, query string")
    lines = {r.line for r in S.format_results(S.run_queries(idx, q, stem=False)).collect()}
    assert lines == {"Found: 1", '1. "2"'}


def test_url_synonym_group(spark):
    docs = spark.createDataFrame([(0, "see www.example.com now"), (1, "an example here"), (2, "nothing")],
                                 "doc_id long, text string")
    ix = I.build_index(docs, A.AnalyzerOptions(stem=False))
    q = spark.createDataFrame([(1, "www.example.com")], "query_id long, query string")
    res = {r.doc_id: r for r in S.run_queries(ix, q, stem=False).collect()}
    assert set(res) == {0, 1}
    st = ix.stats.first()
    # doc 1: one synonym-group clause, tf = 1 (example), df = max df of the group = 2
    assert res[1].score == pytest.approx(round(_bm25(1, 2, 3, st.n_docs, st.avgdl), 6), abs=1e-6)


def test_sloppy_phrases_of_one_and_of_repeated_terms(spark, idx):
    def hits(text):
        rows = S.search(idx, _clauses(spark, [(1, 0, "SHOULD", "phrase", text, 1.0, 3)]), stem=False).collect()
        return {r.doc_id for r in rows}

    assert hits("apple") == {0, 2, 3}
    assert hits("apple apple") == {0, 3}


def test_match_all_next_to_other_clauses(spark, idx):
    def run(*rows, k=10):
        found = S.search(idx, _clauses(spark, [(1, i, *r) for i, r in enumerate(rows)]), k=k, stem=False).collect()
        return [(r.doc_id, r.total_hits) for r in sorted(found, key=lambda r: r.rank)]

    every = ("SHOULD", "match_all", None, 1.0, 0)
    assert run(every, ("MUST_NOT", "term", "apple", 1.0, 0)) == [(1, 2), (4, 2)]
    assert run(every, ("SHOULD", "term", "split", 1.0, 0)) == [(1, 5), (0, 5), (2, 5), (3, 5), (4, 5)]
    assert run(every, ("SHOULD", "term", "split", 1.0, 0), k=2) == [(1, 5), (0, 5)]
    assert run(every, ("MUST", "term", "banana", 1.0, 0), ("MUST_NOT", "term", "split", 1.0, 0)) == [(0, 1)]
    assert run(("MUST_NOT", "match_all", None, 1.0, 0), ("SHOULD", "term", "apple", 1.0, 0)) == []
    assert run(every, every) == [(i, 5) for i in range(5)]


def test_rest_of_many_taken_documents(spark, monkeypatch):
    import random

    monkeypatch.setattr(S, "PLACE_BLOCK", 7)
    rnd, n, k = random.Random(8), 90, 5
    docs = spark.createDataFrame([(i * 3, f"d{i}") for i in range(n)], "doc_id long, text string")
    ix = I.build_index(docs, A.AnalyzerOptions(stem=False))
    scored, negated, want = [], [], {}
    for q, out in enumerate((0, 1, 30, 80, 88, 90)):
        gone = set(rnd.sample(range(n), out)) if q != 2 else set(range(out))
        hit = {i: round(2 + rnd.random(), 3) for i in set(range(n)) - gone if rnd.random() < 0.1}
        negated += [(q, i * 3) for i in gone]
        scored += [(q, i * 3, s) for i, s in hit.items()]
        ranked = sorted(((-hit.get(i, 1.0), i * 3) for i in set(range(n)) - gone))[:k]
        want[q] = [(d, -s, n - out) for s, d in ranked]
    queries = spark.createDataFrame([(q, 1.0) for q in want], "query_id long, boost double")
    rows = S.match_rest(ix, queries, spark.createDataFrame(scored, "query_id long, doc_id long, score double"),
                        spark.createDataFrame(negated, "query_id long, doc_id long"), k).collect()
    got = {q: [(r.doc_id, r.score, r.total_hits) for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)] for q in want}
    assert got == want
