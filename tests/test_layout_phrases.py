"""The index layout by term, and phrases of position sets against brute force."""

import itertools
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from quarry import session
from quarry.operators import analyzer as A
from quarry.operators import index as I
from quarry.operators import phrase_rows
from quarry.operators import search as S

OPTS = A.AnalyzerOptions(stem=False, stopwords=(), stopwords_folded=())


def _docs():
    rnd = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "www.alpha.com", "beta.gamma"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 6, 20])))) for i in range(70)]
    return rows + [(100 + i, "common " * 5 + f"rare{i}") for i in range(60)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_docs(), "doc_id long, text string")


@pytest.fixture(scope="module")
def layouts(spark, docs, tmp_path_factory):
    base, idx = str(tmp_path_factory.mktemp("layouts")), I.build_index(docs, OPTS)
    I.write_index(idx, f"{base}/document")
    I.write_index(idx, f"{base}/term", layout="term", postings_files=12)
    return {x: I.read_index(spark, f"{base}/{x}") for x in ("document", "term")}


def test_layouts_hold_the_same_postings(layouts):
    columns = ["term", "doc_id", "tf", "positions", "dl"]
    rows = {k: sorted(map(str, v.postings.select(columns).collect())) for k, v in layouts.items()}
    assert rows["document"] == rows["term"] and len(rows["term"]) > 300
    terms = {k: sorted(map(str, v.terms.select("term", "df", "ttf").collect())) for k, v in layouts.items()}
    assert terms["document"] == terms["term"]


def test_frequent_terms_lie_in_many_buckets(layouts):
    ix = layouts["term"]
    place = {r.term: (r.first_bucket, r.last_bucket) for r in ix.terms.collect()}
    assert place["common"][1] - place["common"][0] >= 1
    held = {}
    for r in ix.postings.select("term", "bucket").distinct().collect():
        held.setdefault(r.term, set()).add(r.bucket)
    assert all(min(b) == place[t][0] and max(b) == place[t][1] for t, b in held.items())
    assert len(held["rare7"]) == 1


def test_postings_are_dealt_in_passes(spark, docs, layouts, tmp_path, monkeypatch):
    """Only the postings of one pass lie in shuffle files, and these go with it;
    the index is the same."""
    monkeypatch.setattr(I, "PASS_BYTES", 3000)
    dealt, deal = [], I.deal_by_term

    def kept(postings, buckets, first=0):
        dealt.append((postings.count(), buckets, first, spark.conf.get(session.CLEANUP, None)))
        return deal(postings, buckets, first)

    monkeypatch.setattr(I, "deal_by_term", kept)
    I.write_index(I.build_index(docs, OPTS), str(tmp_path), layout="term", postings_files=12)
    ix, columns = I.read_index(spark, str(tmp_path)), ["term", "doc_id", "tf", "positions", "dl"]
    assert len(dealt) >= 3 and all(x[3] == "true" for x in dealt)
    assert sorted(map(str, ix.postings.select(columns).collect())) == sorted(map(str, layouts["document"].postings.select(columns).collect()))
    assert sum(x[0] for x in dealt) == ix.postings.count() > max(x[0] for x in dealt)
    assert [x[2] for x in dealt] == [k * dealt[0][1] for k in range(len(dealt))]
    held = {r.term: (r.a, r.b) for r in ix.postings.groupBy("term").agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).collect()}
    assert held == {r.term: (r.first_bucket, r.last_bucket) for r in ix.terms.collect()}
    monkeypatch.undo()
    cl = spark.createDataFrame(CLAUSES, S.CLAUSE_SCHEMA)
    rows = [sorted(map(str, S.search(x, cl, stem=False).collect())) for x in (ix, layouts["document"])]
    assert rows[0] == rows[1]


def test_a_lookup_opens_the_buckets_of_its_terms(spark, layouts):
    ix = layouts["term"]
    terms = ["alpha", *[f"rare{i}" for i in range(9)]]
    wanted = spark.createDataFrame([(t,) for t in terms], "term string")
    found = S._postings_for(ix, wanted, len(terms))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    rows = ix.terms.where(F.col("term").isin(terms)).collect()
    named = {b for r in rows for b in range(r.first_bucket, r.last_bucket + 1)}
    opened = {int(os.path.dirname(r.f).split("bucket=")[1]) for r in found.select(F.input_file_name().alias("f")).distinct().collect()}
    everywhere = {r.bucket for r in ix.postings.select("bucket").distinct().collect()}
    assert opened <= named and len(named) < len(everywhere)


def test_a_large_batch_joins_by_bucket(spark, layouts, monkeypatch):
    monkeypatch.setattr(S, "PUSHDOWN_MAX_TERMS", 1)
    q = spark.createDataFrame([(1, "alpha rare3"), (2, "common beta.gamma")], "query_id long, query string")
    rows = [sorted(map(tuple, S.run_queries(ix, q, stem=False).collect())) for ix in layouts.values()]
    assert rows[0] == rows[1] and len(rows[0]) == 20


CLAUSES = [
    (1, 0, "SHOULD", "phrase", "alpha beta", 1.0, 0),
    (2, 0, "SHOULD", "term", "common", 1.0, 0), (2, 1, "MUST_NOT", "term", "rare5", 1.0, 0),
    (3, 0, "SHOULD", "prefix", "rare1", 1.0, 0), (4, 0, "SHOULD", "fuzzy", "gamna", 1.0, 0),
    (5, 0, "SHOULD", "phrase", "www.alpha.com gamma", 1.0, 2),
]


def test_searches_agree_between_layouts(spark, layouts):
    cl = spark.createDataFrame(CLAUSES, S.CLAUSE_SCHEMA)
    rows = [sorted(map(str, S.search(ix, cl, stem=False).collect())) for ix in layouts.values()]
    assert rows[0] == rows[1] and len(rows[0]) > 20


# --------------------------------------------------------------------------- phrases
def _frequency(slots, doc, slop):
    """By trying every choice of a place for each slot."""
    at = [[(p - off, (t, p)) for t in terms for p in doc.get(t, ())] for off, terms in slots]
    if slop == 0:
        return len(set.intersection(*({a for a, _ in x} for x in at)))
    windows = set()
    for choice in itertools.product(*at):
        places = [k for _, k in choice]
        width = max(a for a, _ in choice) - min(a for a, _ in choice)
        if len(set(places)) == len(places) and width <= slop:
            windows.add((min(a for a, _ in choice), max(a for a, _ in choice)))
    least = [w for w in windows if not any(v != w and v[0] >= w[0] and v[1] <= w[1] for v in windows)]
    return sum(1 / (1 + b - a) for a, b in least)


PHRASES = [
    "alpha beta", "beta alpha gamma", "alpha alpha", "alpha alpha alpha", "alpha beta alpha", "gamma delta alpha beta",
    "alpha beta gamma delta alpha", "www.alpha.com beta", "beta.gamma alpha", "beta beta.gamma gamma", "www.alpha.com beta.gamma", "alpha missing",
]


def test_phrases_against_every_choice(spark, docs, layouts):
    ix = layouts["document"]
    analysed = lambda df, key: {r[0]: r.tokens for r in A.analyze(df, key, "text", OPTS).select(key, "tokens").collect()}
    texts = {}
    for d, tokens in analysed(docs, "doc_id").items():
        for x in tokens:
            texts.setdefault(d, {}).setdefault(x.term, []).append(x.pos)
    n, avgdl = ix.stats.first().n_docs, ix.stats.first().avgdl
    df = {r.term: r.df for r in ix.terms.collect()}
    dl = {r.doc_id: r.dl for r in ix.docs.collect()}
    tries = [(100 * slop + i, text, slop) for slop in (0, 1, 2, 4) for i, text in enumerate(PHRASES)]
    queries = analysed(spark.createDataFrame(list(enumerate(PHRASES)), "q int, text string"), "q")
    want = {}
    for q, _, slop in tries:
        tokens = queries[q % 100]
        first = min(x.pos for x in tokens)
        slots = [(p - first, sorted({x.term for x in tokens if x.pos == p and x.term in df})) for p in sorted({x.pos for x in tokens})]
        if not all(t for _, t in slots):
            continue
        weight = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) for _, terms in slots for t in terms)
        for d, places in texts.items():
            tf = _frequency(slots, places, slop)
            if tf:
                want[q, d] = round(weight * tf / (tf + 1.2 * (0.25 + 0.75 * dl[d] / avgdl)), 6)
    rows = [(q, 0, "SHOULD", "phrase", t, 1.0, slop) for q, t, slop in tries]
    got = S.search(ix, spark.createDataFrame(rows, S.CLAUSE_SCHEMA), k=1000, stem=False).collect()
    assert {(r.query_id, r.doc_id) for r in got} == set(want)
    assert all(r.score == pytest.approx(want[r.query_id, r.doc_id], abs=2e-6) for r in got)


def test_phrases_held_by_tasks_are_those_of_the_join(spark, layouts, monkeypatch):
    """In every cut of the postings, and without a row for each place."""
    ix = layouts["document"]
    rows = [(100 * slop + i, 0, "SHOULD", "phrase", t, 1.0, slop) for slop in (0, 1, 3) for i, t in enumerate([*PHRASES, "common common", "common rare7", "common common rare7"])]
    clauses = spark.createDataFrame(rows, S.CLAUSE_SCHEMA)
    scored, score = [], S._score_phrase
    monkeypatch.setattr(S, "_score_phrase", lambda *a: (scored.append(score(*a)), scored[-1])[1])
    found = lambda: sorted(map(str, S.search(ix, clauses, k=1000, stem=False).collect()))
    got = found()
    plan = scored[0]._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "collect_list" not in plan and "Generate" not in plan
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for postings, size in ((1, 7), (20, 7), (50, 1000)):
            monkeypatch.setattr(phrase_rows, "POSTINGS", postings)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert found() == got
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    monkeypatch.setattr(S, "HELD_TERMS", 0)
    assert found() == got and len(got) > 300


def test_least_windows_of_random_places():
    rnd = random.Random(2)
    for _ in range(400):
        k, vocabulary = rnd.randint(2, 5), "abc"
        slots = [(i, sorted(rnd.sample(vocabulary, rnd.choice([1, 1, 2])))) for i in range(k)]
        doc = {t: sorted(rnd.sample(range(14), rnd.randint(1, 4))) for t in vocabulary}
        slop = rnd.randint(1, 5)
        entries = [{"i": i, "off": off, "term": t, "positions": doc[t]} for i, (off, terms) in enumerate(slots) for t in terms]
        assert S.sloppy_frequency(entries, slop) == pytest.approx(_frequency(slots, doc, slop))
