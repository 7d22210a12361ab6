"""Vocabulary tables for inexact clauses against brute force over all terms."""

import os
import random
import re

import pytest

from quarry.operators import analyzer as A
from quarry.operators import expansion as X
from quarry.operators import index as I
from quarry.operators import search as S

RX = ["ab.*", "a[bc]+d?", "[a-d]{3}", "abc", "(ab|cd).*", r"a\.b", "b+c*a", ".*cab.*", "a{2}b", "x?abca?", "", r"\w+da", "é.a"]


@pytest.fixture(scope="module")
def terms():
    rnd = random.Random(2)
    return sorted({"".join(rnd.choice("abcdé.") for _ in range(rnd.randint(1, 11))) for _ in range(1500)})


@pytest.fixture(scope="module")
def ix(spark, terms):
    return I.Index(None, spark.createDataFrame([(t,) for t in terms], "term string"), None, None)


def test_fuzzy_expansion(spark, ix, terms):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 11))) for _ in range(25)]
    df = spark.createDataFrame([(i, 0, w) for i, w in enumerate(words)], "query_id long, clause_id int, text string")
    got = {}
    for r in S._expand_fuzzy(ix, df, 2).collect():
        got.setdefault(r.query_id, set()).add(r.term)
    for i, w in enumerate(words):
        near = [(S.osa_distance(w, t) / min(len(w), len(t)), t) for t in terms if S.osa_distance(w, t) <= 2]
        assert got.get(i, set()) == {t for s, t in sorted(x for x in near if x[0] < 1)[:50]}


@pytest.mark.parametrize("rx", RX)
def test_required_pieces_stand_in_every_match(rx, terms):
    pieces = X.required_pieces(rx)
    matching = [X.START + t + X.END for t in terms if re.fullmatch(rx, t)]
    assert all(p in t for p in pieces for t in matching)


def test_patterns(spark, ix, terms):
    wild = ["ab*", "a?c*", "*", "abc", "?b*a", "*ca", "a.b*", "é*"]
    rows = [("wildcard", w) for w in wild] + [("regex", r) for r in RX] + [("range", "[ab TO b]"), ("range", "{c TO *]"), ("prefix", "abc"), ("prefix", "d")]
    df = spark.createDataFrame(rows, "kind string, text string")
    got = {}
    for r in S._expand_patterns(ix, df, {k: 1 for k, _ in rows}).collect():
        got.setdefault((r.kind, r.text), []).append(r.term)
    match = {  # \\w of Java is ASCII
        "wildcard": lambda p, t: re.fullmatch("".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in p), t),
        "regex": lambda p, t: re.fullmatch(p, t, re.A), "prefix": lambda p, t: t.startswith(p),
        "range": lambda p, t: "ab" <= t <= "b" if p.startswith("[ab") else t > "c",
    }
    for kind, text in rows:
        assert sorted(got.get((kind, text), [])) == [t for t in terms if match[kind](text, t)], (kind, text)


def test_written_tables_are_looked_up(spark, tmpdir_fresh):
    docs = spark.createDataFrame([(i, f"word{i} other{i % 7}") for i in range(300)], "doc_id long, text string")
    path = os.path.join(tmpdir_fresh, "ix")
    I.write_index(I.build_index(docs, A.AnalyzerOptions(stem=False)), path, layout="term", expansions=True)
    ix = I.read_index(spark, path)
    words = spark.createDataFrame([("word12",)], "text string")
    found = X.fuzzy_candidates(ix, words, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "/deletions" in plan and "In(variant" in plan and "/terms" not in plan
    pairs, open_ = X.pattern_candidates(ix, spark.createDataFrame([("wildcard", "wo*99"), ("regex", ".*")], "kind string, text string"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "/grams" in plan and "EqualTo(gram" in plan and "/terms" not in plan
    assert [tuple(r) for r in open_.collect()] == [("regex", ".*")]
    rows = [(1, 0, "SHOULD", "fuzzy", "word12", 1.0, 0), (2, 0, "SHOULD", "wildcard", "wo*99", 1.0, 0)]
    hits = S.search(ix, spark.createDataFrame(rows, S.CLAUSE_SCHEMA), stem=False).collect()
    assert {r.doc_id for r in hits if r.query_id == 2} == {99, 199, 299}
    assert next(r.doc_id for r in hits if r.query_id == 1 and r.rank == 1) == 12
