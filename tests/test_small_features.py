"""Span masks, nested predictions, reported hits and the gradient of a head."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import conversations as C
from quarry.operators import explore as X
from quarry.operators import metrics as M
from quarry.operators import models
from quarry.operators import search as S


def test_span_masks(spark):
    spans = spark.createDataFrame([(1, 0, 0, 0, 0, 2), (1, 1, 1, 0, 4, 6), (1, 2, 1, 1, 90, 95)], "conversation_ID long, pair_idx int, utterance int, cause int, boc int, eoc int")
    tokens = spark.createDataFrame([(1, 0, 0, 0, 3), (1, 0, 1, 4, 7)], "conversation_ID long, pos int, token int, start int, end int")
    rows = {m: {(r.utterance, r.cause): (r.start, r.stop, r.span_mask) for r in C.span_matrix(spans, tokens, m).collect()} for m in ("sum", "present")}
    assert rows["sum"] == {(0, 0): (0, 0, 0), (1, 0): (1, 1, 1), (1, 1): (0, 0, 0)}
    assert rows["present"] == {(0, 0): (0, 0, 1), (1, 0): (1, 1, 1), (1, 1): (0, 0, 0)}
    with pytest.raises(ValueError):
        C.span_matrix(spans, tokens, "other")


def test_word_offsets(spark):
    rows = spark.createDataFrame([(1, 0, " ab  c d "), (1, 1, ""), (1, 2, "x")], "conversation_ID long, pos int, text string")
    got = {(r.pos, r.token): (r.word, r.start, r.end) for r in C.utterance_tokens(rows).collect()}
    assert got == {(0, 1): ("ab", 1, 3), (0, 2): ("c", 5, 6), (0, 3): ("d", 7, 8), (2, 1): ("x", 0, 1)}


def test_nested_spans(spark):
    spans = spark.createDataFrame([(1, 0, 1, 2, 3), (1, 0, 0, 1, 1), (1, 1, 0, 0, 2), (1, 2, 0, 5, 5), (1, 0, 2, 5, 5), (2, 0, 0, 1, 0)], "conv_id int, effect int, cause int, start int, stop int")
    lengths = spark.createDataFrame([(1, 2), (2, 1), (3, 4)], "conv_id int, n_valid int")
    got = {(r.conv_id, r.effect): [tuple(x) for x in r.spans] for r in M.nest_spans(spans, lengths).collect()}
    assert got == {(1, 0): [(0, 1, 1), (1, 2, 3)], (1, 1): [(0, 0, 2)], (2, 0): [(0, 1, 0)]}


def test_reported_hits(spark):
    rows = spark.createDataFrame([(1, 7, "ok"), (1, 7, "ok"), (2, 1000, "ok"), (3, 1001, "ok"), (4, None, "error: x")], "query_id long, total_hits long, status string")
    got = {r.query_id: (r.reported, r.hits_exact) for r in S.reported_hits(rows).collect()}
    assert got == {1: (7, True), 2: (1000, True), 3: (1001, False)}


def test_text_parts(spark):
    df = spark.createDataFrame([(k, i, f"{k}{i}") for k in "ab" for i in range(25 if k == "a" else 3)], "k string, i int, text string").repartition(4)
    parts = X.text_parts(df, "k", ["i"], rows_a_part=10).collect()
    assert sorted((r.k, r.part) for r in parts) == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
    whole = {k: " ".join(r.text for r in sorted(parts, key=lambda r: r.part) if r.k == k) for k in "ab"}
    assert whole == {r.k: r.text for r in X.concat_text(df, "k", "i").collect()}


def test_gradient(spark):
    rows = spark.createDataFrame([([1.0, 2.0], 0, [0.7, 0.3], 2.0), ([0.0, -1.0], 1, [0.4, 0.6], 1.0)], "x array<double>, y int, p array<double>, w double")
    got = {(r["class"], r.idx): r.gradient for r in models.loss_gradient(rows, "x", "y", "p", "w").collect()}
    want = {(c, j): sum(w * (p[c] - (y == c)) * x[j] for x, y, p, w in map(tuple, rows.collect())) / 3.0 for c in (0, 1) for j in (0, 1)}
    assert got == {k: pytest.approx(v) for k, v in want.items()}
