"""Synonyms and stems from tables."""

import random

from pyspark.sql import functions as F

from quarry.operators import analyzer as A
from quarry.operators import stem_table as ST
from quarry.operators import synonym_rows
from quarry.operators import synonyms as SY
from quarry.operators.stemmer import stem_word
from quarry.plans import retrieval

NO_STOPWORDS = dict(stem=False, use_synonyms=True, stopwords=(), stopwords_folded=())


def _added(tokens, pairs):
    """Every synonym word by trying every pair at every token."""
    out, whole = [], {x.pos: x.term for x in tokens if x.ord == 0}
    for left, right in {(a.lower(), b.lower()) for a, b in pairs}:
        words, syn = left.split("\0"), right.split("\0")
        for x in tokens:
            first = x.term == words[0] and (x.ord == 0 or len(words) == 1)
            if first and all(whole.get(x.pos + k) == w for k, w in enumerate(words) if k):
                out += [(x.pos + k, w) for k, w in enumerate(syn)]
    return sorted(out)


def test_synonym_table_against_brute_force(spark):
    rnd = random.Random(6)
    words = ["alpha", "beta", "gamma", "www.alpha.com", "Delta", "!", "x1"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 15])))) for i in range(60)]
    pairs = [("alpha", "first"), ("Alpha\0beta", "ab\0both"), ("beta\0gamma\0delta", "long"), ("com", "suffix"), ("gamma", "g\0h\0i"), ("gamma", "g\0h\0i"), ("missing", "never"), ("x1\0x1", "twin")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame([*pairs, (None, "x"), ("y", None)], "term string, synonym string")
    plain = {r.doc_id: r.tokens for r in A.analyze(df, opts=A.AnalyzerOptions(**{**NO_STOPWORDS, "use_synonyms": False})).collect()}
    rich = {r.doc_id: r.tokens for r in A.analyze(df, opts=A.AnalyzerOptions(**NO_STOPWORDS, synonyms=table)).collect()}
    assert set(rich) == set(plain) == {i for i, _ in docs}
    for i, tokens in rich.items():
        own = [(x.pos, x.ord, x.term) for x in tokens if x.ord < SY.FIRST_ORD]
        assert own == [(x.pos, x.ord, x.term) for x in plain[i]]
        assert sorted((x.pos, x.term) for x in tokens if x.ord >= SY.FIRST_ORD) == _added(plain[i], pairs)
        assert [x.pos for x in tokens] == sorted(x.pos for x in tokens)


def test_gaps_are_no_neighbours(spark):
    """A token that is dropped keeps its position, so its neighbours are not consecutive."""
    rows = spark.createDataFrame([(1, [(0, 0, "a", ["Word"]), (2, 0, "b", ["Word"]), (3, 0, "a", ["Word"]), (4, 0, "b", ["Word"])])], f"doc_id long, tokens {A.TOKEN_TYPE}")
    pairs = spark.createDataFrame([("a\0b", "ab")], "term string, synonym string")
    assert [(r.pos, r.word) for r in SY.synonym_words(rows, pairs).collect()] == [(3, "ab")]
    none = spark.createDataFrame([], "term string, synonym string")
    assert SY.synonym_words(rows, none).count() == 0
    assert SY.inject_synonyms_table(rows, none).first().tokens == rows.first().tokens


def test_large_synonym_lists_are_no_literals(spark):
    pairs = spark.range(200_000).select(F.concat(F.lit("left"), "id").alias("term"), F.concat(F.lit("right"), "id").alias("synonym"))
    df = spark.createDataFrame([(1, "see left777 now")], "doc_id long, text string")
    out = A.analyze(df, opts=A.AnalyzerOptions(**NO_STOPWORDS, synonyms=pairs))
    assert "right777" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [x.term for x in out.first().tokens] == ["see", "left777", "right777", "now"]


def test_stem_table_adds_new_terms_only(spark, tmpdir_fresh):
    words = ["casele", "frumoasă", "copiilor", "mergând", "case", "x"]
    table = lambda ws: spark.createDataFrame([(w,) for w in ws], "term string")
    path = f"{tmpdir_fresh}/stems"
    first = {r.term: r.stem for r in ST.update_stems(table(words[:3] + [None]), path).collect()}
    files = set(ST.read_stems(spark, path).inputFiles())
    both = {r.term: r.stem for r in ST.update_stems(table(words + words), path).collect()}
    assert first == {w: stem_word(w) for w in words[:3]} and both == {w: stem_word(w) for w in words}
    assert files <= set(ST.read_stems(spark, path).inputFiles())
    assert ST.update_stems(table(words), path).count() == len(words)
    tokens = spark.createDataFrame([(1, "casele", 0), (1, "unknownword", 1)], "doc_id long, term string, pos int")
    got = {r.pos: r.term for r in ST.stem_rows(tokens, ST.read_stems(spark, path)).collect()}
    assert got == {0: stem_word("casele"), 1: "unknownword"}


def test_synonym_words_by_batches_are_those_of_the_join(spark, monkeypatch):
    """Left sides of one to three words, URL pieces, gaps, texts without a token
    and ids in several rows, in every cut of the batches."""
    tok = lambda *x: [(p, o, t, ["Word"]) for p, o, t in x]
    text = lambda s: tok(*[(i, 0, t) for i, t in enumerate(s.split())])
    docs = [(1, text("a b c a b a a b c")), (1, text("b a b c")), (2, None), (2, []), (None, text("a b")), (3, tok((0, 0, "a"), (2, 0, "b"), (3, 0, "c"))),
            (None, text("a c")), (4, tok((0, 0, "x.a"), (0, 1, "a"), (1, 0, "b"), (1, 1, "c"))), (5, text("z z")), (6, text("c c a"))]
    df = spark.createDataFrame(docs, "doc_id long, tokens array<struct<pos: int, ord: int, term: string, flags: array<string>>>")
    nul = "\0"
    pairs = spark.createDataFrame([("a", "k"), ("a", f"k{nul}l"), (f"a{nul}b", "m"), (f"a{nul}b", f"k{nul}b{nul}n"), (f"A{nul}b{nul}c", "o"), ("c", "k"), (f"b{nul}c", "c"), ("none", "p"), (None, "q")], "term string, synonym string")
    rows = lambda **x: sorted(map(str, SY.synonym_words(df.coalesce(1).sortWithinPartitions("doc_id"), pairs, **x).collect()))
    monkeypatch.setattr(SY, "HELD_BRANCHES", -1)
    words, counts = rows(), rows(counted=True)
    assert len(words) > 40 and any("n=2" in x for x in counts) and any("doc_id=None" in x for x in counts)
    monkeypatch.setattr(SY, "HELD_BRANCHES", 100)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size, tokens in ((1, 1), (2, 4), (3, 1 << 16), (1000, 3), (1000, 1 << 16)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            monkeypatch.setattr(synonym_rows, "TOKENS", tokens)
            assert rows() == words and rows(counted=True) == counts
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_synonym_words_of_the_tables_are_not_rows_before_they_are_counted(spark):
    plan = retrieval.synonym_words(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Aggregate" not in plan and "Generate" not in plan
