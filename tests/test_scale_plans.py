"""Registered plans whose shuffled and written bytes must not outgrow the input."""

from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from quarry.functions import text
from quarry.operators import analyzer as A
from quarry.operators import index, posting_rows
from quarry.plans import ingest, retrieval

SF = "/root/testdata/sf0.001"


def test_synonym_words_are_counted_where_their_document_is(spark):
    df = retrieval.synonym_words(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and "hashpartitioning(doc_id#" in plan
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
    assert len(exchanges) == 1 and ", pos" not in exchanges[0] and "REPARTITION_BY_NUM" in exchanges[0]


def test_synonym_lines_are_written_compressed(spark, monkeypatch):
    paths = []
    written = ingest._written
    monkeypatch.setattr(ingest, "_written", lambda *a: (paths.append(written(*a)), paths[-1])[1])
    assert ingest.read_synonyms(spark, SF).count() > 0
    files = [p.name for p in Path(paths[0].removeprefix("file:")).glob("part-*")]
    assert files and all(f.endswith(".txt.gz") for f in files)


def test_postings_settle_a_word_once_for_all_documents(spark, monkeypatch):
    rows = [(1, "Dan www.Site.ro a aşa _ 12.5 Dan", ), (2, None), (3, "..."), (4, "Ëst XIV " + "z" * 600 + " ŒUVRE i.e. 31/12/2020 Străzile https://www.ab.com/x1 a_b şi și"), (5, "Dan " * 40)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    columns = ["term", "doc_id", "tf", "positions", "dl", "dl_exact"]
    found = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    for opts in (A.AnalyzerOptions(stem=False), A.AnalyzerOptions(), A.AnalyzerOptions(stopwords=("dan",), stopwords_folded=("est",)), A.AnalyzerOptions(tokenizer="whitespace")):
        for norm in ("lossy", "exact"):
            new = index.document_postings(docs, opts, norm=norm)
            assert found(new) == found(index.build_postings(A.analyze(docs, opts=opts), norm))
    monkeypatch.setattr(posting_rows, "TOKENS", 3)
    words = pa.record_batch({"doc_id": [1, 2, 3, 4], "words": pa.array([["a", "B"], None, ["b", "b", "c", "b"], ["B"]], pa.list_(pa.string()))})
    asked = []
    monkeypatch.setattr(posting_rows, "word_terms", lambda opts: lambda w: (asked.append(w), (w.lower(),))[1])
    batches = list(posting_rows.batch_postings(A.AnalyzerOptions(), "exact")(iter([words])))
    assert sorted(asked) == ["B", "a", "b", "c"] and len(batches) == 3
    assert pa.Table.from_batches(batches).select(["term", "doc_id", "tf", "dl"]).to_pylist() == [
        dict(zip(("term", "doc_id", "tf", "dl"), r)) for r in (("a", 1, 1, 2), ("b", 1, 1, 2), ("b", 3, 3, 4), ("c", 3, 1, 4), ("b", 4, 1, 1))]


def test_lossy_length_of_a_number_is_that_of_a_column(spark):
    ns = [*range(300), 1023, 1024, 1025, 20_000, 10**6, 2**31 - 1]
    got = spark.createDataFrame([(n,) for n in ns], "n int").select(text.lossy_length(F.col("n"))).collect()
    assert [r[0] for r in got] == [text.lossy_length_py(n) for n in ns]
