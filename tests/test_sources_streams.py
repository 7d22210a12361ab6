import io
import os
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import analyzer as A
from quarry.operators import index as I
from quarry.operators import search as S
from quarry.sources import files as SF
from quarry.sources.resources import read_queries, read_stopwords, read_synonyms, stopword_list, synonym_map
from quarry.streaming import streams as ST


def _docx(text, first="[Content_Types].xml"):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        if first:
            z.writestr(first, "<Types/>")
        z.writestr("word/document.xml",
                   '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main">'
                   f"<w:body><w:p><w:r><w:t>{text}</w:t></w:r></w:p></w:body></w:document>")
    return buf.getvalue()


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    (root / "sub").mkdir()
    (root / "a.txt").write_text("alpha beta")
    (root / "sub" / "b.TXT").write_text("upper case extension")
    (root / "sub" / "c.html").write_text("<html><body>x</body></html>")
    (root / "d.docx").write_bytes(_docx("gamma delta"))
    (root / "e.pdf").write_bytes(b"%PDF-1.4\n")
    (root / "f.doc").write_bytes(bytes.fromhex("D0CF11E0A1B11AE1") + b"\0" * 8)
    # truncated right after the first entry's name: sniffs as docx, cannot be opened
    (root / "broken.docx").write_bytes(_docx("x", first=None)[:80])
    (root / "empty.txt").write_text("")
    (root / "_hidden.txt").write_text("hidden")
    return str(root)


def test_scan_extensions_and_types(spark, tree):
    names = {p.split("/")[-1] for (p,) in SF.scan_files(spark, tree, "txt").select("path").collect()}
    # Spark's file sources skip zero-length files (empty.txt), names starting
    # with '_' or '.' (_hidden.txt); the extension match is case-sensitive (b.TXT)
    assert names == {"a.txt"}
    typed = SF.scan_files(spark, tree).select("path", SF.sniff_media_type(F.col("content")).alias("t"))
    t = {p.split("/")[-1]: m for p, m in typed.collect()}
    assert t["a.txt"] == SF.MEDIA_TXT and t["d.docx"] == SF.MEDIA_DOCX and t["e.pdf"] == SF.MEDIA_PDF
    assert t["f.doc"] == SF.MEDIA_OLE2 and t["c.html"] == SF.MEDIA_HTML
    with pytest.raises(FileNotFoundError):
        SF.scan_files(spark, os.path.join(tree, "nope"))


def test_every_file_is_listed(spark, tmpdir_fresh, monkeypatch):
    monkeypatch.setattr(SF, "LISTING_ROWS", 3)
    files = {"a.txt": "alpha", "empty.txt": "", "_hidden.txt": "hidden é", ".dot/in.txt": "inner", "sub/_x/y z.txt": "deep", "sub/b.bin": "\x00\x01",
             ".git/config": "c", "sub/.e": "", "_SUCCESS": "", "sub/c.txt": "gamma"}
    for name, text in files.items():
        at = os.path.join(tmpdir_fresh, name)
        os.makedirs(os.path.dirname(at), exist_ok=True)
        with open(at, "w") as f:
            f.write(text)
    walked = {os.path.relpath(os.path.join(d, x), tmpdir_fresh) for d, _, names in os.walk(tmpdir_fresh) for x in names}
    rows = SF.scan_files(spark, tmpdir_fresh, every=True).collect()
    got = {os.path.relpath(r.path.removeprefix("file:").replace("%20", " "), tmpdir_fresh): bytes(r.content).decode() for r in rows}
    assert got == files and set(got) == walked and len(rows) == len(walked)
    texts = SF.scan_files(spark, tmpdir_fresh, "txt", every=True)
    assert texts.count() == sum(n.endswith(".txt") for n in files)
    assert [bytes(r.content) for r in SF.scan_files(spark, f"{tmpdir_fresh}/_hidden.txt", every=True).collect()] == ["hidden é".encode()]


def test_extract_and_rejects(spark, tree):
    docs, rejects = SF.load_documents(spark, tree)
    got = {r.filename: r.text for r in docs.collect()}
    assert got["d.docx"] == "gamma delta" and got["a.txt"] == "alpha beta"
    assert "c.html" not in got
    rej = {r.path.split("/")[-1] for r in rejects.collect()}
    assert {"e.pdf", "f.doc", "broken.docx"} <= rej


def test_resources_and_queries(spark, tmpdir_fresh):
    sw = os.path.join(tmpdir_fresh, "stop.txt")
    with open(sw, "w") as f:
        f.write(" foo \nbar\n\n")
    assert stopword_list(read_stopwords(spark, sw)) == ("bar", "foo")
    assert read_stopwords(spark, os.path.join(tmpdir_fresh, "none.txt"), required=False) is None
    syn = os.path.join(tmpdir_fresh, "syn.txt")
    with open(syn, "w") as f:
        f.write("car auto\nnew\0york nyc\n")
    assert synonym_map(read_synonyms(spark, syn)) == {"car": ["auto"], "new\0york": ["nyc"]}
    qd = os.path.join(tmpdir_fresh, "q")
    os.makedirs(qd)
    with open(os.path.join(qd, "queries.txt"), "w") as f:
        f.write("apple\n\n  \nbanana split\n")
    qs = read_queries(spark, qd)
    assert sorted(r.query for r in qs.collect()) == ["  ", "apple", "banana split"]


def test_stream_equals_batch(spark, tmpdir_fresh):
    docs = spark.createDataFrame([(0, "apple banana"), (1, "banana cherry"), (2, "apple pie")], "doc_id long, text string")
    idx = I.build_index(docs, A.AnalyzerOptions(stem=False))
    qd = os.path.join(tmpdir_fresh, "qs")
    os.makedirs(qd)
    with open(os.path.join(qd, "q1.txt"), "w") as f:
        f.write("apple\nbanana\n")
    h, out = ST.stream_queries(spark, qd, idx, stem=False)
    h.awaitTermination()
    streamed = sorted((r.rank, r.doc_id, r.score) for r in spark.read.parquet(out).collect())
    batch_q = read_queries(spark, qd).select("query_id", "query")
    batch = sorted((r.rank, r.doc_id, r.score) for r in S.run_queries(idx, batch_q, stem=False).collect())
    assert streamed == batch and len(batch) == 4

    src = os.path.join(tmpdir_fresh, "docs")
    docs.write.parquet(src)
    stream = spark.readStream.schema(docs.schema).parquet(src)
    ipath = os.path.join(tmpdir_fresh, "sidx")
    ST.stream_index(spark, stream, ipath, A.AnalyzerOptions(stem=False)).awaitTermination()
    s_idx = ST.read_stream_index(spark, ipath)
    assert sorted(map(tuple, s_idx.terms.collect())) == sorted(map(tuple, idx.terms.collect()))


def _batches(spark, folder, parts, schema):
    """One file for each micro-batch, in order."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        for name in os.listdir(folder):
            if name.startswith("part-"):
                os.rename(os.path.join(folder, name), os.path.join(folder, f"b{i}-{name}"))
                os.utime(os.path.join(folder, f"b{i}-{name}"), (1_000_000_000 + i, 1_000_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_statistics_add_up(spark, tmpdir_fresh):
    parts = [[(0, "apple banana"), (1, "banana")], [(2, "apple pie"), (3, "")], [(4, "pie pie cherry")]]
    stream = _batches(spark, f"{tmpdir_fresh}/d", parts, "doc_id long, text string")
    opts, path = A.AnalyzerOptions(stem=False), f"{tmpdir_fresh}/ix"
    ST.stream_index(spark, stream, path, opts).awaitTermination()
    whole = I.build_index(spark.createDataFrame(sum(parts, []), "doc_id long, text string"), opts)

    def same():
        ix = ST.read_stream_index(spark, path)
        assert sorted(map(tuple, ix.terms.select("term", "df", "ttf").collect())) == sorted(map(tuple, whole.terms.collect()))
        assert tuple(ix.stats.first()) == tuple(whole.stats.first())
        for df in (ix.terms, ix.stats):  # neither opens a file of postings
            assert not any("/postings/" in f for f in df.inputFiles())

    same()
    assert ST.compact_stream_index(spark, path) == 2
    assert ST.compact_stream_index(spark, path) == 2
    same()
    # a replayed batch overwrites its own deltas, which the base already holds
    replay = spark.read.parquet(f"{path}/term_deltas").where("batch_id = 1")
    rows = [tuple(r) for r in replay.collect()]
    spark.createDataFrame(rows, replay.schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{path}/term_deltas")
    same()


def test_running_mean_writes_changed_keys_and_resets(spark, tmpdir_fresh):
    parts = [[("a", 1, 2.0), ("b", 1, 4.0)], [("a", 1, 4.0)], [("a", 2, 10.0)], [("b", 1, 100.0), ("b", 2, 1.0)]]
    stream = _batches(spark, f"{tmpdir_fresh}/m", parts, "k string, epoch long, v double")
    handle, out = ST.stream_mean(stream, "v", ["k"], f"{tmpdir_fresh}/means", epoch="epoch")
    handle.awaitTermination()
    written = {}
    for r in spark.read.parquet(out).collect():
        written.setdefault(r.batch_id, []).append((r.k, r.epoch, r.v, r.n))
    assert sorted(written[0]) == [("a", 1, 2.0, 1), ("b", 1, 4.0, 1)]
    assert written[1] == [("a", 1, 3.0, 2)] and written[2] == [("a", 2, 10.0, 1)]
    latest = {r.k: (r.epoch, r.v, r.n) for r in ST.read_means(spark, out, ["k"], "epoch").collect()}
    assert latest == {"a": (2, 10.0, 1), "b": (2, 1.0, 1)}
