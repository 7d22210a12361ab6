"""Inverted index as three parquet tables (IDX-1..8, SNK-1/2).

* ``postings(term, doc_id, tf, positions, dl)`` — one row per (term, doc).
  The document's ranking length ``dl`` (lossy one-byte norm, decoded) is
  denormalised into every posting so scoring never joins ``docs``.
* ``terms(term, df, ttf)`` — document / total frequency per term; with the
  layout by term also ``first_bucket`` and ``last_bucket``, the directory of
  the folders that hold a term's postings.
* ``docs(doc_id, filename, filepath, n_tokens, dl_exact, norm, dl)``.
* ``stats(n_docs, sum_ttf, avgdl)`` — a single row.

Build plan: the postings of a document are cut from its own sorted tokens, so
building postings needs no shuffle at all.  The analyser settles each distinct
word of a batch of documents once.  Two layouts can be written:

* ``document``: postings stay with their document's partition.  No exchange;
  a batch of many queries sums a document's terms before its one exchange, and
  every lookup opens every file.
* ``term``: one more exchange deals the postings by range of (term, salt of the
  document) into buckets of ``BUCKET_BYTES``, one folder each.  The range
  bounds come from a sample of the postings, so a frequent term is cut into as
  many buckets as its list needs, and a lookup opens the folders of its terms.
  Many postings are dealt in passes over ranges of terms, so that shuffle files
  hold those of one pass.

Postings are sorted by term inside each file, so parquet min/max statistics
prune row groups for term lookups.  Term and collection statistics are partial
aggregates over the written postings.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import shuffle_cleanup, stage_table
from .analyzer import AnalyzerOptions, analyze, explode_token_rows
from .posting_rows import batch_postings, by_words
from .rowindex import with_row_index

INDEX_TABLES = ("postings", "terms", "docs", "stats")
# Bytes of postings in a bucket of the layout by term.
BUCKET_BYTES = 64 << 20
# Bytes of postings that are dealt by term at a time: only theirs lie in shuffle files.
PASS_BYTES = 4 << 30
# Terms drawn to find the bounds of the passes, for each pass.
PASS_TERMS = 500


def analyzed_docs(docs: DataFrame, opts: AnalyzerOptions | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    return analyze(docs, id_col, text_col, opts)


def build_postings(analyzed: DataFrame, norm: str = "lossy") -> DataFrame:
    """IDX-1: term, doc_id, tf, positions (sorted; overlaps repeat the
    position), dl (ranking length), dl_exact.

    A document's tokens are all in its own row, so its postings are built
    inside the row: sort the (term, pos) array, find where each term's run
    starts, and slice the runs.  No aggregation and no exchange; postings
    stay with their document's partition."""
    dl = analyzed["dl"] if norm == "exact" else T.lossy_length(analyzed["dl"])
    srt = F.sort_array(F.transform("tokens", lambda x: F.struct(x["term"].alias("term"), x["pos"].alias("pos"))))
    a = analyzed.select("doc_id", dl.alias("dl"), F.col("dl").alias("dl_exact"), srt.alias("_s"))
    s = F.col("_s")
    n = F.size(s)
    idx = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(idx, lambda i: (i == 0) | (F.element_at(s, i + 1)["term"] != F.element_at(s, F.greatest(i, F.lit(1)))["term"]))
    b = a.select("doc_id", "dl", "dl_exact", "_s", starts.alias("_st"))
    st = F.col("_st")
    # exclusive run ends; empty when there is no run (zip_with would pad)
    ends = F.when(F.size(st) > 0, F.concat(F.slice(st, 2, F.greatest(F.size(st) - 1, F.lit(0))), F.array(F.size(s)))
                  ).otherwise(F.array().cast("array<int>"))
    runs = F.zip_with(st, ends, lambda a0, e0: F.struct(
        F.element_at(s, a0 + 1)["term"].alias("term"),
        (e0 - a0).cast("int").alias("tf"),
        F.transform(F.slice(s, a0 + 1, e0 - a0), lambda x: x["pos"]).alias("positions")))
    c = b.select("doc_id", "dl", "dl_exact", runs.alias("_r"))
    r = explode_token_rows(c, ["doc_id", "dl", "dl_exact"], arr="_r", name="p")
    return r.select(F.col("p.term").alias("term"), "doc_id", F.col("p.tf").alias("tf"),
                    F.col("p.positions").alias("positions"), "dl", "dl_exact")


def document_postings(docs: DataFrame, opts: AnalyzerOptions | None = None, id_col="doc_id", text_col="text", norm: str = "lossy") -> DataFrame:
    """IDX-1 from texts: the rows of ``build_postings``.  Where the chain looks at
    one token at a time (no synonyms, no rules of the user), an Arrow batch of
    documents is analysed by its distinct words (``posting_rows``)."""
    opts = opts or AnalyzerOptions()
    if not by_words(opts):
        return build_postings(analyze(docs, id_col, text_col, opts), norm)
    words = docs.select(F.col(id_col).alias("doc_id"), T.tokenize(F.col(text_col)).alias("words"))
    schema = f"term string, doc_id {words.schema['doc_id'].dataType.simpleString()}, tf int, positions array<int>, dl int, dl_exact int"
    return words.mapInArrow(batch_postings(opts, norm), schema)


def lengths_from_postings(postings: DataFrame) -> DataFrame:
    """IDX-3/4 from written postings (no second analysis pass): all tokens
    = Σ tf, ranking length carried in every posting."""
    per = postings.groupBy("doc_id").agg(F.sum("tf").cast("int").alias("n_tokens"), F.max("dl_exact").alias("dl_exact"))
    return per.select("doc_id", "n_tokens", (F.col("n_tokens") - F.col("dl_exact")).alias("n_overlap"), "dl_exact",
                      T.encode_length(F.col("dl_exact")).alias("norm"), T.lossy_length(F.col("dl_exact")).alias("dl"))


def doc_lengths(analyzed: DataFrame) -> DataFrame:
    """IDX-3/4: per document the token count with and without overlaps, the
    one-byte norm and its decoded value."""
    return analyzed.select(
        "doc_id",
        F.col("n_tokens"),
        (F.col("n_tokens") - F.col("dl")).alias("n_overlap"),
        F.col("dl").alias("dl_exact"),
        T.encode_length(F.col("dl")).alias("norm"),
        T.lossy_length(F.col("dl")).alias("dl"),
    )


def term_stats(postings: DataFrame) -> DataFrame:
    """IDX-5: df and total term frequency per term (partial + final agg)."""
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf")
    )


def collection_stats(postings: DataFrame) -> DataFrame:
    """IDX-6: one row — documents with at least one token, total tokens
    (overlaps included), average length."""
    per_doc = postings.groupBy("doc_id").agg(F.sum("tf").alias("n"))
    return per_doc.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("sum_ttf"),
    ).select(
        "n_docs",
        "sum_ttf",
        F.when(F.col("n_docs") > 0, F.col("sum_ttf") / F.col("n_docs")).otherwise(F.lit(0.0)).alias("avgdl"),
    )


def vocabulary(postings_or_tokens: DataFrame) -> DataFrame:
    """IDX-8: distinct terms."""
    return postings_or_tokens.select("term").distinct()


def build_docs(docs: DataFrame, id_col="doc_id", path_col="filepath") -> DataFrame:
    """IDX-2: stored fields only (content is searchable, not stored)."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.element_at(F.split(F.col(path_col), "/"), -1).alias("filename"),
        F.col(path_col).alias("filepath"),
    )


class Index:
    """Handle on the four index tables (lazy DataFrames)."""

    def __init__(self, postings: DataFrame, terms: DataFrame, docs: DataFrame, stats: DataFrame,
                 deletions: DataFrame | None = None, grams: DataFrame | None = None):
        self._numbered = self._n_docs = None
        self.deletions, self.grams = deletions, grams  # see ``expansion``; None where not written
        self.postings = postings
        self.terms = terms
        self.docs = docs
        self.stats = stats

    def numbered_docs(self) -> DataFrame:
        """(doc_id, place): the documents numbered in index order, written once
        for this handle."""
        if self._numbered is None:
            self._numbered = stage_table(with_row_index(self.docs.select("doc_id"), ["doc_id"], "place"), "places")
        return self._numbered

    @property
    def n_docs(self) -> int:
        """Documents with a token, read once for this handle."""
        if self._n_docs is None:
            row = self.stats.select("n_docs").first()
            self._n_docs = row.n_docs if row else 0
        return self._n_docs

    @property
    def by_term(self) -> bool:
        """Whether the postings lie in buckets that the term table names."""
        return "bucket" in self.postings.columns


def build_index(
    docs: DataFrame,
    opts: AnalyzerOptions | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = None,
    norm: str = "lossy",
) -> Index:
    """IDX-7 (lazy): docs → postings, terms, docs table, stats.  ``path_col``
    names the stored path; by default the id is used as the path."""
    src = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        (F.col(path_col) if path_col else F.col(id_col).cast("string")).alias("filepath"),
    )
    postings = document_postings(src, opts, norm=norm)
    stored = build_docs(src)
    lengths = doc_lengths(analyze(src, "doc_id", "text", opts))
    docs_table = stored.join(lengths, "doc_id", "left")
    return Index(postings, term_stats(postings), docs_table, collection_stats(postings))


def posting_bytes() -> Column:
    """Roughly the bytes of a posting."""
    return F.length("term") + 24 + 4 * F.col("tf")


def deal_by_term(postings: DataFrame, buckets: int, first: int = 0) -> DataFrame:
    """Postings in ``buckets`` ranges of (term, salt of the document), each in
    the order of its terms, with the range's number, from ``first`` on, in
    ``bucket``."""
    dealt = postings.repartitionByRange(buckets, F.col("term"), F.hash("doc_id"))
    return dealt.withColumn("bucket", F.spark_partition_id() + first).sortWithinPartitions("bucket", "term", "doc_id")


def passes(postings: DataFrame, size: int, pass_bytes: int | None = None) -> list[Column]:
    """Ranges of terms that hold all postings together, each about ``pass_bytes``
    (``PASS_BYTES``) of the ``size``; terms that are drawn bound them."""
    n = -(-size // (pass_bytes or PASS_BYTES))
    if n <= 1:
        return [F.lit(True)]
    drawn = postings.select("term").sample(min(1.0, n * PASS_TERMS / max(postings.count(), 1)), 7).limit(4 * n * PASS_TERMS)
    terms = sorted(r.term for r in drawn.collect())
    bounds = sorted({terms[len(terms) * k // n] for k in range(1, n)}) if terms else []
    if not bounds:
        return [F.lit(True)]
    term = F.col("term")
    # A term without text would fit no range.
    return [(term < bounds[0]) | term.isNull(), *[(term >= a) & (term < b) for a, b in zip(bounds, bounds[1:])], term >= bounds[-1]]


def term_directory(postings: DataFrame) -> DataFrame:
    """IDX-5 with the buckets of each term; ranges of terms are contiguous."""
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"),
        F.min("bucket").alias("first_bucket"), F.max("bucket").alias("last_bucket"))


def write_index(index: Index, path: str, postings_files: int | None = None, layout: str = "document",
                bucket_bytes: int = BUCKET_BYTES, expansions: bool = False) -> None:
    """SNK-1: create mode — replaces an earlier index at ``path``.  Postings
    are written first (the one expensive job); terms and stats are then
    derived from the written postings, not from a second analysis pass.  With
    ``layout="term"`` the written postings are dealt by term afterwards, into
    ``postings_files`` buckets or as many as ``bucket_bytes`` asks for.  With
    ``expansions`` the tables for inexact clauses are written too."""
    if layout not in ("document", "term"):
        raise ValueError("layout must be 'document' or 'term'")
    spark = index.postings.sparkSession
    by_document = os.path.join(path, "postings" if layout == "document" else "by_document")
    p = index.postings
    if postings_files and layout == "document":
        p = p.repartition(postings_files, "term")
    with shuffle_cleanup(spark):
        p.sortWithinPartitions("term", "doc_id").write.mode("overwrite").parquet(by_document)
    written = spark.read.parquet(by_document)
    if layout == "document":
        term_stats(written).sortWithinPartitions("term").write.mode("overwrite").parquet(os.path.join(path, "terms"))
    else:
        size = written.agg(F.sum(posting_bytes()).alias("n")).first().n or 0
        buckets = postings_files or max(spark.sparkContext.defaultParallelism, -(-size // bucket_bytes))
        at = os.path.join(path, "postings")
        parts = passes(written, size)
        each = -(-buckets // len(parts))
        for k, part in enumerate(parts):
            with shuffle_cleanup(spark):
                deal_by_term(written.where(part), each, k * each).write.mode("append" if k else "overwrite").partitionBy("bucket").parquet(at)
        dealt = spark.read.schema(f"{_ddl(written.schema)}, bucket int").parquet(at)
        with shuffle_cleanup(spark):
            term_directory(dealt).sortWithinPartitions("term").write.mode("overwrite").parquet(os.path.join(path, "terms"))
    with shuffle_cleanup(spark):
        collection_stats(written).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "stats"))
    stored = index.docs.select("doc_id", "filename", "filepath")
    lengths = lengths_from_postings(written)
    docs = stored.join(lengths, "doc_id", "left").select(
        "doc_id", "filename", "filepath",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_tokens", "n_overlap", "dl_exact", "norm", "dl")])
    with shuffle_cleanup(spark):
        docs.write.mode("overwrite").parquet(os.path.join(path, "docs"))
    if layout == "term":
        fs, staged = _fs(spark, by_document)
        fs.delete(staged, True)
    if expansions:
        from .expansion import write_expansions

        write_expansions(spark.read.parquet(os.path.join(path, "terms")), path)


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def read_index(spark: SparkSession, path: str) -> Index:
    """SNK-2: the path must exist, be a directory and hold the four tables."""
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    if not _is_dir(spark, path):
        raise NotADirectoryError(f"an index is a folder of tables; {path} is a file")
    tables = {}
    for name in INDEX_TABLES:
        full = os.path.join(path, name)
        if not _exists(spark, full):
            raise FileNotFoundError(full)
        tables[name] = spark.read.parquet(full)
    need = {"postings": {"term", "doc_id", "tf", "positions", "dl"}, "terms": {"term", "df", "ttf"},
            "stats": {"n_docs", "sum_ttf", "avgdl"}, "docs": {"doc_id", "filepath"}}
    for name, cols in need.items():
        missing = cols - set(tables[name].columns)
        if missing:
            raise ValueError(f"index table {name} lacks columns {sorted(missing)}")
    more = [spark.read.parquet(os.path.join(path, x)) if _exists(spark, os.path.join(path, x)) else None for x in ("deletions", "grams")]
    return Index(tables["postings"], tables["terms"], tables["docs"], tables["stats"], *more)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).isDirectory()


_MATERIALIZED: dict = {}


def materialize_index(index: Index, key=None, layout: str = "document", expansions: bool = False) -> Index:
    """Write ``index`` under the session's shared checkpoint folder and read
    it back (cuts the lineage; every later query scans parquet).  With a
    ``key``, the written index is reused for the same key in this process."""
    import uuid

    from ..session import ensure_checkpoint_dir

    spark = index.postings.sparkSession
    if key is not None and key in _MATERIALIZED:
        path = _MATERIALIZED[key]
        if _exists(spark, os.path.join(path, "stats")):
            return read_index(spark, path)
    base = ensure_checkpoint_dir(spark)
    path = base.rstrip("/") + "/quarry-index-" + uuid.uuid4().hex
    write_index(index, path, layout=layout, expansions=expansions)
    if key is not None:
        _MATERIALIZED[key] = path
    return read_index(spark, path)
