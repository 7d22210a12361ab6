"""Registered source-operator plans over the driver tables (SRC-1..6, 9..11
and SNK-5).

Column logic runs on the ``pages`` and ``documents`` tables: URLs stand in for
paths, page HTML and document text (as bytes) for file contents.  File sources
read files that Spark has written from those tables into the shared folder.
Docx extraction and JSON arrays are exercised on fixture folders in the tests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..session import ensure_checkpoint_dir
from ..sources import conversations as SC
from ..sources import files as SF
from ..sources import resources as SR
from ..sources import sinks
from .dialogue import EMO_SQL, nested
from .sqlgen import q
from .tables import load

PAGE_EXTENSIONS = ("html", "htm")


def has_extension(spark, sf):
    p = load(spark, sf, "pages")
    return p.select("page_id", "url", SF.has_extension(F.col("url"), PAGE_EXTENSIONS).alias("has_ext"))


def document_rows(spark, sf):
    p = load(spark, sf, "pages")
    return SF.document_rows(p.select("page_id", F.col("url").alias("path"))).select("page_id", "filename", "filepath")


def media_types(spark, sf):
    pages = load(spark, sf, "pages").select(F.lit("pages").alias("source"), F.col("page_id").alias("id"),
                                            F.encode("html", "UTF-8").alias("content"))
    docs = load(spark, sf, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"),
                                               F.encode("text", "UTF-8").alias("content"))
    typed = pages.unionByName(docs).select("source", "id", SF.sniff_media_type(F.col("content")).alias("media_type"))
    return typed.select("*", F.col("media_type").isin(*SF.ALLOWED_MEDIA_TYPES).alias("allowed"))


def allowed_documents(spark, sf):
    """SRC-4: only allowed media types pass (pages are HTML: all rejected)."""
    return SF.filter_media_type(media_types(spark, sf)).select("source", "id", "media_type")


def _written(spark, lines, name, compression="none"):
    """A folder of text files with one line a row."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{name}-{uuid.uuid4().hex}"
    lines.write.option("compression", compression).text(path)
    return path


def _words(spark, sf):
    """The blank-split words of every document, line ends as blanks."""
    return load(spark, sf, "documents", spread_rows=True).select(F.split(F.translate("text", "\n", " "), " ").alias("w"))


def read_files(spark, sf):
    """SRC-1/5: text files scanned, decoded and counted, with the rejects."""
    path = _written(spark, load(spark, sf, "documents", spread_rows=True).select("text"), "files")
    files = SF.scan_files(spark, path, ("txt",))
    docs, rejects = SF.extract_text(files.select("path", "content", SF.sniff_media_type(F.col("content")).alias("media_type")))
    read = docs.agg(F.sum(F.length("text")).alias("n_chars"))
    return read.crossJoin(F.broadcast(rejects.agg(F.count("*").alias("n_rejects"))))  # one row each


def read_stopwords(spark, sf):
    """SRC-9: a word list of padded lines, one for every word of every document."""
    lines = _words(spark, sf).select(F.explode("w").alias("line")).select(F.concat(F.lit("  "), "line", F.lit(" ")))
    return SR.read_stopwords(spark, _written(spark, lines, "stopwords"))


def read_synonyms(spark, sf):
    """SRC-10: every three words in a row of every document, one and two words;
    the lines repeat each word three times, so their files are compressed."""
    w = _words(spark, sf).select("w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("i"))
    lines = w.select(F.array_join(F.expr("slice(w, i, 3)"), " ").alias("line"))
    pairs = SR.read_synonyms(spark, _written(spark, lines, "synonyms", "gzip"))
    return pairs.groupBy("term", "synonym").agg(F.count("*").alias("n"))


def read_queries(spark, sf):
    """SRC-11: query lines of a folder of files."""
    path = _written(spark, load(spark, sf, "benchmark").select("text"), "queries")
    return SR.read_queries(spark, path).select("query")


def _arrays(batches):
    """The JSON objects of a partition as the lines of one array."""
    import pyarrow as pa

    first = True
    for batch in batches:
        lines = [("[" if first and not i else ",") + x for i, x in enumerate(batch.column(0).to_pylist())]
        first = first and not lines
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], names=["value"])


def _conversation_files(spark, sf, subtask):
    """The conversations as JSON arrays, a third of them in each split."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-conversations-{uuid.uuid4().hex}"
    rows = nested(spark, sf)
    for i, split in enumerate(P.SPLITS):
        lines = rows.where(F.col("conversation_ID") % 3 == i).select(F.to_json(F.struct(*rows.columns)).alias("value"))
        lines.mapInArrow(_arrays, "value string").write.text(SC.conversation_path(base, split, subtask))
    return base


def _conversation_columns(df):
    return df.select("split", "conversation_ID", F.size("conversation").alias("n_utterances"), F.array_join("conversation.text", "|").alias("texts"),
                     F.array_join("conversation.emotion", ",").alias("emotions"), F.size("emotion-cause_pairs").alias("n_pairs"), "has_spans", "has_emotions", "has_video")


def read_conversations(spark, sf):
    """SRC-7: the training conversations of subtask 2, read from JSON arrays."""
    return _conversation_columns(SC.read_conversations(spark, _conversation_files(spark, sf, "2"), "train", "2"))


def read_all_splits(spark, sf):
    """SRC-8: the conversations of all splits."""
    return _conversation_columns(SC.read_all_splits(spark, _conversation_files(spark, sf, "1"), "1"))


def metric_log(spark, sf):
    """SNK-5: a log appended to twice and read back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-metrics-{uuid.uuid4().hex}"
    events = load(spark, sf, "documents").groupBy(F.col("lang").alias("split"))
    for step in (0, 1):
        sinks.append_metrics(events.agg(F.lit("n_chars").alias("metric"), F.lit(step).alias("step"), F.sum("n_chars").alias("value")), path)
    return spark.read.parquet(path).select("split", "metric", "step", "value")


QUERIES = {
    "read_files": read_files,
    "read_stopwords": read_stopwords,
    "read_synonyms": read_synonyms,
    "read_queries": read_queries,
    "read_conversations": read_conversations,
    "read_all_splits": read_all_splits,
    "metric_log": metric_log,
    "has_extension": has_extension,
    "document_rows": document_rows,
    "media_types": media_types,
    "allowed_documents": allowed_documents,
}

_EXT_RX = r".*\.(" + "|".join(PAGE_EXTENSIONS) + ")"
_ALLOWED = "(" + ", ".join(q(t) for t in SF.ALLOWED_MEDIA_TYPES) + ")"
_SNIFF = f"""
  CASE WHEN starts_with(t, '%PDF-') THEN {q(SF.MEDIA_PDF)}
       WHEN starts_with(hex(substr(t, 1, 8)), 'D0CF11E0A1B11AE1') THEN {q(SF.MEDIA_OLE2)}
       WHEN starts_with(hex(substr(t, 1, 8)), '504B0304') AND contains(t, 'word/') THEN {q(SF.MEDIA_DOCX)}
       WHEN starts_with(hex(substr(t, 1, 8)), '504B0304') THEN 'application/zip'
       WHEN starts_with(lower(ltrim(substr(t, 1, {SF.SNIFF_BYTES}))), '<!doctype html')
         OR starts_with(lower(ltrim(substr(t, 1, {SF.SNIFF_BYTES}))), '<html') THEN {q(SF.MEDIA_HTML)}
       WHEN NOT contains(substr(t, 1, {SF.SNIFF_BYTES}), chr(0)) THEN {q(SF.MEDIA_TXT)}
       ELSE {q(SF.MEDIA_BINARY)} END"""
_TYPED = f"""typed AS (
  SELECT source, id, {_SNIFF} AS media_type FROM (
    SELECT 'pages' AS source, page_id AS id, html AS t FROM pages
    UNION ALL SELECT 'documents', doc_id, text FROM documents))"""

_WORDS = "SELECT string_split(replace(text, chr(10), ' '), ' ') AS w FROM documents"
_NESTED = f"""SELECT conv_id, count(*) AS n, string_agg(text, '|' ORDER BY turn) AS texts,
  string_agg({EMO_SQL}[1 + CAST((conv_id * 31 + turn * 7) % 7 AS INTEGER)], ',' ORDER BY turn) AS emotions,
  count(*) FILTER (turn >= 1) AS n_pairs FROM conversations GROUP BY conv_id"""


def _conversation_sql(split, where, subtask):
    return f"""SELECT {split} AS split, conv_id AS conversation_ID, CAST(n AS INTEGER) AS n_utterances, texts, emotions,
        CAST(n_pairs AS INTEGER) AS n_pairs, {split} = 'train' AND {subtask} = 1 AS has_spans, {split} = 'train' AS has_emotions,
        {subtask} = 2 AS has_video FROM ({_NESTED}) WHERE {where}"""


SQL = {
    "read_files": "SELECT CAST(sum(length(text) + 1) AS BIGINT) AS n_chars, CAST(0 AS BIGINT) AS n_rejects FROM documents",
    "read_stopwords": f"""SELECT DISTINCT trim(word) AS word FROM (SELECT unnest(w) AS word FROM ({_WORDS}))
        WHERE length(trim(word)) > 0""",
    "read_synonyms": f"""SELECT line[:strpos(line, ' ') - 1] AS term, line[strpos(line, ' ') + 1:] AS synonym, count(*) AS n
        FROM (SELECT array_to_string(list_slice(w, i, i + 2), ' ') AS line FROM (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM ({_WORDS})))
        WHERE strpos(line, ' ') > 1 GROUP BY ALL""",
    "read_conversations": _conversation_sql("'train'", "conv_id % 3 = 0", 2),
    "read_all_splits": _conversation_sql("['train', 'trial', 'test'][1 + CAST(conv_id % 3 AS INTEGER)]", "true", 1),
    "read_queries": """SELECT query FROM (SELECT unnest(string_split(text, chr(10))) AS query FROM benchmark)
        WHERE length(query) > 0""",
    "metric_log": """SELECT lang AS split, 'n_chars' AS metric, CAST(step AS INTEGER) AS step,
        CAST(sum(n_chars) AS DOUBLE) AS value FROM documents, (VALUES (0), (1)) s(step) GROUP BY lang, step""",
    "has_extension": f"SELECT page_id, url, regexp_full_match(url, {q(_EXT_RX)}) AS has_ext FROM pages",
    "document_rows": "SELECT page_id, string_split(url, '/')[-1] AS filename, url AS filepath FROM pages",
    "media_types": f"WITH {_TYPED} SELECT source, id, media_type, media_type IN {_ALLOWED} AS allowed FROM typed",
    "allowed_documents": f"WITH {_TYPED} SELECT source, id, media_type FROM typed WHERE media_type IN {_ALLOWED}",
}
