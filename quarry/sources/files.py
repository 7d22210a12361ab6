"""Document files (SRC-1..6): recursive scan, extension and media-type
filters, text extraction, stored-field projection.

Files are read with Spark's ``binaryFile`` source (one row per file, read
by the executors).  Media type is sniffed from leading bytes with column
expressions, and the type filter runs *before* extraction so no rejected
file is decoded.  Plain text is decoded in the JVM; docx (a zip holding
``word/document.xml``) is opened per file inside ``mapInPandas`` with the
standard library, which is the only per-row Python here.
"""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

LISTING = "path string, length long"
LISTING_ROWS = 10_000
BINARY = "path string, modificationTime timestamp, length long, content binary"

# Media types and the allowed document types.
MEDIA_DOCX = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
MEDIA_OLE2 = "application/x-tika-msoffice"
MEDIA_PDF = "application/pdf"
MEDIA_TXT = "text/plain"
MEDIA_HTML = "text/html"
MEDIA_BINARY = "application/octet-stream"
ALLOWED_MEDIA_TYPES = (MEDIA_DOCX, MEDIA_OLE2, MEDIA_PDF, MEDIA_TXT)
SNIFF_BYTES = 1024


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _passed_over(spark: SparkSession, path: str) -> DataFrame:
    """Files that Spark's sources pass over: empty ones, and those with a part of
    their path below ``path`` that begins with ``_`` or ``.``.  The listing is
    read file by file and written down in pieces, so any number of files can be
    listed; the other files are listed by Spark, on the cluster."""
    fs, p = _fs(spark, path)
    root = fs.resolvePath(p).toString().rstrip("/")
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-listing-{uuid.uuid4().hex}"
    found, rows = fs.listFiles(p, True), []

    def put() -> None:
        spark.createDataFrame(rows, LISTING).write.mode("append").parquet(out)
        rows.clear()

    while found.hasNext():
        status = found.next()
        name, size = status.getPath().toString(), status.getLen()
        below = name.removeprefix(root).split("/") if name != root else [name.rsplit("/", 1)[-1]]
        if size == 0 or any(x[:1] in ("_", ".") for x in below):
            rows.append((name, size))
        if len(rows) == LISTING_ROWS:
            put()
    put()
    return spark.read.schema(LISTING).parquet(out)


def _read_passed_over(batches):
    """The bytes of the listed files, opened where the task runs."""
    import pyarrow as pa
    from pyarrow import fs as pafs

    for batch in batches:
        for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            content = b""
            if size:
                uri = re.sub(r"^file:/(?!/)", "file:///", path)
                system, name = pafs.FileSystem.from_uri(uri.replace(" ", "%20"))
                with system.open_input_stream(name) as stream:
                    content = stream.read()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([content], pa.binary())], names=["path", "length", "content"])


def scan_files(spark: SparkSession, path: str, extensions=(), every: bool = False) -> DataFrame:
    """SRC-1: regular files under ``path`` (a directory, recursively, or a
    single file); a missing path is an error.  With ``extensions`` only
    matching paths are kept (SRC-2).  Spark passes over empty files and names
    starting with ``_`` or ``.``; with ``every`` they are listed and read too."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    matching = has_extension(F.col("path"), extensions) if extensions else F.lit(True)
    if not every:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(matching)
    rest = _passed_over(spark, path).where(matching).repartition("path").mapInArrow(_read_passed_over, "path string, length long, content binary")
    usual = spark.read.schema(BINARY).format("binaryFile").option("recursiveFileLookup", "true").load(path).where(matching)
    return usual.where("length > 0").select("path", "length", "content").unionByName(rest)


def has_extension(path: Column, extensions) -> Column:
    """SRC-2: whole-path match of ``.*\\.(ext1|ext2…)``, case-sensitive;
    extensions are escaped (no pattern injection)."""
    exts = [e.strip() for e in (extensions.split(",") if isinstance(extensions, str) else extensions) if e.strip()]
    if not exts:
        return F.lit(True)
    rx = r"^(?:.*\.(" + "|".join(re.escape(e) for e in exts) + r"))\z"
    return path.rlike(rx)


def sniff_media_type(content: Column) -> Column:
    """SRC-3: media type from the leading bytes only (no file-name hint)."""
    head = F.substring(content, 1, SNIFF_BYTES)
    hexhead = F.hex(F.substring(content, 1, 8))
    text = F.lower(F.ltrim(F.decode(head, "ISO-8859-1")))  # ASCII markers; never fails
    return (
        F.when(F.substring(content, 1, 5) == F.lit(b"%PDF-"), F.lit(MEDIA_PDF))
        .when(hexhead.startswith("D0CF11E0A1B11AE1"), F.lit(MEDIA_OLE2))
        .when(hexhead.startswith("504B0304") & (F.instr(F.decode(content, "ISO-8859-1"), "word/") > 0), F.lit(MEDIA_DOCX))
        .when(hexhead.startswith("504B0304"), F.lit("application/zip"))
        .when(text.startswith("<!doctype html") | text.startswith("<html"), F.lit(MEDIA_HTML))
        .when(~F.hex(head).rlike("^(?:..)*?00"), F.lit(MEDIA_TXT))
        .otherwise(F.lit(MEDIA_BINARY))
    )


def filter_media_type(df: DataFrame, types=ALLOWED_MEDIA_TYPES, col: str = "media_type") -> DataFrame:
    """SRC-4: keep rows whose media type is exactly one of ``types``."""
    return df.where(F.col(col).isin(*types))


def _docx_text(data: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        xml = z.read("word/document.xml")
    root = ElementTree.fromstring(xml)
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    paras = []
    for p in root.iter(ns + "p"):
        paras.append("".join(t.text or "" for t in p.iter(ns + "t")))
    return "\n".join(paras)


def _extract_batches(batches):
    for pdf in batches:
        texts, errors = [], []
        for mt, content in zip(pdf["media_type"], pdf["content"]):
            try:
                if mt == MEDIA_DOCX:
                    texts.append(_docx_text(bytes(content)))
                    errors.append(None)
                else:
                    texts.append(None)
                    errors.append(f"no extractor for {mt}")
            except Exception as e:  # noqa: BLE001 - any decoding failure rejects the file only
                texts.append(None)
                errors.append(f"{type(e).__name__}: {e}"[:500])
        yield pd.DataFrame({"path": pdf["path"], "media_type": pdf["media_type"], "text": texts, "error": errors})


def extract_text(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC-5: (documents, rejects).  ``files`` needs path, content,
    media_type.  Text files are decoded in the JVM; docx in a
    ``mapInPandas`` step; any failure moves the file to ``rejects`` and the
    job continues.  No character limit."""
    raw = F.col("content").cast("string")
    valid = F.is_valid_utf8(raw)
    txt = files.where(F.col("media_type") == MEDIA_TXT).select(
        "path", "media_type", F.when(valid, raw).alias("text"), F.when(~valid, F.lit("not valid UTF-8")).alias("error"))
    other = files.where(F.col("media_type") != MEDIA_TXT).select("path", "media_type", "content")
    decoded = other.mapInPandas(_extract_batches, "path string, media_type string, text string, error string")
    allrows = txt.unionByName(decoded)
    return allrows.where(F.col("error").isNull()).drop("error"), allrows.where(F.col("error").isNotNull())


def document_rows(df: DataFrame, path_col: str = "path") -> DataFrame:
    """SRC-6: filename = last path component, filepath = the full path."""
    return df.select("*", F.element_at(F.split(F.col(path_col), "/"), -1).alias("filename"),
                     F.col(path_col).alias("filepath"))


def load_documents(spark: SparkSession, path: str, extensions=()) -> tuple[DataFrame, DataFrame]:
    """SRC-1..6 composed: scan → sniff → filter → extract → stored fields,
    with a stable ``doc_id`` (hash of the path)."""
    files = scan_files(spark, path, extensions).select("path", "content")
    typed = files.select("path", "content", sniff_media_type(F.col("content")).alias("media_type"))
    docs, rejects = extract_text(filter_media_type(typed))
    docs = document_rows(docs).select(F.xxhash64("path").alias("doc_id"), "filename", "filepath", "media_type", "text")
    return docs, rejects
