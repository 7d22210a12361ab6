"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with elastic net,
then temperature calibration.

Document frequencies come from all learning documents (a map with partial sums
and one small aggregation of at most ``FEATURES`` rows); only the learner reads
a bounded sample of ``PER_LANG`` documents a language; prediction is a map over
whole texts.  Null text, or text without a letter: ``und`` with score 0, as is
everything if no document has a language.  Repeated rows are predicted row by
row; further columns are not read."""

from __future__ import annotations

import re
from decimal import Decimal
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import map_batches, table
from quarry.llm.ftrl import Ftrl, Row, scores, softmax, temperature

BITS = 15
FEATURES = 1 << BITS
#: Documents a language in the learner's sample (expected; drawn by a hash of the id).
PER_LANG = 700
EPOCHS = 3
_WORD = re.compile(r"[^\W\d_]")  # letters, and number signs such as \u00bd
_M1, _M2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def has_letter(text: str) -> bool:
    return any(found.group().isalpha() for found in _WORD.finditer(text))


def buckets(text: str) -> np.ndarray:
    """A feature for each character n-gram of one to three characters of the
    lower-cased text, in order of occurrence."""
    x = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    one = x * _M1
    two = (one[:-1] ^ (x[1:] + np.uint32(1))) * _M2
    three = (two[:-1] ^ (x[2:] + np.uint32(2))) * _M1
    return np.concatenate([h >> np.uint32(32 - BITS) for h in (one, two, three)]).astype(np.int64)


def counted(text: str) -> Row:
    """Distinct features and their share of all n-grams of the text."""
    at, n = np.unique(buckets(text), return_counts=True)
    return at, n / max(n.sum(), 1)


def held_out(fold: int, of: int = 4):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of)) == fold


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that have each feature, and their number, over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, has = np.zeros(FEATURES, np.int64), 0, np.zeros(FEATURES, bool)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                has[:] = False
                has[buckets(text)] = True
                df += has
                n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1], pa.int32()), pa.array([*df[at].tolist(), n], pa.int64())], names=["feature", "df"])

    out, n = np.zeros(FEATURES, np.int64), 0
    for r in docs.select("text").where("text is not null").mapInArrow(count, "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df")).toLocalIterator():
        if r.feature < 0:
            n = r.df
        else:
            out[r.feature] = r.df
    return out, n


def sample(docs: DataFrame, per_lang: int) -> list[tuple[str, Row]]:
    """The bounded sample as sparse rows, in a fixed order."""
    # One row a language, as the model has a column for each: small enough to broadcast.
    sizes = docs.groupBy("lang").agg(F.count("*").alias("lang_rows"))
    # The hash as 62 bits against a threshold in whole numbers: right for any number of rows.
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(7)), 2) <= F.floor(F.lit(Decimal(per_lang << 62)) / F.col("lang_rows").cast("decimal(20,0)"))
    drawn = docs.join(F.broadcast(sizes), "lang").where(draw).select("doc_id", "lang", "text")

    def features(batch: pa.RecordBatch) -> dict:
        rows = [counted(t) for t in batch.column(2).to_pylist()]
        return {"doc_id": batch.column(0), "lang": batch.column(1), "at": [r[0].tolist() for r in rows], "share": [r[1].tolist() for r in rows]}

    got = map_batches(drawn, features, "doc_id long, lang string, at array<int>, share array<float>").collect()
    got.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.lang, len(r.at)))
    return [(r.lang, (np.array(r.at, np.int64), np.array(r.share))) for r in got]


def train(docs: DataFrame, per_lang: int = PER_LANG) -> dict | None:
    """Weights (features x languages, with the TF-IDF factor folded in)."""
    known = docs.where("text is not null and lang is not null and length(text) > 0")
    rows = sample(known, per_lang)
    langs = sorted({x for x, _ in rows})
    if not langs:
        return None
    df, n = document_frequencies(known)
    scale = 20.0 * np.log((1 + n) / (1 + df))
    x = [(at, share * scale[at]) for _, (at, share) in rows]
    y = np.array([langs.index(lang) for lang, _ in rows])
    fold = np.arange(len(x)) % 5 == 4
    model = Ftrl(FEATURES, len(langs), alpha=0.5, l1=0.02, l2=0.5)
    model.fit([r for r, f in zip(x, fold) if not f], y[~fold], EPOCHS)
    weights, bias = model.table()
    t = temperature(scores([r for r, f in zip(x, fold) if f], weights, bias), y[fold])
    return {"langs": langs, "weights": (weights * scale[:, None] / t).astype(np.float32), "bias": bias / t}


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, the most probable language and its probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES x languages floats

    def one(text: str | None) -> tuple[str, float]:
        m = shared.value
        if m is None or text is None or not has_letter(text):
            return "und", 0.0
        at = buckets(text)
        p = softmax(m["weights"][at].sum(axis=0, dtype=np.float64) / len(at) + m["bias"])
        return m["langs"][int(p.argmax())], float(p.max())

    def of(batch: pa.RecordBatch) -> dict:
        got = [one(t) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "held_out": batch.column(2), "lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    return map_batches(docs.select("doc_id", "text", F.coalesce(held_out(2), F.lit(False)).alias("held")), of, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs.where(~F.coalesce(held_out(2), F.lit(False)))))
