"""Tables over the vocabulary that answer inexact clauses (QRY-9..13).

* ``deletions(variant, term)``: what is left of a term's first ``PREFIX``
  characters after up to two deletions.  Two words at most k edits apart share a
  variant of up to k deletions each, also when only their beginnings are taken:
  of p characters each, at most k have no partner on the other side.
* ``grams(gram, term)``: the distinct runs of three characters of a term with
  marked ends.  The literal pieces of a wildcard or regular expression name
  grams that a matching term must have; the rarest one names the candidates.

Both are written with the index, sorted by their first column, and made from
the term table where an index has none.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions import patterns as P
from ..session import broadcast_if_small

#: Characters of a word whose deletions are stored, and how many are deleted.
PREFIX, EDITS = 7, P.FUZZY_MAX_EDITS
GRAM = 3
START, END = "\x02", "\x03"
#: Keys that are pushed to the scan as a list.
PUSHDOWN_KEYS = 5000


def _without(s: Column, i: Column) -> Column:
    return F.concat(F.substr(s, F.lit(1), i), F.substr(s, i + 2))


def deletion_variants(word: Column, edits: int = EDITS) -> Column:
    """The first ``PREFIX`` characters of a word without up to ``edits`` of them."""
    none = F.array().cast("array<string>")

    def shorter(words: Column) -> Column:
        each = lambda w: F.when(F.length(w) > 0, F.transform(F.sequence(F.lit(0), F.length(w) - 1), lambda i: _without(w, i))).otherwise(none)
        return F.array_distinct(F.flatten(F.transform(words, each)))

    level = F.array(F.substring(word, 1, PREFIX))
    found = level
    for _ in range(edits):
        level = shorter(level)
        found = F.concat(found, level)
    return F.array_distinct(found)


def deletions_table(terms: DataFrame, edits: int = EDITS) -> DataFrame:
    return terms.select(F.explode(deletion_variants(F.col("term"), edits)).alias("variant"), "term")


def grams_of(piece: Column) -> Column:
    last = F.length(piece) - (GRAM - 1)
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(piece, i, F.lit(GRAM)))).otherwise(F.array().cast("array<string>"))


def grams_table(terms: DataFrame) -> DataFrame:
    padded = F.concat(F.lit(START), "term", F.lit(END))
    return terms.select(F.explode(F.array_distinct(grams_of(padded))).alias("gram"), "term")


def write_expansions(terms: DataFrame, path: str) -> None:
    """Both tables, dealt and sorted by key so that a lookup skips files and row groups."""
    for name, key, table in (("deletions", "variant", deletions_table(terms)), ("grams", "gram", grams_table(terms))):
        dealt = table.repartitionByRange(F.col(key), F.hash("term")).sortWithinPartitions(key, "term")
        dealt.write.mode("overwrite").parquet(f"{path}/{name}")


def _lookup(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``table`` joined with ``wanted`` on ``key``: few keys are pushed to
    the scan, and a side is broadcast only where its counted rows allow."""
    n = wanted.count()
    if n <= PUSHDOWN_KEYS:
        keys = [r[0] for r in wanted.select(key).distinct().collect()]
        table = table.where(F.col(key).isin(keys)) if keys else table.where(F.lit(False))
    return table.join(broadcast_if_small(wanted, known_rows=n), key)


def fuzzy_candidates(index, words: DataFrame, edits: int) -> DataFrame:
    """(text, term) pairs that share a deletion variant, for distinct ``text``."""
    stored = index.deletions if index.deletions is not None and edits <= EDITS else deletions_table(index.terms.select("term"), edits)
    wanted = words.select("text", F.explode(deletion_variants(F.col("text"), edits)).alias("variant")).checkpoint()
    near = F.abs(F.length("term") - F.length("text")) <= edits
    return _lookup(stored, "variant", wanted).where(near).select("text", "term").distinct()


_STEP = re.compile(r"\\[QE]|\\[A-Za-z0-9]|\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|\{\d*,?\d*\}|.", re.S)


def required_pieces(rx: str) -> list[str]:
    """Literal pieces that every word with a full match of ``rx`` holds, with
    marked ends; none for what this small reader can't follow (groups, choices,
    quoting, possessive or lazy signs are left alone by giving up pieces)."""
    if re.search(r"[|()]|\\[QE]", rx):
        return []
    pieces, piece = [], START
    steps = _STEP.findall(rx)
    for i, step in enumerate(steps):
        literal = step[1] if len(step) == 2 and step[0] == "\\" and not step[1].isalnum() else step if len(step) == 1 and step not in ".^$*+?{}[]\\" else None
        repeat = steps[i + 1] if i + 1 < len(steps) else ""
        if step in ("*", "+", "?") or step.startswith("{"):
            continue
        if literal is None:
            pieces, piece = [*pieces, piece], ""
        elif repeat in ("*", "?") or repeat.startswith("{"):
            pieces, piece = [*pieces, piece], ""
        elif repeat == "+":
            pieces, piece = [*pieces, piece + literal], literal
        else:
            piece += literal
    return [x for x in [*pieces, piece + END] if len(x) >= GRAM]


def _required_udf():
    @F.arrow_udf(ArrayType(StringType()))
    def required(rx: pa.Array) -> pa.Array:
        return pa.array([required_pieces(x) for x in rx.to_pylist()], pa.list_(pa.string()))

    return required


def pattern_candidates(index, patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ``patterns(kind, text)``, wildcards and regular expressions: the pairs
    (kind, text, term) that share the pattern's rarest gram, and the patterns
    without any gram, whose candidates are all terms."""
    stored = index.grams if index.grams is not None else grams_table(index.terms.select("term"))
    padded = F.concat(F.lit(START), "text", F.lit(END))
    wild = patterns.where("kind = 'wildcard'").select("kind", "text", F.split(padded, "[*?]+").alias("pieces"))
    rx = patterns.where("kind = 'regex'").select("kind", "text", _required_udf()(F.col("text")).alias("pieces"))
    each = wild.unionByName(rx).select("kind", "text", F.array_distinct(F.flatten(F.transform("pieces", grams_of))).alias("grams")).checkpoint()
    wanted = each.select("kind", "text", F.explode("grams").alias("gram"))
    counts = _lookup(stored, "gram", wanted.select("gram").distinct()).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # a gram that no term has comes first: then nothing matches
    rank = Window.partitionBy("kind", "text").orderBy(F.coalesce("n", F.lit(0)), "gram")
    rarest = wanted.join(counts, "gram", "left").withColumn("r", F.row_number().over(rank)).where("r = 1").select("kind", "text", "gram")
    return _lookup(stored, "gram", rarest.checkpoint()).select("kind", "text", "term"), each.where(F.size("grams") == 0).select("kind", "text")
