"""Benchmark decontamination with a distributed positional inverted index.

The postings (term, doc_id, pos) of all words that the stated query set uses
are stored as Parquet, dealt by term and a salt of the document, so that a
frequent term's list spans many files, and sorted, so that a reader skips the
rest.  Each test window is looked up from its two rarest terms: their lists,
each shifted by the term's offset, are intersected on (document, item, shift).
What remains is compared word by word with the whole text.

Only DataFrame functions are used.  The query set is broadcast after its size
is measured, else joined by shuffle.  Null or empty text has no words.  Items
without id or words are ignored, repeated items count once.  Repeated documents
are judged row by row; rows of equal id share candidates, never results.
Further columns are not read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import Stages, table

WINDOW = 13
#: A query-set table is broadcast up to this many bytes, measured beforehand.
BROADCAST_BYTES = 16 << 20
SALTS = 32
#: Everything but 0-9, a-z and code points from 0x80, after lower-casing A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


def measured_broadcast(df: DataFrame) -> DataFrame:
    """``df`` for a broadcast join if its measured size allows, else as it is."""
    sizes = [F.length(c) if t == "string" else F.size(c) * 16 if t.startswith("array") else F.lit(8) for c, t in df.dtypes]
    row = reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0)).cast("long") for x in sizes])
    size = df.agg(F.sum(row + 16).alias("size")).first().size
    return F.broadcast(df) if (size or 0) <= BROADCAST_BYTES else df


def build_index(docs: DataFrame, stages: Stages, terms: DataFrame | None = None) -> DataFrame:
    """The stored postings (term, doc_id, pos) of ``docs``, of all terms or of
    those in ``terms`` (one column, distinct)."""
    found = docs.select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    if terms is not None:
        found = found.join(measured_broadcast(terms), "term", "left_semi")
    salt = F.pmod(F.hash("doc_id"), F.lit(SALTS))
    return stages.write(found.select("term", "doc_id", "pos").repartition(F.col("term"), salt).sortWithinPartitions("term", "doc_id", "pos"), "postings")


def test_windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The items (item_id, words) and their windows (item_id, at, n)."""
    whole = items.where("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words"))
    # Texts of one id are told apart by their words.
    whole = whole.where("size(words) > 0").distinct().withColumn("item", F.xxhash64("item_id", "words"))
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - window)))
    return whole, whole.select("item", F.size("words").alias("size"), starts.alias("at")).select("item", "at", F.least(F.lit(window), F.col("size")).alias("n"))


def exact_matches(index: DataFrame, items: DataFrame, windows: DataFrame, stages: Stages) -> DataFrame:
    """Candidates (doc_id, item, at, start): windows whose two rarest terms
    stand in the document at their offsets."""
    counts = index.groupBy("term").agg(F.count("*").alias("occurrences"))
    places = items.select("item", F.posexplode("words").alias("ipos", "term")).join(counts, "term")
    offsets = windows.join(places, "item").where("ipos >= at and ipos < at + n").groupBy("item", "at", "n").agg(
        F.count("*").alias("known"), F.array_sort(F.collect_list(F.struct("occurrences", "ipos", "term"))).alias("rare")
    )
    # A window with a word that no document has can't occur.
    planned = stages.write(
        offsets.where("known = n").select("item", "at", F.col("rare")[0].alias("first"), F.expr("rare[least(1, n - 1)]").alias("second")), "planned"
    )
    anchors = planned.select("item", F.explode(F.array("first", "second")).alias("a")).select("item", "a.ipos", "a.term").distinct()
    shifted = stages.write(
        index.join(measured_broadcast(anchors), "term").select("doc_id", "item", (F.col("pos") - F.col("ipos")).alias("shift"), "ipos"), "shifted"
    )
    plan = measured_broadcast(planned.select("item", "at", F.col("first.ipos").alias("ipos"), F.col("second.ipos").alias("other")))
    left = shifted.join(plan, ["item", "ipos"]).where("shift + at >= 0").select("doc_id", "item", "shift", "at", "other")
    right = shifted.select(F.col("doc_id").alias("d"), F.col("item").alias("i"), F.col("shift").alias("s"), F.col("ipos").alias("p"))
    both = left.join(right, F.expr("doc_id <=> d and item = i and shift = s and other = p"), "left_semi")
    return both.select("doc_id", "item", "at", (F.col("shift") + F.col("at")).alias("start"))


def near_matches(index: DataFrame, pairs: DataFrame, distance: int) -> DataFrame:
    """Proximity: (doc_id, a, b, pos_a, pos_b) for every place where the terms
    of a pair (columns a, b) stand at most ``distance`` words apart.  Positions
    meet in bands of ``distance`` words, so a long list is never joined whole."""
    pairs = pairs.select("a", "b").distinct()
    band = F.floor(F.col("pos") / max(distance, 1))
    a = index.join(pairs, index.term == pairs.a).select("doc_id", "a", "b", F.col("pos").alias("pos_a"), F.explode(F.array(band - 1, band, band + 1)).alias("band"))
    b = index.join(pairs, index.term == pairs.b).select(F.col("doc_id").alias("d"), F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("pos").alias("pos_b"), band.alias("band2"))
    met = a.join(b, F.expr("doc_id <=> d and a = a2 and b = b2 and band = band2"))
    return met.where((F.abs(F.col("pos_a") - F.col("pos_b")) <= distance) & ~((F.col("a") == F.col("b")) & (F.col("pos_a") >= F.col("pos_b")))).select("doc_id", "a", "b", "pos_a", "pos_b")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: words, words inside test windows, the items found, and the
    verdict (a hit share of 5 % or more).  ``keep`` names columns to carry."""
    stages = Stages(docs.sparkSession, "decontaminate")
    whole, windows = test_windows(items, window)
    whole = stages.write(whole, "items")
    _, windows = test_windows(items, window)
    vocabulary = whole.select(F.explode("words").alias("term")).distinct()
    index = build_index(docs, stages, vocabulary)
    found = exact_matches(index, whole, windows, stages)
    phrases = measured_broadcast(whole.select("item", "item_id", "words"))
    named = found.join(phrases, "item").select(
        F.col("doc_id").alias("d"), F.struct("item_id", "start", F.expr(f"slice(words, at + 1, {window})").alias("phrase")).alias("candidate")
    )
    candidates = stages.write(named.groupBy("d").agg(F.collect_set("candidate").alias("candidates")), "candidates")
    rows = docs.select("doc_id", "text", *keep).join(candidates, F.expr("doc_id <=> d"), "left").withColumn("w", words(F.col("text")))
    hits = F.filter("candidates", lambda c: F.slice(F.col("w"), c.start + 1, F.size(c.phrase)) == c.phrase)
    places = F.flatten(F.transform("hits", lambda h: F.sequence(h.start, h.start + F.size(h.phrase) - 1)))
    ids = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h.item_id)))
    n_hit = F.when(F.size("hits") > 0, F.size(F.array_distinct(places))).otherwise(0).cast("long")
    judged = rows.withColumn("hits", F.coalesce(hits, F.expr("slice(candidates, 1, 0)"), F.array().cast(candidates.schema["candidates"].dataType)))
    out = judged.select("doc_id", F.size("w").cast("long").alias("n_words"), n_hit.alias("n_hit"), ids.alias("items"), *(["text"] if keep else []), *keep)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


def oracle() -> str:
    of = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {of} AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {of} AS w FROM benchmark WHERE item_id IS NOT NULL),
q AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, k, k + 12), ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM q),
p AS (
  SELECT rid, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS phrase
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT rid, item_id, k, n FROM p JOIN q USING (n, phrase)),
c AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS pos FROM h) GROUP BY rid),
i AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN i USING (rid)"""
