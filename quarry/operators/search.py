"""Ranked retrieval over the parquet index (QRY-1..20).

Queries arrive as a table.  Free text (``run_queries``) is analysed with the
same chain in query mode; each analysed position becomes an optional
clause, several terms at one position (URL subtokens) score as one
synonym group.  Structured queries use a clause table
``(query_id, clause_id, occur, kind, text, boost, slop)`` with occur in
MUST / SHOULD / MUST_NOT and kind in term / phrase / prefix / wildcard /
regex / fuzzy / range / match_all.

Physical shape: the query side is small and is broadcast only behind a row
count check; postings are scanned once per batch of queries with a
``term IN`` filter pushed to parquet and dealt once by document; equal clauses
are scored once a document, and joined with the queries that ask for them only
there, so that clause, query and document never meet in an exchange; each shard
of documents gives its first k of a query and its count, and the first k of those
are the result; stored fields are fetched for the k hits only.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..functions import patterns as P
from ..session import BROADCAST_MAX_ROWS, broadcast_if_small, ensure_checkpoint_dir, stage_table
from .analyzer import AnalyzerOptions, analyze, explode_token_rows
from .expansion import fuzzy_candidates, pattern_candidates
from .index import Index
from .phrase_rows import Phrases, shard_phrases
from .shard_rank import Asked, first_of_shard

OCCURS = ("MUST", "SHOULD", "MUST_NOT")
KINDS = ("term", "phrase", "prefix", "wildcard", "regex", "fuzzy", "range", "match_all")
SCORE_DIGITS = 6
# Literal term filters pushed to the postings scan up to this many terms.
PUSHDOWN_MAX_TERMS = 5000
# Documents of a shard, and shards of a task: a query's documents are ranked by shard first.
SHARD_DOCS, TASK_SHARDS = 1024, 8
# Weights of clause terms that are joined after the postings are dealt by document.
LOCAL_WEIGHTS = 500_000
# Clauses of a batch that every task holds; more are joined with the scores.
HELD_CLAUSES = 500_000
# Terms of phrases that every task holds; more are joined with the positions.
HELD_TERMS = 200_000
# Places that are counted together where a query takes documents out.
PLACE_BLOCK = 8192
# Clauses whose predicates are compiled into one vocabulary scan at a time.
PREDICATE_CHUNK = 200
# Regex / range clause specs pass through the driver: bounded per batch.
MAX_PREDICATE_CLAUSES = 20_000

CLAUSE_SCHEMA = "query_id long, clause_id int, occur string, kind string, text string, boost double, slop int"
RESULT_COLUMNS = ["query_id", "rank", "doc_id", "filepath", "score", "total_hits", "status"]


# ---------------------------------------------------------------------------
# Scoring
# ---------------------------------------------------------------------------
def idf(df: Column, n_docs: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25(tf: Column, df: Column, dl: Column, n_docs: Column, avgdl: Column,
         k1: float = P.BM25_K1, b: float = P.BM25_B, idf_col: Column | None = None) -> Column:
    """QRY-5: idf · tf / (tf + k1·(1 − b + b·dl/avgdl)); no (k1+1) factor."""
    w = idf(df, n_docs) if idf_col is None else idf_col
    return w * tf / (tf + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * dl / avgdl))


def _stats(index: Index) -> DataFrame:
    # one row, proven bound → broadcast
    return F.broadcast(index.stats.select("n_docs", "avgdl"))


# ---------------------------------------------------------------------------
# Query analysis
# ---------------------------------------------------------------------------
def query_options(stem: bool = True) -> AnalyzerOptions:
    return AnalyzerOptions(mode="query", use_synonyms=False, stem=stem)


def analyze_queries(queries: DataFrame, stem: bool = True, id_col="query_id", text_col="query") -> DataFrame:
    """QRY-1: (query_id, pos, ord, term) for every surviving query token."""
    a = analyze(queries, id_col, text_col, query_options(stem))
    t = explode_token_rows(a, [F.col(id_col).alias("query_id")])
    return t.select("query_id", F.col("t.pos").alias("pos"), F.col("t.ord").alias("ord"), F.col("t.term").alias("term"))


def _postings_for(index: Index, terms: DataFrame, n_terms: int, *more: str) -> DataFrame:
    """Postings restricted to ``terms`` (term column), with the columns
    ``more``.  A small literal list is pushed to the parquet scan (row groups
    pruned by term statistics); in the layout by term the scan opens the buckets
    that the directory names, and no others."""
    p = index.postings.select("term", "doc_id", "tf", "dl", *more, *(["bucket"] if index.by_term else []))
    if n_terms > PUSHDOWN_MAX_TERMS:
        return p
    wanted = terms.select("term").distinct()
    if not index.by_term:
        lits = [r[0] for r in wanted.collect()]
        return p.where(F.col("term").isin(lits)) if lits else p.where(F.lit(False))
    rows = index.terms.select("term", "first_bucket", "last_bucket").join(broadcast_if_small(wanted, known_rows=n_terms), "term").collect()
    if not rows:
        return p.where(F.lit(False))
    return p.where(_in_buckets(rows) & F.col("term").isin([r.term for r in rows]))


def _in_buckets(rows) -> Column:
    """The buckets of the terms: a list of those with one, ranges for the rest."""
    single = sorted({r.first_bucket for r in rows if r.first_bucket == r.last_bucket})
    spans = sorted({(r.first_bucket, r.last_bucket) for r in rows if r.first_bucket < r.last_bucket})
    found = F.col("bucket").isin(single) if single else F.lit(False)
    for first, last in spans:
        found = found | F.col("bucket").between(first, last)
    return found


def _dealt(index: Index, terms: DataFrame) -> tuple[DataFrame, list[str]]:
    """Query terms with the columns of the term table, and the columns that join
    them with postings: in the layout by term also the bucket, so that a batch of
    any size opens its buckets only (dynamic partition pruning)."""
    if not index.by_term:
        return index.terms.select("term", "df").join(terms, "term"), ["term"]
    named = index.terms.select("term", "df", "first_bucket", "last_bucket").join(terms, "term")
    return named.withColumn("bucket", F.explode(F.sequence("first_bucket", "last_bucket"))).drop("first_bucket", "last_bucket"), ["term", "bucket"]


# ---------------------------------------------------------------------------
# Term / synonym-group clauses
# ---------------------------------------------------------------------------
def score_term_groups(index: Index, groups: DataFrame, known_rows: int | None = None) -> DataFrame:
    """QRY-2/6/15: ``groups(query_id, clause_id, sub_id, term, boost)`` →
    (query_id, clause_id, doc_id, score).  Terms sharing (query, clause,
    sub_id) form one synonym group: tf summed, df = max df.  A clause's score
    is the sum over its groups."""
    n = known_rows if known_rows is not None else groups.count()
    g = broadcast_if_small(groups, known_rows=n)
    # unknown terms never match, so an inner join with the term table is enough
    with_df, keys = _dealt(index, g)
    gdf = Window.partitionBy("query_id", "clause_id", "sub_id")
    qterms = with_df.select("*", F.max("df").over(gdf).alias("gdf"))
    post = _postings_for(index, groups, n)
    cand = post.join(broadcast_if_small(qterms, known_rows=n), keys).crossJoin(_stats(index))
    cand = cand.repartition("query_id", "doc_id")
    per_group = cand.groupBy("query_id", "clause_id", "sub_id", "doc_id", "dl", "gdf", "boost", "n_docs", "avgdl").agg(
        F.sum("tf").alias("tf"))
    scored = per_group.select(
        "query_id", "clause_id", "doc_id",
        (F.col("boost") * bm25(F.col("tf"), F.col("gdf"), F.col("dl"), F.col("n_docs"), F.col("avgdl"))).alias("score"),
    )
    return scored.groupBy("query_id", "clause_id", "doc_id").agg(F.sum("score").alias("score"))


def free_text_groups(qtokens: DataFrame) -> DataFrame:
    """Each analysed position of a free-text query is one optional clause."""
    return qtokens.select(
        "query_id",
        F.col("pos").alias("clause_id"),
        F.lit(0).alias("sub_id"),
        "term",
        F.lit(1.0).alias("boost"),
    )


# ---------------------------------------------------------------------------
# Top-k, totals, fetch
# ---------------------------------------------------------------------------
def by_document(index: Index, rows: DataFrame) -> DataFrame:
    """``rows`` dealt by document, with the ``shard`` of each: what is grouped by
    shard and document, or by shard and query, needs no further exchange."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-index.n_docs // (SHARD_DOCS * TASK_SHARDS)))
    return rows.withColumn("shard", F.pmod(F.hash("doc_id"), F.lit(tasks * TASK_SHARDS))).repartition(tasks, "shard")


def first_by_shard(scored: DataFrame, k: int) -> DataFrame:
    """(query_id, doc_id, score, n): the best k of a query in every shard; ``n``
    is the shard's number of matching documents, at the first of them only."""
    w = Window.partitionBy("shard", "query_id")
    ranked = scored.select("*", F.row_number().over(w.orderBy(F.desc("score"), F.asc("doc_id"))).alias("r"))
    ranked = ranked.select("*", F.count(F.lit(1)).over(w).alias("_n")).where(F.col("r") <= k)
    return ranked.select("query_id", "doc_id", "score", F.when(F.col("r") == 1, F.col("_n")).otherwise(0).alias("n"))


def top_k(scored: DataFrame, k: int = P.TOP_K) -> DataFrame:
    """QRY-16: best k per query by score desc, then index order (doc_id)."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return scored.select("*", F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)


def total_hits(scored: DataFrame) -> DataFrame:
    """QRY-17: exact number of matching documents per query."""
    return scored.groupBy("query_id").agg(F.count(F.lit(1)).alias("total_hits"))


def reported_hits(results: DataFrame, threshold: int = P.HITS_THRESHOLD) -> DataFrame:
    """QRY-17: one row per answered query with the count as a searcher reports it
    that stops counting: exact up to ``threshold``, beyond it a lower bound
    (``hits_exact`` false)."""
    per = results.where(F.col("status") == "ok").groupBy("query_id").agg(F.max("total_hits").alias("total_hits"))
    exact = F.col("total_hits") <= threshold
    return per.select("query_id", "total_hits", F.when(exact, F.col("total_hits")).otherwise(F.lit(threshold + 1)).alias("reported"), exact.alias("hits_exact"))


def fetch_docs(hits: DataFrame, index: Index, known_rows: int | None = None) -> DataFrame:
    """QRY-18: stored fields of the hits only (hits side broadcast, checked)."""
    h = broadcast_if_small(hits, known_rows=known_rows)
    return h.join(index.docs.select("doc_id", "filepath"), "doc_id")


def rank_results(index: Index, per_doc: DataFrame, k: int, n_queries: int) -> DataFrame:
    """Round, rank, count and fetch: the common tail of every search.  Scored
    candidates are read once, where they are made; only the first k of each
    shard of documents, with the shard's count, are written."""
    ensure_checkpoint_dir(per_doc.sparkSession)
    dealt = per_doc if "shard" in per_doc.columns else by_document(index, per_doc)
    scored = dealt.select("shard", "query_id", "doc_id", F.round("score", SCORE_DIGITS).alias("score"))
    return _fetched(index, first_by_shard(scored, k), k, n_queries)


def rank_units(index: Index, scored: DataFrame, asked: DataFrame, k: int, n_queries: int, n_asked: int) -> DataFrame:
    """The results from ``scored(shard, unit, doc_id, score)`` and the clauses
    ``asked(unit, query_id, boost, must, should, never)``.  Every task holds the
    clauses and multiplies them with its shards (``shard_rank``), so that a
    document and a query never meet in a row; more than ``HELD_CLAUSES`` clauses
    are joined with the scores."""
    if n_asked > HELD_CLAUSES:
        need = asked.groupBy("query_id").agg(F.sum("must").alias("n_must"))
        per_doc = scored.join(broadcast_if_small(asked), "unit").groupBy("shard", "query_id", "doc_id").agg(
            F.sum(F.col("score") * F.col("boost")).alias("score"), *[F.sum(c).alias(c) for c in ("must", "should", "never")])
        per_doc = per_doc.where("never = 0").join(broadcast_if_small(need, known_rows=n_queries), "query_id")
        per_doc = per_doc.where("must = n_must and (n_must > 0 or should > 0)").select("shard", "query_id", "doc_id", "score")
        return rank_results(index, per_doc, k, n_queries)
    clauses = asked.select("unit", "query_id", "boost", "must", "should", "never")
    held = asked.sparkSession.sparkContext.broadcast(Asked(clauses.toArrow()))
    schema = StructType([asked.schema["query_id"], scored.schema["doc_id"], StructField("score", DoubleType()), StructField("n", LongType())])
    run = first_of_shard(held, k, SCORE_DIGITS, to_arrow_schema(schema))
    return _fetched(index, scored.select("shard", "unit", "doc_id", "score").groupBy("shard").applyInArrow(run, schema), k, n_queries)


def _fetched(index: Index, first: DataFrame, k: int, n_queries: int) -> DataFrame:
    """The results from the first k (query_id, doc_id, score, n) of every shard."""
    ensure_checkpoint_dir(first.sparkSession)
    first = first.checkpoint()
    hits = top_k(first.drop("n"), k)
    totals = broadcast_if_small(first.groupBy("query_id").agg(F.sum("n").alias("total_hits")), known_rows=n_queries)
    hits = hits.join(totals, "query_id")
    out = fetch_docs(hits, index, known_rows=n_queries * k)
    return out.select(
        "query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "filepath", "score", "total_hits",
        F.lit("ok").alias("status"),
    )


def run_queries(index: Index, queries: DataFrame, k: int = P.TOP_K, stem: bool = True,
                id_col: str = "query_id", text_col: str = "query") -> DataFrame:
    """QRY-20 (QRY-1/2/5/6/16/17/18): every free-text query in one job.
    Default operator OR; a stopword-only query has no hits."""
    ensure_checkpoint_dir(queries.sparkSession)
    n_queries = queries.count()
    qtok = analyze_queries(queries, stem, id_col, text_col)
    groups = free_text_groups(qtok)
    # positions holding one term (the usual case) collapse to (query, term,
    # weight = repetitions); several terms at a position form a synonym group.
    # The analysed query side is small: checkpoint it once to the shared
    # folder so the size checks and the scoring job reuse it.
    size = Window.partitionBy("query_id", "clause_id")
    g = groups.select("*", F.count(F.lit(1)).over(size).alias("_n")).checkpoint()
    single = g.where(F.col("_n") == 1).groupBy("query_id", "term").agg(F.sum("boost").alias("weight"))
    multi = g.where(F.col("_n") > 1).drop("_n")
    n_single = single.count()
    n_multi = multi.count()
    known, post = postings_by_document(index, single, n_single)
    asked = single.join(broadcast_if_small(known, known_rows=n_single), "term").select(F.col("tid").alias("unit"), "query_id", F.col("weight").alias("boost"))
    scored = by_document(index, post).join(broadcast_if_small(known.select("tid", "df"), known_rows=n_single), "tid").crossJoin(_stats(index))
    score = bm25(F.col("tf"), F.col("df"), F.col("dl"), F.col("n_docs"), F.col("avgdl"))
    scored = scored.select("shard", F.col("tid").alias("unit"), "doc_id", score.alias("score"))
    if n_multi:  # each group is a unit of its query
        own = multi.select("query_id", "clause_id").distinct().withColumn("unit", -1 - F.monotonically_increasing_id()).checkpoint()
        named = multi.join(broadcast_if_small(own, known_rows=n_multi), ["query_id", "clause_id"]).select(F.col("unit").alias("query_id"), "clause_id", "sub_id", "term", "boost")
        groups = score_term_groups(index, named, known_rows=n_multi).select(F.col("query_id").alias("unit"), "doc_id", "score")
        scored = scored.unionByName(by_document(index, groups).select("shard", "unit", "doc_id", "score"))
        asked = asked.unionByName(own.select("unit", "query_id", F.lit(1.0).alias("boost")))
    asked = asked.select("*", F.lit(0).alias("must"), F.lit(1).alias("should"), F.lit(0).alias("never"))
    return rank_units(index, scored, asked, k, n_queries, n_single + n_multi)


def postings_by_document(index: Index, terms: DataFrame, n: int, *more: str) -> tuple[DataFrame, DataFrame]:
    """The known ``terms`` (term, tid, df), numbered, and their postings (tid,
    doc_id, tf, dl and the columns ``more``); not yet dealt."""
    named, keys = _dealt(index, broadcast_if_small(terms.select("term").distinct(), known_rows=n))
    known = named.select("term", "df").distinct().withColumn("tid", F.monotonically_increasing_id())
    known = stage_table(known, "query-terms")
    named = named.select(*keys).join(broadcast_if_small(known.select("term", "tid"), known_rows=n), "term")
    post = _postings_for(index, terms, n, *more).join(broadcast_if_small(named, known_rows=n), keys)
    return known, post.select("tid", "doc_id", "tf", "dl", *more)


def score_terms(index: Index, qterms: DataFrame, known_rows: int | None = None) -> DataFrame:
    """Single-term clauses: ``qterms(query_id, term, weight)`` → (shard, query_id,
    doc_id, score) with score = weight · bm25 summed per doc.  The postings of the
    query terms are dealt by document once; queries are joined behind that, so
    that the sums need no exchange."""
    n = known_rows if known_rows is not None else qterms.count()
    known, post = postings_by_document(index, qterms, n)
    weights = qterms.join(broadcast_if_small(known, known_rows=n), "term").select("tid", "df", "query_id", "weight")
    cand = by_document(index, post).join(broadcast_if_small(weights, known_rows=n), "tid").crossJoin(_stats(index))
    s = cand.select("shard", "query_id", "doc_id",
                    (F.col("weight") * bm25(F.col("tf"), F.col("df"), F.col("dl"), F.col("n_docs"), F.col("avgdl"))).alias("score"))
    return s.groupBy("shard", "query_id", "doc_id").agg(F.sum("score").alias("score"))


def format_results(results: DataFrame) -> DataFrame:
    """SNK-4: ``n. "filepath"`` lines and the ``Found`` line per query."""
    lines = results.where(F.col("status") == "ok").select(
        "query_id", "rank",
        F.concat(F.col("rank").cast("string"), F.lit('. "'), F.col("filepath"), F.lit('"')).alias("line"),
    )
    found = results.where(F.col("status") == "ok").groupBy("query_id").agg(
        F.lit(0).alias("rank"), F.concat(F.lit("Found: "), F.max("total_hits").cast("string")).alias("line"))
    return found.unionByName(lines)


# ---------------------------------------------------------------------------
# Structured clause queries
# ---------------------------------------------------------------------------
def clause_table(df: DataFrame) -> DataFrame:
    """Normalise a clause table: defaults boost 1.0, slop 0, occur SHOULD."""
    cols = set(df.columns)
    return df.select(
        F.col("query_id").cast("long").alias("query_id"),
        F.col("clause_id").cast("int").alias("clause_id"),
        F.upper(F.coalesce(F.col("occur"), F.lit("SHOULD"))).alias("occur") if "occur" in cols else F.lit("SHOULD").alias("occur"),
        F.lower(F.col("kind")).alias("kind"),
        F.col("text").cast("string").alias("text"),
        (F.coalesce(F.col("boost").cast("double"), F.lit(1.0)) if "boost" in cols else F.lit(1.0)).alias("boost"),
        (F.coalesce(F.col("slop").cast("int"), F.lit(0)) if "slop" in cols else F.lit(0)).alias("slop"),
    )


RANGE_RX = r"^([\[{])\s*(\S+)\s+TO\s+(\S+)\s*([\]}])$"


def validate_clauses(clauses: DataFrame) -> DataFrame:
    """QRY-19: an ``error`` column (null when the clause is valid)."""
    text = F.col("text")
    err = (
        F.when(~F.col("occur").isin(*OCCURS), F.concat(F.lit("unknown occur: "), F.col("occur")))
        .when(~F.col("kind").isin(*KINDS), F.concat(F.lit("unknown clause kind: "), F.col("kind")))
        .when((F.col("kind") != "match_all") & (text.isNull() | (F.length(F.trim(text)) == 0)), F.lit("empty clause text"))
        .when(F.col("kind").isin("wildcard", "prefix") & (text.startswith("*") | text.startswith("?")),
              F.lit("'*' or '?' not allowed as first character in WildcardQuery"))
        .when((F.col("kind") == "range") & ~text.rlike(RANGE_RX), F.lit("malformed range"))
        .when(F.col("slop") < 0, F.lit("negative slop"))
    )
    return clauses.select("*", err.alias("error"))


def _java_regex_error(spark, rx: str) -> str | None:
    try:
        spark.sparkContext._jvm.java.util.regex.Pattern.compile("^(?:" + rx + r")\z")
        return None
    except Exception as e:  # noqa: BLE001 - py4j wraps the Java exception
        return "invalid regex: " + str(e).splitlines()[-1][:200]


def _analyzed_unit_terms(units: DataFrame, stem: bool) -> DataFrame:
    """(unit, kind, slop, pos, ord, term) for term and phrase clauses; the text
    goes through the query-mode analyser."""
    a = analyze(units, "unit", "text", query_options(stem), keep=("kind", "slop"))
    t = explode_token_rows(a, ["unit", "kind", "slop"])
    return t.select("unit", "kind", "slop", F.col("t.pos").alias("pos"), F.col("t.ord").alias("ord"), F.col("t.term").alias("term"))


def _score_phrase(index: Index, pterms: DataFrame, n: int) -> DataFrame:
    """QRY-7/8: phrase clauses ``pterms(unit, slop, pos, term)`` → (shard, unit,
    doc_id, score).

    A phrase is a row of slots: the analysed positions, each with the set of
    terms there (URL subtokens share a position); any of them fills the slot.
    A place in a document counts from its slot: position minus the slot's offset.
    Exact (slop 0): tf is the number of starts that all slots share.  Sloppy:
    the least windows that hold a place of every slot, at most ``slop`` wide, no
    place of a term taken twice; each contributes 1 / (1 + width).  The idf is
    the sum over the phrase's known terms.

    The positions of the phrases' terms are dealt by document once.  Up to
    ``HELD_TERMS`` terms of phrases are held by every task, which looks at the
    documents of a few shards together (``phrase_rows``).  Of more, a place of a
    phrase's rarest slot looks at the positions around it; only where every slot
    has a place near enough, those places are kept.  Each window holds a place of
    the rarest slot, so none is missed."""
    w = Window.partitionBy("unit")
    pt = pterms.select("unit", "slop", "term", (F.col("pos") - F.min("pos").over(w)).alias("off"), F.dense_rank().over(w.orderBy("pos")).alias("i"))
    pt = pt.withColumn("n_slots", F.max("i").over(w)).dropDuplicates(["unit", "i", "term"])
    known, post = postings_by_document(index, pterms, n, "positions")
    stats = _stats(index)
    slots = pt.join(broadcast_if_small(known, known_rows=n), "term").crossJoin(stats)
    slot = slots.groupBy("unit", "i").agg(F.sum(idf(F.col("df"), F.col("n_docs"))).alias("idf"), F.sum("df").alias("weight"), F.max("n_slots").alias("n_slots"),
                                          F.max("slop").alias("slop"), F.collect_list(F.struct("i", "off", "tid")).alias("s"))
    phrase = slot.groupBy("unit").agg(F.sum("idf").alias("idf_sum"), F.min(F.struct("weight", "i")).alias("rare"), F.count(F.lit(1)).alias("k"),
                                      F.max("n_slots").alias("n_slots"), F.max("slop").alias("slop"), F.flatten(F.collect_list("s")).alias("s"))
    # a slot without a known term can't be filled
    phrase = phrase.where("k = n_slots").select("unit", "slop", "n_slots", "idf_sum", F.col("rare.i").alias("rare"), "s")
    phrase = stage_table(phrase, "phrases")
    if n <= HELD_TERMS:
        held = phrase.sparkSession.sparkContext.broadcast(Phrases(phrase.collect()))
        rows = by_document(index, post).select("shard", "doc_id", "dl", "tid", "positions").sortWithinPartitions("shard")
        schema = StructType([rows.schema["shard"], StructField("unit", LongType()), rows.schema["doc_id"], rows.schema["dl"], StructField("idf_sum", DoubleType()), StructField("tf", DoubleType())])
        per = rows.mapInArrow(shard_phrases(held, to_arrow_schema(schema), sloppy_frequency), schema)
        return per.crossJoin(stats).select(
            "shard", "unit", "doc_id", bm25(F.col("tf"), F.lit(0), F.col("dl"), F.col("n_docs"), F.col("avgdl"), idf_col=F.col("idf_sum")).alias("score"))
    span = phrase.agg(F.max(F.expr("array_max(transform(s, x -> x.off))") + F.col("slop"))).first()[0] or 0
    rare = phrase.select("*", F.explode("s").alias("x")).where("x.i = rare").select("unit", "slop", "n_slots", "idf_sum", "s", "x.tid", F.col("x.off").alias("at"))
    places = by_document(index, post).select("shard", "doc_id", "dl", "tid", F.explode("positions").alias("p"))
    around = Window.partitionBy("shard", "doc_id").orderBy("p").rangeBetween(-span, span)
    places = places.withColumn("near", F.collect_list(F.struct("p", "tid")).over(around))
    found = places.join(broadcast_if_small(rare, known_rows=n), "tid").withColumn("start", F.col("p") - F.col("at"))
    filled = F.expr("""flatten(transform(s, x -> transform(filter(near, y -> y.tid = x.tid and abs(y.p - x.off - start) <= slop),
        y -> struct(x.i as i, x.off as off, x.tid as term, array(y.p) as positions))))""")
    found = found.withColumn("f", filled).where(F.size(F.array_distinct("f.i")) == F.col("n_slots"))
    per = found.groupBy("shard", "unit", "doc_id", "dl", "slop", "idf_sum").agg(F.collect_set("start").alias("starts"), F.flatten(F.collect_list("f")).alias("f"))
    exact = F.when(F.col("slop") == 0, F.size("starts").cast("double"))
    if phrase.where("slop > 0").isEmpty():
        per = per.withColumn("tf", exact)
    else:
        per = per.withColumn("_w", _sloppy_udf()(F.when(F.col("slop") > 0, F.col("f")).otherwise(F.expr("slice(f, 1, 0)")), F.col("slop")))
        per = per.withColumn("tf", F.coalesce(exact, F.col("_w")))
    return per.where("tf > 0").crossJoin(stats).select(
        "shard", "unit", "doc_id", bm25(F.col("tf"), F.lit(0), F.col("dl"), F.col("n_docs"), F.col("avgdl"), idf_col=F.col("idf_sum")).alias("score"))


def _least_end(slots: list[list[tuple]], shared: bool, start: int, slop: int) -> int | None:
    """The end of the least window from ``start`` on that has a place for every
    slot; ``slots`` holds sorted (place from the slot, (term, position))."""
    near = []
    for places in slots:
        at = bisect_left(places, (start,))
        near.append(places[at:bisect_left(places, (start + slop + 1,))])
        if not near[-1]:
            return None
    end = max(x[0][0] for x in near)
    while shared and end <= start + slop and not _all_placed(near, end):
        end += 1
    return end if end <= start + slop else None


def _all_placed(near: list[list[tuple]], end: int) -> bool:
    """Whether the slots can take different places up to ``end`` (matching by
    augmenting paths)."""
    taken: dict = {}

    def place(i: int, seen: set) -> bool:
        for at, key in near[i]:
            if at <= end and key not in seen:
                seen.add(key)
                if key not in taken or place(taken[key], seen):
                    taken[key] = i
                    return True
        return False

    return all(place(i, set()) for i in range(len(near)))


def sloppy_frequency(entries: list[dict], slop: int) -> float:
    """Sum of 1 / (1 + width) over the least windows of a document's slots."""
    slots: dict[int, set] = {}
    for x in entries:
        slots.setdefault(x["i"], set()).update((p - x["off"], (x["term"], p)) for p in x["positions"])
    rows = [sorted(x) for x in slots.values()]
    terms = [{key[0] for _, key in x} for x in rows]
    shared = sum(map(len, terms)) > len(set().union(*terms))
    starts: dict[int, int] = {}
    for start in sorted({at for x in rows for at, _ in x}):
        end = _least_end(rows, shared, start, slop)
        if end is not None:
            starts[end] = start  # the latest start for an end
    return sum(1.0 / (1 + end - start) for end, start in starts.items())


def _sloppy_udf():
    from pyspark.sql.types import DoubleType

    @F.arrow_udf(DoubleType())
    def frequency(s: pa.Array, slop: pa.Array) -> pa.Array:
        return pa.array([sloppy_frequency(x, y) for x, y in zip(s.to_pylist(), slop.to_pylist(), strict=True)], pa.float64())

    return frequency


def _expand_prefix(index: Index, clauses: DataFrame) -> DataFrame:
    """Vocabulary terms starting with a literal key: equi-join on the key
    (one key column per distinct key length), never clause × vocabulary."""
    keyed = clauses.where(F.length("key") > 0)
    lens = [r[0] for r in keyed.select(F.length("key")).distinct().collect()]
    if not lens:
        return clauses.withColumn("term", F.lit(None).cast("string")).where(F.lit(False))
    vocab = index.terms.select("term").where(F.col("term") >= min(
        [r[0] for r in keyed.select(F.min("key")).collect()]))
    vk = vocab.select("term", F.explode(F.array(*[
        F.when(F.length("term") >= L, F.substring("term", 1, L)) for L in sorted(lens)])).alias("key")).where(F.col("key").isNotNull())
    return vk.join(broadcast_if_small(keyed), "key").select(*clauses.columns, "term")


def _like_pattern(text: Column) -> Column:
    esc = F.regexp_replace(text, r"([\\%_])", r"\\$1")
    return F.translate(esc, "*?", "%_")


def _range_part(i: int) -> Column:
    return F.regexp_extract("text", RANGE_RX, i)


def _shared_beginning(a: Column, b: Column) -> Column:
    """What both texts begin with; nothing where one is open (``*``)."""
    n = F.least(F.length(a), F.length(b))
    same = F.size(F.filter(F.sequence(F.lit(1), n), lambda i: F.substr(a, F.lit(1), i) == F.substr(b, F.lit(1), i)))
    return F.when((n > 0) & (a != "*") & (b != "*"), F.substr(a, F.lit(1), same)).otherwise("")


def _expand_patterns(index: Index, patterns: DataFrame, kinds) -> DataFrame:
    """QRY-9..11/13: (kind, text, term) for distinct patterns.  A prefix is
    joined by its length, and so is a range by the beginning that its ends share,
    which all terms between them have; a wildcard or regular expression by the
    rarest gram of its literal pieces, and then compared; patterns without such a
    piece, and ranges without a shared beginning, become literal predicates of one
    vocabulary scan per chunk."""
    parts, rest = [], patterns.where("kind = 'range'").withColumn("key", _shared_beginning(_range_part(2), _range_part(3)))
    if kinds.get("range"):
        keyed = rest.where("key != ''").select("text", "key")
        keyed = keyed.select("*", *[_range_part(i).alias(c) for i, c in ((1, "open"), (2, "lo"), (3, "hi"), (4, "close"))])
        inside = F.expr("if(open = '[', term >= lo, term > lo) and if(close = ']', term <= hi, term < hi)")
        parts.append(_expand_prefix(index, keyed).where(inside).select(F.lit("range").alias("kind"), "text", "term"))
    rest = rest.where("key = ''").drop("key")
    if kinds.get("prefix"):
        keyed = patterns.where("kind = 'prefix'").select("text", F.col("text").alias("key"))
        parts.append(_expand_prefix(index, keyed).select(F.lit("prefix").alias("kind"), "text", "term"))
    if kinds.get("wildcard") or kinds.get("regex"):
        pairs, open_ = pattern_candidates(index, patterns.where("kind in ('wildcard', 'regex')"))
        like = pairs.where("kind = 'wildcard'").withColumn("pattern", _like_pattern(F.col("text"))).where(F.expr("term LIKE pattern"))
        rx = pairs.where("kind = 'regex'").withColumn("pattern", F.concat(F.lit("^(?:"), "text", F.lit(r")\z"))).where(F.expr("term RLIKE pattern"))
        parts += [like.select("kind", "text", "term"), rx.select("kind", "text", "term")]
        rest = rest.unionByName(open_)
    specs = []
    rows = rest.limit(MAX_PREDICATE_CLAUSES + 1).collect()
    if len(rows) > MAX_PREDICATE_CLAUSES:
        raise ValueError(f"more than {MAX_PREDICATE_CLAUSES} ranges and patterns without literals; split the batch")
    for i, r in enumerate(rows):
        if r.kind == "regex":
            pred = F.col("term").rlike("^(?:" + r.text + r")\z")
        elif r.kind == "wildcard":
            pred = F.col("term").like(re.sub(r"([\\%_])", r"\\\1", r.text).replace("*", "%").replace("?", "_"))
        else:
            m = re.match(RANGE_RX, r.text)
            lo_inc, lo, hi, hi_inc = m.group(1) == "[", m.group(2), m.group(3), m.group(4) == "]"
            pred = F.lit(True)
            if lo != "*":
                pred = pred & ((F.col("term") >= lo) if lo_inc else (F.col("term") > lo))
            if hi != "*":
                pred = pred & ((F.col("term") <= hi) if hi_inc else (F.col("term") < hi))
        specs.append((i, pred))
    if specs:
        ids = patterns.sparkSession.createDataFrame([(i, r.kind, r.text) for i, r in enumerate(rows)], "spec_idx int, kind string, text string")
        # at most MAX_PREDICATE_CLAUSES rows
        parts.append(_expand_by_predicates(index, specs).join(F.broadcast(ids), "spec_idx").select("kind", "text", "term"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _expand_by_predicates(index: Index, specs: list[tuple[int, Column]]) -> DataFrame:
    """Vocabulary terms matching per-clause predicates, evaluated in one scan
    of the term table per chunk of clauses: (spec_idx, term)."""
    out = None
    for start in range(0, len(specs), PREDICATE_CHUNK):
        chunk = specs[start:start + PREDICATE_CHUNK]
        hit = F.array_compact(F.array(*[F.when(pred, F.lit(i)) for i, pred in chunk]))
        part = index.terms.select("term", F.explode(hit).alias("spec_idx"))
        out = part if out is None else out.unionByName(part)
    return out


def osa_distance(a: str, b: str) -> int:
    """Edit distance with adjacent transpositions (optimal string alignment)."""
    la, lb = len(a), len(b)
    prev2 = None
    prev = list(range(lb + 1))
    for i in range(1, la + 1):
        cur = [i] + [0] * lb
        for j in range(1, lb + 1):
            cost = 0 if a[i - 1] == b[j - 1] else 1
            v = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + cost)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                v = min(v, prev2[j - 2] + 1)
            cur[j] = v
        prev2, prev = prev, cur
    return prev[lb]


def _osa_udf():
    from pyspark.sql.types import IntegerType

    @F.arrow_udf(IntegerType())
    def osa(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([osa_distance(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int32())

    return osa


def _expand_fuzzy(index: Index, fz: DataFrame, max_edits: int) -> DataFrame:
    """QRY-12: candidates by shared deletion variants, then the exact distance
    on the survivors; best FUZZY_MAX_EXPANSIONS per clause by similarity, then
    term.  Equal texts are expanded once."""
    cand = fuzzy_candidates(index, fz.select("text").distinct(), max_edits)
    scored = cand.select("*", _osa_udf()(F.col("text"), F.col("term")).alias("ed")).where(F.col("ed") <= max_edits)
    sim = F.lit(1.0) - F.col("ed") / F.least(F.length("text"), F.length("term"))
    scored = scored.select("text", "term", sim.alias("sim")).where(F.col("sim") > 0)
    w = Window.partitionBy("text").orderBy(F.desc("sim"), F.asc("term"))
    best = scored.select("*", F.row_number().over(w).alias("r")).where(F.col("r") <= P.FUZZY_MAX_EXPANSIONS).drop("r")
    return best.join(broadcast_if_small(fz.select("query_id", "clause_id", "text")), "text").select("query_id", "clause_id", "term", "sim")


def _score_units(index: Index, weights: DataFrame, n: int, all_documents: int | None = None) -> DataFrame:
    """``weights(unit, sub, term, factor, df)`` → (shard, unit, doc_id, score).
    Terms of a (unit, sub) are one synonym group: tf summed, df = max df; a unit's
    score is the sum over its groups, factor · bm25 each.  Without a ``df`` the
    score is 1 for every document with a term.  ``all_documents`` names a unit
    that every document has.  Many weights are joined with the postings before
    these are dealt by document, some behind that."""
    shape = weights.groupBy("unit", "sub").agg(F.count(F.lit(1)).alias("n"), F.max("df").alias("df"))
    shape = shape.groupBy("unit").agg(F.sum("n").alias("n"), F.max(F.when(F.col("df").isNotNull(), F.col("n"))).alias("m")).agg(F.max("n").alias("n"), F.max("m").alias("m")).first()
    many, multi = (shape.n or 0) > 1, (shape.m or 0) > 1
    every = index.docs.select("doc_id", F.lit(all_documents).cast("long").alias("unit")) if all_documents is not None else None
    known, post = postings_by_document(index, weights, n)
    weights = weights.join(broadcast_if_small(known.select("term", "tid"), known_rows=n), "term").select("tid", "unit", "sub", "factor", "df")
    if n <= LOCAL_WEIGHTS:
        if every is not None:  # a term of its own that each document has once
            none = lambda t: F.lit(None).cast(t)
            post = post.unionByName(every.select(F.lit(-1).cast("long").alias("tid"), "doc_id", F.lit(1).alias("tf"), F.lit(1).alias("dl")))
            own = weights.sparkSession.range(1).select(F.lit(-1).cast("long").alias("tid"), F.lit(all_documents).cast("long").alias("unit"), F.lit(0).alias("sub"), F.lit(1.0).alias("factor"), none("long").alias("df"))
            weights = weights.unionByName(own)
        rows = by_document(index, post).join(broadcast_if_small(weights, known_rows=n + 1), "tid")
    else:
        rows = post.join(broadcast_if_small(weights, known_rows=n), "tid").drop("tid")
        if every is not None:
            rows = rows.unionByName(every.select("doc_id", F.lit(1).alias("tf"), F.lit(1).alias("dl"), "unit", F.lit(0).alias("sub"), F.lit(1.0).alias("factor"), F.lit(None).cast("long").alias("df")))
        rows = by_document(index, rows)
    if multi:
        rows = rows.groupBy("shard", "doc_id", "unit", "sub", "dl", "factor", "df").agg(F.sum("tf").alias("tf"))
    rows = rows.crossJoin(_stats(index))
    score = F.when(F.col("df").isNull(), 1.0).otherwise(F.col("factor") * bm25(F.col("tf"), F.col("df"), F.col("dl"), F.col("n_docs"), F.col("avgdl")))
    rows = rows.select("shard", "unit", "doc_id", score.alias("score"), F.col("df").isNull().alias("flat"))
    if many:
        rows = rows.groupBy("shard", "unit", "doc_id").agg(F.when(F.max("flat"), 1.0).otherwise(F.sum("score")).alias("score"))
    return rows.select("shard", "unit", "doc_id", "score")


def search(index: Index, clauses: DataFrame, k: int = P.TOP_K, stem: bool = True,
           max_edits: int = P.FUZZY_MAX_EDITS) -> DataFrame:
    """QRY-3..15/19: boolean combination of clauses per query.  A document
    matches when it matches every MUST clause, no MUST_NOT clause and — if
    the query has no MUST clause — at least one SHOULD clause; its score is
    the sum of its matching MUST/SHOULD clause scores.  A query with an
    invalid clause yields one error row; the other queries are answered."""
    spark = clauses.sparkSession
    ensure_checkpoint_dir(spark)
    # the clause table is small: validated once and checkpointed to the
    # shared folder, so the driver-side checks below reuse it
    cl = validate_clauses(clause_table(clauses)).checkpoint()
    # Whether a regular expression compiles is asked of the JVM, once for each.
    if cl.where(F.col("kind") == "regex").select("text").distinct().count() > MAX_PREDICATE_CLAUSES:
        raise ValueError(f"more than {MAX_PREDICATE_CLAUSES} regular expressions in one batch; split the batch")
    rx = [r.text for r in cl.where((F.col("kind") == "regex") & F.col("error").isNull()).select("text").distinct().collect()]
    rx_err = [("regex", t, e) for t in rx if (e := _java_regex_error(spark, t))]
    if rx_err:
        errs = spark.createDataFrame(rx_err, "kind string, text string, rx_error string")
        cl = cl.join(F.broadcast(errs), ["kind", "text"], "left").select(
            *[c for c in cl.columns if c != "error"], F.coalesce("error", "rx_error").alias("error"))
    bad_q = cl.where(F.col("error").isNotNull()).groupBy("query_id").agg(F.min(F.concat_ws(": ", F.col("clause_id").cast("string"), "error")).alias("message"))
    valid = cl.join(bad_q, "query_id", "left_anti").drop("error")
    negated = F.col("occur") == "MUST_NOT"
    all_q = valid.where(F.col("kind") == "match_all").groupBy("query_id").agg(
        F.sum(F.when(negated, 0.0).otherwise(F.col("boost"))).alias("all_boost"), F.max(negated).alias("none"))
    all_q = all_q.checkpoint()
    # a negated match-all clause leaves its query without hits
    good = valid.where(F.col("kind") != "match_all").join(all_q.where("none"), "query_id", "left_anti").checkpoint()
    mixed_q = all_q.where("not none").join(good.select("query_id").distinct(), "query_id", "left_semi").checkpoint()
    all_q = all_q.where("not none").join(mixed_q, "query_id", "left_anti").select("query_id", F.col("all_boost").alias("boost"))
    n = good.count()

    # equal clauses are one unit, scored once a document with a boost of 1
    units = good.select("kind", "text", "slop").distinct().withColumn("unit", F.monotonically_increasing_id()).checkpoint()
    kinds = {r["kind"]: r["count"] for r in units.groupBy("kind").count().collect()}  # at most 8 rows
    weights, live, phrases, n_phrase = [], [units.where(~F.col("kind").isin("term", "phrase")).select("unit")], None, 0
    columns = lambda sub, factor, df: ["unit", sub.alias("sub"), "term", factor.alias("factor"), df.cast("long").alias("df")]
    df_of = lambda t, *by: t.join(index.terms.select("term", "df"), "term").withColumn("df", F.max("df").over(Window.partitionBy(*by)))
    if kinds.get("term") or kinds.get("phrase"):
        # term clauses: each analysed position is a synonym group
        tp = _analyzed_unit_terms(units.where(F.col("kind").isin("term", "phrase")), stem)
        # a phrase of one position is a term clause
        places = Window.partitionBy("unit")
        one = F.min("pos").over(places) == F.max("pos").over(places)
        tp = tp.withColumn("kind", F.when(one, "term").otherwise(F.col("kind"))).checkpoint()
        live.append(tp.select("unit").distinct())
        phrases = tp.where(F.col("kind") == "phrase")
        n_phrase = phrases.count()
        weights.append(df_of(tp.where(F.col("kind") == "term"), "unit", "pos").select(*columns(F.col("pos"), F.lit(1.0), F.col("df"))))
    inexact = ("prefix", "wildcard", "regex", "range")
    if any(kinds.get(x) for x in inexact):
        # every distinct pattern is expanded once, for all of its clauses; the score is constant
        asked = units.where(F.col("kind").isin(*inexact)).select("unit", "kind", "text")
        matched = _expand_patterns(index, asked.select("kind", "text"), kinds)
        matched = matched.join(broadcast_if_small(asked), ["kind", "text"]).distinct()
        weights.append(matched.select(*columns(F.lit(0), F.lit(1.0), F.lit(None))))
    if kinds.get("fuzzy"):
        # blended scoring: df = max df over the clause's expansions; each term adds similarity · bm25
        fz = units.where(F.col("kind") == "fuzzy").select(F.col("unit").alias("query_id"), F.lit(0).alias("clause_id"), "text")
        near = _expand_fuzzy(index, fz, max_edits).withColumnRenamed("query_id", "unit")
        weights.append(df_of(near, "unit").select(*columns(F.row_number().over(Window.partitionBy("unit").orderBy("term")), F.col("sim"), F.col("df"))))
    # match_all queries are answered apart (first k documents, N hits)
    open_unit = None if mixed_q.isEmpty() else -1
    parts = []
    if weights or open_unit is not None:
        w = reduce(DataFrame.unionByName, weights) if weights else spark.createDataFrame([], "unit long, sub int, term string, factor double, df long")
        w = stage_table(w, "clause-terms")
        parts.append(_score_units(index, w, w.count(), open_unit))
    if n_phrase:
        parts.append(_score_phrase(index, phrases, n_phrase))
    if not parts:
        parts.append(spark.createDataFrame([], "shard int, unit long, doc_id long, score double"))
    scored = reduce(DataFrame.unionByName, parts)

    count = lambda occur: F.sum(F.when(F.col("occur") == occur, 1).otherwise(0))
    asked = good.join(units, (good["kind"] == units["kind"]) & good["text"].eqNullSafe(units["text"]) & (good["slop"] == units["slop"]))
    # clauses that analyse to nothing are dropped, as a parser would drop them
    asked = asked.join(reduce(DataFrame.unionByName, live), "unit", "left_semi").select("unit", "query_id", "occur", "boost")
    # next to another MUST clause a match-all clause only adds its boost; else every document matches
    asked = asked.unionByName(mixed_q.select(F.lit(-1).cast("long").alias("unit"), "query_id", F.lit("SHOULD").alias("occur"), F.col("all_boost").alias("boost")))
    asked = asked.groupBy("unit", "query_id").agg(
        F.sum(F.when(F.col("occur") == "MUST_NOT", 0.0).otherwise(F.col("boost"))).alias("boost"),
        count("MUST").alias("must"), count("SHOULD").alias("should"), count("MUST_NOT").alias("never"))
    asked = stage_table(asked, "clauses")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("query_id").alias("queries")).first()
    ok = rank_units(index, scored, asked, k, max(size.queries, 1), size.n)
    errors = bad_q.select(
        "query_id", F.lit(None).cast("int").alias("rank"), F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("string").alias("filepath"), F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("long").alias("total_hits"), F.concat(F.lit("error: "), F.col("message")).alias("status"))
    return ok.unionByName(match_all(index, all_q, k)).unionByName(errors)


def match_rest(index: Index, queries: DataFrame, scored: DataFrame, negated: DataFrame, k: int = P.TOP_K) -> DataFrame:
    """Match-all next to optional and excluded clauses: every document but the
    ``negated`` ones (query_id, doc_id) matches, the ``scored`` ones with their
    score, the rest with the boost.  Only the first k of the rest can be among a
    query's first k: taken documents are counted by blocks of places, and of the
    first blocks with a free place, k at most, the places are looked at."""
    scored = scored.join(queries.select("query_id"), "query_id", "left_semi").checkpoint()
    negated = negated.join(queries.select("query_id"), "query_id", "left_semi").checkpoint()
    numbered = index.numbered_docs()
    taken = scored.select("query_id", "doc_id").union(negated).distinct().join(numbered, "doc_id")
    taken = taken.select("query_id", "place", F.floor(F.col("place") / PLACE_BLOCK).cast("long").alias("block")).checkpoint()
    n_docs = F.broadcast(index.docs.agg(F.count(F.lit(1)).alias("n_docs")))  # one row
    used = taken.groupBy("query_id", "block").agg(F.count(F.lit(1)).alias("n_taken"))
    total = used.groupBy("query_id").agg(F.sum("n_taken").alias("n_all"))
    last = F.least(F.col("n_docs"), F.lit(k) + F.coalesce("n_all", F.lit(0))) - 1
    blocks = queries.join(total, "query_id", "left").crossJoin(n_docs).where("n_docs > 0")
    blocks = blocks.select("query_id", "boost", "n_docs", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / PLACE_BLOCK).cast("long"))).alias("block"))
    end = F.least(F.col("n_docs"), (F.col("block") + 1) * PLACE_BLOCK)
    blocks = blocks.join(used, ["query_id", "block"], "left").withColumn("free", end - F.col("block") * PLACE_BLOCK - F.coalesce("n_taken", F.lit(0)))
    earlier = Window.partitionBy("query_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("free").over(earlier), F.lit(0))).where((F.col("free") > 0) & (F.col("before") < k))
    places = blocks.select("query_id", "boost", F.explode(F.sequence(F.col("block") * PLACE_BLOCK, end - 1)).alias("place"))
    order = Window.partitionBy("query_id").orderBy("place")
    free = places.join(taken, ["query_id", "place"], "left_anti").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    rest = free.join(numbered, "place").select("query_id", "doc_id", F.col("boost").alias("score"))
    first = top_k(scored.unionByName(rest).select("query_id", "doc_id", F.round("score", SCORE_DIGITS).alias("score")), k)
    out = negated.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_out"))
    totals = queries.join(out, "query_id", "left").crossJoin(n_docs).select(
        "query_id", (F.col("n_docs") - F.coalesce("n_out", F.lit(0))).alias("total_hits"))
    return fetch_docs(first.join(totals, "query_id"), index).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "filepath", "score", "total_hits", F.lit("ok").alias("status"))


def match_all(index: Index, queries: DataFrame, k: int = P.TOP_K) -> DataFrame:
    """QRY-14: every document matches with score = boost; the hits are the
    first k documents in index order and the total is the document count.
    Only k documents are ever paired with the (bounded) query list."""
    n_q = queries.count()
    if n_q == 0:
        return queries.sparkSession.createDataFrame([], ", ".join(
            ["query_id long", "rank int", "doc_id long", "filepath string", "score double", "total_hits long", "status string"]))
    first = index.docs.select("doc_id", "filepath").orderBy("doc_id").limit(k)
    first = first.select("*", F.row_number().over(Window.orderBy("doc_id")).alias("rank"))  # k rows only
    n_docs = index.docs.agg(F.count(F.lit(1)).alias("total_hits"))
    qs = broadcast_if_small(queries, known_rows=n_q).crossJoin(F.broadcast(n_docs))
    out = qs.crossJoin(F.broadcast(first))
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "filepath",
                      F.round(F.col("boost"), SCORE_DIGITS).alias("score"), "total_hits", F.lit("ok").alias("status"))
