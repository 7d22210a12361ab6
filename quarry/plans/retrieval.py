"""Registered text-analysis, index and retrieval queries over the driver
tables, each with its SQL twin.

Corpus: ``documents`` (``doc_id`` doubles as the stored path).  Free-text
queries: every ``benchmark`` passage (passages occur inside documents), so
the query batch grows with the tables.  The oracle runs the chain with
stemming off (no stemmer exists on the SQL side).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import analyzer as A
from ..operators import index as I
from ..operators import search as S
from ..operators import stem_table as ST
from ..operators import synonyms as SY
from ..session import ensure_checkpoint_dir
from . import sqlgen as G
from .tables import load

NOSTEM = A.AnalyzerOptions(stem=False)
# Documents of a task whose synonym words are counted in memory.
SYNONYM_DOCS = 512


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents", spread_rows=True)


def _analyzed(spark, sf):
    return A.analyze(_docs(spark, sf), "doc_id", "text", NOSTEM)


def _postings(spark, sf):
    return I.document_postings(_docs(spark, sf), NOSTEM)


def _stamp(spark, sf) -> int:
    fs, path = I._fs(spark, f"{sf}/documents.parquet")
    return fs.getFileStatus(path).getModificationTime()


def _index(spark, sf, layout: str = "document") -> I.Index:
    """The documents index, written once per (tables, layout) to the shared
    checkpoint folder and read back as parquet; a changed table is read anew.
    One batch reads the vocabulary once, so the tables for inexact clauses are
    made when a clause asks for them."""
    return I.materialize_index(I.build_index(_docs(spark, sf), NOSTEM), key=(sf, _stamp(spark, sf), "nostem", layout), layout=layout)


def _benchmark_queries(spark, sf) -> DataFrame:
    return load(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def _flags_str(c):
    return F.array_join(c, ",")


# --------------------------------------------------------------------------- TXT
def tokenize(spark, sf):
    """TXT-1/2: tokens and positions of every document."""
    d = _docs(spark, sf)
    t = d.select("doc_id", F.posexplode(T.tokenize(F.col("text"))).alias("pos", "term"))
    return t.select("doc_id", F.col("pos").cast("int").alias("pos"), "term")


def flag_tokens(spark, sf):
    """TXT-3/4: flags of every raw token (before lowercasing) and the final test."""
    t = A.raw_tokens(_docs(spark, sf))
    return t.select("doc_id", "pos", "term", _flags_str(F.col("flags")).alias("flags"), "is_final")


def custom_flags(spark, sf):
    """UDF-1: tokens that a user's rules flag besides the standard ones."""
    rules = [*T.DEFAULT_RULES, T.TokenRule(r"[A-Z][a-z]+", "NamedEntity"), T.TokenRule(r"\p{L}\p{L}", "Number", "Acronym")]
    t = A.raw_tokens(_docs(spark, sf), rules=rules).withColumn("flags", _flags_str(F.col("flags")))
    return t.groupBy("doc_id", "flags").agg(F.count("*").alias("n"))


def analyze_tokens(spark, sf):
    """TXT-5..14 (stemming off): the surviving tokens of the whole chain."""
    t = A.explode_tokens(_analyzed(spark, sf))
    return t.select("doc_id", "pos", "ord", "pos_inc", "term", _flags_str(F.col("flags")).alias("flags"), "is_final")


def token_dump(spark, sf):
    """SNK-3: ``[term]: [flags] isFinal`` per surviving token."""
    t = A.explode_tokens(_analyzed(spark, sf))
    line = F.concat(
        F.lit("["), F.col("term"), F.lit("]: ["), F.array_join("flags", ", "), F.lit("] "),
        F.when(F.col("is_final"), F.lit("true")).otherwise(F.lit("false")),
    )
    return t.select("doc_id", "pos", "ord", line.alias("line"))


def unit_count(spark, sf):
    """TXT-15: blank-split unit count per document."""
    return load(spark, sf, "documents").select("doc_id", T.unit_count(F.col("text")).alias("n_units"))


def _synonym_pairs(spark, sf) -> DataFrame:
    """From every word of every passage on: it, and it with the next one, have
    the next word, and the next two, as synonyms."""
    letters = F.transform(F.split(F.lower("text"), " "), lambda w: F.regexp_replace(w, r"[^\p{L}]", ""))
    w = load(spark, sf, "benchmark").select(F.filter(letters, lambda x: x != "").alias("w"))
    e = w.select("w", F.explode(F.expr("sequence(0, size(w) - 4)")).alias("i")).where("i >= 0 and size(w) >= 4")
    word = lambda n: F.get("w", F.col("i") + n)
    nul = F.lit("\0")
    one = e.select(word(0).alias("term"), word(1).alias("synonym"))
    two = e.select(F.concat(word(0), nul, word(1)).alias("term"), F.concat(word(2), nul, word(3)).alias("synonym"))
    return one.unionByName(two)


def synonym_words(spark, sf):
    """TXT-9: the synonym words that the passages' pairs add to the documents.
    Texts are dealt by document, and not the many more words found in them; rows of
    one document lie together, so that its words are counted there."""
    docs = load(spark, sf, "documents").select("doc_id", "text")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // SYNONYM_DOCS))
    tokens = docs.repartition(tasks, "doc_id").sortWithinPartitions("doc_id").select("doc_id", A.token_array(F.col("text"), lower=True).alias("t"))
    return SY.synonym_words(tokens.select("doc_id", A._front(F.col("t"), NOSTEM).alias("tokens")), _synonym_pairs(spark, sf), counted=True)


def stem_terms(spark, sf):
    """TXT-11: the stem table of the documents' vocabulary, filled in two runs."""
    terms = I.vocabulary(_index(spark, sf).postings)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-stems-{uuid.uuid4().hex}"
    ST.update_stems(terms.where(F.pmod(F.hash("term"), F.lit(2)) == 0), path)
    return ST.update_stems(terms, path)


def search_stemmed(spark, sf):
    """QRY-1/TXT-11: top 10 per passage over the stemmed index."""
    options = A.AnalyzerOptions(stem=True)
    index = I.materialize_index(I.build_index(_docs(spark, sf), options), key=(sf, _stamp(spark, sf), "stem"))
    return S.run_queries(index, _benchmark_queries(spark, sf), stem=True)


# --------------------------------------------------------------------------- IDX
def postings(spark, sf):
    p = _postings(spark, sf)
    return p.select("term", "doc_id", "tf", F.array_join("positions", " ").alias("positions"), "dl")


def doc_lengths(spark, sf):
    return I.doc_lengths(_analyzed(spark, sf))


def term_stats(spark, sf):
    return I.term_stats(_postings(spark, sf))


def collection_stats(spark, sf):
    s = I.collection_stats(_postings(spark, sf))
    return s.select("n_docs", "sum_ttf", F.round("avgdl", 6).alias("avgdl"))


def vocabulary(spark, sf):
    return I.vocabulary(_postings(spark, sf))


def docs_table(spark, sf):
    """IDX-2/7: stored fields joined with the length columns."""
    idx = _index(spark, sf)
    return idx.docs.select("doc_id", "filename", "filepath", "n_tokens", "dl_exact", "norm", "dl")


# --------------------------------------------------------------------------- QRY
def search_any(spark, sf):
    """QRY-1/2/5/6/16/17/18/20: top 10 per benchmark passage, OR semantics."""
    return S.run_queries(_index(spark, sf), _benchmark_queries(spark, sf), stem=False)


def hit_counts(spark, sf):
    """QRY-17: hit counts that are exact up to half of the documents."""
    index = _index(spark, sf)
    half = index.docs.count() // 2
    return S.reported_hits(S.run_queries(index, _benchmark_queries(spark, sf), stem=False), half)


def result_lines(spark, sf):
    """SNK-4: printed result lines."""
    return S.format_results(search_any(spark, sf))


QUERIES = {
    "tokenize": tokenize,
    "flag_tokens": flag_tokens,
    "custom_flags": custom_flags,
    "analyze_tokens": analyze_tokens,
    "token_dump": token_dump,
    "synonym_words": synonym_words,
    "stem_terms": stem_terms,
    "search_stemmed": search_stemmed,
    "unit_count": unit_count,
    "postings": postings,
    "doc_lengths": doc_lengths,
    "term_stats": term_stats,
    "collection_stats": collection_stats,
    "vocabulary": vocabulary,
    "docs_table": docs_table,
    "search_any": search_any,
    "result_lines": result_lines,
    "hit_counts": hit_counts,
}

# --------------------------------------------------------------------------- SQL
_IDX = G.index_ctes()


def search_sql(queries: str, id_col: str, text_col: str, ctes: str = "") -> str:
    """Top 10 of every query in a table or in one of the given CTEs."""
    analyzed = G.analyzer_ctes("qtok", queries, id_col, text_col)
    return f"""
WITH {_IDX}, {ctes}{analyzed},
  groups AS (SELECT id AS query_id, pos AS clause_id, term FROM qtok),
  gterms AS (SELECT g.*, t.df, max(t.df) OVER (PARTITION BY g.query_id, g.clause_id) AS gdf
             FROM groups g JOIN terms t ON t.term = g.term),
  per_group AS (
    SELECT g.query_id, g.clause_id, p.doc_id, p.dl, g.gdf, sum(p.tf) AS tf
    FROM gterms g JOIN postings p ON p.term = g.term
    GROUP BY g.query_id, g.clause_id, p.doc_id, p.dl, g.gdf),
  per_doc AS (
    SELECT query_id, doc_id, sum({G.bm25_sql('tf', 'gdf', 'dl')}) AS score
    FROM per_group, stats s GROUP BY query_id, doc_id),
{G.rank_sql('per_doc')}
"""


LETTERS = "\\p{L}\\p{L}"
SEARCH_ANY_SQL = search_sql("benchmark", "item_id", "text")


SQL = {
    "tokenize": f"SELECT id AS doc_id, pos, term FROM ({G.tokens_sql('documents', 'doc_id', 'text')})",
    "flag_tokens": f"""
        SELECT id AS doc_id, pos, term, array_to_string(f, ',') AS flags, {G.is_final_sql('f')} AS is_final
        FROM (SELECT id, pos, term, {G.flags_sql('term')} AS f
              FROM ({G.tokens_sql('documents', 'doc_id', 'text')}))""",
    "custom_flags": f"""
        SELECT id AS doc_id, array_to_string(f, ',') AS flags, count(*) AS n
        FROM (SELECT id, {G.flags_sql('term', [("NamedEntity", '[A-Z][a-z]+'), ("Number", LETTERS), ("Acronym", LETTERS)])} AS f
              FROM ({G.tokens_sql('documents', 'doc_id', 'text')})) GROUP BY ALL""",
    "analyze_tokens": f"""
        WITH {G.analyzer_ctes('tok', 'documents', 'doc_id', 'text')}
        SELECT id AS doc_id, pos, ord, pos_inc, term, array_to_string(flags, ',') AS flags, is_final FROM tok""",
    "token_dump": f"""
        WITH {G.analyzer_ctes('tok', 'documents', 'doc_id', 'text')}
        SELECT id AS doc_id, pos, ord,
               '[' || term || ']: [' || array_to_string(flags, ', ') || '] ' ||
               CASE WHEN is_final THEN 'true' ELSE 'false' END AS line
        FROM tok""",
    "synonym_words": f"""
        WITH {G.analyzer_ctes('tok', 'documents', 'doc_id', 'text')},
        w AS (SELECT list_filter(list_transform(string_split(lower(text), ' '), lambda x: regexp_replace(x, '[^\\p{{L}}]', '', 'g')), lambda x: x <> '') AS w FROM benchmark),
        e AS (SELECT w, unnest(range(1, len(w) - 2)) AS i FROM w),
        pairs AS (SELECT DISTINCT w[i] AS a, NULL AS b, [w[i + 1]] AS r FROM e UNION SELECT w[i], w[i + 1], [w[i + 2], w[i + 3]] FROM e),
        hit AS (
          SELECT t.id, t.pos, p.r FROM tok_t4 t JOIN pairs p ON p.b IS NULL AND p.a = t.term
          UNION ALL
          SELECT t.id, t.pos, p.r FROM tok_t4 t JOIN tok_t4 u ON u.id = t.id AND u.pos = t.pos + 1 AND t.ord = 0 AND u.ord = 0
          JOIN pairs p ON p.a = t.term AND p.b = u.term)
        SELECT id AS doc_id, CAST(pos + k AS INTEGER) AS pos, word, count(*) AS n
        FROM (SELECT id, pos, unnest(r) AS word, unnest(range(len(r))) AS k FROM hit) GROUP BY ALL""",
    "unit_count": "SELECT doc_id, len(string_split(text, ' ')) AS n_units FROM documents",
    "postings": f"""
        WITH {_IDX}
        SELECT term, doc_id, tf, array_to_string(positions, ' ') AS positions, dl FROM postings""",
    "doc_lengths": f"""
        WITH {_IDX}
        SELECT doc_id, n_tokens, n_tokens - dl_exact AS n_overlap, dl_exact,
               {G.encode_length_sql('dl_exact')} AS norm,
               {G.decode_length_sql(G.encode_length_sql('dl_exact'))} AS dl
        FROM dlen""",
    "term_stats": f"WITH {_IDX} SELECT term, df, ttf FROM terms",
    "collection_stats": f"WITH {_IDX} SELECT n_docs, sum_ttf, round(avgdl, 6) AS avgdl FROM stats",
    "vocabulary": f"WITH {_IDX} SELECT DISTINCT term FROM postings",
    "docs_table": f"""
        WITH {_IDX}
        SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) AS filename, CAST(d.doc_id AS VARCHAR) AS filepath,
               l.n_tokens, l.dl_exact,
               {G.encode_length_sql('l.dl_exact')} AS norm,
               {G.decode_length_sql(G.encode_length_sql('l.dl_exact'))} AS dl
        FROM documents d LEFT JOIN dlen l ON l.doc_id = d.doc_id""",
    "search_any": SEARCH_ANY_SQL,
    "hit_counts": f"""
        WITH res AS ({SEARCH_ANY_SQL}), half AS (SELECT count(*) // 2 AS h FROM documents)
        SELECT query_id, max(total_hits) AS total_hits, least(max(total_hits), max(h) + 1) AS reported, max(total_hits) <= max(h) AS hits_exact
        FROM res, half GROUP BY query_id""",
    "result_lines": f"""
        WITH res AS ({SEARCH_ANY_SQL})
        SELECT query_id, 0 AS rank, 'Found: ' || CAST(max(total_hits) AS VARCHAR) AS line FROM res GROUP BY query_id
        UNION ALL
        SELECT query_id, rank, CAST(rank AS VARCHAR) || '. "' || filepath || '"' AS line FROM res""",
}
