"""Registered structured-query plans (QRY-3/4/7..15/19) and their SQL twins.

Clause tables are derived from ``benchmark`` passages in both engines
(words = the passage split on single blanks), so the number of queries
grows with the tables and the corpus is the whole ``documents`` table:

* all      — every word of the passage as a MUST term clause (AND);
* bool     — first word MUST, last word MUST_NOT, the others SHOULD with boost 2;
* phrase   — every three words in a row as one exact phrase each;
* near     — from every word on, words 1, 3 and 4 as a phrase with slop 3;
* prefix / wildcard / regex / range — from the first letters of every word;
* fuzzy    — every word, lowercased, letters only, two edits;
* match_all — one match-all clause per passage;
* all_but  — a match-all clause next to every word, by turns excluded and optional;
* errors   — for every word one query with a leading wildcard (rejected) and
  one valid term query.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import search as S
from . import sqlgen as G
from .retrieval import _index
from .tables import load

# --------------------------------------------------------------------------- Spark side


def _words(spark, sf):
    b = load(spark, sf, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.split("text", " ").alias("w"))


def _each(df, kind, text, occur="SHOULD", boost=1.0, slop=0):
    """One clause for every word ``w[clause_id]`` of every passage; ``text`` is
    made of the words from there on (column ``rest``)."""
    e = df.select("query_id", "w", F.posexplode("w").alias("clause_id", "word"))
    e = e.withColumn("rest", F.expr("slice(w, clause_id + 1, size(w))"))
    return e.select("query_id", "clause_id", F.lit(occur).alias("occur"), F.lit(kind).alias("kind"),
                    text.alias("text"), F.lit(boost).alias("boost"), F.lit(slop).alias("slop"))


def clauses_all(spark, sf):
    w = _words(spark, sf)
    e = w.select("query_id", F.posexplode("w").alias("clause_id", "text"))
    return e.select("query_id", "clause_id", F.lit("MUST").alias("occur"), F.lit("term").alias("kind"), "text",
                    F.lit(1.0).alias("boost"), F.lit(0).alias("slop"))


def clauses_bool(spark, sf):
    w = _words(spark, sf)
    e = w.select("query_id", F.size("w").alias("n"), F.posexplode("w").alias("clause_id", "text"))
    occur = (F.when(F.col("clause_id") == 0, "MUST").when(F.col("clause_id") == F.col("n") - 1, "MUST_NOT")
             .otherwise("SHOULD"))
    boost = F.when(occur == "SHOULD", F.lit(2.0)).otherwise(F.lit(1.0))
    return e.select("query_id", "clause_id", occur.alias("occur"), F.lit("term").alias("kind"), "text",
                    boost.alias("boost"), F.lit(0).alias("slop"))


def _first_letters(n):
    return F.lower(F.substring(F.col("word"), 1, n))


def clauses_phrase(spark, sf):
    return _each(_words(spark, sf), "phrase", F.array_join(F.slice("rest", 1, 3), " "))


def clauses_near(spark, sf):
    return _each(_words(spark, sf), "phrase", F.concat_ws(" ", F.get("rest", F.lit(0)), F.get("rest", F.lit(2)), F.get("rest", F.lit(3))), slop=3)


def clauses_prefix(spark, sf):
    return _each(_words(spark, sf), "prefix", _first_letters(3))


def clauses_wildcard(spark, sf):
    return _each(_words(spark, sf), "wildcard", F.concat(_first_letters(2), F.lit("?*")))


def clauses_regex(spark, sf):
    letters = F.regexp_replace(_first_letters(2), r"[^\p{L}\p{N}]", "")
    return _each(_words(spark, sf), "regex", F.concat(letters, F.lit("[a-z]*")))


def clauses_range(spark, sf):
    lo = _first_letters(2)
    return _each(_words(spark, sf), "range", F.concat(F.lit("["), lo, F.lit(" TO "), lo, F.lit("z]")))


def clauses_fuzzy(spark, sf):
    return _each(_words(spark, sf), "fuzzy", F.regexp_replace(F.lower("word"), r"[^\p{L}]", "")).where("text != ''")


def clauses_match_all(spark, sf):
    w = _words(spark, sf)
    return w.select("query_id", F.lit(0).alias("clause_id"), F.lit("SHOULD").alias("occur"), F.lit("match_all").alias("kind"),
                    F.lit(None).cast("string").alias("text"), F.lit(1.0).alias("boost"), F.lit(0).alias("slop"))


def clauses_all_but(spark, sf):
    """All documents but those with an odd word of the passage; those with its
    even words first."""
    occur = F.when(F.col("clause_id") % 2 == 1, "MUST_NOT").otherwise("SHOULD")
    words = _each(_words(spark, sf), "term", F.col("word")).withColumn("occur", occur)
    return clauses_match_all(spark, sf).withColumn("clause_id", F.lit(-1)).unionByName(words)


def clauses_errors(spark, sf):
    words = _each(_words(spark, sf), "term", F.col("word"))
    bad = words.select((F.col("query_id") * 2).alias("query_id"), "clause_id", "occur", F.lit("wildcard").alias("kind"),
                       F.concat(F.lit("*"), F.lower("text")).alias("text"), "boost", "slop")
    return bad.unionByName(words.withColumn("query_id", F.col("query_id") * 2 + 1))


CLAUSES = {
    "search_all": clauses_all,
    "search_bool": clauses_bool,
    "search_phrase": clauses_phrase,
    "search_near": clauses_near,
    "search_prefix": clauses_prefix,
    "search_wildcard": clauses_wildcard,
    "search_regex": clauses_regex,
    "search_range": clauses_range,
    "search_fuzzy": clauses_fuzzy,
    "search_match_all": clauses_match_all,
    "search_all_but": clauses_all_but,
    "search_errors": clauses_errors,
}


def _runner(make):
    def run(spark, sf):
        return S.search(_index(spark, sf, "term"), make(spark, sf), stem=False)
    run.__doc__ = make.__doc__
    return run


QUERIES = {name: _runner(make) for name, make in CLAUSES.items()}

# --------------------------------------------------------------------------- SQL side
_WORDS = "SELECT item_id AS query_id, string_split(text, ' ') AS w FROM benchmark"


_EACH = f"SELECT query_id, CAST(i AS INTEGER) AS clause_id, w[i + 1] AS word, w[i + 1:] AS rest FROM (SELECT query_id, w, unnest(range(len(w))) AS i FROM ({_WORDS}))"


def _each_sql(kind, text, occur="'SHOULD'", boost=1.0, slop=0, qid="query_id"):
    return (f"SELECT {qid} AS query_id, clause_id, {occur} AS occur, '{kind}' AS kind, "
            f"CAST({text} AS VARCHAR) AS text, {boost} AS boost, {slop} AS slop FROM ({_EACH})")


def _fl(n):
    return f"lower(substr(word, 1, {n}))"


_MATCH_ALL = f"SELECT query_id, CAST(0 AS INTEGER) AS clause_id, 'SHOULD' AS occur, 'match_all' AS kind, CAST(NULL AS VARCHAR) AS text, 1.0 AS boost, 0 AS slop FROM ({_WORDS})"


CLAUSE_SQL = {
    "search_all": f"""SELECT query_id, CAST(i - 1 AS INTEGER) AS clause_id, 'MUST' AS occur, 'term' AS kind, text,
                        1.0 AS boost, 0 AS slop
                      FROM (SELECT query_id, unnest(w) AS text, unnest(range(1, len(w) + 1)) AS i FROM ({_WORDS}))""",
    "search_bool": f"""SELECT query_id, clause_id, occur, 'term' AS kind, text,
                         CASE WHEN occur = 'SHOULD' THEN 2.0 ELSE 1.0 END AS boost, 0 AS slop FROM (
                        SELECT query_id, CAST(i - 1 AS INTEGER) AS clause_id, text,
                               CASE WHEN i = 1 THEN 'MUST' WHEN i = n THEN 'MUST_NOT' ELSE 'SHOULD' END AS occur
                        FROM (SELECT query_id, len(w) AS n, unnest(w) AS text, unnest(range(1, len(w) + 1)) AS i
                              FROM ({_WORDS})))""",
    "search_phrase": _each_sql("phrase", "array_to_string(rest[1:3], ' ')"),
    "search_near": _each_sql("phrase", "concat_ws(' ', rest[1], rest[3], rest[4])", slop=3),
    "search_prefix": _each_sql("prefix", _fl(3)),
    "search_wildcard": _each_sql("wildcard", f"{_fl(2)} || '?*'"),
    "search_regex": _each_sql("regex", f"regexp_replace({_fl(2)}, '[^\\p{{L}}\\p{{N}}]', '', 'g') || '[a-z]*'"),
    "search_range": _each_sql("range", f"'[' || {_fl(2)} || ' TO ' || {_fl(2)} || 'z]'"),
    "search_fuzzy": "SELECT * FROM (" + _each_sql("fuzzy", "regexp_replace(lower(word), '[^\\p{L}]', '', 'g')") + ") WHERE text <> ''",
    "search_match_all": _MATCH_ALL,
    "search_all_but": f"SELECT * REPLACE (CAST(-1 AS INTEGER) AS clause_id) FROM ({_MATCH_ALL}) UNION ALL " +
                      _each_sql("term", "word", "CASE WHEN clause_id % 2 = 1 THEN 'MUST_NOT' ELSE 'SHOULD' END"),
    "search_errors": (_each_sql("wildcard", "'*' || lower(word)", qid="query_id * 2") + " UNION ALL " +
                      _each_sql("term", "word", qid="query_id * 2 + 1")),
}


def _like_sql(text: str) -> str:
    esc = f"replace(replace(replace({text}, '\\', '\\\\'), '%', '\\%'), '_', '\\_')"
    return f"translate({esc}, '*?', '%_')"


def _ascii(word: str) -> str:
    return f"regexp_replace({word}, '[^\\x00-\\x7F]', '?', 'g')"


# rows: [row before the last, last row]; a cell takes the least of its three
# neighbours and, where two letters are swapped, of the cell two rows up
_CELL = """least(r[2][j + 1] + 1, c[j] + 1, r[2][j] + CASE WHEN a[i] = b[j] THEN 0 ELSE 1 END,
    CASE WHEN i > 1 AND j > 1 AND a[i] = b[j - 1] AND a[i - 1] = b[j] THEN r[1][j - 1] + 1 ELSE 999 END)"""
_OSA = f"""list_reduce(range(1, len(a) + 1), lambda r, i: [r[2], list_reduce(range(1, len(b) + 1), lambda c, j: list_append(c, {_CELL}), [i])],
    [range(0, len(b) + 1), range(0, len(b) + 1)])[2][len(b) + 1]"""


def search_sql(clauses_sql: str) -> str:
    """SQL twin of ``search.search`` (stemming off)."""
    k1, b = 1.2, 0.75
    an_src = "(SELECT {'q': query_id, 'c': clause_id} AS key, text FROM cl WHERE kind IN ('term', 'phrase'))"
    return f"""
WITH RECURSIVE {G.index_ctes()},
  cl0 AS ({clauses_sql}),
  cl1 AS (SELECT *,
     CASE WHEN occur NOT IN ('MUST', 'SHOULD', 'MUST_NOT') THEN 'unknown occur: ' || occur
          WHEN kind NOT IN ('term','phrase','prefix','wildcard','regex','fuzzy','range','match_all')
               THEN 'unknown clause kind: ' || kind
          WHEN kind <> 'match_all' AND (text IS NULL OR length(trim(text)) = 0) THEN 'empty clause text'
          WHEN kind IN ('wildcard', 'prefix') AND (starts_with(text, '*') OR starts_with(text, '?'))
               THEN '''*'' or ''?'' not allowed as first character in WildcardQuery'
          WHEN kind = 'range' AND NOT regexp_matches(text, {G.q(S.RANGE_RX)}) THEN 'malformed range'
          WHEN slop < 0 THEN 'negative slop'
     END AS error FROM cl0),
  cl2 AS (SELECT *, error AS err FROM cl1),
  bad_q AS (SELECT query_id, min(CAST(clause_id AS VARCHAR) || ': ' || err) AS message FROM cl2
            WHERE err IS NOT NULL GROUP BY query_id),
  all_q AS (SELECT query_id, sum(CASE WHEN occur <> 'MUST_NOT' THEN boost ELSE 0 END) AS boost,
                   bool_or(occur = 'MUST_NOT') AS none
            FROM cl2 WHERE kind = 'match_all' AND query_id NOT IN (SELECT query_id FROM bad_q) GROUP BY query_id),
  cl AS (SELECT query_id, clause_id, occur, kind, text, boost, slop FROM cl2
         WHERE query_id NOT IN (SELECT query_id FROM bad_q) AND kind <> 'match_all'),
  {G.analyzer_ctes('ct', an_src, 'key', 'text')},
  tp0 AS (SELECT t.id.q AS query_id, t.id.c AS clause_id, t.pos, t.ord, t.term, c.kind, c.boost, c.slop, c.occur
          FROM ct t JOIN cl c ON c.query_id = t.id.q AND c.clause_id = t.id.c),
  -- a phrase of one position is a term clause
  tp AS (SELECT * REPLACE (CASE WHEN min(pos) OVER w = max(pos) OVER w THEN 'term' ELSE kind END AS kind)
         FROM tp0 WINDOW w AS (PARTITION BY query_id, clause_id)),
  -- term clauses
  tg AS (SELECT x.*, max(t.df) OVER (PARTITION BY x.query_id, x.clause_id, x.pos) AS gdf
         FROM tp x JOIN terms t USING (term) WHERE x.kind = 'term'),
  tpg AS (SELECT g.query_id, g.clause_id, g.pos, p.doc_id, p.dl, g.gdf, g.boost, sum(p.tf) AS tf
          FROM tg g JOIN postings p USING (term) GROUP BY ALL),
  term_scores AS (SELECT query_id, clause_id, doc_id, sum(boost * {G.bm25_sql('tf', 'gdf', 'dl')}) AS score
                  FROM tpg, stats s GROUP BY query_id, clause_id, doc_id),
  -- phrase clauses: slots are positions with sets of terms
  pt0 AS (SELECT query_id, clause_id, term, boost, slop, pos - min(pos) OVER w AS off,
                 dense_rank() OVER (w ORDER BY pos) AS i
          FROM tp WHERE kind = 'phrase' WINDOW w AS (PARTITION BY query_id, clause_id)),
  pt1 AS (SELECT p.*, max(i) OVER (PARTITION BY query_id, clause_id) AS n_slots FROM pt0 p),
  pt2 AS (SELECT DISTINCT p.*, t.df FROM pt1 p JOIN terms t USING (term)),
  pidf AS (SELECT query_id, clause_id, sum(ln(1.0 + (s.n_docs - df + 0.5) / (df + 0.5))) AS idf_sum
           FROM pt2, stats s GROUP BY query_id, clause_id, n_slots HAVING count(DISTINCT i) = n_slots),
  pocc AS (SELECT DISTINCT t.query_id, t.clause_id, t.boost, t.slop, t.i, t.n_slots, t.term, f.idf_sum, p.doc_id, p.dl,
                  unnest(p.positions) AS p, t.off FROM pt2 t JOIN pidf f USING (query_id, clause_id) JOIN postings p USING (term)),
  pex AS (SELECT query_id, clause_id, doc_id, dl, boost, idf_sum, count(*) * 1.0 AS tf FROM (
            SELECT query_id, clause_id, doc_id, dl, boost, idf_sum, n_slots, p - off AS start
            FROM pocc WHERE slop = 0 GROUP BY ALL HAVING count(DISTINCT i) = n_slots) GROUP BY ALL),
  pslot AS (SELECT *, p - off AS a, term || ':' || p AS place FROM pocc WHERE slop > 0),
  -- every choice of different places, one for each slot, that is narrow enough
  choice AS (
    SELECT query_id, clause_id, doc_id, 1 AS i, a AS lo, a AS hi, [place] AS used FROM pslot WHERE i = 1
    UNION ALL
    SELECT c.query_id, c.clause_id, c.doc_id, c.i + 1, least(lo, a), greatest(hi, a), list_append(used, place)
    FROM choice c JOIN pslot o ON o.query_id = c.query_id AND o.clause_id = c.clause_id AND o.doc_id = c.doc_id AND o.i = c.i + 1
    WHERE greatest(hi, a) - least(lo, a) <= o.slop AND NOT list_contains(used, place)),
  pwin AS (SELECT DISTINCT c.query_id, c.clause_id, c.doc_id, o.dl, o.boost, o.idf_sum, c.lo, c.hi FROM choice c
           JOIN (SELECT DISTINCT query_id, clause_id, doc_id, dl, boost, idf_sum, n_slots FROM pslot) o
           ON o.query_id = c.query_id AND o.clause_id = c.clause_id AND o.doc_id = c.doc_id AND c.i = o.n_slots),
  psl AS (SELECT query_id, clause_id, doc_id, dl, boost, idf_sum, sum(1.0 / (1.0 + hi - lo)) AS tf FROM pwin w
          WHERE NOT EXISTS (SELECT 1 FROM pwin v WHERE v.query_id = w.query_id AND v.clause_id = w.clause_id AND v.doc_id = w.doc_id
                            AND v.lo >= w.lo AND v.hi <= w.hi AND (v.lo > w.lo OR v.hi < w.hi))
          GROUP BY query_id, clause_id, doc_id, dl, boost, idf_sum),
  phrase_scores AS (SELECT query_id, clause_id, doc_id,
                      boost * idf_sum * tf / (tf + {k1} * ({1 - b} + {b} * dl / s.avgdl)) AS score
                    FROM (SELECT * FROM pex UNION ALL SELECT * FROM psl), stats s),
  -- prefix / wildcard / regex / range: constant score
  rng AS (SELECT query_id, clause_id, regexp_extract(text, {G.q(S.RANGE_RX)}, 1) AS lb,
                 regexp_extract(text, {G.q(S.RANGE_RX)}, 2) AS lo, regexp_extract(text, {G.q(S.RANGE_RX)}, 3) AS hi,
                 regexp_extract(text, {G.q(S.RANGE_RX)}, 4) AS hb FROM cl WHERE kind = 'range'),
  cexp AS (
    SELECT c.query_id, c.clause_id, t.term FROM cl c JOIN terms t ON c.kind = 'prefix' AND starts_with(t.term, c.text)
    UNION
    SELECT c.query_id, c.clause_id, t.term FROM cl c JOIN terms t
      ON c.kind = 'wildcard' AND t.term LIKE {_like_sql('c.text')} ESCAPE '\\'
    UNION
    SELECT c.query_id, c.clause_id, r.term FROM cl c JOIN (SELECT x.text, t.term FROM (SELECT DISTINCT text FROM cl WHERE kind = 'regex') x
      JOIN terms t ON regexp_full_match(t.term, x.text)) r ON c.kind = 'regex' AND c.text = r.text
    UNION
    SELECT r.query_id, r.clause_id, t.term FROM rng r JOIN terms t ON
      (r.lo = '*' OR (CASE WHEN r.lb = '[' THEN t.term >= r.lo ELSE t.term > r.lo END)) AND
      (r.hi = '*' OR (CASE WHEN r.hb = ']' THEN t.term <= r.hi ELSE t.term < r.hi END))),
  const_scores AS (SELECT DISTINCT e.query_id, e.clause_id, p.doc_id, c.boost AS score
                   FROM cexp e JOIN postings p USING (term) JOIN cl c USING (query_id, clause_id)),
  -- fuzzy: blended scoring over the best expansions
  -- restricted distance: a fold over rows of the table, each a fold over its cells; the
  -- unrestricted distance (of bytes, so of words in ASCII), which is never larger, picks the pairs
  fzc AS (SELECT x.text, t.term, t.df, string_split(x.text, '') AS a, string_split(t.term, '') AS b
          FROM (SELECT DISTINCT text FROM cl WHERE kind = 'fuzzy') x
          JOIN terms t ON abs(length(t.term) - length(x.text)) <= 2 AND damerau_levenshtein({_ascii('x.text')}, {_ascii('t.term')}) <= 2),
  fzd AS (SELECT text, term, df, {_OSA} AS ed FROM fzc),
  fz0 AS (SELECT c.query_id, c.clause_id, c.boost, f.term, f.df, f.ed, least(length(c.text), length(f.term)) AS ml
          FROM cl c JOIN fzd f ON c.kind = 'fuzzy' AND c.text = f.text),
  fz1 AS (SELECT *, 1.0 - ed / ml AS sim FROM fz0 WHERE ed <= 2),
  fz2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, clause_id ORDER BY sim DESC, term ASC) AS r
                         FROM fz1 WHERE sim > 0) WHERE r <= 50),
  fz AS (SELECT *, max(df) OVER (PARTITION BY query_id, clause_id) AS bdf FROM fz2),
  fuzzy_scores AS (SELECT f.query_id, f.clause_id, p.doc_id,
                     sum(f.boost * f.sim * {G.bm25_sql('p.tf', 'f.bdf', 'p.dl')}) AS score
                   FROM fz f JOIN postings p USING (term), stats s GROUP BY f.query_id, f.clause_id, p.doc_id),
  scored AS (SELECT * FROM term_scores UNION ALL SELECT * FROM phrase_scores
             UNION ALL SELECT * FROM const_scores UNION ALL SELECT * FROM fuzzy_scores),
  sc AS (SELECT s.*, c.occur FROM scored s JOIN cl c USING (query_id, clause_id)),
  live AS (SELECT DISTINCT t.query_id, t.clause_id, t.occur FROM tp t
           UNION SELECT query_id, clause_id, occur FROM cl WHERE kind NOT IN ('term', 'phrase')),
  need AS (SELECT query_id, sum(CASE WHEN occur = 'MUST' THEN 1 ELSE 0 END) AS n_must FROM live GROUP BY query_id),
  neg AS (SELECT DISTINCT query_id, doc_id FROM sc WHERE occur = 'MUST_NOT'),
  agg AS (SELECT query_id, doc_id, sum(score) AS score,
                 count(DISTINCT CASE WHEN occur = 'MUST' THEN clause_id END) AS must_hit,
                 count(CASE WHEN occur = 'SHOULD' THEN 1 END) AS should_hit
          FROM sc WHERE occur <> 'MUST_NOT' GROUP BY query_id, doc_id),
  matched AS (SELECT a.query_id, a.doc_id, a.score FROM agg a JOIN need n USING (query_id)
              WHERE a.must_hit = n.n_must AND (n.n_must > 0 OR a.should_hit > 0)
                AND query_id NOT IN (SELECT query_id FROM all_q)
              UNION ALL
              SELECT q.query_id, d.doc_id, q.boost + coalesce(a.score, 0) AS score
              FROM all_q q CROSS JOIN documents d LEFT JOIN need n ON n.query_id = q.query_id
              LEFT JOIN agg a ON a.query_id = q.query_id AND a.doc_id = d.doc_id
              WHERE NOT q.none AND coalesce(a.must_hit, 0) = coalesce(n.n_must, 0)),
  per_doc AS (SELECT * FROM matched a
              WHERE NOT EXISTS (SELECT 1 FROM neg g WHERE g.query_id = a.query_id AND g.doc_id = a.doc_id)),
  {G.rank_ctes('per_doc')}
SELECT * FROM res
UNION ALL
SELECT query_id, NULL AS rank, NULL AS doc_id, NULL AS filepath, NULL AS score, NULL AS total_hits,
       'error: ' || message AS status FROM bad_q
"""


SQL = {name: search_sql(CLAUSE_SQL[name]) for name in CLAUSES}
