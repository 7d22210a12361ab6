"""ANSI/DuckDB SQL twins of the Spark plans, used as correctness oracles.

The SQL side is written in row form (one row per token) with RE2 regexes;
it must compute the same values as the array-form Spark chain.  Only the
oracle uses these strings; the library never parses SQL.
"""

from __future__ import annotations

from ..functions import patterns as P
from ..functions import text as T


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(q(w) for w in words) + ")"


def flags_sql(term: str, more: list[tuple[str, str]] = ()) -> str:
    """Flags by the standard rules and by ``more`` (flag, pattern)."""
    items = []
    rules = dict(P.FLAG_RULES_RE2)
    for flag in P.FLAG_ORDER:
        conds = [f"regexp_full_match({term}, {q(rx)})" for name, rx in more if name == flag]
        if flag in rules:
            cond = f"regexp_full_match({term}, {q(rules[flag])})"
            conds.append(f"(length({term}) > 0 AND {cond})" if flag == "Roman" else cond)
        if conds:
            items.append(f"CASE WHEN {' OR '.join(conds)} THEN {q(flag)} END")
    found = f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"
    return f"(CASE WHEN len({found}) > 0 THEN {found} ELSE ['Word'] END)"


def fold_sql(term: str) -> str:
    src, dst, multi = T.fold_tables()
    out = f"translate({term}, {q(src)}, {q(dst)})"
    for ch, rep in multi:
        out = f"replace({out}, {q(ch)}, {q(rep)})"
    return out


def is_final_sql(flags: str) -> str:
    return f"(len({flags}) = 1 AND {flags}[1] <> 'Word')"


def tokens_sql(source: str, id_col: str, text_col: str) -> str:
    """(id, pos, term) — tokeniser output with positions."""
    return f"""
        SELECT id, CAST(pos AS INTEGER) AS pos, term FROM (
          SELECT id, unnest(toks) AS term, unnest(range(len(toks))) AS pos FROM (
            SELECT {id_col} AS id, list_filter(regexp_extract_all({text_col}, {q(P.TOKEN_RX)}, 0),
                                      lambda t: regexp_matches(t, {q(P.ALNUM_RX)})) AS toks
            FROM {source}))"""


def analyzer_ctes(name: str, source: str, id_col: str, text_col: str, stop: bool = True) -> str:
    """CTEs ending in ``{name}`` with columns id, pos, ord, pos_inc, term,
    flags (list), is_final — the full chain without stemming."""
    s1 = in_list(T.bundled_stopwords())
    s2 = in_list(T.bundled_stopwords_folded())
    stop1 = f"WHERE NOT (list_contains(flags, 'Word') AND term IN {s1})" if stop else ""
    stop2 = f"WHERE NOT (list_contains(flags, 'Word') AND term IN {s2})" if stop else ""
    return f"""
      {name}_t0 AS ({tokens_sql(source, id_col, text_col)}),
      {name}_t1 AS (SELECT id, pos, term, {flags_sql('term')} AS flags FROM {name}_t0),
      {name}_t2 AS (SELECT * FROM {name}_t1 WHERE NOT regexp_matches(term, {q(P.PUNCT_RX_RE2)})),
      {name}_t3 AS (
        SELECT id, pos, 0 AS ord, term, flags FROM {name}_t2
        UNION ALL
        SELECT id, pos, CAST(o AS INTEGER) AS ord, sub AS term, flags FROM (
          SELECT id, pos, flags, unnest(subs) AS sub, unnest(range(1, len(subs) + 1)) AS o FROM (
            SELECT id, pos, flags,
                   list_filter(regexp_extract_all(term, {q(P.URL_SUBTOKEN_RX_RE2)}, 1),
                               lambda s: length(s) > 0 AND s <> term) AS subs
            FROM {name}_t2 WHERE list_contains(flags, 'UrlAddress')))),
      {name}_t4 AS (SELECT id, pos, ord, lower(term) AS term, flags FROM {name}_t3),
      {name}_t5 AS (SELECT * FROM {name}_t4 {stop1}),
      {name}_t6 AS (SELECT id, pos, ord,
                      CASE WHEN list_contains(flags, 'Word') THEN {fold_sql('term')} ELSE term END AS term,
                      flags FROM {name}_t5),
      {name}_t7 AS (SELECT * FROM {name}_t6 {stop2}),
      {name} AS (
        SELECT id, pos, ord,
               CAST(pos - lag(pos, 1, -1) OVER (PARTITION BY id ORDER BY pos, ord) AS INTEGER) AS pos_inc,
               term, flags, {is_final_sql('flags')} AS is_final
        FROM {name}_t7)"""


def encode_length_sql(n: str) -> str:
    free = P.NORM_FREE_VALUES
    x = f"(CAST({n} AS BIGINT) - {free})"
    shift = f"(length(bin({x})) - 4)"
    normal = f"((({x} >> {shift}) & 7) | (({shift} + 1) << 3))"
    enc = f"(CASE WHEN {x} < 8 THEN {x} ELSE {normal} END)"
    return f"CAST(CASE WHEN {n} < {free} THEN {n} ELSE {free} + {enc} END AS INTEGER)"


def decode_length_sql(b: str) -> str:
    free = P.NORM_FREE_VALUES
    i = f"(CAST({b} AS BIGINT) - {free})"
    bits = f"({i} & 7)"
    shift = f"(({i} >> 3) - 1)"
    dec = f"(CASE WHEN {shift} = -1 THEN {bits} ELSE (({bits} | 8) << CAST({shift} AS INTEGER)) END)"
    return f"CAST(CASE WHEN {b} < {free} THEN {b} ELSE {free} + {dec} END AS INTEGER)"


def index_ctes(source: str = "documents", id_col: str = "doc_id", text_col: str = "text") -> str:
    """CTEs: tok (analysed tokens), dlen (per doc), postings, terms, stats."""
    return analyzer_ctes("tok", source, id_col, text_col) + f""",
      dlen AS (
        SELECT d.{id_col} AS doc_id, CAST(coalesce(a.n_tokens, 0) AS INTEGER) AS n_tokens,
               CAST(coalesce(a.dl_exact, 0) AS INTEGER) AS dl_exact
        FROM {source} d LEFT JOIN (
          SELECT id, count(*) AS n_tokens, sum(CASE WHEN pos_inc > 0 THEN 1 ELSE 0 END) AS dl_exact
          FROM tok GROUP BY id) a ON a.id = d.{id_col}),
      postings AS (
        SELECT t.term, t.id AS doc_id, CAST(count(*) AS INTEGER) AS tf,
               list_sort(list(t.pos)) AS positions,
               {decode_length_sql(encode_length_sql('d.dl_exact'))} AS dl
        FROM tok t JOIN dlen d ON d.doc_id = t.id
        GROUP BY t.term, t.id, d.dl_exact),
      terms AS (SELECT term, count(*) AS df, sum(tf) AS ttf FROM postings GROUP BY term),
      stats AS (
        SELECT count(*) AS n_docs, coalesce(sum(n), 0) AS sum_ttf,
               CASE WHEN count(*) > 0 THEN sum(n) / count(*) ELSE 0.0 END AS avgdl
        FROM (SELECT doc_id, sum(tf) AS n FROM postings GROUP BY doc_id))"""


def bm25_sql(tf: str, df: str, dl: str, n_docs: str = "s.n_docs", avgdl: str = "s.avgdl") -> str:
    k1, b = P.BM25_K1, P.BM25_B
    return (f"(ln(1.0 + ({n_docs} - {df} + 0.5) / ({df} + 0.5)) * {tf} / "
            f"({tf} + {k1} * ({1 - b} + {b} * {dl} / {avgdl})))")


def rank_sql(per_doc: str, k: int = P.TOP_K) -> str:
    """Final select over ``per_doc(query_id, doc_id, score)``: round, rank,
    totals, filepath = doc id as text."""
    return f"""
      scored AS (SELECT query_id, doc_id, round(score, 6) AS score FROM {per_doc}),
      totals AS (SELECT query_id, count(*) AS total_hits FROM scored GROUP BY query_id),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id ASC) AS rnk
                 FROM scored)
    SELECT r.query_id, CAST(r.rnk AS INTEGER) AS rank, r.doc_id, CAST(r.doc_id AS VARCHAR) AS filepath,
           r.score, t.total_hits, 'ok' AS status
    FROM ranked r JOIN totals t ON t.query_id = r.query_id
    WHERE r.rnk <= {k}"""


def rank_ctes(per_doc: str, name: str = "res", k: int = P.TOP_K) -> str:
    """Like ``rank_sql`` but as CTEs ending in ``{name}`` (prefixed names)."""
    return f"""
      {name}_scored AS (SELECT query_id, doc_id, round(score, 6) AS score FROM {per_doc}),
      {name}_totals AS (SELECT query_id, count(*) AS total_hits FROM {name}_scored GROUP BY query_id),
      {name}_ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id ASC) AS rnk
                        FROM {name}_scored),
      {name} AS (
        SELECT r.query_id, CAST(r.rnk AS INTEGER) AS rank, r.doc_id, CAST(r.doc_id AS VARCHAR) AS filepath,
               r.score, t.total_hits, 'ok' AS status
        FROM {name}_ranked r JOIN {name}_totals t ON t.query_id = r.query_id
        WHERE r.rnk <= {k})"""
