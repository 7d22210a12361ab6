"""The text-analysis chain, one document per row.

Order (fixed): tokenise → flag → drop punctuation → URL subtokens → e-mail
subtokens → lowercase → synonyms → stopwords (accented) → stem → fold →
stopwords (folded).

The chain runs in *array form*: each document row carries
``array<struct<pos, ord, term, flags>>`` and every step is a built-in
higher-order function over that array.  Nothing is shuffled, a document's
length is known in its own row, and positions are fixed at tokenising time,
so removed tokens leave gaps.  ``explode_tokens`` turns the result into one
row per token when a token table is wanted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T

TOKEN_TYPE = "array<struct<pos:int,ord:int,term:string,flags:array<string>>>"


def _tok(pos: Column, ord_: Column, term: Column, flags: Column) -> Column:
    return F.struct(
        pos.cast("int").alias("pos"),
        ord_.cast("int").alias("ord"),
        term.alias("term"),
        flags.alias("flags"),
    )


def _with_term(x: Column, term: Column) -> Column:
    return _tok(x["pos"], x["ord"], term, x["flags"])


# ---------------------------------------------------------------------------
# Steps (array → array)
# ---------------------------------------------------------------------------
def token_array(text: Column, tokenizer: str = "standard", rules=None, lower: bool = False) -> Column:
    """TXT-1/2/3: tokens with their position (fixed before any removal) and
    flags (always decided on the original spelling).  ``lower`` stores the
    lowercased term right away (TXT-8 fused into the same pass)."""
    terms = T.tokenize(text) if tokenizer == "standard" else T.whitespace_tokenize(text)
    return F.transform(terms, lambda t, i: _tok(i, F.lit(0), F.lower(t) if lower else t, T.flags(t, rules)))


def drop_punctuation(arr: Column) -> Column:
    """TXT-5: tokens made only of punctuation are dropped (positions kept)."""
    return F.filter(arr, lambda x: ~T.is_punctuation(x["term"]))


def emit_subtokens(arr: Column, pattern: str, marked: list[str], include: bool = True) -> Column:
    """TXT-6/7: for tokens selected by ``when_flagged(marked, include)``, keep
    the original and add every capture of group 1 of ``pattern`` (whole-token
    captures skipped) at the same position with ``ord`` 1, 2, …"""

    def expand(x: Column) -> Column:
        caps = F.filter(
            F.regexp_extract_all(x["term"], F.lit(pattern), 1),
            lambda s: (F.length(s) > 0) & (s != x["term"]),
        )
        subs = F.transform(caps, lambda s, j: _tok(x["pos"], j + 1, s, x["flags"]))
        return F.when(
            T.when_flagged(x["flags"], marked, include),
            F.concat(F.array(x), subs),
        ).otherwise(F.array(x))

    return F.flatten(F.transform(arr, expand))


def emit_email_subtokens(arr: Column) -> Column:
    """TXT-7b: e-mail tokens keep the original and add the local part and the
    domain-like runs, ordered by their first offset in the token (ties: local
    part first)."""

    def expand(x: Column) -> Column:
        t = x["term"]
        local = F.regexp_extract_all(t, F.lit(P.EMAIL_SUBTOKEN_RXS[0]), 1)
        runs = F.regexp_extract_all(t, F.lit(P.EMAIL_SUBTOKEN_RXS[1]), 1)
        keyed = F.concat(
            F.transform(local, lambda s: F.struct(F.instr(t, s).alias("at"), F.lit(0).alias("p"), s.alias("s"))),
            F.transform(runs, lambda s: F.struct(F.instr(t, s).alias("at"), F.lit(1).alias("p"), s.alias("s"))),
        )
        kept = F.filter(F.array_sort(keyed), lambda k: (F.length(k["s"]) > 0) & (k["s"] != t))
        subs = F.transform(kept, lambda k, j: _tok(x["pos"], j + 1, k["s"], x["flags"]))
        return F.when(
            F.array_contains(x["flags"], "EmailAddress"), F.concat(F.array(x), subs)
        ).otherwise(F.array(x))

    return F.flatten(F.transform(arr, expand))


def lowercase(arr: Column) -> Column:
    """TXT-8: every token lowercased."""
    return F.transform(arr, lambda x: _with_term(x, F.lower(x["term"])))


def remove_stopwords(arr: Column, words, only_flag: str | None = P.DEFAULT_FLAG) -> Column:
    """TXT-10/13: drop tokens whose term is a stopword; with ``only_flag``,
    only tokens carrying that flag are candidates."""
    words = list(words)
    if not words:
        return arr

    def drop(x: Column) -> Column:
        hit = x["term"].isin(words)
        if only_flag:
            hit = hit & F.array_contains(x["flags"], only_flag)
        return ~hit

    return F.filter(arr, drop)


def fold(arr: Column, only_flag: str | None = P.DEFAULT_FLAG) -> Column:
    """TXT-12: ASCII folding of tokens carrying ``only_flag``."""

    def f(x: Column) -> Column:
        folded = T.fold_ascii(x["term"])
        if only_flag:
            folded = F.when(F.array_contains(x["flags"], only_flag), folded).otherwise(x["term"])
        return _with_term(x, folded)

    return F.transform(arr, f)


def inject_synonyms(arr: Column, synonyms: dict[str, list[str]]) -> Column:
    """TXT-9: after each token whose term (or run of consecutive terms, for
    multi-word left sides) has synonyms, add each synonym at the token's
    position; a multi-word synonym places its k-th word at ``pos + k``.
    Synonym tokens carry the default flag.  ``synonyms`` maps a left side
    (words joined by NUL) to right sides (words joined by NUL).  For a few pairs:
    they become literals; ``synonyms.inject_synonyms_table`` takes a table."""
    if not synonyms:
        return arr
    max_left = max(len(k.split("\0")) for k in synonyms)
    keys = list(synonyms)
    syn_map = F.create_map(
        *[c for k in keys for c in (F.lit(k), F.array(*[F.lit(v) for v in synonyms[k]]))]
    )
    n = F.size(arr)

    def expand(x: Column, i: Column) -> Column:
        # candidate left sides starting at this token: terms i .. i+len-1
        cands = F.transform(
            F.sequence(F.lit(1), F.least(F.lit(max_left), n - i)),
            lambda ln: F.array_join(F.transform(F.slice(arr, i + 1, ln), lambda y: y["term"]), "\0"),
        )
        rights = F.flatten(
            F.transform(cands, lambda key: F.coalesce(F.element_at(syn_map, key), F.array().cast("array<string>")))
        )
        words = F.flatten(
            F.transform(
                rights,
                lambda r: F.transform(
                    F.split(r, "\0"),
                    lambda w, k: F.struct(k.alias("k"), w.alias("w")),
                ),
            )
        )
        subs = F.transform(
            words,
            lambda kw, j: _tok(x["pos"] + kw["k"], F.lit(1000) + j, kw["w"], F.array(F.lit(P.DEFAULT_FLAG))),
        )
        return F.concat(F.array(x), subs)

    out = F.flatten(F.transform(arr, expand))
    # keep the position order (synonym words at pos+k move behind later originals)
    return F.array_sort(out, lambda a, b: F.when(a["pos"] != b["pos"], a["pos"] - b["pos"]).otherwise(a["ord"] - b["ord"]))


def with_pos_inc(arr: Column) -> Column:
    """Position increment of each surviving token: distance to the previous
    surviving token's position (first token: pos + 1); 0 for overlaps.
    ``arr`` should be a column reference (it is read three times)."""
    prev = F.concat(F.array(F.lit(-1)), F.transform(arr, lambda x: x["pos"]))
    return F.zip_with(
        arr,
        F.slice(prev, 1, F.size(arr)),
        lambda x, p: F.struct(
            x["pos"].alias("pos"),
            x["ord"].alias("ord"),
            (x["pos"] - p).cast("int").alias("pos_inc"),
            x["term"].alias("term"),
            x["flags"].alias("flags"),
        ),
    )


# ---------------------------------------------------------------------------
# The whole chain
# ---------------------------------------------------------------------------
@dataclass
class AnalyzerOptions:
    mode: str = "index"  # "index" | "query"
    use_synonyms: bool = False
    synonyms: dict[str, list[str]] | DataFrame | None = None  # a table (term, synonym) for lists of any size
    stopwords: tuple[str, ...] | None = None  # None → bundled list
    stopwords_folded: tuple[str, ...] | None = None  # None → bundled list folded
    stem: bool = True
    tokenizer: str = "standard"
    rules: list = field(default=None)

    def __post_init__(self):
        if self.mode not in ("index", "query"):
            raise ValueError("mode must be 'index' or 'query'")


def _front(text: Column, opts: AnalyzerOptions) -> Column:
    if opts.tokenizer == "standard":
        # Standard tokens always hold a letter or digit (never punctuation
        # only) and never contain '@' (no e-mail tokens).  The URL subtoken
        # class is case-insensitive, so cutting the lowercased term yields
        # the lowercased pieces: lowercase is fused into the first pass.
        # ``text`` is the token-array column here (see ``analyze``).
        arr = text
        has_url = F.exists(arr, lambda x: F.array_contains(x["flags"], "UrlAddress"))
        return F.when(has_url, emit_subtokens(arr, P.URL_SUBTOKEN_RX, ["UrlAddress"])).otherwise(arr)
    arr = token_array(text, opts.tokenizer, opts.rules)
    arr = drop_punctuation(arr)
    arr = emit_subtokens(arr, P.URL_SUBTOKEN_RX, ["UrlAddress"])
    arr = emit_email_subtokens(arr)
    return lowercase(arr)


def _back(arr: Column, opts: AnalyzerOptions) -> Column:
    from . import stemmer  # local import: pulls in the Arrow UDF only if used

    stop1 = T.bundled_stopwords() if opts.stopwords is None else opts.stopwords
    stop2 = T.bundled_stopwords_folded() if opts.stopwords_folded is None else opts.stopwords_folded
    arr = remove_stopwords(arr, stop1)
    if opts.stem:
        arr = stemmer.stem_array(arr)
    arr = fold(arr)
    return remove_stopwords(arr, stop2)


def analyze(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    opts: AnalyzerOptions | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """TXT-14.  Columns: ``id_col``, *keep, ``tokens`` (final array of
    struct<pos, ord, pos_inc, term, flags>), ``dl`` (tokens that advance the
    position: the length used for ranking), ``n_tokens`` (all tokens,
    overlaps included).

    Steps whose lambdas read the whole array run in their own projection so
    the array is read from a column, never recomputed per element."""
    opts = opts or AnalyzerOptions()
    ids = [F.col(id_col)] + [F.col(k) for k in keep]
    if opts.tokenizer == "standard":
        # the token array gets its own projection: the URL step reads it twice
        cur = df.select(*ids, token_array(F.col(text_col), opts.tokenizer, opts.rules, lower=True).alias("_a"))
        cur = cur.select(*ids, _front(F.col("_a"), opts).alias("_t"))
    else:
        cur = df.select(*ids, _front(F.col(text_col), opts).alias("_t"))
    if opts.mode == "index" and opts.use_synonyms and isinstance(opts.synonyms, DataFrame):
        from .synonyms import inject_synonyms_table

        cur = inject_synonyms_table(cur, opts.synonyms, id_col, "_t")
    elif opts.mode == "index" and opts.use_synonyms and opts.synonyms:
        cur = cur.select(*ids, inject_synonyms(F.col("_t"), opts.synonyms).alias("_t"))
    cur = cur.select(*ids, _back(F.col("_t"), opts).alias("_t"))
    out = cur.select(*ids, with_pos_inc(F.col("_t")).alias("tokens"))
    return out.select(
        "*",
        F.size(F.filter("tokens", lambda x: x["pos_inc"] > 0)).alias("dl"),
        F.size("tokens").alias("n_tokens"),
    )


def explode_token_rows(df: DataFrame, cols, arr: str = "tokens", name: str = "t") -> DataFrame:
    """``explode`` of a token array.  ``explode_outer`` + a null filter is
    used on purpose: a plain explode lets the optimizer infer a
    ``size(tokens) > 0`` filter below the Arrow-evaluated stemming UDF, which
    cannot be evaluated there."""
    out = df.select(*cols, F.explode_outer(arr).alias(name))
    return out.where(F.col(name).isNotNull())


def explode_tokens(analyzed: DataFrame, id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per token: id, pos, ord, pos_inc, term, flags, is_final."""
    t = explode_token_rows(analyzed, [F.col(id_col), *[F.col(k) for k in keep]])
    return t.select(
        F.col(id_col),
        *[F.col(k) for k in keep],
        F.col("t.pos").alias("pos"),
        F.col("t.ord").alias("ord"),
        F.col("t.pos_inc").alias("pos_inc"),
        F.col("t.term").alias("term"),
        F.col("t.flags").alias("flags"),
        T.is_final(F.col("t.flags")).alias("is_final"),
    )


def raw_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=None) -> DataFrame:
    """TXT-1/2/3/4 without the rest of the chain: id, pos, term, flags, is_final."""
    arr = token_array(F.col(text_col), rules=rules)
    t = df.select(F.col(id_col), F.explode(arr).alias("t"))
    return t.select(
        F.col(id_col),
        F.col("t.pos").alias("pos"),
        F.col("t.term").alias("term"),
        F.col("t.flags").alias("flags"),
        T.is_final(F.col("t.flags")).alias("is_final"),
    )
