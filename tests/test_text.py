from pyspark.sql import functions as F

from quarry.functions import patterns as P
from quarry.functions import text as T
from quarry.operators import analyzer as A
from quarry.operators.stemmer import stem_word

LINE = "Vezi https://www.example.com/pag U.S.A. a@b.ro 31.12.2020 1,5 0721-123-456 l-am a_b și VI _ x."


def test_tokenizer_line(spark):
    got = spark.createDataFrame([(LINE,)], "text string").select(T.tokenize(F.col("text"))).first()[0]
    assert got == ["Vezi", "https", "www.example.com", "pag", "U.S.A", "a", "b.ro", "31.12.2020", "1,5",
                   "0721", "123", "456", "l", "am", "a_b", "și", "VI", "x"]


FLAG_CASES = {
    "31.12.2020": ["UrlAddress", "Date"],
    "29.02.2024": ["UrlAddress", "Date"],
    "29.02.2023": ["UrlAddress"],
    "072.123.4567": ["PhoneNumber", "UrlAddress"],
    "0721234567": ["PhoneNumber"],
    "12": ["Number"],
    "1,5": ["Number"],
    "123": ["Word"],
    "VI": ["Roman"],
    "MIX": ["Roman"],
    "mix": ["Word"],
    "vi": ["Word"],
    "foo.bar": ["UrlAddress"],
    "10.20.30": ["UrlAddress"],
    "www.example.com": ["UrlAddress"],
    "U.S.A.": ["Acronym"],
    "a@b.ro": ["EmailAddress"],
}


def test_flags_on_raw_strings(spark):
    df = spark.createDataFrame([(k,) for k in FLAG_CASES], "t string")
    rows = df.select("t", T.flags(F.col("t")).alias("f"), T.is_final(T.flags(F.col("t"))).alias("fin")).collect()
    for r in rows:
        assert r.f == FLAG_CASES[r.t], r.t
        assert r.fin == (len(r.f) == 1 and r.f[0] != "Word")


def _chain(spark, text, **kw):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    a = A.analyze(df, opts=A.AnalyzerOptions(stem=False, **kw))
    return [(r.pos, r.ord, r.term) for r in A.explode_tokens(a).orderBy("pos", "ord").collect()]


def test_chain_subtokens_stopwords_and_gaps(spark):
    got = _chain(spark, "vi VI www.example.com U.S.A. si şi și MI")
    terms = [t for _, _, t in got]
    assert "vi" in terms  # 'VI' is Roman → not a stopword candidate; lowercased afterwards
    assert terms.count("vi") == 1  # the lowercase 'vi' (Word) was removed
    assert ("www.example.com" in terms and "www" in terms and "example" in terms and "com" in terms)
    url_pos = {p for p, _, t in got if t in ("www.example.com", "www", "example", "com")}
    assert len(url_pos) == 1
    assert "u.s.a" in terms
    assert "si" not in terms and "şi" not in terms and "și" not in terms
    assert "mi" in terms  # 'MI' is Roman, kept
    # removed tokens leave gaps: positions are those of the tokenizer
    assert got[0][0] == 1


def test_pos_inc_and_lengths(spark):
    df = spark.createDataFrame([(1, "foo.bar şi baz")], "doc_id long, text string")
    a = A.analyze(df, opts=A.AnalyzerOptions(stem=False)).first()
    toks = [(t.pos, t.ord, t.pos_inc, t.term) for t in a.tokens]
    assert toks == [(0, 0, 1, "foo.bar"), (0, 1, 0, "foo"), (0, 2, 0, "bar"), (2, 0, 2, "baz")]
    assert a.dl == 2 and a.n_tokens == 4


def test_fold_and_second_list():
    assert T.fold_ascii_py("ăâîşţșț") == "aaistst"
    assert T.fold_ascii_py("Straße") == "Strasse"
    assert {"un", "și", "şi", "pentru"} <= set(T.bundled_stopwords())
    assert T.bundled_stopwords_folded()[T.bundled_stopwords().index("şi")] == "si"


def _lucene_norm(n):
    def int4(i):
        nb = i.bit_length()
        if nb < 4:
            return i
        s = nb - 4
        return ((i >> s) & 7) | ((s + 1) << 3)

    def back4(b):
        bits, s = b & 7, (b >> 3) - 1
        return bits if s == -1 else (bits | 8) << s

    free = P.NORM_FREE_VALUES
    b = n if n < free else free + int4(n - free)
    return b, (b if b < free else free + back4(b - free))


def test_length_norm_matches_reference_scheme(spark):
    df = spark.range(0, 3000).select(F.col("id").cast("int").alias("n"))
    rows = df.select("n", T.encode_length(F.col("n")).alias("b"), T.lossy_length(F.col("n")).alias("d")).collect()
    for r in rows:
        assert (r.b, r.d) == _lucene_norm(r.n)
    d = {r.n: r.d for r in rows}
    assert all(d[i] == i for i in range(40)) and d[41] != 41
    assert all(d[i] <= i for i in d) and all(d[i] <= d[i + 1] for i in range(2999))


def test_stemmer_words():
    assert stem_word("") == ""
    cases = {"cărţile": "cărţ", "naţiune": "naţiun", "copiilor": "cop", "abilitate": "abil", "fetele": "fet"}
    for w, s in cases.items():
        assert stem_word(w) == s, w
    for w in ["frumoasă", "alergând", "lucrătoare", "studenţi"]:
        assert len(stem_word(w)) <= len(w)


def test_stemmed_chain_runs(spark):
    df = spark.createDataFrame([(1, "Casele frumoase sunt aici"), (2, "")], "doc_id long, text string")
    a = A.analyze(df, opts=A.AnalyzerOptions(stem=True))
    terms = [r.term for r in A.explode_tokens(a).orderBy("doc_id", "pos").collect()]
    assert terms == ["cas", "frumoas"]


def test_synonyms_index_mode_only(spark):
    syn = {"masina": ["auto"], "new\0york": ["nyc"]}
    df = spark.createDataFrame([(1, "masina in new york")], "doc_id long, text string")
    a = A.analyze(df, opts=A.AnalyzerOptions(stem=False, use_synonyms=True, synonyms=syn, stopwords=(), stopwords_folded=()))
    got = [(t.pos, t.term) for t in a.first().tokens]
    assert (0, "auto") in got and (2, "nyc") in got
    q = A.analyze(df, opts=A.AnalyzerOptions(mode="query", stem=False, use_synonyms=True, synonyms=syn))
    assert "auto" not in [t.term for t in q.first().tokens]


def test_whitespace_mode_email_subtokens(spark):
    df = spark.createDataFrame([(1, "mail a@b.ro now")], "doc_id long, text string")
    a = A.analyze(df, opts=A.AnalyzerOptions(stem=False, tokenizer="whitespace", stopwords=(), stopwords_folded=()))
    got = [(t.pos, t.ord, t.term) for t in a.first().tokens]
    assert got == [(0, 0, "mail"), (1, 0, "a@b.ro"), (1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 4, "ro"), (2, 0, "now")]


def test_custom_token_rule(spark):
    rules = T.DEFAULT_RULES + [T.TokenRule(r"[A-Z]{2}-\d+", "NamedEntity", "Number")]
    df = spark.createDataFrame([("RO-12",), ("plain",)], "t string")
    got = {r.t: r.f for r in df.select("t", T.flags(F.col("t"), rules).alias("f")).collect()}
    assert got == {"RO-12": ["NamedEntity", "Number"], "plain": ["Word"]}
