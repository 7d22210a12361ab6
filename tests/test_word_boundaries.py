"""Word boundaries of scripts with and without spaces."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import patterns as P
from quarry.functions import text as T

CASES = {
    "我爱你 abc漢字x": ["我", "爱", "你", "abc", "漢", "字", "x"],
    "コンピュータ_ー テスト123 ﾊﾝｶｸ": ["コンピュータ_ー", "テスト", "123", "ﾊﾝｶｸ"],
    "ひらがなカタカナ": ["ひ", "ら", "が", "な", "カタカナ"],
    "สวัสดีครับ hello ไทย": ["สวัสดีครับ", "hello", "ไทย"],
    "한국어 단어 a_b _ __ x_": ["한국어", "단어", "a_b", "x_"],
    "שלום צה\"ל ג'ורג' \"abc\"": ["שלום", "צה\"ל", "ג'ורג", "abc"],
    "👍🏽 👨‍👩‍👧 🇷🇴 x😀y": ["👍🏽", "👨‍👩‍👧", "🇷🇴", "x", "😀", "y"],
    "café co­op a‍b": ["café", "co­op", "a‍b"],
    "1,5 10.20.30 3;4 a.b.c a,b 1:2 l'été": ["1,5", "10.20.30", "3;4", "a.b.c", "a", "b", "1", "2", "l'été"],
    "x‿y ＿ａ＿": ["x‿y", "＿ａ＿"],
    "— … ! ___": [],
    "": [],
}


@pytest.fixture(scope="module")
def found(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "id int, text string")
    rows = df.select("text", T.tokenize(F.col("text")).alias("t")).collect()
    return {r.text: r.t for r in rows}


@pytest.mark.parametrize("text", list(CASES))
def test_boundaries(found, text):
    assert found[text] == CASES[text]


def test_long_words_are_cut(spark):
    for text in ("x" * 600, "漢 " + "x" * 600):
        got = spark.createDataFrame([(text,)], "text string").select(T.tokenize(F.col("text"))).first()[0]
        assert [len(t) for t in got if t != "漢"] == [255, 255, 90]


def test_short_and_full_patterns_agree_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    full = F.filter(F.regexp_extract_all("text", F.lit(P.TOKEN_RX_ALL), 0), lambda t: t.rlike(P.WORD_RX))
    assert docs.where(full != T.tokenize(F.col("text"))).count() == 0
    assert docs.where(F.size(T.tokenize(F.col("text"))) > 0).count() > 100


def test_a_text_is_matched_once(spark):
    """The pattern stands once in each branch, inside a lambda's argument."""
    plan = spark.createDataFrame([("a",)], "text string").select(T.tokenize(F.col("text")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2
