import random

import pytest

DOC_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, fp long, seed long, words string, n int, w1 string, "
    "shard string, kept string, term string, pos int, d string, items string, quality string, text_key string, candidates string, salt string"
)


def doc(i, text, lang="en", source="src0"):
    return (i, text, lang, source, None if text is None else len(text), 1, 2, "x", 3, "y", "z", "k", "t", 4, "d", "i", "q", "u", "c", "s")


PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
EDGE = [
    doc(0, "Alpha " + PASSAGE + " omega."),
    doc(1, None, None, None),
    doc(2, ""),
    doc(3, " \t\n "),
    doc(4, "Beta " + PASSAGE + " end"),
    doc(4, "Beta " + PASSAGE + " end"),
    doc(5, "\u00c9t\u00e9 \u00e9t\u00e9 NA\u00cfVE \u4f60\u597d  two  spaces\r\nline\x0bfeed \U0001f600 <|endoftext|> x"),
    doc(6, "same line here\nsame line here\n\nsame line here\n" * 40),
    doc(7, "word " * 30_000),
    doc(8, PASSAGE.replace(" ", "\n"), None, "src1"),
    doc(None, "Beta " + PASSAGE + " end"),
    doc(None, None),
    doc(9, "###!! $$$ 123 456"),
    doc(10, "Released under the MIT License. SPDX-License-Identifier: (GPL-2.0-only WITH x OR mit) AND apache-2.0"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def corpus():
    """Random texts over a small vocabulary, with copies and shared passages."""
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdefgh\u00e9") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    passages = [[rnd.choice(vocabulary) for _ in range(rnd.randint(13, 40))] for _ in range(6)]
    out = []
    for i in range(160):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 5, 12, 13, 40, 120]))]
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randint(0, len(words))
            part = rnd.choice(passages)
            cut = rnd.randint(0, 5)
            words[at:at] = part[cut : len(part) - rnd.randint(0, 5)]
        if i % 7 == 3 and out:
            words = rnd.choice(out)[1].split()
            if words and i % 2:
                words[rnd.randrange(len(words))] = "changed"
        out.append((i, rnd.choice([" ", "\n", "  "]).join(w.upper() if rnd.random() < 0.1 else w for w in words)))
    return out


@pytest.fixture(scope="session")
def corpus_df(spark, corpus):
    return spark.createDataFrame([doc(*r) for r in corpus], DOC_SCHEMA).repartition(4)
