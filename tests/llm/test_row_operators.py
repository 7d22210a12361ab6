"""Operators that judge each row: repetition, licences, languages, URLs, packing."""

import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import language, licences, packing, repetition, url_rules
from quarry.llm.common import Stages


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def base_repetition(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
        seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), n < 20 or 100 * len(hit) > 30 * n


@pytest.mark.parametrize("which", ["edge", "corpus_df"])
def test_repetition_base_figures(which, request):
    df = request.getfixturevalue(which)
    texts = [r.text for r in df.select("text").collect()]
    got = repetition.repetition_rules(df).collect()
    assert len(got) == len(texts)
    figures = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
    assert sorted(map(figures, got)) == sorted(map(base_repetition, texts))
    assert not any(r.kept and r.base_failed for r in got)


def test_repetition_shares():
    clean = " ".join(f"w{i}" for i in range(100)).encode()
    assert repetition.judge(clean)[6] is True
    lines = b"\n".join([b"alpha beta gamma delta epsilon"] * 3 + [clean])
    assert repetition.judge(lines)[9] == pytest.approx(2 * 26 / (3 * 26 + 290))
    assert repetition.judge(b"a b " * 100)[6] is False


def test_repetition_confirms_hash_matches():
    ids = np.array([1, 2, 3, 4, 1, 2])
    assert list(repetition.repeated(np.array([7, 7, 7, 7, 7], np.uint64), ids, 2)) == [0, 4]


BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@pytest.mark.parametrize("which", ["edge", "corpus_df"])
def test_licence_base_figures(which, request, spark):
    df = request.getfixturevalue(which)
    if which == "corpus_df":
        df = df.withColumn("text", F.concat_ws(" ", "text", F.lit("Under the MIT-License, Apache License, Version 2.0; CC BY-NC"), "text", F.lit("cc by nc by nc")))
    want = []
    for r in df.collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(r.text or ""))
        at = [(i, label) for p, label in BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in at]
        want.append((len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))))
    got = [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licences.scan_licences(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_licence_expressions():
    assert licences.evaluate("MIT OR GPL-3.0-only") == ({"mit", "gpl-3"}, 1.0)
    assert licences.evaluate("MIT AND GPL-3.0-only") == ({"mit", "gpl-3"}, 0.3)
    assert licences.evaluate("(MIT OR GPL-2.0) AND CC-BY-NC-4.0")[1] == 0.1
    assert licences.evaluate("MIT OR GPL-2.0 AND CC-BY-NC-4.0")[1] == 1.0  # and binds closer
    assert licences.evaluate("GPL-2.0 WITH Classpath-exception-2.0") == ({"gpl-2"}, 0.3)
    for bad in ("", "AND", "(MIT", "OR MIT", "()", "Mitigated risk", "see file LICENSE", "x"):
        assert licences.evaluate(bad) is None
    for cut in ("MIT )", "MIT OR", "MIT or", "MIT AND (see LICENSE)", "MIT OR (Apache-2.0", "MIT AND so on", "MIT WITH", "MIT (ISC)"):
        assert licences.evaluate(cut) == ({"mit"}, 1.0)


def test_licence_tags_in_a_long_line(none):
    phrases = tuple((p, x, True) for p, x in BASE.items())
    begun = time.process_time()
    row = licences.scan(b"SPDX-License-Identifier: MIT OR (x " * 100_000, phrases)
    assert row[5] == "mit" and len(row[7]) == 100_000 and set(row[7]) == {"MIT"}
    assert time.process_time() - begun < 5
    assert licences.scan_licences(none).count() == 0 and repetition.repetition_rules(none).count() == 0


def test_samples_of_range_bounds_at_any_size():
    assert url_rules.draw_limit(0) == url_rules.draw_limit(url_rules.SAMPLE_KEYS) == 1 << 62
    for rows in (10**6, 10**11, 10**15):
        assert url_rules.draw_limit(rows) * rows == pytest.approx(url_rules.SAMPLE_KEYS << 62, rel=1e-3)


def test_letters():
    assert [language.has_letter(t) for t in ("a", "\u00e9", "\u4f60", "", "12 _ !", "\u00bd \u00b2 \u2167 _", "\u00bda")] == [True, True, True, False, False, False, True]


def test_licence_expressions_within_prose():
    phrases = tuple((p, x, True) for p, x in BASE.items())
    for text, labels in [
        ("SPDX-License-Identifier: MIT (see LICENSE)", "mit"),
        ("(SPDX-License-Identifier: MIT)", "mit"),
        ("(SPDX-License-Identifier: (MIT OR ISC) AND Apache-2.0) and more", "apache-2,isc,mit"),
        ("License-Expression: MIT\nx\nspdx-license-identifier: isc", "isc,mit"),
        ("\u00e9 SPDX-License-Identifier: (MIT (see LICENSE", ""),
    ]:
        assert licences.scan(text.encode(), phrases)[5] == labels, text


def test_licence_tags(edge):
    row = licences.scan_licences(edge).where("doc_id = 10").first()
    assert row.base_labels == "mit" and row.labels == "apache-2,gpl-2,mit" and row.n_base == 1 and 0 <= row.score <= 1


def test_language_learns_and_marks_unknown(spark, edge, none):
    de, en = "der die und nicht ein sich auch", "the and of not with that have"
    rows = [(i, " ".join(np.random.default_rng(i).permutation((de if i % 2 else en).split())) * 3, "de" if i % 2 else "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = docs.where(~language.held_out(2))
    model = language.train(learn)
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert len(got) == 300 and sum(got[i].lang_pred == x for i, _, x in rows) >= 297
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= got[i].score <= 1 for i in got)
    odd = language.predict(edge, model).collect()
    assert len(odd) == edge.count()
    assert all(r.lang_pred == "und" for r in odd if r.doc_id in (1, 2, 3)) and {r.lang_pred for r in odd} <= {"und", "de", "en"}
    assert language.train(none) is None
    assert {r.lang_pred for r in language.predict(edge, None).collect()} == {"und"}
    assert language.predict(none, model).count() == 0


URLS = [
    None, "", "no scheme", "http://", "http://NET", "http://net/", "https://a.Example.NET/en/x?q#f", "http://example.net/EN/", "http://xnet/",
    "ftp://fr.org/fr/a", "http://org/fr", "http://example.com/de/", "http://sub.example.com/de/z#/x", "http://a.net?x/y", "http://a.net#/en/",
    "x://y://example.net/en/", "http://net./", "http://a..net/", "http://example.net/en/", "http://example.net/en/",
]


def brute_url(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    host, path = ascii_lower(host), slash + path
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


@pytest.mark.parametrize("rules", [url_rules.RULES, [("net", "/", "block"), ("net", "/en/", "allow"), ("a.net", "/", "allow"), ("com", "/", "block"), ("a.net", "/", "block")], []])
def test_urls_match_brute_force(spark, rules):
    urls = [(i, u, "host") for i, u in enumerate(URLS * 5)] + [(None, "http://example.com/de/q", "h")]
    pages = spark.createDataFrame(urls, "page_id long, url string, host string").repartition(3)
    got = url_rules.url_verdicts(pages, spark.createDataFrame(rules, url_rules.RULE_SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *brute_url(u, rules)) for i, u, _ in urls), key=str)


def test_urls_without_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.url_verdicts(pages, spark.createDataFrame(url_rules.RULES, url_rules.RULE_SCHEMA)).count() == 0


@pytest.mark.parametrize("which", ["edge", "corpus_df"])
def test_packing_holds_every_id_once(which, request):
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    whole = Tokenizer.from_file(path)
    df = request.getfixturevalue(which)
    want = sorted(np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4").tobytes() for r in df.collect())
    rows = packing.pack(df, path).withColumn("crc", F.crc32("ids")).collect()
    assert all(r.length == len(r.ids) // 4 and r.crc == zlib.crc32(r.ids) for r in rows)
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and at & (at - 1) == 0
    # Rows of one id have equal texts here, so their pieces are told apart by order of start.
    got = []
    for (_, total), parts in pieces.items():
        copies = sum(len(ids) // 4 for _, ids in parts) // total
        by_start = sorted(set(parts))
        if copies == 1:
            got.append(b"".join(ids for _, ids in by_start))
        else:
            ids = bytearray(4 * total)
            for start, part in by_start:
                ids[4 * start : 4 * start + len(part)] = part
            got += [bytes(ids)] * copies
    assert sorted(got) == want


def test_packing_prefers_near_documents():
    near = [np.array([1, 2, 3, 4]), np.array([50, 51, 52]), np.array([1, 2, 3, 9]), np.array([50, 51, 60])]
    index = packing.Bm25(near)
    assert index.near(0, np.array([True, False, False, False])) == [2]
    assert index.near(1, np.array([False, True, False, False])) == [3]


def test_packing_scores_all_terms_of_a_seed():
    # Twenty rare terms that a chance document shares one by one, and many middling ones that the near document shares.
    seed, near = np.arange(60), np.arange(20, 60)
    chance, others = [np.array([t, 100 + t]) for t in range(20)], [np.array([20 + t, 200 + t]) for t in range(40)]
    docs = [seed, near, *chance, *others]
    assert packing.Bm25(docs).near(0, np.arange(len(docs)) == 0)[0] == 1


def test_packing_searches_all_documents(spark, corpus, monkeypatch):
    """Neighbours are those of brute force over all documents, whatever the
    partitions and blocks, and every document stands in one chain."""
    monkeypatch.setattr(packing, "BLOCK", 30)
    monkeypatch.setattr(packing, "NEAR", 4)
    df = spark.createDataFrame([(i, t) for i, t in corpus], "doc_id long, text string").repartition(5)
    stages = Stages(spark, "packing-test")
    rows = stages.write(packing.tokenised(df, packing.tokenizer_path()), "tokens")
    at = sorted(rows.collect(), key=lambda r: r.key)
    index, place = packing.Bm25([np.frombuffer(r.ids, "<u4")[:-1] for r in at]), {r.key: i for i, r in enumerate(at)}
    stats = packing.statistics(rows)
    blocks = stages.write(packing.blocks(rows, stats), "index")
    got = {}
    for r in packing.neighbours(stages, blocks, blocks, stats[2][stats[3] * packing.COMMON > stats[0]], "test").collect():
        got.setdefault(place[r.a], {})[place[r.b]] = r.score
    hits = want = 0
    for i in range(len(at)):
        best = index.near(i, np.arange(len(at)) == i)[:4]
        hits, want = hits + len(set(best) & set(got.get(i, ()))), want + len(best)
    assert want > 300 and hits >= 0.9 * want  # equal scores may stand in another order
    nodes = packing.ordered(Stages(spark, "packing-test"), rows).collect()
    assert sorted(n.key for n in nodes) == [r.key for r in at]
    chains = {}
    for n in nodes:
        chains.setdefault(n.head, []).append(n.pos)
    assert all(sorted(p) == list(range(len(p))) for p in chains.values())
    assert len(chains) <= 1 + sum(r.size == 0 for r in at)  # all texts here are near to some other


def test_packing_searches_by_cells(spark, monkeypatch):
    """Cells keep nine of ten neighbours with a part of the pairs, and the chains
    end as they do without cells."""
    rnd = np.random.default_rng(4)
    texts = [" ".join(f"{'abcdefgh'[i % 8]}{w}" for w in rnd.zipf(1.3, 60) % 300) for i in range(400)] + ["", "lone"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    monkeypatch.setattr(packing, "NEAR", 4)
    monkeypatch.setattr(packing, "CENTRES", 8)
    stages = Stages(spark, "packing-test")
    rows = stages.write(packing.tokenised(df, packing.tokenizer_path()), "tokens")
    stats = packing.statistics(rows)
    common = stats[2][stats[3] * packing.COMMON > stats[0]]
    dealt = packing.cells(rows, stats)
    asked, index = packing.blocks(rows, stats, dealt, True), packing.blocks(rows, stats, dealt)
    keys = lambda df: sorted(k for r in df.collect() for k in np.frombuffer(r.keys, "<i8").tolist())
    own = sorted(r.key for r in rows.where("octet_length(terms) > 0").select("key").collect())
    assert keys(index) == own and keys(asked) == sorted(own * packing.PROBES)
    met = asked.alias("q").join(index.alias("i"), "cell").selectExpr("sum(length(q.keys) / 8 * (length(i.keys) / 8)) AS n").first().n
    assert met < 0.7 * len(own) ** 2
    near = lambda *b: {(r.a, r.b) for r in packing.neighbours(Stages(spark, "packing-test"), *b, common, "test").collect()}
    whole = stages.write(packing.blocks(rows, stats), "whole")
    want = near(whole, whole)
    assert len(want & near(stages.write(asked, "asked"), stages.write(index, "index"))) >= 0.9 * len(want)
    heads = lambda: packing.ordered(Stages(spark, "packing-test"), rows).groupBy("head").count().count()
    whole = heads()
    monkeypatch.setattr(packing, "EXACT", 100)
    assert heads() == whole


def test_packing_meets_all_documents_however_many(spark, monkeypatch):
    """Neighbours of brute force, also above the size that once was searched by
    cells; no join comes to the driver."""
    rnd = np.random.default_rng(6)
    texts = [" ".join(f"{'abcdefgh'[i % 8]}{w}" for w in rnd.zipf(1.3, 40) % 300) for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for name, value in (("NEAR", 4), ("CENTRES", 8), ("PROBES", 1), ("EXACT", 50), ("BLOCK", 30), ("SIDE", 2), ("STREAMS", 3)):
        monkeypatch.setattr(packing, name, value, raising=False)
    stages = Stages(spark, "packing-test")
    rows = stages.write(packing.tokenised(df, packing.tokenizer_path()), "tokens")
    at = sorted(rows.collect(), key=lambda r: r.key)
    index, place = packing.Bm25([np.frombuffer(r.ids, "<u4")[:-1] for r in at]), {r.key: i for i, r in enumerate(at)}
    firsts, linked = [], packing.linked

    def first(stages, nodes, pairs, name):
        firsts.append(pairs.collect() if name == "0" else None)
        return linked(stages, nodes, pairs, name)

    monkeypatch.setattr(packing, "linked", first)
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    packing.ordered(Stages(spark, "packing-test"), rows)
    got = {}
    for r in firsts[0]:
        got.setdefault(place[r.a], []).append(place[r.b])
    hits = 0
    for i in range(len(at)):
        best = index.near(i, np.arange(len(at)) == i)[:4]
        assert len(got[i]) == len(best)
        hits += len(set(best) & set(got[i]))
    assert hits >= 0.99 * 4 * len(at)  # equal scores may stand in another order


def test_packing_searches_a_cell_in_few_partitions(spark, monkeypatch):
    """A query's best of its cells are few rows, however many tasks search."""
    rnd = np.random.default_rng(8)
    names = [[f"t{k}w{i}" for i in range(30)] for k in range(8)]
    texts = [(i, " ".join(rnd.choice(names[i % 8], 12))) for i in range(400)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    for name, value in (("NEAR", 4), ("CENTRES", 8), ("PROBES", 2), ("BLOCK", 5), ("SIDE", 4)):
        monkeypatch.setattr(packing, name, value)
    stages = Stages(spark, "packing-test")
    rows = stages.write(packing.tokenised(df, packing.tokenizer_path()), "tokens")
    stats = packing.statistics(rows)
    dealt = packing.cells(rows, stats)
    asked, index = (stages.write(packing.blocks(rows, stats, dealt, x), str(x)) for x in (True, False))
    near = packing.neighbours(stages, asked, index, stats[2][:0], "test")
    assert near.groupBy("a").count().where("count = 4").count() == 400
    # Over 20 partitions of the index: dealt at random most of them hold some of a query's cells.
    assert spark.read.parquet(f"{stages.root}/found-test").count() < 400 * 4 * 10


def test_packing_keeps_the_driver_small(spark, monkeypatch):
    """Centres are fitted by a task; the joins of chains are columns."""
    df = spark.createDataFrame([(i, f"a{i % 9} b{i % 7} c{i % 5}") for i in range(60)], "doc_id long, text string")
    rows = Stages(spark, "packing-test").write(packing.tokenised(df, packing.tokenizer_path()), "tokens")
    monkeypatch.setattr(packing, "CENTRES", 4)
    monkeypatch.setattr(packing, "products", None)  # not called here
    found = packing.cells(rows, packing.statistics(rows))
    assert found.centres.shape == found.means.shape and found.centres.shape[1] == 4 and found.means.any()
    pairs = pa.table({"a": [7, 3, 7], "b": [3, 7, 9], "score": [3.0, 2.0, 1.0], "size_a": [2, 1, 2], "size_b": [1, 2, 4]})
    assert packing.greedy(pairs).to_pylist() == [{"head": 3, "to": 7, "shift": 2}]


def test_packing_rounds_join_like_the_driver(spark, monkeypatch):
    nodes = spark.createDataFrame([(i, i, 0) for i in range(8)], "key long, head long, pos long")
    pairs = spark.createDataFrame([(a, b, float((a * 5 + b * 3) % 11)) for a in range(8) for b in range(8) if a != b], "a long, b long, score float")
    for most in (50, 1_000_000):
        monkeypatch.setattr(packing, "DRIVER_PAIRS", most)
        got = packing.linked(Stages(spark, "packing-test"), nodes, pairs, "test").collect()
        assert sorted((r.key, r.pos) for r in got)[0][0] == 0 and sorted(r.pos for r in got) == list(range(8)) and len({r.head for r in got}) == 1


@pytest.mark.parametrize("common", [[], [3, 4, 9], range(60)])
def test_packing_scores_are_whole_in_every_cut(common, monkeypatch):
    monkeypatch.setattr(packing, "ROWS", 7)
    monkeypatch.setattr(packing, "EXPANDED", 20)
    rnd = np.random.default_rng(3)
    has = rnd.random((40, 60)) < 0.2
    weight = rnd.random((40, 60)).astype("<f4")
    place, term = np.nonzero(has)
    raw = [np.arange(40, dtype="<i8").tobytes(), place.astype("<u4").tobytes(), term.astype("<u4").tobytes(), weight[has].tobytes()]
    own = packing.Queries(*raw[:3], np.array(common, int))
    own.meet(*raw)
    scores = has @ np.where(has, weight, 0).T
    np.fill_diagonal(scores, 0)
    assert np.allclose(-np.sort(-own.scores, axis=1), -np.sort(-scores, axis=1)[:, : packing.NEAR], atol=1e-4)
    assert np.allclose(np.take_along_axis(scores, own.near, 1), own.scores, atol=1e-4)


def test_packing_joins_documents_of_other_partitions(spark):
    texts = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcdefgh"]
    rows = [(i, t) for i, t in enumerate(texts + texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(8, "doc_id")
    got = packing.pack(df, packing.tokenizer_path()).orderBy("sequence_id", "offset").collect()
    order = list(dict.fromkeys(r.doc_id for r in got))
    assert sum(abs(a - b) == 8 for a, b in zip(order, order[1:])) == 8


def test_packing_without_documents(none):
    assert packing.pack(none, packing.tokenizer_path()).count() == 0


def test_remembered_words_give_the_same_ids(corpus, monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 20)
    monkeypatch.setattr(packing, "TOGETHER", 7)
    encoder = packing.Encoder(packing.tokenizer_path())
    texts = [t for _, t in corpus] + ["It's 3.5%, isn't it?\nNo -- 你好　x", "a\n\nb", " a", "a ", " a b", "x y z", "<|endoftext|> a", "a <|endoftext|>"]
    for k in range(0, len(texts), 9):
        assert encoder.encode(texts[k : k + 9]) == encoder.whole(texts[k : k + 9])
