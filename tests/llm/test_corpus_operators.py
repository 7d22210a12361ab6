"""Operators over the whole corpus, against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import cotrain, decontaminate, katz, phrases, simhash
from quarry.llm.common import Stages
from quarry.llm.components import components

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def alnum_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))


# --- near duplicates -------------------------------------------------------


def brute_fingerprint(text):
    w = SPACED.findall(ascii_lower(text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, radius):
    """Root of each distinct value under links within the radius."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


def check_components(rows, got, radius):
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    root = brute_components([f for _, f in prints], radius)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = [(i, format(f, "016x"), least.get(root[f])) for i, f in prints]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("which", ["edge", "corpus_df"])
def test_simhash_components(which, request):
    df = request.getfixturevalue(which)
    found = simhash.near_duplicates(df).select("doc_id", simhash.hexadecimal(F.col("fp")), "component_id").collect()
    check_components([(r.doc_id, r.text) for r in df.collect()], found, 4)


def test_simhash_broadcasts_nothing(spark, corpus, monkeypatch):
    """No side that grows with the documents goes through the driver, however
    small its estimate."""
    plans, write = [], Stages.write

    def kept(self, df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, name)

    monkeypatch.setattr(Stages, "write", kept)
    df = spark.createDataFrame([(i, t) for i, t in corpus], "doc_id long, text string")
    found = simhash.near_duplicates(df)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 3
    assert not any("Broadcast" in p for p in plans)


def test_simhash_without_documents(none):
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3, 4, 5])
def test_masks_cover_every_pattern(radius):
    masks = [m & (1 << 64) - 1 for m in simhash.masks(radius)]
    rnd = np.random.default_rng(radius)
    for _ in range(3000):
        flipped = sum(1 << int(b) for b in rnd.choice(64, radius, replace=False))
        assert any(not flipped & m for m in masks)


@pytest.mark.parametrize("bucket", [2048, 3])
def test_links_are_whole_for_small_and_large_buckets(spark, bucket):
    rnd = np.random.default_rng(3)
    centres = [int(x) for x in rnd.integers(0, 1 << 62, 12)]
    prints = set(centres)
    for c in centres:
        for _ in range(12):
            prints.add(c ^ sum(1 << int(b) for b in rnd.choice(64, int(rnd.integers(1, 7)), replace=False)))
    want = brute_components(prints, 4)
    stages = Stages(spark, "test")
    df = spark.createDataFrame([(simhash.signed(x),) for x in prints], "fp long")
    edges = simhash.links(stages, df, 4, bucket)
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in edges.collect())
    got = {r.node & (1 << 64) - 1: r.root for r in components(stages, edges).collect()}
    groups = collections.defaultdict(set)
    for v in prints:
        groups[got.get(v, v)].add(v)
    wanted = collections.defaultdict(set)
    for v, r in want.items():
        wanted[r].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(Stages(spark, "test"), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(i, 0) == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(1, 30)) and got[201] == 200
    assert components(Stages(spark, "test"), spark.createDataFrame([], "a long, b long")).count() == 0


# --- substring dedup -------------------------------------------------------


def brute_phrases(rows, window=13):
    first = {}
    texts = [(i, SPACED.findall(t or "")) for i, t in rows]
    for i, w in texts:
        if i is not None:
            for s in range(len(w) - window + 1):
                k = tuple(w[s : s + window])
                first[k] = min(i, first.get(k, i))
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("which,window", [("edge", 13), ("corpus_df", 13), ("corpus_df", 4), ("corpus_df", 1)])
def test_phrases_match_brute_force(which, window, request):
    df = request.getfixturevalue(which)
    got = phrases.remove_repeats(df, window).collect()
    assert sorted(map(tuple, got), key=str) == brute_phrases([(r.doc_id, r.text) for r in df.collect()], window)


def test_phrases_with_many_automata(corpus_df, corpus, monkeypatch):
    found = [(i, " ".join(SPACED.findall(t))) for i, t in corpus if t.strip()]
    one = phrases.Automata(found, 13)
    monkeypatch.setattr(phrases, "BLOCKS", 5)
    many = phrases.Automata(found, 13)
    assert len(many.parts) > 1
    for i, t in corpus:
        words = t.encode().split()
        assert (one.removed(words, i) == many.removed(words, i)).all()
    assert not one.removed(corpus[20][1].encode().split(), None).any()


def test_phrases_hash_texts_together(monkeypatch):
    """A word has one hash wherever it stands, and no window reaches over two texts."""
    texts = [b"one two  three", b"", b" \t", b"two\x0bone \xc3\xa9 " + b"x" * 100, b"three\r\n" + b"x" * 100 + b" ba ab"]
    h, doc = phrases.chunk_hashes(texts)
    words = [(k, w) for k, t in enumerate(texts) for w in t.split()]
    assert doc.tolist() == [k for k, _ in words]
    assert len(set(h.tolist())) == len({w for _, w in words}) == len({(w, x) for (_, w), x in zip(words, h.tolist())})
    _, at, doc, seed, first = phrases.chunk_seeds(texts, 2)
    assert list(zip(doc.tolist(), (at - first[doc]).tolist())) == [(k, i) for k, t in enumerate(texts) for i in range(len(t.split()) - 1)]
    monkeypatch.setattr(phrases, "CHUNK", 10)
    assert [t for _, part in phrases.chunks(texts) for t in part] == texts and [k for k, _ in phrases.chunks(texts)] == [0, 1, 4]


def test_phrases_keep_the_rest_of_the_text(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = spark.createDataFrame([(1, passage), (2, f"one\n two  {passage}\n\nthree é\n"), (3, "own text\n as it  is")], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in phrases.remove_repeats(docs.withColumn("x", F.lit(1)), keep=("x",)).collect()}
    assert got == {1: passage, 2: "one\n two  three é\n", 3: "own text\n as it  is"}


def test_phrases_without_documents(none):
    assert phrases.remove_repeats(none).count() == 0


# --- benchmark decontamination ---------------------------------------------


def brute_contamination(docs, items, window=13):
    queries = collections.defaultdict(set)
    for i, t in items:
        w = alnum_words(t)
        if i is not None and w:
            for s in range(max(1, len(w) - window + 1)):
                queries[tuple(w[s : s + window])].add(str(i))
    sizes, out = {len(q) for q in queries}, []
    for d, t in docs:
        w, hit, found = alnum_words(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if names := queries.get(tuple(w[s : s + n])):
                    hit |= set(range(s, s + n))
                    found |= names
        ids = ",".join(sorted(found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("which", ["edge", "corpus_df"])
def test_contamination_matches_brute_force(which, request, spark, corpus):
    df = request.getfixturevalue(which)
    items = [(k, " ".join(t.split()[2:30])) for k, (_, t) in enumerate(corpus[:40])] + [(100, "Word word"), (100, "été"), (101, None), (102, ""), (None, "word"), (7, "BETA one-two three"), (7, "BETA one-two three")]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, words string")
    got = decontaminate.contamination(df, bench).select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.concat_ws(",", "items"), 256), "contaminated")
    assert sorted(map(tuple, got.collect()), key=str) == brute_contamination([(r.doc_id, r.text) for r in df.collect()], items)


def test_contamination_of_empty_tables(spark, edge, none):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(edge, no_items).where("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.contamination(none, no_items).count() == 0


def test_near_matches(spark):
    docs = spark.createDataFrame([(1, "a x x b a"), (2, "b y y y y a"), (3, "a a")], "doc_id long, text string")
    index = decontaminate.build_index(docs, Stages(spark, "test"))
    pairs = spark.createDataFrame([("a", "b"), ("a", "a")], "a string, b string")
    got = sorted(map(tuple, decontaminate.near_matches(index, pairs, 3).collect()))
    assert got == [(1, "a", "b", 0, 3), (1, "a", "b", 4, 3), (3, "a", "a", 0, 1)]


# --- language model --------------------------------------------------------


def brute_katz(rows):
    texts = [(i, SPACED.findall(ascii_lower(t or "")) + [""]) for i, t in rows]
    train = [katz.learns(i) for i, _ in texts]
    c, p = collections.Counter(), collections.Counter()
    for (_, w), t in zip(texts, train):
        if t:
            c.update(w)
            p.update(zip([" ", *w], w))
    n, v = sum(c.values()), len(c)
    d1, d2 = (katz.discounts(collections.Counter(x.values())) for x in (c, p))
    cut = lambda r, d: r * (d[r - 1] if r <= len(d) else 1)
    kept = sum(cut(r, d1) for r in c.values())
    scale = n if n - kept > 1e-9 * n else n + 1
    own, unknown = {w: cut(r, d1) / scale for w, r in c.items()}, 1 - kept / scale if n else 1.0
    history = collections.defaultdict(lambda: [0, 0.0, 0.0])
    for (a, b), r in p.items():
        h = history[a]
        h[0], h[1], h[2] = h[0] + r, h[1] + cut(r, d2), h[2] + own[b]

    def prob(a, b):
        h = history.get(a)
        if h is None:
            return own.get(b, unknown)
        c1 = h[0] if h[0] - h[1] > 1e-9 * h[0] else h[0] + 1
        if (a, b) in p:
            return cut(p[a, b], d2) / c1
        return (1 - h[1] / c1) / (1 - h[2]) * own.get(b, unknown)

    for a in list(history)[:10]:
        assert sum(prob(a, b) for b in c) + prob(a, "\0") == pytest.approx(1)
    out = []
    for (i, w), t in zip(texts, train):
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        out.append((i, not t, len(w), sum(x in c for x in w), n, base, sum(math.log10(prob(a, b)) for a, b in zip([" ", *w], w))))
    return sorted(out, key=str)


@pytest.mark.parametrize("which", ["edge", "corpus_df"])
def test_katz_matches_brute_force(which, request, spark):
    df = request.getfixturevalue(which)
    stages = Stages(spark, "test")
    got = sorted(map(tuple, katz.score(df, katz.train(df, stages), stages).collect()), key=str)
    want = brute_katz([(r.doc_id, r.text) for r in df.collect()])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want])


def test_katz_without_learning_rows(spark, edge, none):
    stages = Stages(spark, "test")
    model = katz.train(none, stages)
    got = katz.score(edge, model, stages).collect()
    assert len(got) == edge.count() and all(r.n_known == 0 and r.score == 0 for r in got)
    assert katz.score(none, model, Stages(spark, "test")).count() == 0


def test_katz_reads_texts_once_to_learn_and_once_to_score(spark, corpus_df, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK", 300, raising=False)  # many chunks and buckets give the same
    monkeypatch.setattr(katz, "BUCKET", 1000, raising=False)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = corpus_df.select("doc_id", "text")
    stages = Stages(spark, "test")
    docs = df.mapInArrow(counted, df.schema)
    got = sorted(map(tuple, katz.score(docs, katz.train(docs, stages), stages).collect()), key=str)
    want = brute_katz([(r.doc_id, r.text) for r in df.collect()])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want])
    assert read.value == 2 * len(want)


# --- quality classifier ----------------------------------------------------


def test_co_training_finds_both_kinds(spark, edge, none):
    rnd = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        words = list(rnd.choice(vocabulary, int(rnd.integers(20, 120))))
        toxic, low = i % 9 == 4, i % 7 == 2
        if toxic:
            words[int(rnd.integers(0, 10)) : 3] = ["scumbag", str(rnd.choice(["moronic", "moronish"]))]
        text = " ".join(w + "***" for w in words[:5] * 8) if low else " ".join(words)
        rows.append((i, text, "src1", "en"))
        if i % 2:
            labels.append((i, int(not low), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    marks = spark.createDataFrame(labels + labels[:5] + [(None, 0, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    model = cotrain.train(docs, marks)
    got = {r.doc_id: r.quality for r in cotrain.score(docs, model).collect()}
    unseen = [i for i in range(900) if i % 2 == 0]
    assert np.mean([got[i].kept == (i % 9 != 4 and i % 7 != 2) for i in unseen]) > 0.97
    assert all(0 <= q.score <= 1 for q in got.values())
    scored = cotrain.score(edge.drop("quality"), model)
    assert scored.count() == edge.count() and scored.where("quality.kept is null").count() == 0
    empty = cotrain.train(edge, marks.limit(0))
    assert cotrain.score(edge.drop("quality"), empty).where("quality.kept").count() == edge.count()
    assert cotrain.score(none.drop("quality"), cotrain.train(none, marks)).count() == 0
