"""Katz backoff language model of words.

Counts of words and word pairs are discounted by Good-Turing; what a history
leaves over goes to the words not seen after it, in proportion to their own
probability, with a weight that makes every distribution sum to exactly one.
Words are named by 64-bit hashes, pairs by two.

Texts are read once for the counts and once for the scores.  They become chunks
of about ``CHUNK`` tokens, numbered by the chunk's own list of words.  A chunk
sends each of its words and pairs once, in one row for each bucket of them; a
bucket adds up the counts of all chunks, or answers a chunk with what is known of
its words or pairs.  So a document meets the counts in its chunk, and no row is a
pair of a document.  Buckets grow in number with the learning tokens, and what is
frequent is one entry a chunk; ``SLICES`` parts of the pairs' buckets follow each
other, so that only one is in flight.  Nothing but counts of counts reaches the
driver.

Null text counts as empty: its only token is the end.  Null ids learn and are
scored.  Repeated rows learn as often as they occur and get the same score;
further columns are not read."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, Stages, byte_texts, mapped, mix64, table

#: Counts above this are taken as they are.
GOOD_TURING = 5
#: Tokens of a chunk (one long document may have more), and learning tokens for each bucket of words and of pairs.
CHUNK, BUCKET = 1 << 21, 1 << 20
#: Parts in which the pairs are counted and looked up.
SLICES = 3
#: Numbers of the start and the end in every chunk; their spellings are no words.
START, END = 0, 1
MARKS = (b" ", b"")
#: Counts of counts; what a word has that is not in a table: its count, its count as a history, and that one's weight.
MET = [f"m{r}" for r in range(1, GOOD_TURING + 2)]
DEFAULTS = {"c": 0, "c1": 1, "alpha": 1.0}


def learns(doc: int | None) -> bool:
    return doc is None or zlib.crc32(str(doc).encode()) % 5 != 1


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}") if n else np.zeros(0, np.uint8)


def chunks(docs: DataFrame) -> DataFrame:
    """(chunk, doc_ids, n, tokens, words): each document's start, words and end
    as numbers, and the hashes of the words by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        key = TaskContext.get().partitionId() << 33

        def fresh() -> None:
            nonlocal number, ids, tokens, size
            number, ids, tokens, size = defaultdict(), [], [], 0
            number.default_factory = number.__len__
            for mark in MARKS:
                number[mark]

        def out() -> list:
            words = np.array([xxhash.xxh3_64_intdigest(w) for w in number], "<u8")
            return [[key], [ids], [size], [packed(np.concatenate(tokens))], [words.tobytes()]]

        number, ids, tokens, size = defaultdict(), [], [], 0
        fresh()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
                words = (text or b"").translate(LOWER).split()
                if ids and size + len(words) + 2 > CHUNK:
                    yield out()
                    key += 1
                    fresh()
                ids.append(doc)
                tokens.append(np.fromiter((START, *map(number.__getitem__, words), END), np.uint32, len(words) + 2))
                size += len(words) + 2
        if ids:
            yield out()

    return mapped(docs.select("doc_id", "text"), run, "chunk long, doc_ids array<long>, n long, tokens binary, words binary")


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def cuts(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Every bucket of a sorted list and its place there."""
    starts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    for x, y in zip(starts, [*starts[1:], len(bucket)]):
        yield int(bucket[x]), slice(x, y)


def dealt(words: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """The order of words by bucket, and the buckets there."""
    bucket = bucket_of(mix64(words), buckets)
    order = np.argsort(bucket, kind="stable")
    return order, list(cuts(bucket[order]))


def by_bucket(rows: DataFrame, f, schema: str, *order: Column) -> DataFrame:
    """``f`` of the rows of every bucket in turn, one task holding one bucket at
    a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        flat = (tuple(r) for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        for bucket, found in groupby(flat, lambda r: r[0]):
            yield from f(bucket, found)

    return mapped(rows.repartition("bucket").sortWithinPartitions("bucket", *order), run, schema)


def word_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """For each bucket its words and their counts over all chunks (size, w, c),
    the sum of those, and the words counted 1 to 6 times; the start is no word."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for n, tokens, words in zip(*(c.to_pylist() for c in batch.columns)):
                words = np.frombuffer(words, "<u8")
                times, words = np.bincount(unpacked(tokens, n), minlength=len(words))[1:], words[1:]
                order, found = dealt(words, buckets)
                yield list(zip(*[(k, s.stop - s.start, words[order[s]].tobytes(), packed(times[order[s]])) for k, s in found]))

    def added(bucket: int, found: Iterator[tuple]) -> Iterator[list]:
        _, size, words, times = zip(*found)
        own, at = np.unique(np.frombuffer(b"".join(words), "<u8"), return_inverse=True)
        c = np.bincount(at, np.concatenate([unpacked(x, n) for x, n in zip(times, size)])).astype(np.int64)
        yield [[x] for x in (bucket, len(own), own.tobytes(), packed(c), int(c.sum()), *counts_of_counts(c))]

    rows = mapped(texts.select("n", "tokens", "words"), sent, "bucket int, size long, w binary, n binary")
    return by_bucket(rows, added, f"bucket int, size long, w binary, c binary, total long, {', '.join(f'{m} long' for m in MET)}")


def looked_up(stages: Stages, texts: DataFrame, table: DataFrame, buckets: int, columns: list[str], name: str) -> DataFrame:
    """``texts`` with ``known``: what ``table`` (bucket, size, w, columns) has for
    the chunk's words, by bucket."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for chunk, words in zip(*(c.to_pylist() for c in batch.columns)):
                words = np.frombuffer(words, "<u8")
                order, found = dealt(words, buckets)
                yield list(zip(*[(k, chunk, s.stop - s.start, words[order[s]].tobytes(), *[None] * len(columns)) for k, s in found]))

    def answered(bucket: int, found: Iterator[tuple]) -> Iterator[list]:
        known, have = np.zeros(0, np.uint64), {}
        for _, chunk, size, words, *of in found:
            words = np.frombuffer(words, "<u8")
            if chunk is None:  # the bucket's own row comes first
                known, have = words, {c: of_kind(c, x, size) for c, x in zip(columns, of)}
                continue
            at = np.searchsorted(known, words)
            here = np.flatnonzero(at < len(known))
            here = here[known[at[here]] == words[here]]
            out = []
            for c in columns:
                value = np.full(size, DEFAULTS[c])
                if c in have:
                    value[here] = have[c][at[here]]
                out.append(value.tobytes() if value.dtype == float else packed(value))
            yield [[chunk], [bucket], [size], *[[x] for x in out]]

    blobs = ", ".join(f"{c} binary" for c in columns)
    ask = mapped(texts.select("chunk", "words"), asked, f"bucket int, chunk long, size long, w binary, {blobs}")
    own = table.select("bucket", F.lit(None).cast("long").alias("chunk"), "size", "w", *columns)
    answer = by_bucket(ask.unionByName(own), answered, f"chunk long, bucket int, size long, {blobs}", F.col("chunk").asc_nulls_first())
    return texts.join(gathered(stages.write(answer, name), "known"), "chunk")


def gathered(answer: DataFrame, name: str) -> DataFrame:
    """A chunk's answers in one row."""
    return answer.groupBy("chunk").agg(F.collect_list(F.struct(*[c for c in answer.columns if c != "chunk"])).alias(name))


def of_kind(column: str, raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<f8") if isinstance(DEFAULTS[column], float) else unpacked(raw, n)


def values(known: list[dict], column: str, words: np.ndarray, buckets: int) -> np.ndarray:
    """A column of a chunk's ``known`` in the order of its words."""
    out, met = np.full(len(words), DEFAULTS[column]), {x["bucket"]: x for x in known}
    order, found = dealt(words, buckets)
    for k, s in found:
        out[order[s]] = of_kind(column, met[k][column], met[k]["size"])
    return out


def runs(w: np.ndarray) -> tuple[bytes, bytes]:
    """Equal neighbours once, and how often each."""
    starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
    return w[starts].tobytes(), packed(np.diff(starts, append=len(w)))


def repeated(heads: bytes, lengths: bytes) -> np.ndarray:
    heads = np.frombuffer(heads, "<u8")
    return np.repeat(heads, unpacked(lengths, len(heads)))


@dataclass
class Pairs:
    """A chunk's tokens that follow another: the document of each, and its
    distinct pair; the pairs by bucket, each with its words and its hash."""

    doc: np.ndarray
    second: np.ndarray
    pair: np.ndarray
    a: np.ndarray
    b: np.ndarray
    w1: np.ndarray
    hash: np.ndarray
    bucket: np.ndarray

    @classmethod
    def of(cls, tokens: np.ndarray, words: np.ndarray, buckets: int, part: int | None = None) -> Pairs:
        """All pairs, or those of one slice of the buckets."""
        mixed = mix64(words)
        # With the first word the hash names the second: mixing loses nothing.
        hashes = lambda a, b: mix64(mixed[a] ^ words[b])
        doc = np.cumsum(tokens == START) - 1
        follows = np.flatnonzero(tokens != START)
        if part is not None:
            follows = follows[bucket_of(hashes(tokens[follows - 1], tokens[follows]), buckets) % SLICES == part]
        first, second = tokens[follows - 1].astype(np.int64), tokens[follows].astype(np.int64)
        keys, pair = np.unique(first * len(words) + second, return_inverse=True)
        a, b = np.divmod(keys, len(words))
        hashed = hashes(a, b)
        bucket = bucket_of(hashed, buckets)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        a, b = a[order], b[order]
        return cls(doc[follows], second, place[pair], a, b, words[a], hashed[order], bucket[order])


def pair_counts(texts: DataFrame, buckets: int, part: int, word_p) -> DataFrame:
    """For each bucket of a slice its histories (h1) with their number of pairs
    (runs), the hashes and counts of those, and what its histories have there
    (sums: pairs' counts, pairs counted 1 to 5 times; seen: the probability of the
    second words); and the pairs counted 1 to 6 times.  ``texts`` has the words'
    counts as ``known``."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, tokens, words, known = (c[i].as_py() for c in batch.columns)
                words = np.frombuffer(words, "<u8")
                own, c2 = Pairs.of(unpacked(tokens, n), words, buckets, part), values(known, "c", words, buckets)
                times, c2 = np.bincount(own.pair), c2[own.b]
                rows = [(k, s.stop - s.start, *runs(own.w1[s]), own.hash[s].tobytes(), packed(times[s]), packed(c2[s])) for k, s in cuts(own.bucket)]
                if rows:
                    yield list(zip(*rows))

    def added(bucket: int, found: Iterator[tuple]) -> Iterator[list]:
        _, size, h1, lengths, hashed, times, c2 = zip(*found)
        times, c2 = (np.concatenate([unpacked(x, n).astype(np.int64) for x, n in zip(c, size)]) for c in (times, c2))
        w1, hashed = np.concatenate([repeated(*x) for x in zip(h1, lengths)]), np.frombuffer(b"".join(hashed), "<u8")
        order = np.lexsort((hashed, w1))
        w1, hashed = w1[order], hashed[order]
        first = np.flatnonzero(np.r_[True, (w1[1:] != w1[:-1]) | (hashed[1:] != hashed[:-1])])
        w1, hashed, c, p = w1[first], hashed[first], np.add.reduceat(times[order], first), word_p(c2[order][first])
        at = np.cumsum(np.r_[False, w1[1:] != w1[:-1]])
        own = at[-1] + 1
        sums = [np.bincount(at, c, own), *(np.bincount(at[c == r], minlength=own) for r in range(1, GOOD_TURING + 1))]
        yield [[x] for x in (bucket, len(w1), *runs(w1), hashed.tobytes(), packed(c), np.array(sums, "<i8").tobytes(), np.bincount(at, p).astype("<f8").tobytes(), *counts_of_counts(c))]

    rows = mapped(texts.select("n", "tokens", "words", "known"), sent, "bucket int, size long, h1 binary, runs binary, hash binary, n binary, c2 binary")
    return by_bucket(rows, added, f"bucket int, size long, h1 binary, runs binary, hash binary, c binary, sums binary, seen binary, {', '.join(f'{m} long' for m in MET)}")


def word_table(pairs: DataFrame, words: DataFrame, buckets: int, factors: list[float]) -> DataFrame:
    """For each bucket of words their counts, their counts as histories, and the
    weights of those (size, w, c, c1, alpha)."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for w, sums, seen in zip(*(c.to_pylist() for c in batch.columns)):
                w, seen = np.frombuffer(w, "<u8"), np.frombuffer(seen, "<f8")
                sums = np.frombuffer(sums, "<i8").reshape(-1, len(w))
                order, found = dealt(w, buckets)
                yield list(zip(*[(k, s.stop - s.start, w[order[s]].tobytes(), None, *(packed(x[order[s]]) for x in sums), seen[order[s]].tobytes()) for k, s in found]))

    def added(bucket: int, found: Iterator[tuple]) -> Iterator[list]:
        found = list(found)
        own, at = np.unique(np.frombuffer(b"".join(r[2] for r in found), "<u8"), return_inverse=True)
        c, at = np.zeros(len(own), np.int64), np.split(at, np.cumsum([r[1] for r in found])[:-1])
        history = [(a, r) for a, r in zip(at, found) if r[3] is None]
        for a, r in zip(at, found):
            if r[3] is not None:
                c[a] = unpacked(r[3], r[1])
        places = np.concatenate([a for a, _ in history] or [np.zeros(0, np.int64)])
        total = lambda k, of: np.bincount(places, np.concatenate([of(r[k], r[1]) for _, r in history] or [[]]), len(own))
        c1, *met = (total(4 + k, unpacked) for k in range(GOOD_TURING + 1))
        seen = total(5 + GOOD_TURING, lambda raw, _: np.frombuffer(raw, "<f8"))
        lost = sum(m * r * (1 - d) for r, (m, d) in enumerate(zip(met, factors), 1))
        # A history with frequent pairs only leaves nothing; an unseen word then counts once.
        whole = np.where(lost > 1e-9 * c1, c1, c1 + 1)
        alpha = np.where(c1 > 0, (1 - (c1 - lost) / whole) / (1 - seen), DEFAULTS["alpha"])
        yield [[x] for x in (bucket, len(own), own.tobytes(), packed(c), packed(whole.astype(np.int64)), alpha.astype("<f8").tobytes())]

    blobs = ", ".join(f"{x} binary" for x in ("w", "c", "c1", *MET[:GOOD_TURING], "seen"))
    rows = mapped(pairs.select("h1", "sums", "seen"), sent, f"bucket int, size long, {blobs}")
    return by_bucket(rows.unionByName(words.select("bucket", "size", "w", "c"), allowMissingColumns=True), added, "bucket int, size long, w binary, c binary, c1 binary, alpha binary")


def discounts(counts: dict[int, int], k: int = GOOD_TURING) -> list[float]:
    """Katz's factor for each count from 1 to k, from the counts of counts.
    Where Good-Turing gives none between 0 and 1, absolute discounting."""
    n = [0] + [counts.get(r, 0) for r in range(1, k + 2)]
    if all(n[1:]):
        rest = (k + 1) * n[k + 1] / n[1]
        found = [((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) for r in range(1, k + 1)] if rest < 1 else []
        if found and all(0 < d < 1 for d in found):
            return found
    off = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return [(r - off) / r for r in range(1, k + 1)]


def counts_of_counts(c: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(c, GOOD_TURING + 2), minlength=GOOD_TURING + 3)[1 : GOOD_TURING + 2].tolist()


def cut(c: np.ndarray, factors: list[float]) -> np.ndarray:
    """Counts times their factors."""
    return c * np.array([0.0, *factors, 1.0])[np.minimum(c, len(factors) + 1)]


@dataclass
class Katz:
    """``words``: bucket, size, w, c, and as histories c1 and alpha.  ``pairs``:
    bucket, size, h1, runs, hash, c, by slice.  ``factors``: of the words' and of
    the pairs' counts.  ``scale``: what the words' counts are shares of.
    ``unknown``: an unknown word's probability."""

    words: DataFrame
    pairs: list[DataFrame]
    factors: tuple[list[float], list[float]]
    scale: int
    buckets: int
    tokens: int
    vocabulary: int
    unknown: float


def train(docs: DataFrame, stages: Stages) -> Katz:
    texts = stages.write(chunks(docs.where(~held_out())), "learning-texts")
    buckets = max(1, -(-(texts.agg(F.sum("n")).first()[0] or 0) // BUCKET))
    words = stages.write(word_counts(texts, buckets), "word-counts")
    summed = [F.coalesce(F.sum(m), F.lit(0)) for m in MET]
    total, vocabulary, *met = words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0)), *summed).first()
    word_factors = discounts(dict(enumerate(met, 1)))
    lost = sum(m * r * (1 - d) for r, (m, d) in enumerate(zip(met, word_factors), 1))
    # Without rare words there is no mass left over; the unknown word then counts once.
    scale = total if lost > 1e-9 * total else total + 1
    unknown = 1 - (total - lost) / scale if total else 1.0

    texts = stages.write(looked_up(stages, texts, words, buckets, ["c"], "learning-words").select("n", "tokens", "words", "known"), "learning")
    for done in ("learning-texts", "learning-words"):
        stages.drop(done)
    own_p = lambda c: cut(c, word_factors) / scale
    pairs = [stages.write(pair_counts(texts, buckets, s, own_p), f"pairs-{s}") for s in range(SLICES)]
    stages.drop("learning")
    every = reduce(DataFrame.unionByName, pairs)
    factors = discounts(dict(enumerate(every.agg(*summed).first(), 1)))
    known = stages.write(word_table(every, words, buckets, factors), "words")
    stages.drop("word-counts")
    return Katz(known, pairs, (word_factors, factors), scale, buckets, total, vocabulary, unknown)


def answers(texts: DataFrame, model: Katz, part: int) -> DataFrame:
    """(chunk, bucket, counts): the counts of each chunk's pairs of a slice, in
    their order."""
    buckets = model.buckets

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for chunk, n, tokens, words in zip(*(c.to_pylist() for c in batch.columns)):
                own = Pairs.of(unpacked(tokens, n), np.frombuffer(words, "<u8"), buckets, part)
                rows = [(k, chunk, s.stop - s.start, *runs(own.w1[s]), own.hash[s].tobytes(), None) for k, s in cuts(own.bucket)]
                if rows:
                    yield list(zip(*rows))

    def answered(bucket: int, found: Iterator[tuple]) -> Iterator[list]:
        known, hashes, c = (np.zeros(0, np.uint64),) * 3
        for _, chunk, size, h1, lengths, hashed, counts in found:
            w1, hashed = repeated(h1, lengths), np.frombuffer(hashed, "<u8")
            if chunk is None:  # the bucket's own row comes first
                order = np.argsort(hashed, kind="stable")
                known, hashes, c = w1[order], hashed[order], unpacked(counts, size)[order]
                continue
            out, at = np.zeros(size, np.int64), np.searchsorted(hashes, hashed)
            left = np.arange(size)
            while len(left := left[at[left] < len(hashes)]) and len(left := left[hashes[at[left]] == hashed[left]]):
                same = known[at[left]] == w1[left]
                out[left[same]] = c[at[left[same]]]
                left = left[~same]  # pairs of other first words with the same hash
                at[left] += 1
            yield [[chunk], [bucket], [packed(out)]]

    schema = "bucket int, chunk long, size long, h1 binary, runs binary, hash binary, c binary"
    ask = mapped(texts.select("chunk", "n", "tokens", "words"), asked, schema)
    own = model.pairs[part].select("bucket", F.lit(None).cast("long").alias("chunk"), "size", "h1", "runs", "hash", "c")
    return by_bucket(ask.unionByName(own), answered, "chunk long, bucket int, counts binary", F.col("chunk").asc_nulls_first())


def score(docs: DataFrame, model: Katz, stages: Stages, keep: bool = True) -> DataFrame:
    """Counts and both scores of every document.  A model that is not kept, of the
    same ``stages``, loses its pairs once they have been looked up."""
    texts, counts = stages.write(chunks(docs), "texts"), []
    for s in range(len(model.pairs)):
        counts.append(stages.write(answers(texts, model, s), f"answers-{s}"))
        if not keep:
            stages.drop(f"pairs-{s}")
    counts = reduce(DataFrame.unionByName, counts)
    buckets, unknown, scale, (word_factors, factors) = model.buckets, model.unknown, model.scale, model.factors
    below = model.tokens + 0.5 * (model.vocabulary + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, tokens, words, known, met = (c[i].as_py() for c in batch.columns[1:])
                words = np.frombuffer(words, "<u8")
                own = Pairs.of(unpacked(tokens, n), words, buckets)
                met = {x["bucket"]: x["counts"] for x in met}
                c = np.concatenate([unpacked(met[k], s.stop - s.start).astype(np.int64) for k, s in cuts(own.bucket)])
                c2, c1, alpha = (values(known, x, words, buckets) for x in ("c", "c1", "alpha"))
                p = np.where(c2 > 0, cut(c2, word_factors) / scale, unknown)
                backed = np.log10(alpha)[own.a] + np.log10(p)[own.b]
                with np.errstate(divide="ignore"):
                    logp = np.where(c > 0, np.log10(cut(c, factors) / c1[own.a]), backed)
                sums = lambda x: np.bincount(own.doc, x)  # noqa: B023, E731
                yield [
                    batch.column(0)[i].values, np.bincount(own.doc), sums(c2[own.second] > 0).astype(np.int64),
                    sums(np.log10((c2 + 0.5) / below)[own.second]), sums(logp[own.pair]),
                ]

    found = looked_up(stages, texts, model.words, buckets, list(DEFAULTS), "known").join(gathered(counts, "counts"), "chunk")
    scored = mapped(found.select("doc_ids", "n", "tokens", "words", "known", "counts"), run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stages = table(spark, sf_dir, "documents"), Stages(spark, "katz")
    return score(docs, train(docs, stages), stages, keep=False)
