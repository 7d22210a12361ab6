"""Substring dedup with repeated-phrase automata.

A window is 13 consecutive words.  Words go that lie in a window whose words
also start in a document with a smaller id.

1. Seeds: of the 6-word hashes in a window the smallest; equal windows have the
   same seed, so only windows with a seed that two documents share can recur.
2. Passages: those windows are grouped by a 96-bit digest; the smallest id is
   the first document, whose own words become the phrase.  A digest never
   removes anything: it only names the phrases a shard of documents needs.
3. Automata: each shard of documents compiles its phrases into Aho-Corasick
   automata and streams its documents through them; every
   occurrence found is one on the words themselves.

Shards are dealt by a hash of the id and have a bounded size; a passage that
many documents share goes once to each shard.  Stage tables lie in the shared
folder.  Null text has no words.  Rows without an id neither remove nor lose
words.  Repeated rows have one id, so they don't remove each other's words.
Further columns are not read, except those asked for."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import Stages, map_batches, mix64, table

WINDOW, SEED_WORDS = 13, 6
#: Bytes of text a shard is meant to hold, and blocks in one automaton.
SHARD_BYTES, BLOCKS = 4 << 20, 100_000
#: Bytes of text that are hashed together.
CHUNK = 1 << 18
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_POLY = 0x5851F42D4C957F2D
_LETTERS = mix64(np.arange(1, 257, dtype=np.uint64))
_IN_WORD = ~np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)])


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, 2 * CHUNK)[:n] if n <= 2 * CHUNK else _powers.__wrapped__(base, n)


def chunk_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of the texts, and the number of its text.  The
    bytes of a word are a polynomial, taken from sums over the whole chunk; long
    words, where polynomials of different words may agree, are hashed apart."""
    raw = b" ".join(texts)
    b = np.frombuffer(raw, np.uint8)
    inside = np.concatenate(([False], _IN_WORD[b], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LETTERS[b] * powers(_POLY, len(b)))))
    h = mix64((total[ends] - total[starts]) * powers(pow(_POLY, -1, 1 << 64), len(b))[starts])
    for i in np.flatnonzero(ends - starts > 64).tolist():
        h[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : ends[i]])
    first = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    return h, np.searchsorted(first, starts, "right") - 1


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts of about ``CHUNK`` bytes, and the number of the first."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK or k == len(texts) - 1:
            yield first, texts[first : k + 1]
            first, size = k + 1, 0


def chunk_seeds(texts: list[bytes], window: int) -> tuple[np.ndarray, ...] | None:
    """The words' hashes; for all windows the first word, the text and the
    seed; the first word of every text."""
    h, doc = chunk_hashes(texts)
    if len(h) < window:
        return None
    at = np.flatnonzero(doc[: len(h) - window + 1] == doc[window - 1 :])
    seed = window_seeds(h, window)[at]
    return (h, at, doc[at], seed, np.searchsorted(doc, np.arange(len(texts)))) if len(at) else None


def run_heads(doc: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Where a document or a seed differs from the one before."""
    return np.concatenate(([True], (doc[1:] != doc[:-1]) | (seed[1:] != seed[:-1])))


def rolled(h: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Polynomial hashes of n words, built from those of half as many."""
    if n == 1:
        return h
    a, b = rolled(h, n // 2, base), rolled(h, n - n // 2, base)
    return a[: len(h) - n + 1] * base ** np.uint64(n - n // 2) + b[n // 2 : n // 2 + len(h) - n + 1]


def window_seeds(h: np.ndarray, window: int) -> np.ndarray:
    """The seed of every window: the least hash of its short word runs."""
    k = min(SEED_WORDS, window)
    least, width, target = mix64(rolled(h, k, _BASES[0])), 1, window - k + 1
    while width < target:
        step = min(width, target - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    return least


def digests(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    one, two = (mix64(rolled(h, window, b)) for b in _BASES)
    return one.view(np.int64), (two >> np.uint64(33)).astype(np.int64)


def seeds(docs: DataFrame, window: int) -> DataFrame:
    """The distinct seeds of each document: (seed, doc_id)."""

    def of(batch: pa.RecordBatch) -> dict:
        ids, out = [], []
        docs = batch.column(0).to_numpy()
        for first, texts in chunks(batch.column(1).cast(pa.binary()).to_pylist()):
            found = chunk_seeds(texts, window)
            if found:
                _, _, doc, seed, _ = found
                new = run_heads(doc, seed)
                doc, seed = doc[new], seed[new]
                order = np.lexsort((seed, doc))
                doc, seed = doc[order], seed[order]
                new = run_heads(doc, seed)
                out.append(seed[new].view(np.int64))
                ids.append(docs[first + doc[new]])
        none = np.zeros(0, np.int64)
        return {"seed": np.concatenate(out or [none]), "doc_id": np.concatenate(ids or [none])}

    return map_batches(docs.where("doc_id is not null and text is not null").select("doc_id", "text"), of, "seed long, doc_id long")


def occurrences(docs: DataFrame, shared: DataFrame, window: int) -> DataFrame:
    """(d1, d2, doc_id, pos) of every window with one of the document's shared
    seeds (columns d, seeds)."""
    rows = docs.select("doc_id", "text").join(shared, F.col("doc_id") == F.col("d")).select("doc_id", "text", "seeds")

    def of(batch: pa.RecordBatch) -> dict:
        out = []
        docs, own = batch.column(0).to_numpy(), batch.column(2)
        lengths, shared = own.value_lengths().to_numpy(), own.flatten().to_numpy().view(np.uint64)
        ends = np.cumsum(lengths)
        for first, texts in chunks([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]):
            found = chunk_seeds(texts, window)
            if not found:
                continue
            h, at, doc, seed, starts = found
            last = first + len(texts)
            # A seed counts in its own document only: both are named by one number.
            named = mix64(np.arange(len(texts), dtype=np.uint64) + np.uint64(1))
            given = shared[ends[first] - lengths[first] : ends[last - 1]] ^ np.repeat(named, lengths[first:last])
            new = np.flatnonzero(run_heads(doc, seed))
            met = np.isin(seed[new] ^ named[doc[new]], given)
            met = np.repeat(met, np.diff(np.append(new, len(at))))
            at, doc = at[met], doc[met]
            one, two = (x[at] for x in digests(h, window))
            out.append((one, two, docs[first + doc], at - starts[doc]))
        none = np.zeros(0, np.int64)
        columns = [np.concatenate(x) for x in zip(*out)] or [none] * 4
        return dict(zip(("d1", "d2", "doc_id", "pos"), columns))

    return map_batches(rows, of, "d1 long, d2 long, doc_id long, pos long")


def passages(docs: DataFrame, needed: DataFrame, window: int) -> DataFrame:
    """(shard, first_doc, passage): the first documents' words that cover the
    needed windows (columns m, shard, starts), consecutive windows joined."""
    rows = docs.select("doc_id", "text").join(needed, F.col("doc_id") == F.col("m")).select("shard", "m", "text", "starts")

    def of(batch: pa.RecordBatch) -> dict:
        shards, firsts, out = [], [], []
        for shard, m, text, starts in zip(*(c.to_pylist() for c in batch.columns)):
            words, starts = (text or "").encode("utf-8", "replace").split(), np.array(sorted(starts))
            starts = starts[starts + window <= len(words)]  # rows of one id may differ in length
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                if len(run):
                    shards.append(shard)
                    firsts.append(m)
                    out.append(b" ".join(words[run[0] : run[-1] + window]).decode())
        return {"shard": shards, "first_doc": firsts, "passage": out}

    return map_batches(rows, of, "shard long, first_doc long, passage string")


class Automata:
    """Aho-Corasick automata over the blocks of passages.

    A block is half a window (7 of 13 words), at multiples of its length in the
    passage: each window of the passage holds a whole block.  A block found in
    a document is extended word by word in both directions; where passage and
    document agree over a window or more, those words go.  Each word is written
    with a fixed number of letters, its number to the base ``BASE``; the first
    letter has an alphabet of its own, so that matches start at words, and no
    state has many branches."""

    BASE = 64

    def __init__(self, found: list[tuple[int, str]], window: int):
        passages = [(doc, passage.encode().split()) for doc, passage in found]
        numbers: dict[bytes, int] = {}
        for _, words in passages:
            for w in words:
                numbers.setdefault(w, len(numbers))
        self.window, self.block, self.width = window, (window + 1) // 2, 1
        while self.BASE**self.width < len(numbers):
            self.width += 1
        self.codes = {w: self.code(n) for w, n in numbers.items()}
        self.passages = [(doc, "".join([self.codes[w] for w in words])) for doc, words in passages]
        size, places = self.block * self.width, {}
        for k, (_, text) in enumerate(self.passages):
            for i in range(0, len(text) - size + 1, size):
                places.setdefault(text[i : i + size], []).append((k, i // self.width))
        self.parts, blocks = [], list(places.items())
        for k in range(0, len(blocks), BLOCKS):
            part = ahocorasick.Automaton()
            for block, at in blocks[k : k + BLOCKS]:
                part.add_word(block, at)
            part.make_automaton()
            self.parts.append(part)

    def code(self, n: int) -> str:
        out = ""
        for _ in range(self.width - 1):
            n, digit = divmod(n, self.BASE)
            out = chr(1 + self.BASE + digit) + out
        return chr(1 + n) + out

    def agree(self, text: str, q: int, passage: str, p: int) -> tuple[int, int]:
        """Start and end, in words of ``text``, of the agreement around the
        block at word q of the text and word p of the passage."""
        d = self.width
        start, end = q, q + self.block
        while start and p - (q - start) and text[(start - 1) * d : start * d] == passage[(p - (q - start) - 1) * d : (p - (q - start)) * d]:
            start -= 1
        step, most = 64, min(len(text) // d, len(passage) // d + q - p)
        while step and end < most:
            to = min(end + step, most)
            if text[end * d : to * d] == passage[(end - q + p) * d : (to - q + p) * d]:
                end = to
            else:
                step //= 2
        return start, end

    def removed(self, words: list[bytes], doc: int | None) -> np.ndarray:
        """Mask of the words in windows that a smaller id's passage has."""
        edge = np.zeros(len(words) + 1, np.int64)
        if doc is not None and self.parts and len(words) >= self.window:
            get, unknown = self.codes.get, "\0" * self.width
            text = "".join([get(w, unknown) for w in words])
            for part in self.parts:
                reached: dict[tuple[int, int], int] = {}  # ends of the agreements that this part has found
                for last, places in part.iter(text):
                    q = (last + 1) // self.width - self.block
                    for k, p in places:
                        first, passage = self.passages[k]
                        if first < doc and reached.get((k, q - p), -1) <= q:
                            start, end = self.agree(text, q, passage, p)
                            reached[k, q - p] = end
                            if end - start >= self.window:
                                edge[start] += 1
                                edge[end] -= 1
        return np.cumsum(edge[:-1]) > 0


def cut(text: str, gone: np.ndarray) -> str:
    """The text without the marked words and the white space behind them."""
    raw, out, at = text.encode("utf-8", "replace"), [], 0
    spaces = np.isin(np.frombuffer(raw, np.uint8), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
    starts = np.flatnonzero(~spaces & np.concatenate(([True], spaces[:-1])))
    stops = np.append(starts[1:], len(raw))
    for k in np.flatnonzero(gone):
        out.append(raw[at : starts[k]])
        at = stops[k]
    return b"".join([*out, raw[at:]]).decode()


def _shard(n: int) -> Column:
    return F.pmod(F.coalesce(F.xxhash64("doc_id"), F.lit(0)), F.lit(n))


def remove_repeats(docs: DataFrame, window: int = WINDOW, keep: tuple[str, ...] = ()) -> DataFrame:
    """n_words, n_removed and the digest of what is kept, for every document;
    with ``keep`` also those columns and ``kept_text``."""
    spark = docs.sparkSession
    stages = Stages(spark, "phrases")
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // SHARD_BYTES)

    found = seeds(docs, window)
    recurring = found.groupBy("seed").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    recurring = stages.write(recurring.select("seed"), "recurring")
    shared = found.join(recurring, "seed").groupBy(F.col("doc_id").alias("d")).agg(F.collect_list("seed").alias("seeds"))
    shared = stages.write(shared, "shared")
    stages.drop("recurring")
    places = stages.write(occurrences(docs, shared, window), "places")
    stages.drop("shared")
    first = places.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "pos")).alias("f"), F.max("doc_id").alias("last"))
    first = first.where("f.doc_id < last").select("d1", "d2", F.col("f.doc_id").alias("m"), F.col("f.pos").alias("start"))
    first = stages.write(first, "first")  # a stage of its own, so that its shuffle is gone before the next
    needed = places.join(first, ["d1", "d2"]).where("doc_id > m").select("m", "start", _shard(shards).alias("shard")).distinct()
    needed = stages.write(needed.groupBy("m", "shard").agg(F.collect_list("start").alias("starts")), "needed")
    stages.drop("places")
    stages.drop("first")
    phrases = stages.write(passages(docs, needed, window), "passages")
    stages.drop("needed")

    columns = docs.select("doc_id", "text", *keep)
    given = {f.name: f for f in columns.schema}
    schema = SCHEMA + "".join(f", {x} {given[x].dataType.simpleString()}" for x in keep) + (", kept_text string" if keep else "")

    def apply(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        automata, out = Automata(list(zip(known["first_doc"], known["passage"])), window), []
        for k, (doc, text) in enumerate(zip(rows["doc_id"], rows["text"])):
            words = (text or "").encode("utf-8", "replace").split()
            gone = automata.removed(words, None if pd.isna(doc) else int(doc))
            kept = [w for w, g in zip(words, gone) if not g] if gone.any() else words
            row = [None if pd.isna(doc) else int(doc), len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()]
            if keep:
                row += [rows[x].iloc[k] for x in keep] + [cut(text, gone) if gone.any() else text]
            out.append(row)
        names = [x.split()[0] for x in SCHEMA.split(", ")] + ([*keep, "kept_text"] if keep else [])
        return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    # Rows without an id are spread by their text.
    shard = F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")), F.lit(shards))
    dealt = columns.withColumn("shard", shard).groupBy("shard")
    return dealt.cogroup(phrases.groupBy("shard")).applyInPandas(apply, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
