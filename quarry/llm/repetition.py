"""Repetition coverage: quality rules from rolling hashes in numpy.

Every whole text is judged by the share of its characters inside duplicated
n-grams of several lengths and inside repeated lines.  A map without shuffle:
one document is one unit of work, and memory is bounded by its length.

Null or empty text: no words, ``base_failed``.  Repeated rows are judged row by
row; further columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import map_batches, mix64, table

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
BASE_N = 8
_SPACE = np.isin(np.arange(256), list(SPACES))
_BASE = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, top_share double, repeat_share double, line_share double, symbol_share double"
)


@dataclass(frozen=True)
class Limits:
    """Largest shares of word characters. ``top``: in the most frequent n-gram
    (three occurrences or more); ``repeat``: in n-grams found twice or more;
    ``lines``: in lines equal to an earlier line; ``symbols``: symbols a word."""

    top: dict[int, float] = field(default_factory=lambda: {2: 0.20, 3: 0.18, 4: 0.16})
    repeat: dict[int, float] = field(default_factory=lambda: {5: 0.35, 6: 0.34, 7: 0.33, 8: 0.32, 9: 0.31, 10: 0.30})
    lines: float = 0.30
    symbols: float = 0.30


def word_ids(words: list[bytes]) -> np.ndarray:
    ids: dict[bytes, int] = {}
    return np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)


def rolling(ids: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """Hashes of all windows of each length, each from the one a word shorter."""
    values = mix64(ids.astype(np.uint64) + _BASE)
    out, h = {}, values
    for n in range(1, min(max(lengths), len(ids)) + 1):
        if n > 1:
            h = h[:-1] * _BASE + values[n - 1 :]
        if n in lengths:
            out[n] = h
    return out


def repeated(h: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of n words that occur twice or more, confirmed on
    the word ids."""
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return order[:0]
    windows = np.lib.stride_tricks.sliding_window_view(ids, n)
    a, b = order[:-1][same], order[1:][same]
    if (windows[a] != windows[b]).any():
        _, inverse, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        return np.flatnonzero(counts[inverse.ravel()] > 1)
    return np.union1d(a, b)


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Mask of the words inside windows of n words at the given starts."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def char_lengths(text: bytes) -> np.ndarray:
    """Code points of each word."""
    raw = np.frombuffer(text, np.uint8)
    space = _SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return points[edges[1::2]] - points[edges[::2]]


def judge(text: bytes | None, limits: Limits = Limits()) -> tuple:
    text = text or b""
    words = text.split()
    n = len(words)
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines, seen, n_dup_lines, dup_line_chars = text.split(b"\n"), set(), 0, 0
    if len(lines) > 1:
        for line in lines:
            if line and line not in seen:
                seen.add(line)
            elif line and line.strip(SPACES):
                n_dup_lines += 1
                dup_line_chars += len("".join(x.decode("utf-8", "replace") for x in line.split()))
    if not n:
        return 0, 0, n_symbols, n_dup_lines, 0, True, False, 0.0, 0.0, 0.0, 0.0
    chars = char_lengths(text)
    total, ids = int(chars.sum()), word_ids(words)
    lengths = sorted({*limits.top, *limits.repeat, BASE_N})
    hashes = rolling(ids, lengths)
    n_repeat_words, top_share, repeat_share, over, none_from = 0, 0.0, 0.0, False, 1 << 30
    for m in lengths:
        h = hashes.get(m)
        if h is None or m >= none_from:
            continue
        starts = repeated(h, ids, m)
        if not len(starts):  # then no longer window repeats either
            none_from = m
            continue
        mask = covered(starts, m, n) if m in limits.repeat or m == BASE_N else None
        if m == BASE_N:
            n_repeat_words = int(mask.sum())
        if m in limits.top:
            values, at, counts = np.unique(h[starts], return_index=True, return_counts=True)
            if counts.max() >= 3:
                best = h == values[counts.argmax()]
                share = float(chars[covered(np.flatnonzero(best), m, n)].sum()) / total
                top_share, over = max(top_share, share), over or share > limits.top[m]
        if m in limits.repeat:
            share = float(chars[mask].sum()) / total
            repeat_share, over = max(repeat_share, share), over or share > limits.repeat[m]
    line_share, symbol_share = dup_line_chars / total, n_symbols / n
    over = over or line_share > limits.lines or symbol_share > limits.symbols
    failed = n < 20 or 100 * n_repeat_words > 30 * n
    return n, total, n_symbols, n_dup_lines, n_repeat_words, failed, not failed and not over, top_share, repeat_share, line_share, symbol_share


def repetition_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Counts, shares and verdict of every document, one row for each."""

    def of(batch: pa.RecordBatch) -> dict:
        texts = batch.column(1).cast(pa.binary())
        rows = [judge(t.as_py(), limits) for t in texts]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return {"doc_id": batch.column(0), **dict(zip(names[1:], map(list, zip(*rows)), strict=True))}

    return map_batches(docs.select("doc_id", "text"), of, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(table(spark, sf_dir, "documents"))
