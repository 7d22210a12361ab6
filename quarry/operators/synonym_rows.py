"""Synonym words of a batch of documents by numbers (TXT-9).

A trie of synonyms that a task can hold becomes numbered nodes.  Of an Arrow
batch of documents each distinct term is looked up once; tokens walk down the
trie together, a level at a time, and what their nodes emit is laid out, and
counted where asked, by index in numpy.  The rows are those of the join in
``synonyms.synonym_words``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Tokens whose synonym words are laid out together, at most (the rows of one id are taken whole).
TOKENS = 1 << 16


class Trie:
    """Nodes of the left sides; a node emits (k, word): a right side's k-th word."""

    def __init__(self, rows: list[tuple], joiner: str):
        self.root: dict[str, int] = {}
        self.next: dict[int, dict[str, int]] = defaultdict(dict)
        left, emits, words = [], [], {}

        def step(known: dict[str, int], word: str, path: str) -> int:
            if word not in known:
                known[word] = len(left)
                left.append(path)
                emits.append([])
            return known[word]

        for first, branches in rows:
            for rest, right in branches:
                path = first
                node = step(self.root, first, path)
                for word in rest:
                    path += joiner + word
                    node = step(self.next[node], word, path)
                emits[node] += [(k, words.setdefault(w, len(words))) for k, w in enumerate(right)]
        self.left, self.words = pa.array(left, pa.string()), pa.array(list(words), pa.string())
        self.count = np.array([len(e) for e in emits], np.int64)
        self.first = np.cumsum(self.count) - self.count
        self.shift, self.word = np.array([x for e in emits for x in e], np.int64).reshape(-1, 2).T

    def reached(self, row: np.ndarray, pos: np.ndarray, whole: np.ndarray, terms: list[str], code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(tokens, nodes) of every level: the tokens where a left side begins,
        and the nodes that they reach with the whole tokens behind them."""
        node = np.array([self.root.get(t, -1) for t in terms], np.int64)[code]
        at = np.flatnonzero(node >= 0)
        yield at, node[at]
        # The next levels walk over whole tokens only, at the positions one after the other.
        own = np.flatnonzero(whole)
        row, pos, code, node = row[own], pos[own], code[own], node[own]
        goes_on = np.r_[(row[1:] == row[:-1]) & (pos[1:] == pos[:-1] + 1), False] if len(own) else np.zeros(0, bool)
        place = {t: i for i, t in enumerate(terms)}
        start = end = np.flatnonzero(node >= 0)
        node = node[start]
        while True:
            on = goes_on[end]
            start, end, node = start[on], end[on] + 1, node[on]
            steps = sorted((n * len(terms) + place[t], child) for n in np.unique(node).tolist() for t, child in self.next.get(n, {}).items() if t in place)
            if not steps:
                return
            keys, children = np.array(steps, np.int64).T
            key = node * len(terms) + code[end]
            found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            on = keys[found] == key
            start, end, node = start[on], end[on], children[found[on]]
            yield own[start], node


def _runs(ids: pa.Array) -> np.ndarray:
    """The number of the run of equal ids that each row lies in."""
    code = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy()
    return np.cumsum(np.r_[False, code[1:] != code[:-1]]) if len(code) else code


def _laid_out(trie: Trie, batch: pa.RecordBatch, run: np.ndarray, counted: bool) -> pa.RecordBatch | None:
    """The rows of a few documents (id, pos, ord, term)."""
    lengths = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    pos, order = (pc.list_flatten(batch.column(c)).to_numpy().astype(np.int64) for c in (1, 2))
    coded = pc.dictionary_encode(pc.list_flatten(batch.column(3)))
    row = np.repeat(np.arange(len(lengths)), lengths)
    found = list(trie.reached(row, pos, order == 0, coded.dictionary.to_pylist(), coded.indices.to_numpy()))
    token, node = (np.concatenate(x) for x in zip(*found))
    n = trie.count[node]
    if not n.sum():
        return None
    at = np.repeat(trie.first[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    place, word = np.repeat(pos[token], n) + trie.shift[at], trie.word[at]
    if not counted:
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(row[token], n))), pa.array(place.astype(np.int32)), trie.words.take(pa.array(word)), trie.left.take(pa.array(np.repeat(node, n)))], names=["id", "pos", "word", "left"])
    wide, many = int(place.max()) + 1, len(trie.words)
    key, count = np.unique((np.repeat(run[row[token]], n) * wide + place) * many + word, return_counts=True)
    key, word = np.divmod(key, many)
    key, place = np.divmod(key, wide)
    first = np.searchsorted(run, key)  # a row of the run
    return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first)), pa.array(place.astype(np.int32)), trie.words.take(pa.array(word)), pa.array(count.astype(np.int64))], names=["id", "pos", "word", "n"])


def batch_words(held, schema: pa.Schema, counted: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of Arrow batches (id, pos, ord, term) that gives their synonym
    words; ``held`` is a broadcast ``Trie``.  ``counted`` counts equal rows of
    an id, whose rows lie together."""

    def whole(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        run = _runs(batch.column(0))
        lengths = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if counted else np.arange(len(run))
        ends, before = np.r_[starts[1:], len(run)], np.r_[0, np.cumsum(lengths)]
        k = 0
        while k < len(starts):
            to = max(k + 1, int(np.searchsorted(before[ends], before[starts[k]] + TOKENS, "right")))
            a, b = int(starts[k]), int(ends[to - 1])
            found = _laid_out(held.value, batch.slice(a, b - a), run[a:b] - run[a], counted) if before[b] > before[a] else None
            if found is not None:
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(found.columns, schema)], schema=schema)
            k = to

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if not counted:
                yield from whole(batch)
                continue
            # The last id of a batch may go on in the next.
            run = _runs(batch.column(0))
            same = not kept or kept[-1].column(0)[-1].as_py() == batch.column(0)[0].as_py()
            if not same:
                yield from whole(_joined(kept))
                kept = []
            cut = int(np.searchsorted(run, run[-1]))
            if cut:
                yield from whole(_joined([*kept, batch.slice(0, int(np.searchsorted(run, 1)))]))
                kept, more = [], batch.slice(int(np.searchsorted(run, 1)), cut - int(np.searchsorted(run, 1)))
                if more.num_rows:
                    yield from whole(more)
            kept.append(batch.slice(cut))
        if kept:
            yield from whole(_joined(kept))

    return every


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.concat_batches(batches)
