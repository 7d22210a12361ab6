"""Postings of a batch of documents by its distinct words (IDX-1).

Without synonyms and rules of the user, what the analyser makes of a token
depends on its word alone.  Spark tokenises the texts; of an Arrow batch of
documents each distinct word goes through flags, URL subtokens, lowercase,
stopwords, stem and fold once, and the tokens are mapped, sorted and cut into
runs by index in numpy.  The rows are those of ``index.build_postings``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions import patterns as P
from ..functions import text as T
from .analyzer import AnalyzerOptions
from .stemmer import stem_word

#: Tokens that are sorted together, at most (a longer document is taken whole).
TOKENS = 1 << 19
#: Words whose terms a task remembers.
REMEMBERED = 500_000

_PLAIN = re.compile(r"[^MDCLXVI0-9.@][^0-9.@]*\Z")
_RULES = {flag: re.compile(rf"(?:{rx})\Z", re.ASCII) for flag, rx in P.FLAG_RULES}
_URL_PIECES = re.compile(P.URL_SUBTOKEN_RX_RE2)


def by_words(opts: AnalyzerOptions) -> bool:
    """Whether the chain looks at one token at a time."""
    return opts.tokenizer == "standard" and opts.rules is None and not (opts.mode == "index" and opts.use_synonyms and opts.synonyms is not None)


def word_terms(opts: AnalyzerOptions) -> Callable[[str], tuple[str, ...]]:
    """The terms that the chain makes of a token, in order."""
    stop1 = frozenset(T.bundled_stopwords() if opts.stopwords is None else opts.stopwords)
    stop2 = frozenset(T.bundled_stopwords_folded() if opts.stopwords_folded is None else opts.stopwords_folded)

    def terms(word: str) -> tuple[str, ...]:
        flags = () if _PLAIN.match(word) else [f for f, rx in _RULES.items() if rx.match(word)]
        low = word.lower()
        found = [low]
        if "UrlAddress" in flags:
            found += [x for x in _URL_PIECES.findall(low) if x != low]
        if flags:  # stopwords and folding are for words without a flag
            return tuple(map(stem_word, found)) if opts.stem else tuple(found)
        found = [x for x in found if x not in stop1]
        if opts.stem:
            found = [stem_word(x) for x in found]
        return tuple(x for x in map(T.fold_ascii_py, found) if x not in stop2)

    return terms


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``TOKENS`` tokens, one document at least."""
    ends, start = np.cumsum(lengths), 0
    while start < len(lengths):
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + TOKENS, "right")), start + 1)
        yield start, stop
        start = stop


def batch_postings(opts: AnalyzerOptions, norm: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of Arrow batches (doc_id, words) that gives their postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of, known = word_terms(opts), {}
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for start, stop in _slices(lengths):
                if len(known) > REMEMBERED:
                    known.clear()
                if lengths[start:stop].any():
                    part = batch.slice(start, stop - start)
                    yield from _cut(part, lengths[start:stop], terms_of, known, norm)

    return run


def _cut(batch: pa.RecordBatch, lengths: np.ndarray, terms_of: Callable, known: dict, norm: str) -> Iterator[pa.RecordBatch]:
    coded = pc.dictionary_encode(pc.list_flatten(batch.column(1)))
    words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    known.update((w, terms_of(w)) for w in words if w not in known)
    made = [known[w] for w in words]
    terms = sorted({t for x in made for t in x})
    if not terms:
        return
    place = {t: i for i, t in enumerate(terms)}
    count = np.array([len(x) for x in made])
    first = np.cumsum(count) - count
    ids = np.array([place[t] for x in made for t in x], np.int64)
    # a row for each term of each token
    doc = np.repeat(np.arange(len(lengths)), lengths)
    pos = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    exact = np.bincount(doc, count[codes] > 0, len(lengths)).astype(np.int64)
    n = count[codes]
    at = np.repeat(first[codes] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    key = np.repeat(doc, n) * len(terms) + ids[at]
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    ends = np.r_[starts, len(key)].astype(np.int32)
    own = key[starts] // len(terms)
    dl = exact if norm == "exact" else np.array([T.lossy_length_py(x) for x in exact.tolist()])
    whole = lambda x: pa.array(x.astype(np.int32))
    columns = {
        "term": pa.array(terms, pa.string()).take(pa.array(key[starts] % len(terms))),
        "doc_id": batch.column(0).take(pa.array(own)),
        "tf": whole(np.diff(ends)),
        "positions": pa.ListArray.from_arrays(pa.array(ends), whole(np.repeat(pos, n)[order])),
        "dl": whole(dl[own]),
        "dl_exact": whole(exact[own]),
    }
    yield pa.RecordBatch.from_pydict(columns)
