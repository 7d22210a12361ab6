"""The first documents of every query in a shard (QRY-16).

A shard's rows (unit, doc_id, score) become a matrix of units and documents,
and a query's scores and counts are products of its clauses' rows with their
weights.  Pairs of a document and a query are never rows of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Cells of a matrix, at most (one document may need more).
CELLS = 1 << 22


def rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """Half away from zero by the decimal spelling, as Spark rounds."""
    x = np.asarray(x, float)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.abs(x) * 10.0**digits
        whole = np.floor(scaled)
        part = scaled - whole
        out = np.copysign((whole + (part >= 0.5)) / 10.0**digits, x)
        for i in np.flatnonzero(np.isfinite(x) & (np.abs(part - 0.5) < 1e-4 + scaled * 1e-15)).tolist():
            out[i] = float(Decimal(repr(float(x[i]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) if scaled[i] < 2**52 else x[i]
    return np.where(scaled < 2**52, out, x)


class Asked:
    """The clauses (unit, query_id, boost, must, should, never) by query."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("query_id", "ascending"), ("unit", "ascending")]).combine_chunks()
        self.unit = table["unit"].to_numpy()
        self.boost = table["boost"].to_numpy().astype(float)
        self.counts = np.array([table[c].to_numpy() for c in ("must", "should", "never")], float).reshape(3, -1)
        codes = pc.dictionary_encode(table["query_id"], null_encoding="encode").combine_chunks()
        self.queries, code = codes.dictionary, codes.indices.to_numpy()
        self.starts = np.searchsorted(code, np.arange(len(self.queries) + 1))
        self.n_must = np.bincount(code, self.counts[0], len(self.queries))

    def first(self, units: np.ndarray, scores: np.ndarray, found: np.ndarray, k: int, digits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """(query, columns, scores, hits) of all queries with a hit; ``scores`` and
        ``found`` (how often) have a row for each of the sorted ``units``."""
        at = np.minimum(np.searchsorted(units, self.unit), len(units) - 1)
        here = units[at] == self.unit
        for q, (a, b) in enumerate(zip(self.starts[:-1].tolist(), self.starts[1:].tolist())):
            own = np.flatnonzero(here[a:b]) + a
            if not len(own) or self.counts[0][own].max() == 0 < self.n_must[q]:
                continue
            must, should, never = self.counts[:, own] @ found[at[own]]
            hits = np.flatnonzero((never == 0) & (must == self.n_must[q]) & ((should > 0) | (self.n_must[q] > 0)))
            if len(hits):
                score = rounded((self.boost[own] @ scores[at[own]])[hits], digits)
                order = np.argsort(-score, kind="stable")[:k]
                yield q, hits[order], score[order], len(hits)


def first_of_shard(asked, k: int, digits: int, schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """A function of a shard's rows (unit, doc_id, score) that gives (query_id,
    doc_id, score, n); ``asked`` is a broadcast ``Asked``."""

    def run(table: pa.Table) -> pa.Table:
        clauses = asked.value
        coded = pc.dictionary_encode(table["doc_id"], null_encoding="encode").combine_chunks()
        order = pc.sort_indices(coded.dictionary, null_placement="at_start").to_numpy()
        docs = coded.dictionary.take(pa.array(order))
        col = np.argsort(order)[coded.indices.to_numpy()]
        units, row = np.unique(table["unit"].to_numpy(), return_inverse=True)
        score = table["score"].to_numpy()
        step = max(1, CELLS // len(units))
        out = []
        for start in range(0, len(docs), step):
            wide = min(step, len(docs) - start)
            own = slice(None) if wide == len(docs) else np.flatnonzero((col >= start) & (col < start + wide))
            cell = row[own] * wide + (col[own] - start)
            matrix = lambda w: np.bincount(cell, w, len(units) * wide).reshape(len(units), wide).astype(float)  # noqa: B023, E731
            for q, at, best, n in clauses.first(units, matrix(score[own]), matrix(None), k, digits):
                out.append((np.full(len(at), q), at + start, best, np.r_[n, np.zeros(len(at) - 1, int)]))
        q, at, best, n = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int),) * 4
        return pa.table([clauses.queries.take(pa.array(q)), docs.take(pa.array(at)), pa.array(best, pa.float64()), pa.array(n, pa.int64())], names=schema.names).cast(schema)

    return run
