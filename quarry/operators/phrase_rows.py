"""Phrase frequencies of the documents of a few shards (QRY-7/8).

The positions of the phrases' terms become places on one line, a stretch for
each document, sorted by term.  A phrase begins with the places of its rarest
slot and keeps those that have a place of every other slot near enough; all
documents are looked at together, in numpy.  The numbers are those of the rows
in ``search._score_phrase``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Postings that are looked at together, at most (a shard is taken whole).
POSTINGS = 200_000


class Phrases:
    """The phrases (unit, slop, idf_sum, rare, s: slots as (i, off, tid))."""

    def __init__(self, rows: list):
        self.unit, self.idf_sum = np.array([r.unit for r in rows], np.int64), np.array([r.idf_sum for r in rows], float)
        self.slop = [r.slop for r in rows]
        self.slots = []
        for r in rows:
            slots: dict[int, tuple[int, list[int]]] = {}
            for x in r.s:
                slots.setdefault(x.i, (x.off, []))[1].append(x.tid)
            # the rarest slot comes first
            self.slots.append([(off, tuple(sorted(set(tids)))) for i, (off, tids) in sorted(slots.items(), key=lambda x: (x[0] != r.rare, x[0]))])
        self.shared = [len({t for _, tids in slots for t in tids}) < sum(len(tids) for _, tids in slots) for slots in self.slots]
        self.last = max((off for slots in self.slots for off, _ in slots), default=0)

    def found(self, tid: np.ndarray, doc: np.ndarray, pos: np.ndarray, sloppy: Callable[[list[dict], int], float]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(phrase, documents, frequencies) of all phrases that are there."""
        wide = int(pos.max()) + 2 * (self.last + max(self.slop)) + 2
        key = (doc + 1) * wide + pos
        order = np.lexsort((key, tid))
        tid, key = tid[order], key[order]
        new = np.r_[True, (tid[1:] != tid[:-1]) | (key[1:] != key[:-1])]
        tid, key = tid[new], key[new]
        tids, first = np.unique(tid, return_index=True)
        own = dict(zip(tids.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(tid)])))
        nothing, several = key[:0], {}

        def places(of: tuple[int, ...]) -> np.ndarray:
            if len(of) == 1:
                a, b = own.get(of[0], (0, 0))
                return key[a:b]
            if of not in several:
                several[of] = np.unique(np.concatenate([nothing, *[places((t,)) for t in of]]))
            return several[of]

        number = lambda x: (x + self.last) // wide - 1
        for k, slots in enumerate(self.slots):
            slop, at = self.slop[k], [places(of) for _, of in slots]
            if not all(map(len, at)):
                continue
            start = at[0] - slots[0][0]
            for (off, _), p in zip(slots[1:], at[1:]):
                low = np.searchsorted(p, start + (off - slop))
                start = start[(low < len(p)) & (p[np.minimum(low, len(p) - 1)] <= start + (off + slop))]
                if not len(start):
                    break
            if not len(start):
                continue
            if not slop:
                docs, tf = np.unique(number(start), return_counts=True)
            elif self.shared[k]:
                docs, tf = self._by_choice(k, start, number, places, wide, sloppy)
            else:
                docs, tf = self._by_windows(slots, at, start, slop, number)
            if len(docs):
                yield k, docs, tf.astype(float)

    @staticmethod
    def _by_windows(slots, at, start, slop, number) -> tuple[np.ndarray, np.ndarray]:
        """The least windows where no term stands in two slots: of each end the
        latest beginning."""
        begins = []
        for (off, _), p in zip(slots, at):
            low, n = np.searchsorted(p, start + (off - slop)), np.searchsorted(p, start + off, "right")
            n = n - low
            begins.append(p[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())] - off)
        begin = np.unique(np.concatenate(begins))
        end, inside = begin, np.ones(len(begin), bool)
        for (off, _), p in zip(slots, at):
            low = np.searchsorted(p, begin + off)
            inside &= low < len(p)
            end = np.maximum(end, p[np.minimum(low, len(p) - 1)] - off)
        inside &= end - begin <= slop
        begin, end = begin[inside], end[inside]
        latest = np.r_[end[1:] != end[:-1], True] if len(end) else inside[:0]
        docs, own = np.unique(number(end[latest]), return_inverse=True)
        return docs, np.bincount(own, 1.0 / (1 + end - begin)[latest], len(docs))

    def _by_choice(self, k, start, number, places, wide, sloppy) -> tuple[np.ndarray, np.ndarray]:
        """Different places for slots that share a term, document by document."""
        slop, of = self.slop[k], number(start)
        docs, tf = np.unique(of), []
        for d in docs.tolist():
            entries, near = [], start[of == d]
            for i, (off, tids) in enumerate(self.slots[k]):
                for t in tids:
                    p = places((t,))
                    p = p[np.searchsorted(p, near[0] + off - slop) : np.searchsorted(p, near[-1] + off + slop, "right")]
                    low = np.searchsorted(near, p - off - slop)
                    p = p[(low < len(near)) & (near[np.minimum(low, len(near) - 1)] <= p - off + slop)]
                    entries.append({"i": i, "off": off, "term": t, "positions": (p - (d + 1) * wide).tolist()})
            tf.append(sloppy(entries, slop))
        kept = np.array(tf) > 0
        return docs[kept], np.array(tf)[kept]


def shard_phrases(held, schema: pa.Schema, sloppy: Callable[[list[dict], int], float]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of Arrow batches (shard, doc_id, dl, tid, positions), in the
    order of the shards, that gives (shard, unit, doc_id, dl, idf_sum, tf);
    ``held`` is a broadcast ``Phrases``."""

    def looked_at(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, phrases = pa.concat_batches(batches), held.value
        shard, dl, tid = (rows.column(c).to_numpy() for c in (0, 2, 3))
        doc = pc.dictionary_encode(rows.column(1), null_encoding="encode").indices.to_numpy().astype(np.int64)
        lengths = pc.fill_null(pc.list_value_length(rows.column(4)), 0).to_numpy(zero_copy_only=False)
        if not lengths.any() or not len(phrases.unit):
            return
        _, first = np.unique(doc, return_index=True)
        pos = pc.list_flatten(rows.column(4)).to_numpy().astype(np.int64)
        for k, docs, tf in phrases.found(np.repeat(tid, lengths), np.repeat(doc, lengths), pos, sloppy):
            at, n = first[docs], len(docs)
            columns = [pa.array(shard[at]), pa.array(np.full(n, phrases.unit[k])), rows.column(1).take(pa.array(at)), pa.array(dl[at]), pa.array(np.full(n, phrases.idf_sum[k])), pa.array(tf)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if n + batch.num_rows > POSTINGS:
                shard = batch.column(0).to_numpy()
                # What lies before the last shard of the batch is whole.
                cut = int(np.searchsorted(shard, shard[-1]))
                before = kept[-1].column(0)[-1].as_py() if kept else None
                if cut or (kept and before != shard[0]):
                    yield from _together(looked_at([*kept, batch.slice(0, cut)] if cut else kept), schema)
                    kept, n, batch = [], 0, batch.slice(cut)
            kept.append(batch)
            n += batch.num_rows
        if kept:
            yield from _together(looked_at(kept), schema)

    return run


def _together(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Small batches as a few large ones."""
    kept, n = [], 0
    for batch in batches:
        kept.append(batch)
        n += batch.num_rows
        if n >= POSTINGS:
            yield pa.concat_batches(kept)
            kept, n = [], 0
    if kept:
        yield pa.concat_batches(kept)
