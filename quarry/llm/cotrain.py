"""Quality classifier by co-training.

One view sees the words of a text, the other its page metadata (source,
language, length, layout).  Both start from the labelled rows; in each round
every view labels the unlabelled rows that it is most sure of, as training
rows of the other.  Each view is then calibrated, and a small logistic
combination of both, fitted on labelled rows that neither has seen, scores all
documents.  Two heads are trained this way: low quality and toxic.

Learning reads a bounded sample (``LABELLED`` and ``POOL`` rows, drawn by a hash
of the id); scoring is a map over all whole texts.  Null text counts as empty,
null metadata as a value of its own.  Of several labels of a document the
highest counts.  Without labels everything is kept with probability 0.
Repeated rows are scored row by row; further columns are not read."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import WORD_TABLE, mix64, table
from quarry.llm.ftrl import Ftrl, Row, scores, softmax, temperature

#: Rows in the learner's sample (expected).
LABELLED, POOL = 8_000, 3_000
#: A feature counts from this many rows of the sample.
LEAST_ROWS = 3
ROUNDS, EPOCHS = 2, 2
#: A view labels a pool row for the other view at this probability or above.
SURE = 0.98
#: A document goes at this probability of either head: clean ones are to stay.
THRESHOLD = 0.65
#: How far the combination is held at an even vote of both views.
RIDGE = 0.05
HEADS = ("low_quality", "toxic")
_SYMBOLS = b"#*$%&|<>!"


def words_view(text: bytes) -> np.ndarray:
    """32-bit hashes of the distinct words of a text and of their first four to
    six bytes, which stand for stems."""
    words = set(text.translate(WORD_TABLE).split())
    stems = {w[:n] + b"-" for n in (4, 5, 6) for w in words if len(w) > n}
    return np.unique(np.fromiter(map(zlib.crc32, words | stems), np.uint32))


def meta_view(text: bytes, source: str | None, lang: str | None) -> np.ndarray:
    """Hashes of the page's metadata: provenance and binned layout figures."""
    size, tokens, lines = len(text), text.split(), text.split(b"\n")
    n = max(len(tokens), 1)
    letters = max(size - len(text.translate(None, bytes(range(65, 91)) + bytes(range(97, 123)))), 1)
    upper = size - len(text.translate(None, bytes(range(65, 91))))
    symbols = size - len(text.translate(None, _SYMBOLS))
    facts = {
        "source": source,
        "lang": lang,
        "chars": int(2 * math.log2(size + 1)),
        "lines": int(2 * math.log2(len(lines) + 1)),
        "line length": int(math.log2(size / len(lines) + 1)),
        "same lines": int(10 * (1 - len(set(lines)) / len(lines))),
        "upper": int(10 * upper / letters),
        "symbols": min(int(10 * symbols / n), 20),
        "word length": min(int(size / n), 20),
        "variety": int(10 * len(set(tokens)) / n),
        "long text": int(math.log2(n)) * 20 + int(10 * len(set(tokens)) / n),
    }
    return np.unique(np.array([zlib.crc32(f"{k}={v}".encode()) for k, v in facts.items()], np.uint32))


def _views(text: str | None, source: str | None, lang: str | None) -> tuple[np.ndarray, np.ndarray]:
    raw = (text or "").encode("utf-8", "replace")
    return words_view(raw), meta_view(raw, source, lang)


def known(keys: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Places in the sorted keys of those hashes that are there."""
    if not len(keys):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
    return at[keys[at] == hashed]


class View:
    """One view of the sample: its features as numbers, and their hashes."""

    def __init__(self, hashed: pa.Array, order: np.ndarray, l1: float):
        """``hashed``: a binary column with each row's 32-bit hashes."""
        wide = pa.types.is_large_binary(hashed.type)
        _, offsets, data = hashed.buffers()
        ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[hashed.offset : hashed.offset + len(hashed) + 1] // 4
        flat = np.frombuffer(data, np.uint32) if data is not None and len(hashed) else np.zeros(0, np.uint32)
        found, rows = np.unique(flat[ends[0] : ends[-1]] if len(hashed) else flat, return_counts=True)
        self.keys, self.l1 = found[rows >= LEAST_ROWS], l1
        self.rows: list[Row] = []
        for i in order:
            own = known(self.keys, flat[ends[i] : ends[i + 1]]).astype(np.int32)
            self.rows.append((own, np.broadcast_to(1.0, len(own))))

    def fit(self, at: list[int], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return Ftrl(len(self.keys), 2, alpha=0.3, l1=self.l1, l2=0.05).fit([self.rows[i] for i in at], y, EPOCHS).table()

    def scores(self, at: np.ndarray, fitted: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return scores([self.rows[i] for i in at], *fitted)


@dataclass
class Linear:
    """A fitted view: the hashes with a weight, their weights and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def margin(self, hashed: np.ndarray) -> float:
        return float(self.weights[known(self.keys, hashed)].sum()) + self.bias


def _combine(logits: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (two views and a bias) of a ridge logistic fit by Newton steps,
    starting from an even vote."""
    x, start = np.column_stack([logits, np.ones(len(y))]), np.array([0.5, 0.5, 0.0])
    w = start.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(3) * RIDGE, x.T @ (p - y) + (w - start) * RIDGE)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.array([max(w[0], 0.0), max(w[1], 0.0), w[2]])


def co_train(views: list[View], y: np.ndarray, held: np.ndarray, rounds: int = ROUNDS) -> tuple[list[Linear], np.ndarray] | None:
    """Both views, calibrated, and the weights of their combination.  ``y`` is
    1, 0, or -1 where unlabelled; ``held`` marks the labelled rows kept back
    for calibration."""
    labelled, pool = np.flatnonzero((y >= 0) & ~held), np.flatnonzero(y < 0)
    if len(set(y[labelled])) < 2:
        return None
    given: list[dict[int, int]] = [{}, {}]  # pseudo-labels for each view
    rates = {c: (y[labelled] == c).mean() for c in (0, 1)}
    at_held = np.flatnonzero(held & (y >= 0))
    for r in range(rounds + 1):
        fitted = [view.fit([*labelled, *given[v]], np.array([*y[labelled], *given[v].values()])) for v, view in enumerate(views)]
        logits = [view.scores(at_held, f) for view, f in zip(views, fitted)]
        heat = [temperature(x, y[at_held]) for x in logits]
        if r < rounds and len(pool):
            for v in (0, 1):  # sure by its calibrated probability
                p = softmax(views[v].scores(pool, fitted[v]) / heat[v])
                for c in (0, 1):
                    most = max(1, int(len(pool) * rates[c] / (2 * rounds)))
                    best = np.argsort(-p[:, c], kind="stable")[:most]
                    given[1 - v] |= {int(pool[i]): c for i in best if p[i, c] >= SURE}
    margins = np.column_stack([(x[:, 1] - x[:, 0]) / t for x, t in zip(logits, heat)]) if len(at_held) else np.zeros((0, 2))
    vote = _combine(margins, y[at_held])
    calibrated = []
    for view, (w, b), t in zip(views, fitted, heat):
        difference = (w[:, 1] - w[:, 0]) / t
        own = difference != 0
        calibrated.append(Linear(view.keys[own], difference[own], float(b[1] - b[0]) / t))
    return calibrated, vote


def sample(docs: DataFrame, labels: DataFrame) -> pa.Table:
    """The bounded learning sample: view features and labels (null: pool)."""

    def draw(rows: int, of: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1_000_000)) < int(1e6 * min(1.0, rows / max(of, 1)))

    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    known = known.where(draw(LABELLED, known.count(), 1)).groupBy("doc_id").agg((1 - F.min("quality")).alias("low_quality"), F.max("toxic").alias("toxic"))
    rows = docs.select("doc_id", "text", "source", "lang")
    # The labels drawn have the bound of the sample, so they may be broadcast.
    drawn = rows.join(F.broadcast(known), "doc_id", "left").where(F.col("low_quality").isNotNull() | F.col("toxic").isNotNull() | draw(POOL, docs.count(), 2))

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [_views(*r) for r in zip(f["text"], f["source"], f["lang"])]
            yield pd.DataFrame({"doc_id": f["doc_id"], "words": [g[0].tobytes() for g in got], "meta": [g[1].tobytes() for g in got], "low_quality": f["low_quality"], "toxic": f["toxic"]})

    return drawn.mapInPandas(features, "doc_id long, words binary, meta binary, low_quality int, toxic int").toArrow().combine_chunks()


def train(docs: DataFrame, labels: DataFrame) -> dict[str, tuple[list[Linear], np.ndarray] | None]:
    """A co-trained model for each head; None where the labels have one class."""
    rows = sample(docs, labels)
    # Many words, so a strong penalty keeps all but the telling ones at zero.
    column = lambda name: pa.concat_arrays(rows.column(name).chunks) if rows.num_rows else pa.array([], pa.binary())
    ids = pc.fill_null(rows.column("doc_id"), -1).to_numpy()
    order = np.lexsort((pc.binary_length(column("words")).to_numpy(zero_copy_only=False), ids))
    views = [View(column(name), order, l1) for name, l1 in (("words", 8.0), ("meta", 1.0))]
    held = mix64(ids[order].astype(np.uint64)) % np.uint64(4) == 3  # by a hash, so that no pattern of ids decides
    return {h: co_train(views, pc.fill_null(rows.column(h), -1).to_numpy().astype(np.int64)[order], held) for h in HEADS}


def probabilities(spark: SparkSession, model: dict[str, tuple[list[Linear], np.ndarray] | None]):
    """A column function of (text, source, lang): the probability of each head."""
    shared = spark.sparkContext.broadcast(model)  # the features of the bounded sample that have a weight

    @F.pandas_udf("low_quality double, toxic double")
    def of(text: pd.Series, source: pd.Series, lang: pd.Series) -> pd.DataFrame:
        out = []
        for r in zip(text, source, lang):
            views, row = _views(*r), []
            for head in HEADS:
                m = shared.value[head]
                if m is None:
                    row.append(0.0)
                    continue
                votes = [linear.margin(x) for linear, x in zip(m[0], views)]
                z = float(m[1] @ np.array([*votes, 1.0]))
                row.append(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))))
            out.append(row)
        return pd.DataFrame(out, columns=list(HEADS), dtype=float)

    return of.asNondeterministic()  # so that a filter on it does not run it twice


def score(docs: DataFrame, model: dict[str, tuple[list[Linear], np.ndarray] | None], name: str = "quality") -> DataFrame:
    """All columns of ``docs`` and one struct ``name`` with the probabilities,
    the score (of being neither) and the verdict ``kept``."""
    p = docs.withColumn(name, probabilities(docs.sparkSession, model)("text", "source", "lang"))
    low, toxic = F.col(f"{name}.low_quality"), F.col(f"{name}.toxic")
    return p.withColumn(
        name,
        F.struct(low.alias("low_quality"), toxic.alias("toxic"), ((1 - low) * (1 - toxic)).alias("score"), ((low < THRESHOLD) & (toxic < THRESHOLD)).alias("kept")),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return score(docs, train(docs, table(spark, sf_dir, "labels"))).select("doc_id", "quality.*")
