"""Losses, metrics and decoding (VEC-3, LOS-1..4, MET-1..5, PRD-1..3).

Every metric is an aggregate expression (one pass, partial aggregation
before the shuffle); F1 is computed from per-class confusion counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import vectors as V


def mean_vector(df: DataFrame, key: str, vec: str, mask: str | None = None) -> DataFrame:
    """VEC-3: per key, the mean vector over rows (optionally only masked
    rows): positions are exploded, averaged per (key, index) and gathered
    back in index order."""
    src = df.where(F.col(mask) == 1) if mask else df
    e = src.select(key, F.posexplode(vec).alias("i", "v"))
    m = e.groupBy(key, "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    g = m.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("s"))
    return g.select(key, F.transform("s", lambda x: x["v"]).alias("mean"))


def emotion_loss(df: DataFrame, logits="emotion_logits", label="emotion_label", mask="mask",
                 weight: str | None = None, by=()) -> DataFrame:
    """LOS-1: Σ mask · weight · CE (a sum, not a mean); weight 1 unless given."""
    w = F.col(weight) if weight else F.lit(1.0)
    ce = V.cross_entropy(F.col(logits), F.col(label))
    return df.groupBy(*by).agg(F.sum(F.col(mask) * w * ce).alias("loss_emotion"))


def cause_loss(df: DataFrame, logits="cause_logits", label="cause_label", mask="mask", by=()) -> DataFrame:
    """LOS-2: Σ mask · CE, unweighted."""
    ce = V.cross_entropy(F.col(logits), F.col(label))
    return df.groupBy(*by).agg(F.sum(F.col(mask) * ce).alias("loss_cause"))


def span_loss_expr(start_logits="start_logits", stop_logits="stop_logits", start="start_label",
                   stop="stop_label", span_mask="span_mask", pair_mask="pair_mask") -> Column:
    w = F.when(F.col(span_mask) == 1, F.lit(P.SPAN_WEIGHT_PRESENT)).otherwise(F.lit(P.SPAN_WEIGHT_ABSENT))
    ce = V.cross_entropy(F.col(start_logits), F.col(start)) + V.cross_entropy(F.col(stop_logits), F.col(stop))
    return F.col(pair_mask) * w * ce


def span_loss(pairs: DataFrame, by=(), **cols) -> DataFrame:
    """LOS-3: per pair 0.75 (span present) or 0.25, × pair mask, start + stop CE."""
    return pairs.groupBy(*by).agg(F.sum(span_loss_expr(**cols)).alias("loss_span"))


def total_loss(parts: DataFrame) -> DataFrame:
    """LOS-4: the three components and their sum."""
    return parts.select("*", (F.col("loss_emotion") + F.col("loss_cause") + F.col("loss_span")).alias("loss"))


def mean_metric(df: DataFrame, value: str, by=()) -> DataFrame:
    """MET-1: mean of per-batch values; no values → 0.0."""
    return df.groupBy(*by).agg(F.coalesce(F.avg(value), F.lit(0.0)).alias(value))


def confusion(df: DataFrame, pred: str = "pred", ref: str = "ref", by=()) -> DataFrame:
    """MET-3: counts per (prediction, reference)."""
    return df.groupBy(*by, pred, ref).agg(F.count(F.lit(1)).alias("n"))


def f1_score(df: DataFrame, pred: str = "pred", ref: str = "ref", average: str = "weighted", by=()) -> DataFrame:
    """MET-2: binary / micro / macro / weighted F1 (an undefined class
    scores 0; weighted by reference support).  Classes are the labels
    seen in either column."""
    by = list(by)
    preds = df.select(*by, F.col(pred).alias("c"), F.lit(1).alias("p"), F.lit(0).alias("r"), (F.col(pred) == F.col(ref)).cast("int").alias("tp"))
    refs = df.select(*by, F.col(ref).alias("c"), F.lit(0).alias("p"), F.lit(1).alias("r"), F.lit(0).alias("tp"))
    per = preds.unionByName(refs).groupBy(*by, "c").agg(
        F.sum("p").alias("n_pred"), F.sum("r").alias("support"), F.sum("tp").alias("tp"))
    f1c = F.when(F.col("n_pred") + F.col("support") > 0,
                 2.0 * F.col("tp") / (F.col("n_pred") + F.col("support"))).otherwise(F.lit(0.0))
    per = per.select("*", f1c.alias("f1"))
    if average == "binary":
        return per.groupBy(*by).agg(F.coalesce(F.max(F.when(F.col("c") == 1, F.col("f1"))), F.lit(0.0)).alias("f1"))
    if average == "micro":
        return per.groupBy(*by).agg((2.0 * F.sum("tp") / (F.sum("n_pred") + F.sum("support"))).alias("f1"))
    if average == "macro":
        return per.groupBy(*by).agg(F.avg("f1").alias("f1"))
    if average == "weighted":
        return per.groupBy(*by).agg(
            F.coalesce(F.sum(F.col("f1") * F.col("support")) / F.sum("support"), F.lit(0.0)).alias("f1"))
    raise ValueError(f"unknown average: {average}")


def evaluate(df: DataFrame, pred: str, ref: str, mask: str = "mask", average: str = "weighted", by=()) -> DataFrame:
    """MET-4: F1 over real (masked-in) utterances only."""
    return f1_score(df.where(F.col(mask) == 1), pred, ref, average, by)


def epoch_report(losses: DataFrame, f1s: DataFrame, split_col: str = "split", step_col: str = "step") -> DataFrame:
    """MET-5: long table (split, metric, step, value) — losses are means of
    batch values, F1 over all utterances of the split."""
    lm = losses.groupBy(split_col, step_col).agg(
        *[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in ("loss", "loss_span", "loss_cause", "loss_emotion")])
    wide = lm.join(f1s, [split_col, step_col], "full")
    metrics = ["loss", "loss_span", "loss_cause", "loss_emotion", "f1_cause", "f1_emotion"]
    long = wide.unpivot([split_col, step_col], metrics, "metric", "value")
    return long.select(F.col(split_col).alias("split"), "metric", F.col(step_col).cast("int").alias("step"),
                       F.col("value").cast("double").alias("value"))


def decode_predictions(df: DataFrame, emotion_logits="emotion_logits", cause_logits="cause_logits", mask="mask") -> DataFrame:
    """PRD-1: argmax emotion and cause for valid utterances."""
    return df.where(F.col(mask) == 1).select(
        *[c for c in df.columns if c not in (emotion_logits, cause_logits, mask)],
        V.argmax(F.col(emotion_logits)).alias("emotion"), V.argmax(F.col(cause_logits)).alias("cause"))


def decode_spans(pairs: DataFrame, key: str = "conv_id", start_logits="start_logits", stop_logits="stop_logits") -> DataFrame:
    """PRD-2: (effect, cause, start, stop) where start + stop ≠ 0, for pairs
    of valid turns."""
    s = pairs.select(key, "effect", "cause", V.argmax(F.col(start_logits)).alias("start"),
                     V.argmax(F.col(stop_logits)).alias("stop"))
    return s.where(F.col("start") + F.col("stop") != 0)


def nest_spans(spans: DataFrame, lengths: DataFrame, key: str = "conv_id") -> DataFrame:
    """PRD-2, nested: (key, effect, spans) with the (cause, start, stop) of each
    effect utterance in the order of the causes; turns from ``n_valid`` on
    (``lengths``) are padding.  Effects without a span have no row."""
    real = spans.join(lengths.select(key, "n_valid"), key).where((F.col("effect") < F.col("n_valid")) & (F.col("cause") < F.col("n_valid")))
    return real.groupBy(key, "effect").agg(F.array_sort(F.collect_list(F.struct("cause", "start", "stop"))).alias("spans"))


def valid_length(pair_mask_sum: Column) -> Column:
    """PRD-3: √Σ(pair mask) = number of valid turns."""
    return F.floor(F.sqrt(pair_mask_sum)).cast("int")
