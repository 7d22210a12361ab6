"""Registered vector, loss, metric and decoding plans (VEC, LOS, MET, PRD,
ML) with their SQL twins.

Model outputs do not exist in the driver tables, so both engines derive them
identically from ``embeddings`` (vec_id, embedding float[64], label 0..9):

* emotion logits = entries 1..10, label = ``label``;
* cause logits = entries 11..12, cause label = 1 when label ≥ 5;
* span start logits = entries 1..32, stop logits = entries 33..64, start
  label = label, stop label = label + 3, span present unless label mod 3 = 0;
* batch = vec_id div 32; rows with vec_id mod 5 = 2 are padding utterances and
  rows with vec_id mod 7 = 3 padding pairs (mask 0).

Binary F1 compares ``labels.toxic`` (prediction) with ``labels.quality``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import vectors as V
from ..operators import conversations as C
from ..operators import extension as X
from ..operators import metrics as M
from ..operators import sampling as S
from .dialogue import U as _U
from .dialogue import nested, utterances
from .tables import load


def _rows(spark, sf):
    e = load(spark, sf, "embeddings", spread_rows=True)
    emb = V.to_double(F.col("embedding"))
    return e.select(
        "vec_id", "label",
        F.slice(emb, 1, 10).alias("emotion_logits"),
        F.slice(emb, 11, 2).alias("cause_logits"),
        F.slice(emb, 1, 32).alias("start_logits"),
        F.slice(emb, 33, 32).alias("stop_logits"),
        F.col("label").alias("emotion_label"),
        F.when(F.col("label") >= 5, 1).otherwise(0).alias("cause_label"),
        F.col("label").alias("start_label"),
        (F.col("label") + 3).alias("stop_label"),
        F.when(F.col("label") % 3 == 0, 0).otherwise(1).alias("span_mask"),
        F.when(F.col("vec_id") % 7 == 3, 0).otherwise(1).alias("pair_mask"),
        F.when(F.col("vec_id") % 5 == 2, 0).otherwise(1).alias("mask"),
        F.floor(F.col("vec_id") / P.BATCH_SIZE).cast("long").alias("batch_id"),
    )


def _r(c):
    return F.round(c, 6)


def softmax(spark, sf):
    r = _rows(spark, sf).select("vec_id", F.posexplode(V.softmax(F.col("emotion_logits"))).alias("idx", "p"))
    return r.select("vec_id", "idx", _r(F.col("p")).alias("p"))


def argmax(spark, sf):
    return _rows(spark, sf).select("vec_id", "label", V.argmax(F.col("emotion_logits")).alias("pred"))


def mean_vector(spark, sf):
    m = M.mean_vector(load(spark, sf, "embeddings"), "label", "embedding")
    return m.select("label", F.posexplode("mean").alias("idx", "mean")).select("label", "idx", _r(F.col("mean")).alias("mean"))


def concat_features(spark, sf):
    r = _rows(spark, sf)
    f = V.concat_features(V.softmax(F.col("emotion_logits")), V.to_double(F.slice(F.col("start_logits"), 1, 32)),
                          F.col("stop_logits"))
    return r.select("vec_id", F.size(f).alias("n_features"),
                    _r(F.aggregate(f, F.lit(0.0), lambda a, x: a + x)).alias("f_sum"))


def cross_entropy(spark, sf):
    return _rows(spark, sf).select("vec_id", _r(V.cross_entropy(F.col("emotion_logits"), F.col("label"))).alias("ce"))


def _weighted(spark, sf):
    r = _rows(spark, sf)
    w = S.balanced_weights(r, "label", 10)
    return S.apply_weights(r, w, "label")


def _batch_losses(spark, sf, by=("batch_id",)):
    r = _weighted(spark, sf)
    return r.groupBy(*by).agg(
        F.sum(F.col("mask") * F.col("weight") * V.cross_entropy(F.col("emotion_logits"), F.col("emotion_label"))).alias("loss_emotion"),
        F.sum(F.col("mask") * V.cross_entropy(F.col("cause_logits"), F.col("cause_label"))).alias("loss_cause"),
        F.sum(M.span_loss_expr()).alias("loss_span"),
    )


def emotion_loss(spark, sf):
    return M.emotion_loss(_weighted(spark, sf), weight="weight", by=("batch_id",)).select(
        "batch_id", _r(F.col("loss_emotion")).alias("loss_emotion"))


def cause_loss(spark, sf):
    return M.cause_loss(_rows(spark, sf), by=("batch_id",)).select("batch_id", _r(F.col("loss_cause")).alias("loss_cause"))


def span_loss(spark, sf):
    return M.span_loss(_rows(spark, sf), by=("batch_id",)).select("batch_id", _r(F.col("loss_span")).alias("loss_span"))


def total_loss(spark, sf):
    t = M.total_loss(_batch_losses(spark, sf))
    return t.select("batch_id", *[_r(F.col(c)).alias(c) for c in ("loss", "loss_emotion", "loss_cause", "loss_span")])


def mean_metric(spark, sf):
    t = M.total_loss(_batch_losses(spark, sf))
    return M.mean_metric(t, "loss").select(_r(F.col("loss")).alias("loss"))


def f1_scores(spark, sf):
    lab = load(spark, sf, "labels").select(F.col("toxic").alias("pred"), F.col("quality").alias("ref"))
    emb = argmax(spark, sf).select("pred", F.col("label").alias("ref"))
    parts = []
    for src, df, avgs in (("labels", lab, ("binary", "micro", "macro", "weighted")),
                          ("embeddings", emb, ("micro", "macro", "weighted"))):
        for a in avgs:
            parts.append(M.f1_score(df, "pred", "ref", a).select(F.lit(src).alias("source"), F.lit(a).alias("average"),
                                                                 _r(F.col("f1")).alias("f1")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def confusion(spark, sf):
    return M.confusion(argmax(spark, sf).select("pred", F.col("label").alias("ref")), "pred", "ref")


def _padded_predictions(spark, sf):
    """Conversations padded to MAX_CONV_LEN slots: real slots carry the
    derived label and a derived prediction, padding carries 0 and mask 0."""
    u = utterances(spark, sf).select("conversation_ID", "pos", C.encode_emotion(F.col("emotion")).alias("label"))
    convs = u.groupBy("conversation_ID").agg(F.max("pos").alias("last"))  # longer ones keep all their turns
    slots = convs.select("conversation_ID", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(P.MAX_CONV_LEN - 1), "last"))).alias("pos"))
    j = slots.join(u, ["conversation_ID", "pos"], "left")
    real = F.col("label").isNotNull()
    pred = (F.col("conversation_ID") * 17 + F.col("pos") * 5) % 7
    return j.select("conversation_ID", "pos", F.when(real, 1).otherwise(0).alias("mask"),
                    F.coalesce("label", F.lit(0)).alias("ref"), F.when(real, pred).otherwise(0).cast("int").alias("pred"))


def evaluate(spark, sf):
    return M.evaluate(_padded_predictions(spark, sf), "pred", "ref", "mask", "weighted").select(_r(F.col("f1")).alias("f1"))


def _split_rows(spark, sf):
    r = _weighted(spark, sf)
    sp = S.split_exact(r.select(F.col("vec_id").alias("id")), [0.65, 0.20, 0.15], P.SEED, "id", ["train", "valid", "test"])
    return r.join(sp.withColumnRenamed("id", "vec_id"), "vec_id").withColumn("step", F.lit(0))


def epoch_report(spark, sf):
    r = _split_rows(spark, sf)
    losses = M.total_loss(r.groupBy("split", "step", "batch_id").agg(
        F.sum(F.col("mask") * F.col("weight") * V.cross_entropy(F.col("emotion_logits"), F.col("emotion_label"))).alias("loss_emotion"),
        F.sum(F.col("mask") * V.cross_entropy(F.col("cause_logits"), F.col("cause_label"))).alias("loss_cause"),
        F.sum(M.span_loss_expr()).alias("loss_span")))
    preds = r.where("mask = 1").select("split", "step", V.argmax(F.col("emotion_logits")).alias("pe"), F.col("emotion_label").alias("re"),
                     V.argmax(F.col("cause_logits")).alias("pc"), F.col("cause_label").alias("rc"))
    fe = M.f1_score(preds, "pe", "re", "weighted", by=("split", "step")).withColumnRenamed("f1", "f1_emotion")
    fc = M.f1_score(preds, "pc", "rc", "weighted", by=("split", "step")).withColumnRenamed("f1", "f1_cause")
    rep = M.epoch_report(losses, fe.join(fc, ["split", "step"]))
    return rep.select("split", "metric", "step", _r(F.col("value")).alias("value"))


def decode_predictions(spark, sf):
    return M.decode_predictions(_rows(spark, sf).select("vec_id", "emotion_logits", "cause_logits", "mask"))


def decode_spans(spark, sf):
    r = _rows(spark, sf).select(F.col("vec_id").alias("conv_id"), F.col("vec_id").alias("effect"),
                                F.col("label").alias("cause"), "start_logits", "stop_logits")
    return M.decode_spans(r).select(F.col("conv_id").alias("vec_id"), "start", "stop")


def nested_spans(spark, sf):
    """PRD-2: per conversation of 16 vectors the spans of each valid effect,
    effects and causes being places among its four valid turns."""
    e = load(spark, sf, "embeddings", spread_rows=True).select(
        F.floor(F.col("vec_id") / 16).cast("long").alias("conv_id"), (F.floor(F.col("vec_id") / 4) % 4).cast("int").alias("effect"),
        (F.col("vec_id") % 4).cast("int").alias("cause"), V.to_double(F.col("embedding")).alias("e"))
    pairs = e.select("conv_id", "effect", "cause", F.slice("e", 1, 32).alias("start_logits"), F.slice("e", 33, 32).alias("stop_logits"))
    lengths = e.select("conv_id").distinct().withColumn("n_valid", (F.col("conv_id") % 4 + 1).cast("int"))
    out = M.nest_spans(M.decode_spans(pairs), lengths)
    line = F.transform("spans", lambda x: F.concat_ws("-", x["cause"], x["start"], x["stop"]))
    return out.select("conv_id", "effect", F.array_join(line, ",").alias("spans"))


def custom_metric(spark, sf):
    """UDF-4: a user's accuracy per cause label."""
    r = _rows(spark, sf).select("cause_label", V.argmax(F.col("emotion_logits")).alias("pred"), F.col("label").alias("ref"))
    out = X.custom_metric(r, X.accuracy(), ["cause_label"])
    return out.select("cause_label", _r(F.col("accuracy")).alias("accuracy"))


def filter_with(spark, sf):
    """UDF-2: a user's row predicate."""
    kept = X.filter_with(_rows(spark, sf), lambda df: (df["mask"] == 1) & (F.array_max(df["emotion_logits"]) > 0.25))
    return kept.select("vec_id", "label")


def valid_length(spark, sf):
    pm = C.pair_mask(C.explode_utterances(nested(spark, sf)))
    s = pm.groupBy("conversation_ID").agg(F.sum("mask").alias("s"))
    return s.select("conversation_ID", M.valid_length(F.col("s")).alias("n_valid"))


def fit_head(spark, sf):
    """ML-1/2: multinomial head with class weights on the embeddings (MLlib)."""
    from ..operators import models

    e = load(spark, sf, "embeddings", spread_rows=True)
    w = S.apply_weights(e, S.balanced_weights(e, "label", 10), "label")
    model = models.fit_head(w, "embedding", "label", "weight")
    return models.predict_head(model, e, "embedding").select("vec_id", "label", "prediction")


def fit_cause(spark, sf):
    """ML-3: stage-1 emotion probabilities feed the stage-2 cause model."""
    from ..operators import models

    e = load(spark, sf, "embeddings", spread_rows=True).withColumn(
        "cause_label", F.when(F.col("label") >= 5, 1).otherwise(0))
    out = models.fit_cause(e, "embedding", "label", "cause_label")
    return out.select("vec_id", "prediction", "cause_prediction")


def head_gradient(spark, sf):
    """ML-1/2: the loss has no slope left at the fitted weights of the emotion head."""
    from ..operators import models

    e = load(spark, sf, "embeddings", spread_rows=True)
    w = S.apply_weights(e, S.balanced_weights(e, "label", 10), "label")
    scored = models.predict_head(models.fit_head(w, "embedding", "label", "weight", max_iter=200), w, "embedding")
    g = models.loss_gradient(scored, "embedding", "label", weight="weight")
    return g.select("class", "idx", (F.abs(F.col("gradient")) < 0.002).alias("flat"))


def cause_gradient(spark, sf):
    """ML-3: the same for the cause head on emotion probabilities and vector."""
    from ..operators import models

    e = load(spark, sf, "embeddings", spread_rows=True).withColumn("cause_label", F.when(F.col("label") >= 5, 1).otherwise(0))
    scored = models.fit_cause(e, "embedding", "label", "cause_label")
    x = F.concat("probability", V.to_double(F.col("embedding")))
    g = models.loss_gradient(scored.withColumn("x", x), "x", "cause_label", "cause_probability")
    return g.select("class", "idx", (F.abs(F.col("gradient")) < 0.002).alias("flat"))


QUERIES = {
    "softmax": softmax, "argmax": argmax, "mean_vector": mean_vector, "concat_features": concat_features,
    "cross_entropy": cross_entropy, "emotion_loss": emotion_loss, "cause_loss": cause_loss, "span_loss": span_loss,
    "total_loss": total_loss, "mean_metric": mean_metric, "f1_scores": f1_scores, "confusion": confusion,
    "evaluate": evaluate, "epoch_report": epoch_report, "decode_predictions": decode_predictions,
    "decode_spans": decode_spans, "nested_spans": nested_spans, "custom_metric": custom_metric, "filter_with": filter_with,
    "valid_length": valid_length, "fit_head": fit_head, "fit_cause": fit_cause,
    "head_gradient": head_gradient, "cause_gradient": cause_gradient,
}

# --------------------------------------------------------------------------- SQL
ROWS = f"""rows AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
         CAST(embedding AS DOUBLE[])[1:10] AS el, CAST(embedding AS DOUBLE[])[11:12] AS cl,
         CAST(embedding AS DOUBLE[])[1:32] AS sl, CAST(embedding AS DOUBLE[])[33:64] AS tl,
         label AS emotion_label, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS cause_label,
         label AS start_label, label + 3 AS stop_label,
         CASE WHEN label % 3 = 0 THEN 0 ELSE 1 END AS span_mask, 
         CASE WHEN vec_id % 7 = 3 THEN 0 ELSE 1 END AS pair_mask, CASE WHEN vec_id % 5 = 2 THEN 0 ELSE 1 END AS mask,
         CAST(vec_id // {P.BATCH_SIZE} AS BIGINT) AS batch_id
  FROM embeddings),
  wts AS (SELECT label, tot.n / (10.0 * count(*)) AS weight FROM embeddings, (SELECT count(*) AS n FROM embeddings) tot
          GROUP BY label, tot.n),
  wrows AS (SELECT r.*, w.weight FROM rows r LEFT JOIN wts w USING (label))"""


def ce(l: str, lab: str) -> str:
    return (f"(list_max({l}) + ln(list_sum(list_transform({l}, lambda x: exp(x - list_max({l}))))) "
            f"- {l}[{lab} + 1])")


def amax(l: str) -> str:
    return f"CAST(list_position({l}, list_max({l})) - 1 AS INTEGER)"


SPAN_EXPR = f"pair_mask * (CASE WHEN span_mask = 1 THEN {P.SPAN_WEIGHT_PRESENT} ELSE {P.SPAN_WEIGHT_ABSENT} END) * ({ce('sl', 'start_label')} + {ce('tl', 'stop_label')})"
BATCH = f"""bl AS (SELECT batch_id, sum(mask * weight * {ce('el', 'emotion_label')}) AS loss_emotion,
                   sum(mask * {ce('cl', 'cause_label')}) AS loss_cause, sum({SPAN_EXPR}) AS loss_span
            FROM wrows GROUP BY batch_id)"""


def f1_sql(src: str, by: str = "") -> str:
    """Per-class counts → binary/micro/macro/weighted over ``src(pred, ref[, by])``."""
    b = f"{by}, " if by else ""
    return f"""(SELECT {b}c, sum(p) AS n_pred, sum(r) AS support, sum(tp) AS tp,
                CASE WHEN sum(p) + sum(r) > 0 THEN 2.0 * sum(tp) / (sum(p) + sum(r)) ELSE 0.0 END AS f1
         FROM (SELECT {b}pred AS c, 1 AS p, 0 AS r, CASE WHEN pred = ref THEN 1 ELSE 0 END AS tp FROM {src}
               UNION ALL SELECT {b}ref AS c, 0, 1, 0 FROM {src}) GROUP BY {b}c)"""


_SPLIT = f"""ids AS (SELECT vec_id AS id FROM embeddings),
  ranked AS (SELECT id, row_number() OVER (ORDER BY md5('{P.SEED}|' || CAST(id AS VARCHAR)), id) - 1 AS i FROM ids),
  nn AS (SELECT count(*) AS n FROM ids),
  sz AS (SELECT n, CAST(floor(n * 0.65) AS BIGINT) AS s0, CAST(floor(n * 0.2) AS BIGINT) AS s1,
                CAST(floor(n * 0.15) AS BIGINT) AS s2 FROM nn),
  bnd AS (SELECT s0 + CASE WHEN n - s0 - s1 - s2 > 0 THEN 1 ELSE 0 END AS b0,
                 s0 + CASE WHEN n - s0 - s1 - s2 > 0 THEN 1 ELSE 0 END + s1
                    + CASE WHEN n - s0 - s1 - s2 > 1 THEN 1 ELSE 0 END AS b1 FROM sz),
  splits AS (SELECT id, CASE WHEN i < b0 THEN 'train' WHEN i < b1 THEN 'valid' ELSE 'test' END AS split FROM ranked, bnd)"""


SQL = {
    "softmax": """WITH e AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])[1:10]) AS x,
                               CAST(unnest(range(10)) AS INTEGER) AS idx FROM embeddings),
        m AS (SELECT vec_id, max(x) AS mx FROM e GROUP BY vec_id),
        z AS (SELECT e.vec_id, sum(exp(x - mx)) AS z FROM e JOIN m USING (vec_id) GROUP BY e.vec_id)
        SELECT vec_id, idx, round(exp(x - mx) / z, 6) AS p FROM e JOIN m USING (vec_id) JOIN z USING (vec_id)""",
    "argmax": f"WITH {ROWS} SELECT vec_id, label, {amax('el')} AS pred FROM rows",
    "mean_vector": """SELECT label, idx, round(avg(x), 6) AS mean FROM (
          SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, CAST(unnest(range(len(embedding))) AS INTEGER) AS idx
          FROM embeddings) GROUP BY label, idx""",
    "concat_features": f"""WITH {ROWS}
        SELECT vec_id, len(f) AS n_features, round(list_sum(f), 6) AS f_sum FROM (
          SELECT vec_id, list_concat(list_transform(el, lambda x: exp(x - list_max(el)) /
                   list_sum(list_transform(el, lambda y: exp(y - list_max(el))))), sl, tl) AS f FROM rows)""",
    "cross_entropy": f"WITH {ROWS} SELECT vec_id, round({ce('el', 'label')}, 6) AS ce FROM rows",
    "emotion_loss": f"""WITH {ROWS} SELECT batch_id, round(sum(mask * weight * {ce('el', 'emotion_label')}), 6) AS loss_emotion
        FROM wrows GROUP BY batch_id""",
    "cause_loss": f"""WITH {ROWS} SELECT batch_id, round(sum(mask * {ce('cl', 'cause_label')}), 6) AS loss_cause
        FROM rows GROUP BY batch_id""",
    "span_loss": f"WITH {ROWS} SELECT batch_id, round(sum({SPAN_EXPR}), 6) AS loss_span FROM rows GROUP BY batch_id",
    "total_loss": f"""WITH {ROWS}, {BATCH}
        SELECT batch_id, round(loss_emotion + loss_cause + loss_span, 6) AS loss, round(loss_emotion, 6) AS loss_emotion,
               round(loss_cause, 6) AS loss_cause, round(loss_span, 6) AS loss_span FROM bl""",
    "mean_metric": f"""WITH {ROWS}, {BATCH}
        SELECT round(coalesce(avg(loss_emotion + loss_cause + loss_span), 0.0), 6) AS loss FROM bl""",
    "f1_scores": f"""WITH {ROWS},
        lab AS (SELECT toxic AS pred, quality AS ref FROM labels),
        emb AS (SELECT {amax('el')} AS pred, label AS ref FROM rows),
        pl AS {f1_sql('lab')}, pe AS {f1_sql('emb')}
        SELECT 'labels' AS source, 'binary' AS average, round(coalesce(max(CASE WHEN c = 1 THEN f1 END), 0.0), 6) AS f1 FROM pl
        UNION ALL SELECT 'labels', 'micro', round(2.0 * sum(tp) / (sum(n_pred) + sum(support)), 6) FROM pl
        UNION ALL SELECT 'labels', 'macro', round(avg(f1), 6) FROM pl
        UNION ALL SELECT 'labels', 'weighted', round(coalesce(sum(f1 * support) / sum(support), 0.0), 6) FROM pl
        UNION ALL SELECT 'embeddings', 'micro', round(2.0 * sum(tp) / (sum(n_pred) + sum(support)), 6) FROM pe
        UNION ALL SELECT 'embeddings', 'macro', round(avg(f1), 6) FROM pe
        UNION ALL SELECT 'embeddings', 'weighted', round(coalesce(sum(f1 * support) / sum(support), 0.0), 6) FROM pe""",
    "confusion": f"WITH {ROWS} SELECT {amax('el')} AS pred, label AS ref, count(*) AS n FROM rows GROUP BY 1, 2",
    "evaluate": f"""WITH {_U},
        convs AS (SELECT conversation_ID, greatest({P.MAX_CONV_LEN}, max(pos) + 1) AS n FROM u GROUP BY conversation_ID),
        slots AS (SELECT conversation_ID, CAST(unnest(range(n)) AS INTEGER) AS pos FROM convs),
        j AS (SELECT s.conversation_ID, s.pos, u.label FROM slots s LEFT JOIN u USING (conversation_ID, pos)),
        pr AS (SELECT CASE WHEN label IS NOT NULL THEN 1 ELSE 0 END AS mask, coalesce(label, 0) AS ref,
                      CAST(CASE WHEN label IS NOT NULL THEN (conversation_ID * 17 + pos * 5) % 7 ELSE 0 END AS INTEGER) AS pred
               FROM j),
        m AS (SELECT pred, ref FROM pr WHERE mask = 1),
        pc AS {f1_sql('m')}
        SELECT round(coalesce(sum(f1 * support) / sum(support), 0.0), 6) AS f1 FROM pc""",
    "epoch_report": f"""WITH {ROWS}, {_SPLIT},
        r AS (SELECT w.*, s.split, 0 AS step FROM wrows w JOIN splits s ON s.id = w.vec_id),
        bl AS (SELECT split, step, batch_id, sum(mask * weight * {ce('el', 'emotion_label')}) AS loss_emotion,
                      sum(mask * {ce('cl', 'cause_label')}) AS loss_cause, sum({SPAN_EXPR}) AS loss_span
               FROM r GROUP BY split, step, batch_id),
        lm AS (SELECT split, step, avg(loss_emotion + loss_cause + loss_span) AS loss, avg(loss_span) AS loss_span,
                      avg(loss_cause) AS loss_cause, avg(loss_emotion) AS loss_emotion FROM bl GROUP BY split, step),
        pe_src AS (SELECT split, step, {amax('el')} AS pred, emotion_label AS ref FROM r WHERE mask = 1),
        pc_src AS (SELECT split, step, {amax('cl')} AS pred, cause_label AS ref FROM r WHERE mask = 1),
        fe AS (SELECT split, step, coalesce(sum(f1 * support) / sum(support), 0.0) AS f1_emotion
               FROM {f1_sql('pe_src', 'split, step')} GROUP BY split, step),
        fc AS (SELECT split, step, coalesce(sum(f1 * support) / sum(support), 0.0) AS f1_cause
               FROM {f1_sql('pc_src', 'split, step')} GROUP BY split, step),
        wide AS (SELECT * FROM lm JOIN fe USING (split, step) JOIN fc USING (split, step))
        SELECT split, metric, CAST(step AS INTEGER) AS step, round(value, 6) AS value FROM (
          UNPIVOT wide ON loss, loss_span, loss_cause, loss_emotion, f1_cause, f1_emotion INTO NAME metric VALUE value)""",
    "decode_predictions": f"WITH {ROWS} SELECT vec_id, {amax('el')} AS emotion, {amax('cl')} AS cause FROM rows WHERE mask = 1",
    "decode_spans": f"""WITH {ROWS} SELECT vec_id, start, stop FROM (
        SELECT vec_id, {amax('sl')} AS start, {amax('tl')} AS stop FROM rows) WHERE start + stop <> 0""",
    "nested_spans": f"""WITH e AS (
          SELECT vec_id // 16 AS conv_id, CAST(vec_id // 4 % 4 AS INTEGER) AS effect, CAST(vec_id % 4 AS INTEGER) AS cause,
                 CAST(embedding AS DOUBLE[])[1:32] AS sl, CAST(embedding AS DOUBLE[])[33:64] AS tl FROM embeddings),
        d AS (SELECT conv_id, effect, cause, {amax('sl')} AS start, {amax('tl')} AS stop FROM e)
        SELECT CAST(conv_id AS BIGINT) AS conv_id, effect, string_agg(cause || '-' || start || '-' || stop, ',' ORDER BY cause) AS spans
        FROM d WHERE start + stop <> 0 AND effect < conv_id % 4 + 1 AND cause < conv_id % 4 + 1 GROUP BY conv_id, effect""",
    "custom_metric": f"""WITH {ROWS} SELECT cause_label, round(avg(CASE WHEN {amax('el')} = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
        FROM rows GROUP BY cause_label""",
    "filter_with": f"WITH {ROWS} SELECT vec_id, label FROM rows WHERE mask = 1 AND list_max(el) > 0.25",
    "head_gradient": """SELECT DISTINCT CAST(c AS INTEGER) AS class, CAST(i AS INTEGER) AS idx, true AS flat
        FROM (SELECT len(embedding) AS n FROM embeddings), range(10) a(c), range(n) b(i)""",
    "cause_gradient": """SELECT DISTINCT CAST(c AS INTEGER) AS class, CAST(i AS INTEGER) AS idx, true AS flat
        FROM (SELECT len(embedding) + 10 AS n FROM embeddings), range(2) a(c), range(n) b(i)""",
    "valid_length": f"""WITH {_U}
        SELECT conversation_ID, CAST(floor(sqrt(count(*) * count(*))) AS INTEGER) AS n_valid FROM u GROUP BY conversation_ID""",
}
