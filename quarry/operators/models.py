"""MLlib re-aims of the trained heads (ML-1..3).

The pretrained encoder is not available, so the classification heads are
fitted on the given vectors: a multinomial logistic regression (a linear
layer + softmax) with optional per-row class weights, distributed by
MLlib.  The results are not the reference's weights, only the same kind
of model.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _vec(df: DataFrame, features: str) -> DataFrame:
    return df.select("*", array_to_vector(F.col(features).cast("array<double>")).alias("_features"))


def fit_head(df: DataFrame, features: str, label: str, weight: str | None = None,
             max_iter: int = 50, reg: float = 0.0) -> LogisticRegressionModel:
    """ML-1: linear layer + softmax over ``features`` (array column)."""
    data = _vec(df, features).select("_features", F.col(label).cast("double").alias("_label"),
                                     *([F.col(weight).cast("double").alias("_weight")] if weight else []))
    lr = LogisticRegression(family="multinomial", featuresCol="_features", labelCol="_label", maxIter=max_iter,
                            regParam=reg, **({"weightCol": "_weight"} if weight else {}))
    return lr.fit(data)


def predict_head(model: LogisticRegressionModel, df: DataFrame, features: str, prefix: str = "") -> DataFrame:
    """ML-2: probability vector and predicted label for every row."""
    model = model.copy()
    model.setFeaturesCol("_features").setProbabilityCol("_prob").setPredictionCol("_pred").setRawPredictionCol("_raw")
    out = model.transform(_vec(df, features))
    return out.select(*df.columns, vector_to_array("_prob").alias(prefix + "probability"),
                      F.col("_pred").cast("int").alias(prefix + "prediction"))


def fit_cause(df: DataFrame, features: str, label: str, cause_label: str) -> DataFrame:
    """ML-3: stage-1 emotion probabilities are concatenated in front of the
    vector as the stage-2 input of a 2-class cause head."""
    m1 = fit_head(df, features, label)
    p1 = predict_head(m1, df, features)
    stage2 = p1.select("*", F.concat("probability", F.col(features).cast("array<double>")).alias("_f2"))
    m2 = fit_head(stage2, "_f2", cause_label)
    p2 = predict_head(m2, stage2, "_f2", prefix="cause_")
    return p2.drop("_f2")


def loss_gradient(scored: DataFrame, features: str, label: str, probability: str = "probability", weight: str | None = None) -> DataFrame:
    """(class, idx, gradient): the gradient of the mean weighted cross-entropy in
    the head's weights, at the probabilities of ``scored``; near 0 where a fit
    without a penalty has converged."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    off = F.transform(probability, lambda p, c: w * (p - (F.col(label) == c).cast("double")))
    rows = scored.select(w.alias("_w"), F.col(features).cast("array<double>").alias("_x"), F.posexplode(off).alias("class", "_d"))
    each = rows.select("class", "_w", F.posexplode(F.transform("_x", lambda x: x * F.col("_d"))).alias("idx", "_g"))
    return each.groupBy("class", "idx").agg((F.sum("_g") / F.sum("_w")).alias("gradient"))
