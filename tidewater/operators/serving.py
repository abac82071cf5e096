"""Serving-side tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_features(labels: DataFrame, features: DataFrame, key: str, label_ts: str, feature_ts: str,
                  ttl_seconds: int, feature_cols: list[str], tiebreak: str, sub_buckets: int = 4) -> DataFrame:
    """For each label row, the latest feature row of the same key with
    feature_ts <= label_ts and feature_ts >= label_ts - ttl (no future leak);
    feature columns null when there is none. A null key matches nothing, as in SQL.

    No range join and no window over a whole key: time is cut into buckets
    of width ttl / ``sub_buckets``. A label matches either the latest
    feature at or before it in its own bucket (window over key + bucket) or
    the latest feature of the ``sub_buckets`` buckets before (a per-(key,
    bucket) aggregate, then a range window over bucket numbers of that small
    table, joined back on the unique (key, bucket)); the ttl check decides.
    """
    k = max(1, int(sub_buckets))
    w_us = ttl_seconds * 1_000_000
    b_us = max(1, w_us // k)
    lab = labels.withColumn("__us", F.unix_micros(F.col(label_ts).cast("timestamp")))
    fea = features.where(F.col(key).isNotNull()).select(F.col(key), F.unix_micros(F.col(feature_ts).cast("timestamp")).alias("__us"),
                          F.col(tiebreak).alias("__tb"), *[F.col(c) for c in feature_cols])
    fstruct = F.struct(F.col("__us").alias("f_us"), F.col("__tb").alias("f_tb"),
                       *[F.col(c) for c in feature_cols])
    fea = fea.withColumn("__b", F.floor(F.col("__us") / b_us).cast("bigint"))
    lab = lab.withColumn("__b", F.floor(F.col("__us") / b_us).cast("bigint"))
    ftype = fea.select(fstruct.alias("x")).schema["x"].dataType
    # same bucket: union labels and features, latest feature at or before each label
    lab_u = lab.select(key, "__b", "__us", F.lit(1).alias("__kind"), F.lit(None).cast("bigint").alias("__tb"),
                       F.struct(*[F.col(c) for c in labels.columns]).alias("__label"),
                       F.lit(None).cast(ftype).alias("__f"))
    fea_u = fea.select(key, "__b", "__us", F.lit(0).alias("__kind"), "__tb",
                       F.lit(None).cast(lab_u.schema["__label"].dataType).alias("__label"),
                       fstruct.alias("__f"))
    w = (Window.partitionBy(key, "__b").orderBy("__us", "__kind", "__tb")
         .rowsBetween(Window.unboundedPreceding, 0))
    both = lab_u.unionByName(fea_u).withColumn("__in", F.last("__f", ignorenulls=True).over(w))
    same = both.where(F.col("__kind") == 1).select(key, "__b", "__us", "__label", "__in")
    # earlier buckets: latest feature per (key, bucket), then the latest over
    # the k buckets before each label bucket
    per_b = fea.groupBy(key, "__b").agg(F.max_by(fstruct, F.struct("__us", "__tb")).alias("__bf"))
    lab_b = lab.select(key, "__b").distinct().withColumn("__bf", F.lit(None).cast(ftype))
    grid = per_b.unionByName(lab_b).groupBy(key, "__b").agg(F.max("__bf").alias("__bf"))
    wk = Window.partitionBy(key).orderBy("__b").rangeBetween(-k, -1)
    carry = grid.select(key, "__b", F.max("__bf").over(wk).alias("__pf"))
    j = same.join(carry, [key, "__b"], "left")
    cand = F.coalesce(F.col("__in"), F.col("__pf"))
    ok = cand["f_us"] >= F.col("__us") - F.lit(w_us)
    pick = F.when(ok, cand)
    return j.select("__label.*", pick["f_tb"].alias(f"feature_{tiebreak}"),
                    *[pick[c].alias(c) for c in feature_cols])


def latest_per_entity(df: DataFrame, key: str, ts: str, tiebreak: str, as_of: Column,
                      ttl_seconds: int) -> DataFrame:
    """The latest row per entity with ts in (as_of - ttl, as_of] — the
    online table of a feature view (aggregate, skew-safe)."""
    lo = F.timestamp_seconds(F.unix_seconds(as_of.cast("timestamp")) - F.lit(ttl_seconds))
    t = F.col(ts).cast("timestamp")
    live = df.where((t > lo) & (t <= as_of.cast("timestamp")))
    others = [c for c in df.columns if c != key]
    g = live.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(ts, tiebreak)).alias("__r"))
    return g.select(key, "__r.*")


def fit_linear(df: DataFrame, y: str, x: str) -> DataFrame:
    """B28 fit (one feature, least squares): slope and intercept as one row."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def predict_linear(df: DataFrame, model: DataFrame, x: str, out: str = "prediction") -> DataFrame:
    """B28 apply: the one-row model rides along as a broadcast (bounded)."""
    j = df.crossJoin(F.broadcast(model))
    return j.withColumn(out, F.col("intercept") + F.col("slope") * F.col(x)).drop("slope", "intercept")


def fit_linear_many(df: DataFrame, y: Column | str, xs: list[str]) -> tuple[float, list[float]]:
    """B28 fit, several features (least squares): intercept and coefficients
    from one aggregate of means and covariances; the driver solves a system of
    ``len(xs)`` equations."""
    d = df.select(F.col(y).cast("double").alias("y") if isinstance(y, str) else y.cast("double").alias("y"),
                  *[F.col(x).cast("double").alias(f"x{i}") for i, x in enumerate(xs)]).dropna()
    names = [f"x{i}" for i in range(len(xs))]
    row = d.agg(*[F.avg(c).alias(f"m_{c}") for c in ["y", *names]],
                *[F.covar_pop(a, b).alias(f"c_{a}_{b}") for a in names for b in ["y", *names]]).first()
    if row["m_y"] is None:
        return 0.0, [0.0] * len(xs)
    cov = np.array([[row[f"c_{a}_{b}"] for b in names] for a in names])
    beta = np.linalg.lstsq(cov, np.array([row[f"c_{a}_y"] for a in names]), rcond=None)[0]
    return float(row["m_y"] - sum(b * row[f"m_{c}"] for b, c in zip(beta, names))), [float(b) for b in beta]


def predict_linear_many(df: DataFrame, model: tuple[float, list[float]], xs: list[str], out: str = "prediction") -> DataFrame:
    """B28 apply: intercept + sum of coefficient times feature; null if a feature is."""
    total = F.lit(model[0])
    for b, x in zip(model[1], xs):
        total = total + F.lit(b) * F.col(x)
    return df.withColumn(out, total)


def predict_logistic(df: DataFrame, model: tuple[float, list[float]], xs: list[str], out: str = "prediction") -> DataFrame:
    """B28 apply, logistic: the probability 1 / (1 + exp(-linear))."""
    j = predict_linear_many(df, model, xs, out)
    return j.withColumn(out, 1 / (1 + F.exp(-F.col(out))))


def predict_ml(df: DataFrame, model, features: list[str], out: str = "prediction") -> DataFrame:
    """B28 for fitted ``pyspark.ml`` models: assemble and ``transform``."""
    from pyspark.ml.feature import VectorAssembler
    v = VectorAssembler(inputCols=features, outputCol="__features").transform(df)
    m = model.copy({model.featuresCol: "__features"}) if hasattr(model, "featuresCol") else model
    return m.transform(v).withColumnRenamed(m.getPredictionCol(), out).drop("__features")


def predict_opaque(df: DataFrame, predict_fn, features: list[str], out: str = "prediction") -> DataFrame:
    """B28 for opaque models: ``predict_fn(ndarray[n, k]) -> ndarray[n]`` is
    called on whole Arrow batches through a pandas UDF (vectorised; the model
    object ships once per task with the function)."""
    @F.pandas_udf("double")
    def _score(batch: pd.DataFrame) -> pd.Series:
        x = batch.to_numpy(dtype="float64")
        return pd.Series(np.asarray(predict_fn(x), dtype="float64"))

    return df.withColumn(out, _score(F.struct(*[F.col(c).cast("double") for c in features])))
