"""Monitoring (B29-B31): drift, rolling model quality, pipeline metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPS = 1e-6
DRIFT_ALERT = 0.05
ERROR_RATE_ALERT = 0.01
LATENCY_ALERT_SECONDS = 300


def histogram(df: DataFrame, by: list[str], col: str, lo: float, width: float, bins: int) -> DataFrame:
    b = F.least(F.greatest(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(0)),
                F.lit(bins - 1)).cast("int")
    h = df.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    tot = h.groupBy(*by).agg(F.sum("n").alias("__t"))
    return h.join(tot, by).select(*by, "bin", (F.col("n") / F.col("__t")).alias("p"))


def kl_drift(current: DataFrame, baseline: DataFrame, by: list[str], col: str, lo: float,
             width: float, bins: int, eps: float = EPS) -> DataFrame:
    """KL(P‖Q) of binned current P against baseline Q per group, each
    probability floored at eps; ``alert`` when above the threshold."""
    p = histogram(current, by, col, lo, width, bins).withColumnRenamed("p", "pp")
    q = histogram(baseline, by, col, lo, width, bins).withColumnRenamed("p", "qq")
    j = p.join(q, by + ["bin"], "full_outer")
    pp = F.greatest(F.coalesce("pp", F.lit(0.0)), F.lit(eps))
    qq = F.greatest(F.coalesce("qq", F.lit(0.0)), F.lit(eps))
    kl = j.groupBy(*by).agg(F.sum(pp * F.log(pp / qq)).alias("kl"))
    return kl.withColumn("alert", F.when(F.col("kl") > DRIFT_ALERT, 1).otherwise(0))


def pipeline_metrics(files: DataFrame, window: str = "10 minutes") -> DataFrame:
    """Per tumbling window of arrival and source: files, bytes, error
    rate, p50/p95/p99 arrival→done latency in whole seconds (exact
    percentiles with linear interpolation). Spark's exact percentile keeps
    a count per distinct value, so whole seconds bound each group's buffer
    by the latency range (not by its number of files), merged map-side.

    ``files`` = (received_at, processed_at, source, status, length)."""
    lat = F.when(F.col("status") == "done",
                 F.floor((F.unix_micros("processed_at") - F.unix_micros("received_at")) / 1e6).cast("double"))
    bad = F.col("status").isin("failed", "quarantined").cast("int")
    g = files.groupBy(F.window("received_at", window).alias("w"), "source").agg(
        F.count(F.lit(1)).cast("bigint").alias("files"),
        F.sum("length").cast("bigint").alias("bytes"),
        F.avg(bad).alias("error_rate"),
        F.sum(F.col("status").eqNullSafe("quarantined").cast("int")).cast("bigint").alias("quarantined"),
        F.percentile(lat, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99))).alias("__p"))
    return g.select(F.col("w.start").alias("window_start"), "source", "files", "bytes", "error_rate",
                    "quarantined", F.col("__p")[0].alias("p50"), F.col("__p")[1].alias("p95"),
                    F.col("__p")[2].alias("p99"))


def alerts(metrics: DataFrame) -> DataFrame:
    """One row per (window, source, rule) that breaks its threshold."""
    rules = [
        ("error_rate", F.col("error_rate") > ERROR_RATE_ALERT, F.col("error_rate")),
        ("quarantine", F.col("quarantined") > 0, F.col("quarantined").cast("double")),
        ("latency_p99", F.col("p99") > LATENCY_ALERT_SECONDS, F.col("p99")),
    ]
    arr = F.array(*[F.when(c, F.struct(F.lit(n).alias("rule"), v.alias("observed"))) for n, c, v in rules])
    return (metrics.select("window_start", "source", F.explode(arr).alias("a"))
            .where(F.col("a").isNotNull()).select("window_start", "source", "a.rule", "a.observed"))
