"""Queries over the same tables with null keys, groups and partitions, and other
column types than text: every operator follows the SQL rule (a null group is a
group, a null join key matches nothing)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import layout as LY
from ..operators import packing as PK
from ..operators import serving as SV
from ..operators import temporal as TM
from ..session import scratch_path
from ..sources.tables import table
from .common import prep, r6
from .registry import query

# every fifth event has no type, every seventh no user
_NULLS = """WITH ev AS (SELECT event_id, ts, value, CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type,
                   CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id FROM events)
"""


def _events(spark, sf):
    prep(spark)
    ev = table(spark, sf, "events")
    return ev.select("event_id", "ts", "value", F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("event_type"),
                     F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"))


@query("scale_null_groups", _NULLS + """
SELECT event_id,
  round(CASE WHEN max(value) OVER t = min(value) OVER t THEN 0
        ELSE (value - min(value) OVER t) / (max(value) OVER t - min(value) OVER t) END, 6) AS value_mm,
  round(CASE WHEN stddev_pop(value) OVER t = 0 THEN 0
        ELSE (value - avg(value) OVER t) / stddev_pop(value) OVER t END, 6) AS value_z
FROM ev WINDOW t AS (PARTITION BY event_type)""")
def q_scale_null_groups(spark, sf):
    """B03, B04 by a group that may be null."""
    ev = _events(spark, sf)
    g = FT.apply_minmax(ev, FT.fit_minmax(ev, "value", ["event_type"]), "value", "mm", ["event_type"])
    g = FT.apply_standard(g, FT.fit_standard(ev, "value", ["event_type"]), "value", "z", ["event_type"])
    return g.select("event_id", r6("mm").alias("value_mm"), r6("z").alias("value_z"))


@query("onehot_types", """
SELECT event_id, CASE WHEN value > 100 THEN 0 ELSE 1 END AS high_false, CASE WHEN value > 100 THEN 1 ELSE 0 END AS high_true,
  CASE WHEN day(ts) = 1 THEN 1 ELSE 0 END AS "first_2024-01-01", CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS "half_0.00",
  CASE WHEN event_id % 2 = 1 THEN 1 ELSE 0 END AS "half_0.50" FROM events""")
def q_onehot_types(spark, sf):
    """B06 of a boolean, a date (null but on one day) and a decimal column."""
    prep(spark)
    d = table(spark, sf, "events").select(
        "event_id", (F.col("value") > 100).alias("high"), F.when(F.dayofmonth("ts") == 1, F.lit("2024-01-01").cast("date")).alias("first"),
        ((F.col("event_id") % 2) / 2).cast("decimal(3,2)").alias("half"))
    for c in ("high", "first", "half"):
        d = FT.apply_onehot(d, c, FT.fit_onehot(d, c))
    return d.drop("high", "first", "half")


@query("target_enc_nulls", _NULLS + """,
g AS (SELECT avg(value) AS gm FROM ev),
b AS (SELECT event_type, count(value) AS n, avg(value) AS m FROM ev GROUP BY event_type)
SELECT ev.event_id, round((b.n * b.m + 10 * g.gm) / (b.n + 10), 6) AS type_te
FROM ev JOIN b ON ev.event_type IS NOT DISTINCT FROM b.event_type CROSS JOIN g""")
def q_target_enc_nulls(spark, sf):
    """B07 with null as a category."""
    ev = _events(spark, sf)
    enc, glob = FT.fit_target(ev, "event_type", "value", 10.0)
    return FT.apply_target(ev, enc, glob, "event_type", "te").select("event_id", r6("te").alias("type_te"))


@query("days_since_nulls", _NULLS + """
SELECT event_id,
  CAST(floor((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 86400000000) AS BIGINT) AS days_since_prev,
  CAST(floor((epoch_us(ts) - max(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END)
       OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) / 86400000000) AS BIGINT) AS days_since_event
FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def q_days_since_nulls(spark, sf):
    """B10 with a null user."""
    out = TM.days_since(_events(spark, sf), "user_id", "ts", "event_id", "event_type", "purchase", bucket_seconds=3600)
    return out.select("event_id", "days_since_prev", "days_since_event")


@query("pit_null_keys", _NULLS + """,
l AS (SELECT event_id, user_id, ts FROM ev WHERE event_id % 3 = 0),
v AS (SELECT event_id AS fid, user_id, ts AS fts, value FROM ev WHERE event_id % 3 = 1)
SELECT l.event_id, CASE WHEN v.fts >= l.ts - INTERVAL 1 DAY THEN v.fid END AS feature_event_id,
       CASE WHEN v.fts >= l.ts - INTERVAL 1 DAY THEN v.value END AS value
FROM l ASOF LEFT JOIN v ON l.user_id = v.user_id AND l.ts >= v.fts""")
def q_pit_null_keys(spark, sf):
    """B26 with null keys on both sides: they match nothing."""
    ev = _events(spark, sf)
    lab, fea = ev.where("event_id % 3 = 0").select("event_id", "user_id", "ts"), ev.where("event_id % 3 = 1")
    out = SV.asof_features(lab, fea, "user_id", "ts", "ts", 86400, ["value"], "event_id")
    return out.select("event_id", "feature_event_id", "value")


@query("compact_null_partitions", _NULLS + """
SELECT event_type, event_id, value FROM ev""")
def q_compact_null_partitions(spark, sf):
    """B24 of a table with a null partition: every row stays."""
    path, out = scratch_path(spark, "events-small-files"), scratch_path(spark, "events-compacted")
    _events(spark, sf).select("event_id", "value", "event_type").repartition(4).write.partitionBy("event_type").parquet(path)
    LY.compact(spark, path, out, ["event_type"])
    return spark.read.parquet(out).select("event_type", "event_id", "value")


@query("compact_packed", _NULLS + """
SELECT event_type, event_id, value FROM ev""")
def q_compact_packed(spark, sf):
    """B24 in place: small files of each partition, a null one too, are packed by first fit, large ones cut."""
    path = scratch_path(spark, "events-packed")
    _events(spark, sf).select("event_id", "value", "event_type").repartition(12).write.partitionBy("event_type").parquet(path)
    PK.pack_files(spark, path, 1 << 17)
    return spark.read.parquet(path).select("event_type", "event_id", "value")


@query("backfill_emptied", """
WITH d AS (SELECT CAST(min(ts) AS DATE) AS lo FROM events)
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date,
       CASE WHEN CAST(ts AS DATE) BETWEEN lo + 5 AND lo + 9 THEN 2 ELSE 1 END AS run
FROM events, d WHERE CAST(ts AS DATE) NOT IN (lo + 6, lo + 9)""")
def q_backfill_emptied(spark, sf):
    """B17 where two days of the range have no rows any more."""
    prep(spark)
    ev = table(spark, sf, "events")
    lo, hi = ev.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    out, day = scratch_path(spark, "features-emptied"), _dt.timedelta(days=1)
    feats = lambda run: lambda d: d.select("event_id", F.lit(run).alias("run"), F.date_format("ts", "yyyy-MM-dd").alias("date"))
    LY.backfill(ev, feats(1), "ts", lo.isoformat(), hi.isoformat(), out)
    left = ev.where(~F.to_date("ts").isin(lo + 6 * day, lo + 9 * day))
    LY.backfill(left, feats(2), "ts", (lo + 5 * day).isoformat(), (lo + 9 * day).isoformat(), out)
    return spark.read.parquet(out).select("event_id", "date", "run")
