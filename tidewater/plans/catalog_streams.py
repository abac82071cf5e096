"""Streaming forms of time features: the events arrive shuffled, some late.

The stand-in input deals the events to bands of five days by their time and a delay of up to
a day, every fiftieth event to a band after all others. Bands are written one after another,
so a file stream gives them in that order. Two rows far in the future end the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators.ingest import IngestTables, read_processed
from ..session import scratch_path
from ..sources import landing as LD
from ..sources.tables import table
from ..streaming import adapters as AD
from ..streaming import features as SF
from .catalog_ingest import EVENTS_TYPES
from .common import TS_US_FMT, prep, r6, ts_text
from .registry import query

DAY_US = 86_400_000_000
BAND_DAYS, BANDS = 5, 7
FILES = 2                 # of a band, and of a trigger
HALF = DAY_US // 2


def _bands(df: DataFrame, us, late, name: str) -> DataFrame:
    """``df`` (with a column ts) as a stream of bands by the time ``us`` (microseconds)."""
    spark, root = df.sparkSession, scratch_path(df.sparkSession, name)
    first = df.agg(F.min(us)).first()[0] or 0
    slow = F.pmod(F.xxhash64(*df.columns), F.lit(DAY_US))
    band = F.least(F.floor((us + slow - first) / (BAND_DAYS * DAY_US)), F.lit(BANDS - 1))
    # dealt in one pass; a band then reads its own rows only
    staged = scratch_path(spark, f"{name}-dealt")
    df.withColumn("__band", F.when(late, BANDS).otherwise(band).cast("int")).write.partitionBy("__band").parquet(staged)
    dealt = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, __band int").parquet(staged)
    for i in range(BANDS + 1):
        dealt.where(F.col("__band") == i).drop("__band").repartition(FILES).write.parquet(f"{root}/band-{i}")
    end = spark.range(2).select(*[(F.lit("2100-01-01").cast("timestamp_ntz").cast(f.dataType) if "timestamp" in f.dataType.simpleString()
                                   else F.lit(None).cast(f.dataType)).alias(f.name) for f in df.schema])
    end.write.parquet(f"{root}/end")
    return (spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", FILES).parquet(root))


def _result(spark, out: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    SF.write_stream(spark, out, path, scratch_path(spark, f"{name}-ckpt"))
    return spark.read.schema(out.schema).parquet(path)


@query("rolling_range_stream", f"""
WITH e AS (SELECT *, (epoch_us(ts) // {HALF} + 1) * {HALF} AS bucket_end FROM events),
k AS (SELECT * FROM e WHERE event_id % 50 <> 0 OR bucket_end >
        (SELECT max(bucket_end) FROM e WHERE event_id % 50 <> 0) - 2 * {DAY_US})
SELECT event_id, count(*) OVER w AS n, round(sum(value) OVER w, 6) AS total, round(avg(value) OVER w, 6) AS mean
FROM k WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN {DAY_US} PRECEDING AND CURRENT ROW)""")
def q_rolling_range_stream(spark, sf):
    """B11 over the last day, two days allowed for late events: later ones are dropped."""
    prep(spark)
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    stream = _bands(ev, us, F.col("event_id") % 50 == 0, "roll-in")
    out = SF.rolling_range_stream(stream, "user_id", "ts", "value", 86400, "2 days", sub_buckets=2)
    back = _result(spark, out, "roll-out").where(F.col("event_id").isNotNull())
    return back.select("event_id", F.col("range86400_count").alias("n"), r6("range86400_sum").alias("total"), r6("range86400_avg").alias("mean"))


@query("pit_features_stream", """
WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id AS fid, user_id, ts AS fts, value FROM events WHERE event_type = 'view')
SELECT l.event_id,
       CASE WHEN v.fts >= l.ts - INTERVAL 1 DAY THEN v.fid END AS feature_event_id,
       CASE WHEN v.fts >= l.ts - INTERVAL 1 DAY THEN v.value END AS view_value
FROM l ASOF LEFT JOIN v ON l.user_id = v.user_id AND l.ts >= v.fts""")
def q_pit_features_stream(spark, sf):
    """B26 with labels and features as two streams, both shuffled."""
    prep(spark)
    ev = table(spark, sf, "events")
    us, never = F.unix_micros(F.col("ts").cast("timestamp")), F.lit(False)
    labels = _bands(ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts"), us, never, "pit-labels")
    views = _bands(ev.where(F.col("event_type") == "view").select("event_id", "user_id", "ts", F.col("value").alias("view_value")), us, never, "pit-features")
    out = SF.asof_features_stream(labels, views, "user_id", "ts", "ts", 86400, ["view_value"], "event_id", "2 days")
    return _result(spark, out, "pit-out").where(F.col("event_id").isNotNull()).select("event_id", "feature_event_id", "view_value")


@query("quality_stream", """
WITH p AS (SELECT event_id, ts, CASE WHEN value >= 100 THEN 1 ELSE 0 END AS predicted, least(value / 200, 1.0) AS score,
                  CASE WHEN event_id % 4 <> 0 AND event_id * 7919 % 4320 <= 2880
                       THEN CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END END AS actual FROM events)
SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, count(*) AS n_predictions, count(*) - count(actual) AS n_unmatched,
       round(avg(CASE WHEN actual IS NOT NULL THEN CASE WHEN predicted = actual THEN 1.0 ELSE 0.0 END END), 6) AS accuracy,
       round(sqrt(avg(pow(score - actual, 2))), 6) AS rmse
FROM p GROUP BY 1""")
def q_quality_stream(spark, sf):
    """B30 by day: labels come 0 to 3 days after their predictions (2 are allowed), a quarter
    never, and every third is delivered again."""
    prep(spark)
    ev = table(spark, sf, "events")
    us, never = F.unix_micros(F.col("ts").cast("timestamp")), F.lit(False)
    preds = ev.select("event_id", "ts", F.when(F.col("value") >= 100, 1).otherwise(0).alias("predicted"),
                      F.least(F.col("value") / 200, F.lit(1.0)).alias("score"))
    minutes = F.col("event_id") * 7919 % 4320
    labels = ev.where("event_id % 4 <> 0").select(
        "event_id", (F.col("ts").cast("timestamp") + F.make_dt_interval(mins=minutes.cast("int"))).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("event_type").isin("purchase", "signup"), 1).otherwise(0).alias("actual"))
    labels = labels.select("*", F.explode(F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    out = SF.quality_stream(_bands(preds, us, never, "quality-predictions"), _bands(labels, us, never, "quality-labels"), "event_id", "ts", "ts",
                            "predicted", "score", "actual", "2 DAYS", "2 days", "1 day")
    back = _result(spark, out, "quality-out").where(F.col("window_start") < F.lit("2100-01-01").cast("timestamp"))
    return back.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n_predictions", "n_unmatched",
                       r6("accuracy").alias("accuracy"), r6("rmse").alias("rmse"))


@query("ingest_adapters", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events""")
def q_ingest_adapters(spark, sf):
    """Three adapters into one ingest. Clicks and views land as files, purchases as files that
    notifications name, all other types as messages of at most 1,000 events; every tenth message comes twice."""
    prep(spark)
    root, t = scratch_path(spark, "adapters"), IngestTables(scratch_path(spark, "state-adapters"))
    ev = table(spark, sf, "events").withColumn("ts", F.date_format("ts", TS_US_FMT))
    lines = ev.select("*", F.col("event_type").alias("source"), F.substring("ts", 1, 10).alias("date"))
    landed = F.col("event_type").isin("click", "view")
    named = F.col("event_type") == "purchase"
    for place, part in (("landing", landed), ("second", named)):
        LD.write_landing(lines.where(part), f"{root}/{place}", fmt="json")
    record = F.struct(F.struct(F.struct(F.lit("second").alias("name")).alias("bucket"),
                               F.struct(F.url_encode("key").alias("key"), F.lit(0).cast("bigint").alias("size")).alias("object")).alias("s3"))
    (LD.read_landing(spark, f"{root}/second").select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("value"))
     .write.parquet(f"{root}/notices"))
    body = F.concat(F.array_join(F.collect_list(F.to_json(F.struct(*ev.columns))), "\n"), F.lit("\n")).cast("binary")
    msgs = (lines.where(~landed & ~named).groupBy("source", "date", F.expr("event_id div 1000").alias("block")).agg(body.alias("body"))
            .select("source", F.concat(F.lit("part-"), "block", F.lit(".jsonl")).alias("name"), "body", F.to_timestamp("date").alias("received_at"),
                    F.explode(F.sequence(F.lit(0), F.when(F.col("block") % 10 == 0, 1).otherwise(0))).alias("copy")))
    msgs.write.parquet(f"{root}/messages")
    AD.run_adapters(spark, [
        AD.landing_adapter(spark, f"{root}/landing"),
        AD.notification_adapter(spark.readStream.schema("value string").parquet(f"{root}/notices"), f"{root}/second"),
        AD.message_adapter(spark.readStream.schema(msgs.schema).parquet(f"{root}/messages"), f"{root}/pushed")],
        t, scratch_path(spark, "adapters-ckpt"), [f"{root}/landing"])
    typed = FT.coerce(read_processed(spark, t).select(*EVENTS_TYPES), EVENTS_TYPES, flag=None)
    return typed.select("event_id", ts_text("ts", micros=True).alias("ts"), "user_id", "event_type", "value", "props")
