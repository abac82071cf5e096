"""B31 as a stream: file outcomes → per-window, per-source pipeline metrics.

Reads the ``file_events`` table the ingest appends to, with a watermark on
arrival time so windows close and state stays bounded; late outcomes older
than the watermark are dropped from the stream (the batch form over the
same table still counts them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import monitor as MO

FILE_EVENTS_SCHEMA = ("file_id string, path string, source string, content_hash string, format string, "
                      "status string, reason string, length bigint, n_records bigint, "
                      "received_at timestamp, processed_at timestamp, batch_id bigint")


def windowed_metrics(events: DataFrame, window: str = "10 minutes", watermark: str = "30 minutes") -> DataFrame:
    lat = F.when(F.col("status") == "done",
                 F.floor((F.unix_micros("processed_at") - F.unix_micros("received_at")) / 1e6).cast("double"))
    g = (events.withWatermark("received_at", watermark)
         .groupBy(F.window("received_at", window).alias("w"), "source")
         .agg(F.count(F.lit(1)).cast("bigint").alias("files"),
              F.sum("length").cast("bigint").alias("bytes"),
              F.avg(F.col("status").isin("failed", "quarantined").cast("int")).alias("error_rate"),
              F.sum((F.col("status") == "quarantined").cast("int")).cast("bigint").alias("quarantined"),
              F.percentile_approx(lat, [0.5, 0.95, 0.99], 10000).alias("__p")))
    return g.select(F.col("w.start").alias("window_start"), "source", "files", "bytes", "error_rate",
                    "quarantined", F.col("__p")[0].alias("p50"), F.col("__p")[1].alias("p95"),
                    F.col("__p")[2].alias("p99"))


def run_metrics_stream(spark: SparkSession, file_events_path: str, out_path: str, alerts_path: str,
                       checkpoint: str, available_now: bool = True):
    """Append finished windows to ``out_path`` and their threshold breaches
    to ``alerts_path``."""
    ev = spark.readStream.schema(FILE_EVENTS_SCHEMA).parquet(file_events_path)
    m = windowed_metrics(ev)

    def handle(df: DataFrame, batch_id: int) -> None:
        # a batch run again replaces its own rows
        for rows, path in ((df, out_path), (MO.alerts(df), alerts_path)):
            (rows.withColumn("metrics_batch", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("metrics_batch").parquet(path))

    w = m.writeStream.outputMode("append").foreachBatch(handle).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
    if available_now:
        q.awaitTermination()
    return q
