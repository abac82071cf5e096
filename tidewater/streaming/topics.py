"""Processed-file events: publish (A23) and consume.

The topic is a keyed, append-only table (key, value, timestamp, partition) in folders by
day and batch that Structured Streaming reads as a file source; when
a Kafka connector is on the classpath the same frames can be written with
``format("kafka")`` instead (``kafka_options``), key/value unchanged.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions import constants as K

EVENT_SCHEMA = ("source string, path string, content_hash string, format string, size bigint, "
                "received_at timestamp, processed_at timestamp, processed_bucket string, "
                "processed_key string, metadata map<string,string>")
TOPIC_SCHEMA = "key string, value string, timestamp timestamp, partition int, batch_id bigint, day string"
JSON_OPTS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def event_json(df: DataFrame, processed_bucket: str, at: Column) -> DataFrame:
    """One message per done file. Needs path, key, content_hash, format,
    length, received_at, processed_key. Key = content hash, else processed key."""
    meta = F.create_map(F.lit("bucket"), F.regexp_extract("path", r"^[a-z0-9]+://([^/]*)/", 1),
                        F.lit("key"), F.col("key"))
    ev = F.struct(
        F.lit(K.INGRESS).alias("source"), F.col("path"), F.col("content_hash"), F.col("format"),
        F.col("length").cast("bigint").alias("size"),
        F.col("received_at").cast("timestamp").alias("received_at"),
        at.cast("timestamp").alias("processed_at"),
        F.lit(processed_bucket).alias("processed_bucket"), F.col("processed_key"),
        meta.alias("metadata"))
    key = F.when(F.coalesce(F.col("content_hash"), F.lit("")) == "", F.col("processed_key")).otherwise(
        F.col("content_hash"))
    n = K.TOPICS[K.PROCESSED_TOPIC][0]
    return df.select(key.alias("key"), F.to_json(ev, JSON_OPTS).alias("value"),
                     at.cast("timestamp").alias("timestamp"),
                     F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("partition"))


def decode_events(topic: DataFrame) -> DataFrame:
    """A24 decode: adds ``e`` (struct or null when the value is not an event)."""
    e = F.from_json(F.col("value"), EVENT_SCHEMA, JSON_OPTS)
    ok = e.isNotNull() & e["content_hash"].isNotNull() & F.trim("value").startswith("{")
    return topic.select("*", F.when(ok, e).alias("e"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, empty if nothing was written yet; any other
    failure to read is an error, never taken for an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def publish(spark: SparkSession, done: DataFrame, t, batch_id: int, at: Column) -> None:
    """Append events for ``done`` files. A batch run again adds only what its own folders lack (the
    manifest gives a hash to one batch only), so no other part of the topic is read."""
    msgs = event_json(done, t.processed_bucket, at)
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{t.topic}/day=*/batch_id={batch_id}")
    found = own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(own)
    if found:
        old = spark.read.schema("key string").parquet(*[f.getPath().toString() for f in found])
        msgs = msgs.join(old, "key", "left_anti")
    # by day of the message time, so retention drops whole folders
    (msgs.withColumn("day", F.date_format("timestamp", "yyyy-MM-dd")).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .hint("rebalance").write.mode("append").partitionBy("day", "batch_id").parquet(t.topic))


def expire_topic(spark: SparkSession, topic_path: str, topic: str, now_ms: int) -> list[str]:
    """B22 for a topic: drop the day folders entirely older than the topic's
    retention (files.processed 30 days, dead-letter 30 days, 7 days others)."""
    import datetime as _d
    from ..operators.layout import drop_partitions
    keep_ms = K.TOPICS[topic][1]
    cutoff = _d.datetime.fromtimestamp((now_ms - keep_ms) / 1000, _d.timezone.utc).date().isoformat()
    return drop_partitions(spark, topic_path, "day", cutoff)


def kafka_options(bootstrap: str, topic: str = K.PROCESSED_TOPIC) -> dict:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic}


def consume(spark: SparkSession, topic_path: str, out_path: str, dead_letter_path: str,
            checkpoint: str, available_now: bool = True, kafka: dict | None = None):
    """Stream the topic (the file-backed table, or a Kafka topic when
    ``kafka`` options are given); decoded events → ``out_path`` once per key
    (handler effect idempotent), undecodable values → dead letter.

    Which keys had their effect is keyed state of the stream, kept for the topic's
    retention after which nothing can be delivered again; the first delivery (in a batch,
    the earliest) counts, however late it comes. Offsets and state advance only after
    the batch's writes succeed, and a batch run again replaces its own rows
    (at-least-once delivery, exactly-once effect). Old output is never read."""
    if kafka:   # a real broker (needs the spark-sql-kafka package; untested here)
        stream = (spark.readStream.format("kafka").options(**kafka)
                  .option("subscribe", kafka.get("subscribe", K.PROCESSED_TOPIC)).load()
                  .select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                          "timestamp", "partition"))
    else:
        stream = spark.readStream.schema(TOPIC_SCHEMA).parquet(topic_path)
    cols = ["key", "value", "timestamp", "partition"]
    decoded = decode_events(stream.select(cols))
    hash_ = F.col("e.content_hash")
    once = (decoded.where(F.col("e").isNotNull())
            # the watermark runs over the batches' own times, so no message is ever late
            .withColumn("arrival", F.current_timestamp()).withWatermark("arrival", "1 day")
            .select(F.when(hash_ != "", hash_).otherwise(F.col("key")).alias("once"), "arrival",
                    F.unix_millis("arrival").alias("arrival_ms"), *cols).groupBy("once")
            .transformWithStateInPandas(FirstDelivery(K.TOPICS[K.PROCESSED_TOPIC][1]), _MESSAGE, "append", "EventTime"))
    stream = once.withColumn("good", F.lit(True)).unionByName(
        decoded.where(F.col("e").isNull()).select(*cols, F.lit(False).alias("good")))

    def handle(df: DataFrame, batch_id: int) -> None:
        d = decode_events(df).withColumn("consumer_batch", F.lit(batch_id).cast("bigint"))
        # a batch run again replaces its own rows
        _replace_batch(d.where("NOT good").select(*cols, "consumer_batch"), dead_letter_path)
        _replace_batch(d.where("good").select("key", "partition", "timestamp", "e.*", "consumer_batch"), out_path)

    from .features import with_rocksdb
    w = stream.writeStream.outputMode("append").foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    with with_rocksdb(spark):
        q = w.start()
    if available_now:
        q.awaitTermination()
    return q


_MESSAGE = "key string, value string, timestamp timestamp, partition int"
CONSUMED_SCHEMA = f"key string, partition int, timestamp timestamp, {EVENT_SCHEMA}, consumer_batch bigint"


class FirstDelivery(StatefulProcessor):
    """Passes on a key's first message, and none while the key is remembered."""

    def __init__(self, retention_ms: int):
        self.retention_ms = retention_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "yes boolean")

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        if self.seen.exists():
            return
        cols = ["timestamp", "partition", "key", "value", "arrival_ms"]
        first = None
        for pdf in rows:
            part = pdf[cols].sort_values(cols).head(1)
            first = part if first is None else pd.concat([first, part]).sort_values(cols).head(1)
        if first is not None:
            self.seen.update((True,))
            self.handle.registerTimer(int(first["arrival_ms"].iloc[0]) + self.retention_ms)
            yield first[["key", "value", "timestamp", "partition"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass


def _replace_batch(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("consumer_batch").parquet(path))


def read_consumed(spark: SparkSession, out_path: str) -> DataFrame:
    """The effects of :func:`consume`, empty before the first."""
    return _read(spark, out_path, CONSUMED_SCHEMA)


def publish_kafka(msgs: DataFrame, bootstrap: str, topic: str = K.PROCESSED_TOPIC) -> None:
    """A23 to a real broker: same key/value/timestamp frames, Kafka sink.

    Needs the spark-sql-kafka package on the classpath (not bundled here);
    without it Spark raises a data-source-not-found error, re-raised with a hint.
    """
    try:
        (msgs.select("key", "value", "timestamp").write.format("kafka")
         .options(**kafka_options(bootstrap, topic)).save())
    except Exception as e:  # noqa: BLE001
        msg = str(e).lower()
        if "kafka" in msg and ("find data source" in msg or "not found" in msg or "data_source" in msg):
            raise RuntimeError("Kafka sink unavailable: add the spark-sql-kafka package") from e
        raise
