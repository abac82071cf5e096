"""Streaming drivers: landing stream → ingest batches (A01), fan-in."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import IngestTables, ingest_batch, purge_staging, writer_base
from ..sources import landing as LD


def merge_streams(streams: list[DataFrame], out_path: str, checkpoint: str,
                  available_now: bool = True):
    """All adapters' streams as one (``unionByName``), no order across
    them; written to ``out_path`` with exactly-once file sink semantics."""
    merged = streams[0]
    for s in streams[1:]:
        merged = merged.unionByName(s, allowMissingColumns=True)
    w = merged.writeStream.format("parquet").option("path", out_path).option(
        "checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q


def run_ingest_stream(spark: SparkSession, landing_root: str, t: IngestTables, checkpoint: str,
                      max_files_per_trigger: int = 1000, available_now: bool = True,
                      sweep_empty: bool = True, archive_dir: str | None = None,
                      keep_staging: int = 5):
    """A01 + A07-A23 as a stream: every micro-batch of newly landed files is
    one ``ingest_batch`` keyed by the stream's writer id and the batch id
    (replays converge, other writers' batches are never touched). Zero-length
    files never come out of the binaryFile stream (D19), so each trigger also
    lists the folders that changed for empty files not seen before."""
    stream = LD.stream_landing(spark, landing_root, max_files_per_trigger, archive_dir)
    base = writer_base(spark, checkpoint)

    def handle(df: DataFrame, batch_id: int) -> None:
        batch_id, landed = base + int(batch_id), df
        if sweep_empty:
            landed = landed.unionByName(new_empty_files(spark, [landing_root], t, batch_id))
        ingest_batch(spark, landed, t, int(batch_id),
                     _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
        purge_staging(spark, t, int(batch_id), keep_staging)

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")).start()
    if available_now:
        q.awaitTermination()
    return q


def new_empty_files(spark: SparkSession, roots: list[str], t: IngestTables, batch_id: int) -> DataFrame:
    """Landing rows of the empty files below ``roots`` not seen before. The folders that were listed are
    remembered after the files, so a batch that is run again finds the same rows: in the listing, or
    in what its first run wrote."""
    from .topics import _read

    held = _read(spark, f"{t.root}/empty_folders", "folder string, changed long, batch_id long")
    # one row for each folder that holds files
    known = {r.folder: r.changed for r in held.groupBy("folder").agg(F.max("changed").alias("changed")).collect()}
    found, leaves = None, {}
    for root in roots:
        rows, more = LD.sweep_empty_files(spark, root, known)
        found, leaves = rows if found is None else found.unionByName(rows), leaves | more
    seen = _seen(spark, t).select(LD.norm_uri(F.col("file_id")).alias("file_id"))
    out = _write_empty_seen(LD.empty_rows(found.distinct().join(seen, "file_id", "left_anti")), t, batch_id)
    if leaves:
        rows = spark.createDataFrame([(*x, batch_id) for x in leaves.items()], "folder string, changed long, batch_id long")
        (rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
         .parquet(f"{t.root}/empty_folders"))
    return out


def _seen(spark: SparkSession, t: IngestTables):
    """Empty files already handled by earlier triggers (a small table: one
    row per zero-length file ever seen)."""
    from .topics import _read
    return _read(spark, f"{t.root}/empty_seen", "file_id string")


def _write_empty_seen(empties: DataFrame, t: IngestTables, batch_id: int) -> DataFrame:
    """Remember this trigger's empty files (replay-safe by batch id) and
    return them from the written table."""
    (empties.withColumn("batch_id", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
     .parquet(f"{t.root}/empty_seen"))
    schema = empties.schema.add("batch_id", "long")
    return (empties.sparkSession.read.schema(schema).parquet(f"{t.root}/empty_seen")
            .where(f"batch_id = {batch_id}").drop("batch_id"))


NOTIFICATION_MESSAGES_SCHEMA = "value string"


def run_notification_stream(spark: SparkSession, messages_path: str, landing_root: str, t: IngestTables,
                            checkpoint: str, available_now: bool = True, max_files_per_trigger: int = 100):
    """A02 as a stream: object-store event messages (one JSON document per
    row in ``messages_path``, e.g. the webhook's requests written to a table
    or a Kafka topic) drive ingestion of exactly the objects they name; each
    micro-batch is one ingest batch keyed by its batch id."""
    from ..operators.ingest import ingest_notifications
    msgs = (spark.readStream.schema(NOTIFICATION_MESSAGES_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(messages_path))

    base = writer_base(spark, checkpoint)

    def handle(df: DataFrame, batch_id: int) -> None:
        ingest_notifications(spark, df, landing_root, t, base + int(batch_id),
                             now=_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))

    w = msgs.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()
    if available_now:
        q.awaitTermination()
    return q
