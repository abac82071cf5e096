"""The file manifest as an append-only status log (A13-A17, manifest_recent).

Row = one status change: content_hash, path, source, status, at, seq, reason,
batch_id. The current state of a hash is its latest row by (at, seq);
``created_at`` is the time of its first row (the insert), ``processed_at`` the
time of the latest row when that row is terminal, else null (A16).

Every "latest per key" here is an aggregate (max of a struct), not a
``row_number`` window: the aggregate combines map-side, so a hash (or a
batch) holding a third of all rows never lands whole in one task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K

LOG_SCHEMA = T.StructType([
    T.StructField("content_hash", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("reason", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields]


def log_rows(df: DataFrame, status: str | Column, at: Column, seq: int,
             batch_id: int | Column = 0, reason: Column | None = None) -> DataFrame:
    """Shape rows (needing content_hash, path, source) as manifest log rows."""
    st = F.lit(status) if isinstance(status, str) else status
    bid = F.lit(batch_id) if isinstance(batch_id, int) else batch_id
    rs = reason if reason is not None else F.lit(None)
    return df.select(
        F.col("content_hash"), F.col("path"), F.col("source"),
        st.cast("string").alias("status"), at.cast("timestamp").alias("at"),
        F.lit(seq).cast("int").alias("seq"), rs.cast("string").alias("reason"),
        bid.cast("bigint").alias("batch_id"))


def current(log: DataFrame) -> DataFrame:
    """A16 read side: one row per hash with the reference's manifest columns."""
    g = log.groupBy("content_hash").agg(
        F.min(F.struct("at", "seq", "path", "source")).alias("_first"),
        F.max(F.struct("at", "seq", "status", "reason")).alias("_last"),
    )
    terminal = F.col("_last.status").isin(*K.TERMINAL)
    return g.select(
        F.col("_first.path").alias("path"),
        "content_hash",
        F.col("_first.source").alias("source"),
        F.col("_last.status").alias("status"),
        F.col("_first.at").alias("created_at"),
        F.when(terminal, F.col("_last.at")).alias("processed_at"),
        F.col("_last.reason").alias("reason"),
    )


def first_by_hash(batch: DataFrame, order: tuple[str, ...] = ("received_at", "path")) -> DataFrame:
    """A13 (in-batch part): keep one file per content hash, the earliest by ``order``.

    ``batch`` must not carry file bytes (they would ride the shuffle).
    """
    cols = [c for c in batch.columns if c != "content_hash"]
    key = list(order) + [c for c in cols if c not in order]
    g = batch.groupBy("content_hash").agg(F.min(F.struct(*key)).alias("_f"))
    return g.select("content_hash", *[F.col(f"_f.{c}").alias(c) for c in cols])


def relevant_log(log: DataFrame, hashes: DataFrame) -> DataFrame:
    """Log rows of the given hashes only (semi join; Spark adds a runtime
    bloom filter / broadcast from the small side, the big log is never
    shuffled whole when the batch is small)."""
    return log.join(hashes.select("content_hash").distinct(), "content_hash", "left_semi")


def skip_known(batch: DataFrame, log: DataFrame) -> DataFrame:
    """Files to process = first per hash, minus hashes whose current
    status is done / processing / failed / quarantined (pending goes on)."""
    first = first_by_hash(batch)
    blocked = (current(relevant_log(log, first))
               .where(F.col("status").isin(*K.SKIP_STATUSES))
               .select("content_hash"))
    return first.join(blocked, "content_hash", "left_anti")


def insert_if_absent(todo: DataFrame, log: DataFrame, at: Column, batch_id: int = 0,
                     seq: int = 0) -> DataFrame:
    """Pending rows for hashes with no manifest row at all."""
    known = relevant_log(log, todo).select("content_hash").distinct()
    fresh = todo.join(known, "content_hash", "left_anti")
    return log_rows(fresh, K.PENDING, at, seq, batch_id)


def lookup(current_df: DataFrame, hashes: DataFrame | list[str]) -> DataFrame:
    """Manifest rows for the given hashes (absent hash → no row)."""
    if isinstance(hashes, list):
        return current_df.where(F.col("content_hash").isin(hashes))
    return current_df.join(hashes.select("content_hash").distinct(), "content_hash", "left_semi")


def stuck(current_df: DataFrame, as_of: Column | _dt.datetime,
          older_than_seconds: int = K.STUCK_AFTER_SECONDS,
          include_pending: bool = False) -> DataFrame:
    """Status processing and created_at strictly before as_of - d."""
    t = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    statuses = [K.PROCESSING] + ([K.PENDING] if include_pending else [])
    limit = t - F.make_interval(secs=F.lit(older_than_seconds))
    return current_df.where(F.col("status").isin(*statuses) & (F.col("created_at") < limit))


def recent(current_df: DataFrame, n: int = 10) -> DataFrame:
    """Documented query: latest n entries by created_at (path breaks ties).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top n, only n rows per task reach the final merge.
    """
    return (current_df.orderBy(F.col("created_at").desc(), F.col("path").asc())
            .limit(n).select("path", "status", "content_hash", "created_at"))


class ManifestTable:
    """The log as a Parquet table (append-only, partitioned by day of ``at``)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def log(self) -> DataFrame:
        try:
            return (self.spark.read.schema(_with_day(LOG_SCHEMA))
                    .parquet(self.root).select(*LOG_COLUMNS))
        except Exception as e:  # nothing written yet
            if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
                return self.spark.createDataFrame([], LOG_SCHEMA)
            raise

    def current(self) -> DataFrame:
        return current(self.log())

    def compact(self, out_root: str) -> "ManifestTable":
        """Write the compacted log to ``out_root`` (swap it in when done; the
        old log stays readable until then). Rows are range-partitioned and
        sorted by hash so lookups by hash skip most row groups."""
        (compact_log(self.log()).withColumn("day", F.date_format("at", "yyyy-MM-dd"))
         .repartitionByRange("content_hash").sortWithinPartitions("day", "content_hash")
         .write.mode("overwrite").partitionBy("day").parquet(out_root))
        return ManifestTable(self.spark, out_root)

    def append(self, rows: DataFrame) -> None:
        (rows.select(*LOG_COLUMNS)
         .withColumn("day", F.date_format("at", "yyyy-MM-dd"))
         .write.mode("append").partitionBy("day").parquet(self.root))



def compact_log(log: DataFrame) -> DataFrame:
    """Per hash only its first and its latest row: ``current`` is unchanged
    (created_at from the first, status/processed_at from the latest), while
    the log shrinks to at most two rows per hash."""
    g = log.groupBy("content_hash").agg(
        F.min(F.struct("at", "seq", *[c for c in LOG_COLUMNS if c not in ("at", "seq", "content_hash")])).alias("f"),
        F.max(F.struct("at", "seq", *[c for c in LOG_COLUMNS if c not in ("at", "seq", "content_hash")])).alias("l"))
    both = g.select("content_hash", F.explode(F.array_distinct(F.array("f", "l"))).alias("r"))
    return both.select("content_hash", *[F.col(f"r.{c}").alias(c) for c in LOG_COLUMNS if c != "content_hash"]) \
        .select(*LOG_COLUMNS)


def _with_day(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField("day", T.StringType())])
