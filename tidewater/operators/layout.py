"""Table layout operators."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def backfill(source: DataFrame, compute: Callable[[DataFrame], DataFrame], ts_col: str,
             date_from: str, date_to: str, out_path: str, partition_col: str = "date") -> None:
    """Recompute [date_from, date_to] only (partition filter on the
    input) and replace exactly those output partitions (dynamic overwrite);
    running it again leaves the same table. ``compute`` gives ``partition_col``
    as ``yyyy-MM-dd``; a day of the range for which it gives no rows is emptied."""
    day = F.to_date(F.col(ts_col))
    part = source.where(day.between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))
    days = Observation("backfilled days")      # at most the days of the range
    out = compute(part).observe(days, F.collect_set(F.col(partition_col).cast("string")).alias("days"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(out_path))
    kept = {f"{partition_col}={d}" for d in days.get["days"]}
    spark = source.sparkSession
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(root) if fs.exists(root) else []:
        name = st.getPath().getName()
        if name.startswith(f"{partition_col}=") and name not in kept and date_from <= name.split("=", 1)[1] <= date_to:
            fs.delete(st.getPath(), True)


# --------------------------------------------------------------------- B21
def enforce_schema(df: DataFrame, target: dict[str, str], allow_new: bool = True,
                   reasons: str = "reasons") -> tuple[DataFrame, DataFrame, list[str]]:
    """Cast incoming columns to the table's declared types.

    A row whose non-null value does not cast is rejected (its column names in
    ``reasons``); columns missing from the input are added as nulls; columns
    not in the table are kept as new nullable text columns when
    ``allow_new`` (schema evolution), else every row is rejected.
    Returns (accepted, rejected, added_columns).
    """
    added = [c for c in df.columns if c not in target]
    cols, errs = [], []
    for c, t in target.items():
        if c in df.columns:
            v = F.col(c).try_cast(t)
            errs.append(F.when(F.col(c).isNotNull() & v.isNull(), F.lit(c)))
        else:
            v = F.lit(None).cast(t)
        cols.append(v.alias(c))
    for c in added:
        cols.append(F.col(c).cast("string").alias(c))
        if not allow_new:
            errs.append(F.lit(f"unexpected column {c}"))
    out = df.select(*cols, F.array_compact(F.array(*errs)).alias(reasons))
    ok = F.size(reasons) == 0
    return out.where(ok).drop(reasons), out.where(~ok), added


# --------------------------------------------------------------------- B22
RETENTION_DAYS = {"raw": 90, "processed": 365}


def expired_partitions(df: DataFrame, date_col: str, as_of: Column, days: int) -> DataFrame:
    """B22 ("would delete"): date partitions strictly older than as_of - days,
    with their row counts."""
    d = F.to_date(F.col(date_col))
    cutoff = F.date_sub(F.to_date(as_of), days)
    return (df.where(d < cutoff).groupBy(d.alias("date"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))


def expired_dates(df: DataFrame, date_col: str, as_of: _dt.date, periods: dict[str, int]) -> DataFrame:
    """B22 ("would delete") for several periods in one pass: kind, date, n_rows of
    every date strictly older than ``as_of`` less the kind's days. The longest list's cutoff is a
    constant that reaches the scan: on a table in date folders it chooses folders from the listing, and rows are counted
    from file footers, no column is read; on a date or timestamp column it skips row groups. Null dates never expire."""
    cut = {kind: (as_of - _dt.timedelta(days=n)).isoformat() for kind, n in periods.items()}
    old = (df.where(F.col(date_col) < max(cut.values())).groupBy(F.substring(F.col(date_col).cast("string"), 1, 10).alias("date"))
           .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))
    kinds = F.array_compact(F.array(*[F.when(F.col("date") < c, F.lit(k)) for k, c in cut.items()]))
    return old.select(F.explode(kinds).alias("kind"), "date", "n_rows")


def drop_partitions(spark, root: str, partition_col: str, older_than: str) -> list[str]:
    """B22 (apply): delete every ``<col>=<value>`` folder with value < cutoff,
    at any level of partition folders. A metadata operation on the table's file
    system: folder listings only, no data read. Returns the deleted folders
    relative to root."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(conf)
    gone: list[str] = []
    if not fs.exists(base):
        return gone

    def walk(p, rel: str) -> None:
        for st in fs.listStatus(p):
            if not st.isDirectory():
                continue
            name = st.getPath().getName()
            here = f"{rel}/{name}" if rel else name
            if name.startswith(partition_col + "=") and name.split("=", 1)[1] < older_than:
                fs.delete(st.getPath(), True)
                gone.append(here)
            elif "=" in name:
                walk(st.getPath(), here)

    walk(base, "")
    return gone


def apply_retention(spark, landing_root: str | None, processed_root: str | None, as_of: str) -> dict:
    """B22 with the fixed periods: landing (raw) 90 days, processed 365 days,
    by the ``date`` / ``ingest_date`` partition folders."""
    import datetime as _d
    day = _d.date.fromisoformat(as_of)
    out = {}
    if landing_root:
        cut = (day - _d.timedelta(days=RETENTION_DAYS["raw"])).isoformat()
        out["raw"] = drop_partitions(spark, landing_root, "date", cut)
    if processed_root:
        cut = (day - _d.timedelta(days=RETENTION_DAYS["processed"])).isoformat()
        out["processed"] = drop_partitions(spark, processed_root, "ingest_date", cut)
    return out


# ----------------------------------------------------------------- B23 B24
def write_partitioned(df: DataFrame, path: str, date_col: str = "date", source_col: str = "source",
                      mode: str = "overwrite") -> None:
    """Table laid out by date first, source second. Rows are brought
    together by partition first (large ones are split, small ones share a
    task), so the number of files follows the data, not tasks times partitions."""
    (df.hint("rebalance", F.col(date_col), F.col(source_col))
     .write.mode(mode).partitionBy(date_col, source_col).parquet(path))


TARGET_FILE_BYTES = 256 * 1024 * 1024
COMPACTION_ROWS = 125_000      # of a task, about, unless one file has more


def compaction_plan(spark, path: str, part_cols: list[str], target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """B24 plan: per partition, files, bytes and the file count at
    ``target_bytes`` a file. Files are listed, not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", path).load(path)
             .select(*part_cols, "path", "length"))
    return (files.groupBy(*part_cols)
            .agg(F.count("path").cast("bigint").alias("n_files"), F.sum("length").cast("bigint").alias("bytes"))
            .withColumn("target_files",
                        F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(target_bytes))).cast("bigint")))


def compact(spark, path: str, out_path: str, part_cols: list[str], target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """B24 apply: write the table to ``out_path`` with its partitions in files
    of about ``target_bytes`` (rows unchanged).

    Rows are dealt to ``target_files`` slots of their partition by where they
    lie, so even a huge partition spreads over many tasks, whose number follows the rows
    (up to four times the slots, so that few tasks get several); a task that gets several slots still cuts its files at the rows that the table's mean row
    size gives for ``target_bytes``."""
    plan = compaction_plan(spark, path, part_cols, target_bytes)
    rows, = spark.read.parquet(path).agg(F.count(F.lit(1))).first()
    size, files = plan.agg(F.sum("bytes"), F.sum("target_files")).first()
    if not rows:
        return plan
    t = spark.read.parquet(path)
    # null partitions too: every row finds its partition's plan
    slots = plan.select(*[F.col(c).alias(f"__{c}") for c in part_cols], "target_files")
    t = t.withColumn("__at", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    t = t.join(slots, [t[c].eqNullSafe(slots[f"__{c}"]) for c in part_cols]).drop(*[f"__{c}" for c in part_cols])
    t = t.withColumn("__slot", F.pmod("__at", "target_files"))
    tasks = max(1, min(4 * files, max(-(-rows // COMPACTION_ROWS), 2 * spark.sparkContext.defaultParallelism), 10_000))
    (t.repartition(tasks, *part_cols, "__slot").drop("__slot", "__at", "target_files")
     .write.mode("overwrite").option("maxRecordsPerFile", max(1, round(1.1 * target_bytes * rows / size)))
     .partitionBy(*part_cols).parquet(out_path))
    return plan
