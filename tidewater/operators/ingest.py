"""One ingest batch: landed files → manifest, quarantine, processed, topic.

The stages are separate Spark jobs joined by small staging tables written
under the state root (durable, so a lost executor or a replayed batch never
depends on a long lineage; file bytes are never carried past the first
stage). Replaying a batch id overwrites its own processed/quarantine
partitions and skips messages already on the topic, so reruns converge.

Order of effects per file (reference order): manifest pending → processing →
(quarantine copy | parse) → processed rows → manifest terminal status →
processed-file event.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import constants as K
from ..functions import naming as N
from ..session import configure
from ..sources import landing as LD
from ..sources import ranges as RG
from ..sources import readers as R
from . import manifest as M
from . import store as S

PART_COLS = ("ingest_source", "ingest_date", "ingest_batch")
RECOVERY_DECISION_OFFSET = 10 ** 12  # manifest batch ids of recovery decisions
META_COLS = ("ingest_hash", "ingest_path") + PART_COLS


@dataclass
class IngestTables:
    root: str
    processed_bucket: str = "processed"

    def __post_init__(self):
        self.root = self.root.rstrip("/")

    @property
    def manifest(self) -> str: return f"{self.root}/manifest"
    @property
    def processed(self) -> str: return f"{self.root}/processed"
    @property
    def quarantine(self) -> str: return f"{self.root}/quarantine"
    @property
    def quarantine_ranges(self) -> str: return f"{self.root}/quarantine_ranges"
    @property
    def parts(self) -> str: return f"{self.root}/parts_manifest"
    @property
    def topic(self) -> str: return f"{self.root}/topics/{K.PROCESSED_TOPIC}"
    @property
    def dead_letter(self) -> str: return f"{self.root}/topics/dead-letter"
    @property
    def file_events(self) -> str: return f"{self.root}/file_events"

    def staging(self, batch_id: int, name: str) -> str:
        return f"{self.root}/staging/batch={batch_id}/{name}"


def classify_landed(landed: DataFrame, expected_hash: str | None = None,
                    max_bytes: int = K.MAX_FILE_SIZE, range_bytes: int = RG.RANGE) -> DataFrame:
    """Hash, sniff, validate; keep CSV header and quote check; drop bytes.

    ``length`` is pushed into the binaryFile scan, so only files up to
    ``max_bytes`` become rows with their bytes. Larger ones are streamed in
    ranges inside tasks for the same hash and first bytes.
    They fail validation as too large.
    """
    small = landed.where(F.col("length") <= F.lit(max_bytes))
    fmt = C.detect_format("key", "content")
    cols = [
        "file_id", "path", "key", "length",
        F.col("modificationTime").alias("received_at"), "source", "date",
        C.content_hash("content").alias("content_hash"), fmt.alias("format"),
        F.when(fmt == "csv", R.csv_head(F.col("content"))).alias("head"),
        F.when(fmt == "csv", R.csv_bad_quotes(F.col("content"))).otherwise(False).alias("bad_quote"),
    ]
    if expected_hash:
        cols.append(F.col(expected_hash))
    out = small.select(*cols)
    if expected_hash:
        # the manifest identity is the expected hash (as the reference's
        # recovered event carries it); the bytes' own hash is checked against it
        out = (out.withColumnRenamed("content_hash", "actual_hash")
               .withColumn("content_hash", F.coalesce(F.col(expected_hash), F.col("actual_hash"))))
    big = landed.where(F.col("length") > F.lit(max_bytes))
    if not big.select("file_id").isEmpty():
        out = out.unionByName(_classify_over(big, expected_hash, range_bytes))
    too_big = F.format_string("file size exceeds maximum limit of %d bytes", F.lit(max_bytes))
    reason = C.validation_reason("format", "length", "actual_hash" if expected_hash else "content_hash",
                                 expected_hash if expected_hash else None)
    if max_bytes != K.MAX_FILE_SIZE:   # tests lower the limit
        reason = (F.when(F.col("format") == "unknown", F.lit(K.MSG_UNSUPPORTED))
                  .when(F.col("length") == 0, F.lit(K.MSG_EMPTY))
                  .when(F.col("length") > F.lit(max_bytes), too_big)
                  .otherwise(reason))
    return out.withColumn("reason", reason)


def _classify_over(big: DataFrame, expected_hash: str | None, range_bytes: int) -> DataFrame:
    """What :func:`classify_landed` keeps of files that are streamed."""
    streamed = RG.hash_files(big, range_bytes).select("file_id", F.col("content_hash").alias("actual_hash"), "head")
    out = big.drop("content").join(streamed, "file_id").select(
        "file_id", "path", "key", "length", F.col("modificationTime").alias("received_at"), "source", "date",
        "actual_hash", C.detect_format("key", "head").alias("format"), F.lit(None).cast("string").alias("head"),
        F.lit(False).alias("bad_quote"), *([expected_hash] if expected_hash else []))
    if expected_hash:
        return out.withColumn("content_hash", F.coalesce(F.col(expected_hash), F.col("actual_hash")))
    return out.withColumnRenamed("actual_hash", "content_hash")


def purge_staging(spark: SparkSession, t: IngestTables, current_batch: int, keep: int = 5) -> list[int]:
    """Delete staging folders of batches older than the last ``keep`` (a
    replay only ever needs the current batch's stages). File-system metadata
    calls only; returns the purged batch ids."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{t.root}/staging")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    if not fs.exists(root):
        return gone
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("batch="):
            try:
                b = int(name.split("=", 1)[1])
            except ValueError:
                continue
            if b >> WRITER_SHIFT == current_batch >> WRITER_SHIFT and b <= current_batch - keep:
                fs.delete(st.getPath(), True)
                gone.append(b)
    return sorted(gone)


def _write_stage(df: DataFrame, path: str) -> DataFrame:
    """Materialise a stage under the state root (cuts lineage; a replayed
    batch overwrites its own stage) and continue from the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ingest_batch(spark: SparkSession, landed: DataFrame, t: IngestTables, batch_id: int,
                 now: _dt.datetime | None = None, max_bytes: int = K.MAX_FILE_SIZE,
                 expected_hash: str | None = None, range_bytes: int = RG.RANGE) -> DataFrame:
    """Run one batch. ``landed`` has landing columns (see sources.landing).

    Returns one row per landed file: file_id, path, content_hash, status,
    reason, n_records, processed_key (status ``skipped`` for a repeated hash).
    """
    configure(spark)
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    at = F.lit(now).cast("timestamp")
    man = M.ManifestTable(spark, t.manifest)

    # 1. classify (the only stage that touches the bytes)
    cls = classify_landed(landed, expected_hash, max_bytes=max_bytes, range_bytes=range_bytes)
    if expected_hash:
        cls = cls.drop(expected_hash, "actual_hash")
    cls = _write_stage(cls, t.staging(batch_id, "classified"))

    # 2. idempotency against the manifest as it was before this batch: the
    # log is scanned once, for this batch's hashes only; both checks below
    # work on that staged slice
    log = man.log().where(F.col("batch_id") != F.lit(batch_id))
    rel = _write_stage(M.relevant_log(log, cls), t.staging(batch_id, "manifest_slice"))
    todo = _write_stage(M.skip_known(cls, rel), t.staging(batch_id, "todo"))

    # 3. pending (insert-if-absent) and processing
    pend = M.insert_if_absent(todo, rel, at, batch_id, seq=0)
    proc = M.log_rows(todo, K.PROCESSING, at, 1, batch_id)
    man.append(pend.unionByName(proc))

    # 4. parse what passed validation and has a parser
    meta = (todo.where(F.col("reason").isNull() & F.col("format").isin(*K.PARSEABLE_FORMATS))
            .select("file_id", "path", "format", "head", "bad_quote").collect())
    staged, unreadable = _parse(spark, meta, t, batch_id)
    per_file = staged.groupBy("file_id").agg(
        F.count(F.when(~F.col("bad") & F.col("error").isNull(), 1)).cast("bigint").alias("n_records"),
        F.bool_or(F.col("bad")).alias("any_bad"),
        F.max("error").alias("error"))
    pqs = [_place(r.file_id) for r in meta if r.format == "parquet" and r.file_id not in unreadable]
    bad_ids = spark.createDataFrame([(u,) for u in unreadable], "file_id string")
    if pqs:
        bad_ids = bad_ids.unionByName(R.parquet_verdict(spark, pqs, per_file.select("file_id", "n_records"))).distinct()
    bad_ids = bad_ids.withColumn("unreadable", F.lit(True))
    v = (todo.join(per_file, "file_id", "left").join(bad_ids, "file_id", "left"))
    pr = C.parse_reason("format")
    reason = (F.when(F.col("reason").isNotNull(), F.col("reason"))
              .when(pr.isNotNull(), pr)
              .when(F.col("bad_quote") | (F.col("any_bad") & (F.col("format") == "csv")),
                    F.lit(K.MSG_PARSE_CSV))
              .when(F.col("error").isNotNull() & (F.col("format") == "csv"), F.lit(K.MSG_PARSE_CSV))
              .when(F.col("unreadable").isNotNull(), F.lit(K.MSG_PARSE_PARQUET))
              .when(F.col("error").isNotNull(), F.col("error"))
              .when(F.col("any_bad"), F.lit(K.MSG_PARSE_JSON))
              .when(F.coalesce(F.col("n_records"), F.lit(0)) == 0, F.lit(K.MSG_NO_RECORDS)))
    status = (F.when(F.col("reason").isNotNull(), F.lit(K.QUARANTINED))
              .when(reason.isNotNull(), F.lit(K.FAILED)).otherwise(F.lit(K.DONE)))
    plan = S.parts_plan(v.withColumn("n_records", F.coalesce("n_records", F.lit(0)).cast("bigint")),
                        key="key", total_bytes="length", record_count="n_records")
    verdict = _write_stage(
        plan.select("file_id", "path", "key", "content_hash", "source", "date", "format", "length",
                    "received_at", reason.alias("final_reason"), status.alias("status"),
                    "n_records", "n_parts", "parts", "base_key", "processed_key"),
        t.staging(batch_id, "verdict"))

    # one row of totals decides the part size and which of the optional writes
    # below are needed
    done = F.col("status") == K.DONE
    totals = verdict.agg(
        F.count_if(done).alias("n_done"), F.count_if(F.col("status") == K.QUARANTINED).alias("n_quarantined"),
        F.count_if((F.col("status") == K.QUARANTINED) & (F.col("length") > max_bytes)).alias("n_over"),
        F.sum(F.when(done, F.col("length"))).alias("length"), F.sum(F.when(done, F.col("n_records"))).alias("n_records"),
        F.max(F.when(done, F.col("n_parts"))).alias("n_parts")).first()
    rpp = N.records_per_chunk_py(int(totals.length or 0), int(totals.n_records or 0))

    # 5. processed rows of the files that parsed (all-string, union of keys)
    ok = verdict.where(done)
    if totals.n_done:
        _write_processed(spark, staged, ok, t, batch_id, rpp, int(totals.n_records or 0))

    # 6. quarantine copies (bytes re-read only for these files)
    if totals.n_quarantined:
        refused = verdict.where(F.col("status") == K.QUARANTINED)
        again = refused.where((F.col("length") > 0) & (F.col("length") <= max_bytes))
        paths = [_place(r.file_id) for r in again.select("file_id").collect()]
        _write_quarantine(spark, paths, verdict, t, batch_id, at)
        if totals.n_over:
            _write_ranges(refused.where(F.col("length") > max_bytes), t, batch_id, at, range_bytes)

    # 7. parts manifests of multi-part files
    if (totals.n_parts or 0) > 1:
        multi = ok.where(F.col("n_parts") > 1).select(
            F.col("base_key"), F.col("parts"), F.col("n_records").alias("record_count"),
            at.alias("created_at"), F.lit(batch_id).cast("bigint").alias("batch_id"))
        (multi.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").json(t.parts))

    # 8. terminal manifest rows
    term = verdict.select("content_hash", "path", "source", "status",
                          F.col("final_reason").alias("reason"))
    man.append(M.log_rows(term, F.col("status"), at, 2, batch_id, F.col("reason")))

    # 9. processed-file events for files now done (D15: skip already published)
    from ..streaming import topics as TP
    if totals.n_done:
        TP.publish(spark, ok, t, batch_id, at)

    # 10. one outcome row per file for monitoring (B31), replay-safe by batch
    (verdict.select("file_id", "path", "source", "content_hash", "format", "status",
                    F.col("final_reason").alias("reason"), "length", "n_records", "received_at",
                    at.alias("processed_at"), "processed_key", F.lit(batch_id).cast("bigint").alias("batch_id"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
     .parquet(t.file_events))

    return (cls.join(verdict.select("file_id", "status", "final_reason", "n_records", "processed_key"),
                     "file_id", "left")
            .select("file_id", "path", "content_hash",
                    F.coalesce("status", F.lit("skipped")).alias("status"),
                    F.col("final_reason").alias("reason"), "n_records", "processed_key"))


def _parse(spark: SparkSession, meta, t: IngestTables, batch_id: int) -> tuple[DataFrame, list[str]]:
    """The records of the files in ``meta``, staged: (file_id, record, bad,
    error); and the ids of files that have no readable footer.

    Which parser takes a file depends on the file alone: CSV with a plain first
    line and JSON lines go through Spark's readers, one read for each header;
    the others are split file by file."""
    schema = "file_id string, record map<string,string>, bad boolean, error string"
    none = F.lit(None).cast("string")
    stages: list[DataFrame] = []

    def stage(rows: DataFrame) -> None:
        stages.append(_write_stage(rows.select("file_id", "record", "bad", "error"),
                                   t.staging(batch_id, f"records-{len(stages)}")))

    def whole(paths: list[str]) -> DataFrame:
        return (spark.read.format("binaryFile").option("ignoreMissingFiles", "true").load([LD.literal(p) for p in paths])
                .select(C.file_id().alias("file_id"), "content"))

    csvs = [(r.file_id, _place(r.file_id), r.head) for r in meta if r.format == "csv" and not r.bad_quote]
    by_head: dict = {}
    for f in csvs:
        if R.native_csv(f[2]):
            by_head.setdefault(f[2], []).append(f)
    heads = list(by_head.values())
    for k in range(0, len(heads), R.CSV_GROUPS_PER_JOB):
        files = [f for g in heads[k:k + R.CSV_GROUPS_PER_JOB] for f in g]
        stage(R.read_csv(spark, files).withColumn("error", none))
    if odd := [p for _, p, head in csvs if not R.native_csv(head)]:
        stage(R.split_csv_files(whole(odd)).withColumn("bad", F.lit(False)))
    jsons = [_place(r.file_id) for r in meta if r.format == "ndjson"]
    if jsons:
        # lines are parsed once and staged; which files need the slow path is
        # then read off the staged flags instead of parsing the text again
        lines = _write_stage(R.read_ndjson_lines(spark, jsons), t.staging(batch_id, "ndjson_lines"))
        slow = lines.groupBy("file_id").agg(F.bool_or("bad").alias("b")).where("b").select("file_id")
        stages.append(lines.join(slow, "file_id", "left_anti").withColumn("error", none).select("file_id", "record", "bad", "error"))
        if slow_ids := [r.file_id for r in slow.collect()]:
            stage(R.split_json_files(whole([_place(s) for s in slow_ids])).withColumn("bad", F.lit(False)))
    unreadable: list[str] = []
    pqs = {_place(r.file_id): r.file_id for r in meta if r.format == "parquet"}
    if pqs:
        d, bad_paths = R.read_parquet(spark, list(pqs))
        stage(d.withColumn("error", none))
        unreadable = [pqs.get(p, p) for p in bad_paths]
    if not stages:
        return spark.createDataFrame([], schema), unreadable
    out = stages[0]
    for p in stages[1:]:
        out = out.unionByName(p)
    return out, unreadable


PROCESSED_ROWS = 100_000  # of a partition that one task sorts and writes


def _write_processed(spark: SparkSession, staged: DataFrame, ok: DataFrame, t: IngestTables,
                     batch_id: int, rpp: int, n_records: int) -> None:
    """The records under their partitions. The join holds the files' rows and sorts no records, and a
    task writes about ``PROCESSED_ROWS`` of a partition, however large files, partitions and batch are."""
    pairs = (ok.groupBy("source", "date").agg(F.greatest(F.lit(1), F.ceil(F.sum("n_records") / PROCESSED_ROWS)).alias("slots"))
             .withColumnsRenamed({"source": "s", "date": "d"}))
    files = ok.join(pairs, F.col("source").eqNullSafe(F.col("s")) & F.col("date").eqNullSafe(F.col("d"))).select(
        "file_id", "content_hash", "path", "source", "date", "slots")
    good = staged.join(files.hint("shuffle_hash"), "file_id")
    # the columns of the batch: the keys of its records, each set of keys once
    keys = sorted(r.k for r in good.select(F.map_keys("record").alias("ks")).distinct()
                  .select(F.explode("ks").alias("k")).distinct().collect())
    if not keys:
        return
    # a record key equal to one of our own columns keeps its data as <key>__data
    cols = [F.col("record").getItem(k).alias(k if k not in META_COLS else f"{k}__data") for k in keys]
    # four times as many tasks as slots, so that few tasks get several
    tasks = min(10_000, max(-(-4 * n_records // PROCESSED_ROWS), spark.sparkContext.defaultParallelism))
    good = good.repartition(tasks, F.col("source"), F.col("date"), F.pmod(F.xxhash64(F.to_json("record")), F.col("slots")))
    out = good.select(*cols,
                      F.col("content_hash").alias("ingest_hash"), F.col("path").alias("ingest_path"),
                      F.col("source").alias("ingest_source"),
                      F.coalesce("date", F.lit("unknown")).alias("ingest_date"),
                      F.lit(batch_id).cast("bigint").alias("ingest_batch"))
    w = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*PART_COLS))
    if rpp and rpp > 0:
        w = w.option("maxRecordsPerFile", int(rpp))
    w.parquet(t.processed)


def _write_quarantine(spark: SparkSession, paths: list[str], verdict: DataFrame,
                      t: IngestTables, batch_id: int, at) -> None:
    """Quarantined files with their bytes (re-read for ``paths`` only)."""
    q = verdict.where(F.col("status") == K.QUARANTINED).select(
        "file_id", "path", "content_hash", F.col("final_reason").alias("reason"), "length")
    if paths:
        body = (spark.read.format("binaryFile").option("ignoreMissingFiles", "true").load([LD.literal(p) for p in paths])
                .select(C.file_id().alias("file_id"), "content"))
    else:
        body = spark.createDataFrame([], "file_id string, content binary")
    out = (q.join(body, "file_id", "left")
           .select("path", F.coalesce("content", F.unhex(F.lit(""))).alias("content"),
                   "content_hash", "reason", "length", at.alias("quarantined_at"),
                   F.lit(batch_id).cast("bigint").alias("ingest_batch")))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ingest_batch").parquet(t.quarantine))


def _write_ranges(over: DataFrame, t: IngestTables, batch_id: int, at, range_bytes: int) -> None:
    """A19 for files over the limit: their bytes as rows of one range each."""
    out = RG.copy_ranges(over.select("file_id", "path", "content_hash", F.col("final_reason").alias("reason"), "length"), range_bytes)
    (out.drop("file_id").withColumn("quarantined_at", at).withColumn("ingest_batch", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_batch").parquet(t.quarantine_ranges))


def quarantined_bytes(spark: SparkSession, t: IngestTables) -> DataFrame:
    """The original bytes of quarantined files: path, content_hash, reason, seq, at, content. A file
    up to the size limit is one row, a larger one a row for each range; in order of seq they
    join to the file."""
    cols = ["path", "content_hash", "reason", "seq", "at", "content"]

    def there(root: str) -> bool:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    if not there(t.quarantine):     # nothing was quarantined yet
        return spark.createDataFrame([], "path string, content_hash string, reason string, seq long, at long, content binary")
    whole = spark.read.parquet(t.quarantine)
    ranges = None
    if there(t.quarantine_ranges):
        ranges = spark.read.parquet(t.quarantine_ranges)
        whole = whole.join(ranges.select("content_hash", "path", "ingest_batch").distinct(),
                           ["content_hash", "path", "ingest_batch"], "left_anti")
    out = whole.withColumn("seq", F.lit(0).cast("bigint")).withColumn("at", F.lit(0).cast("bigint")).select(cols)
    return out if ranges is None else out.unionByName(ranges.select(cols))


WRITER_SHIFT = 32         # a batch id is its writer's number and the batch's own


def run_id() -> int:
    """A batch id of its own for a run that is not part of a stream."""
    return uuid.uuid4().int >> 66


def writer_base(spark: SparkSession, checkpoint: str) -> int:
    """What a stream adds to its batch numbers, so that no two streams, and no
    later stream with a new checkpoint folder, share an id. The writer's number
    is drawn once and kept in the checkpoint folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/writer_id")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        out = fs.create(p, False)
        out.write(bytearray(str(uuid.uuid4().int % (1 << 30) + 1), "ascii"))
        out.close()
    held = spark.read.text(LD.literal(p.toString())).first()[0]
    return int(held) << WRITER_SHIFT


def _place(file_id: str) -> str:
    """Where a file's bytes are: its id is the encoded URI Spark read it from."""
    return unquote(file_id)


def ingest_landing(spark: SparkSession, landing_root: str, t: IngestTables, batch_id: int | None = None,
                   now: _dt.datetime | None = None, include_empty: bool = True,
                   max_bytes: int = K.MAX_FILE_SIZE, dates: list[str] | None = None,
                   range_bytes: int = RG.RANGE) -> DataFrame:
    """Batch form of the pipeline: everything under ``landing_root`` (or only
    its ``date=`` folders in ``dates``) as one batch.

    ``batch_id`` names the batch for a replay that must replace it; without one
    every call is a batch of its own. One batch means one file list on the driver; for a large backlog use
    ``streaming.ingest.run_ingest_stream(available_now=True)``, which takes
    it in triggers of ``max_files_per_trigger`` files.
    """
    landed = LD.read_landing(spark, landing_root, dates=dates)
    if include_empty:
        landed = landed.unionByName(LD.empty_files(spark, landing_root, dates=dates))
    return ingest_batch(spark, landed, t, run_id() if batch_id is None else batch_id, now, max_bytes,
                        range_bytes=range_bytes)


def recover_stuck_files(spark: SparkSession, landing_root: str, t: IngestTables, batch_id: int | None = None,
                        now: _dt.datetime | None = None, archive_dir: str | None = None) -> DataFrame:
    """A18 at start-up: files stuck in ``processing`` for over 31 minutes are
    looked up by their paths, in ``archive_dir`` if they are no longer where
    they landed; found ones go back to ``pending`` and are ingested again as a
    batch; missing ones become ``failed``. Only the stuck files are read.

    Recovery batches have negative ids, one of its own for every call unless
    ``batch_id`` is given, so they share an id with no other batch."""
    from . import recovery as RC
    batch_id = -1 - (run_id() >> 2) if batch_id is None else batch_id
    if batch_id >= 0:
        raise ValueError("recovery batch ids are negative")
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    at = F.lit(now).cast("timestamp")
    man = M.ManifestTable(spark, t.manifest)
    st = M.stuck(man.current(), at).select("content_hash", "path", "source")
    paths = [r.path for r in st.collect()]      # bounded: entries stuck at start-up
    if not paths:
        return spark.createDataFrame([], "file_id string, path string, content_hash string, status string, "
                                         "reason string, n_records bigint, processed_key string")
    present = LD.read_files(spark, paths, archive_dir)
    decided = RC.recover(man.current(), present.select("path", "key", "content", "length"), at)
    # the decisions are logged under their own id: the re-ingest below
    # (batch_id) must see them as history, not as its own rows
    man.append(RC.recovery_log_rows(decided, at, batch_id - RECOVERY_DECISION_OFFSET))
    # The stuck entry's hash is the expected one; bytes changed since → mismatch
    again = present.join(st.select("path", F.col("content_hash").alias("expected_hash")), "path")
    return ingest_batch(spark, again, t, batch_id, now, expected_hash="expected_hash")


def ingest_notifications(spark: SparkSession, messages: DataFrame, landing_root: str, t: IngestTables,
                         batch_id: int, value_col: str = "value",
                         now: _dt.datetime | None = None) -> DataFrame:
    """A02 → ingest: decode notification messages and ingest exactly the
    objects they name (see :func:`notified_files`)."""
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    found, empties = notified_files(spark, messages, landing_root, t, batch_id, now, value_col)
    if empties is None:
        return _no_result(spark)
    landed = empties
    if found:    # absent keys are skipped; only notified files' bytes are read
        landed = LD._shape(spark.read.format("binaryFile").option("ignoreMissingFiles", "true")
                           .load([LD.literal(p) for p in found])).unionByName(empties)
    return ingest_batch(spark, landed, t, batch_id, now)


def notified_files(spark: SparkSession, messages: DataFrame, landing_root: str, t: IngestTables, batch_id: int,
                   now: _dt.datetime, value_col: str = "value") -> tuple[list[str], DataFrame | None]:
    """The files that notification messages name (object key resolved under
    ``landing_root``): the paths of those that hold bytes, and landing rows of the
    empty ones (None if no named folder exists).

    Names Spark cannot read (``_x``, ``.x``; D26) get a ``failed`` manifest
    row with reason "hidden name" (their bytes are unknown, so the row is
    keyed by the hash of the path); keys naming no object are skipped, as
    the reference skips objects it cannot download.
    """
    from ..sources import notifications as NT
    at = F.lit(now).cast("timestamp")
    recs, _rejected = NT.decode(messages, value_col)
    root = landing_root.rstrip("/")
    recs = recs.select("key", F.concat(F.lit(root + "/"), F.col("key")).alias("lpath")).distinct()
    hidden = recs.where(C.is_hidden_name("key"))
    man = M.ManifestTable(spark, t.manifest)
    hid = hidden.select(F.concat(F.lit("hidden:"), F.sha2("lpath", 256)).alias("content_hash"),
                        F.col("lpath").alias("path"), C.source_from_key("key").alias("source"))
    man.append(M.log_rows(hid, K.FAILED, at, 2, batch_id, F.lit(K.MSG_HIDDEN)))
    keys = recs.where(~C.is_hidden_name("key")).select("key")
    # one listing of just the folders the notifications name (no per-key calls)
    jvm = spark.sparkContext._jvm
    parents = sorted({r.d for r in keys.select(
        F.when(F.col("key").contains("/"), F.regexp_replace("key", "/[^/]*$", "")).otherwise("").alias("d")).distinct().collect()})
    folders = []
    for d in parents:
        p = jvm.org.apache.hadoop.fs.Path(f"{root}/{d}" if d else root)
        if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            folders.append(LD.literal(f"{root}/{d}" if d else root))
    if not folders:
        return [], None
    listed = spark.read.format("binaryFile").option("ignoreMissingFiles", "true").load(folders)
    every = listed.inputFiles()
    # metadata only (no content column): which notified keys exist here
    meta = LD._shape(listed).select("file_id", "path", "key").join(keys, "key", "left_semi")
    found = [r.path for r in meta.select("path").collect()]     # bounded by the notifications
    ids = spark.createDataFrame([(p,) for p in every], "file_id string").select(
        C.file_id(F.col("file_id")).alias("file_id"))
    empties = LD.empty_rows(ids.join(meta.select("file_id"), "file_id", "left_anti")).join(
        keys, "key", "left_semi")
    return found, empties


def _no_result(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "file_id string, path string, content_hash string, status string, "
                                     "reason string, n_records bigint, processed_key string")


def processed_file(spark: SparkSession, t: IngestTables, content_hash: str | None = None,
                   processed_key: str | None = None) -> DataFrame:
    """The rows of one processed file with only its own columns (what the
    reference's per-file object holds), found by content hash or by the
    published processed key. One small aggregate decides which of the
    table's columns the file uses (keys with at least one value)."""
    if content_hash is None:
        ev = spark.read.parquet(t.file_events).where(
            (F.col("processed_key") == processed_key) & (F.col("status") == K.DONE))
        # Several files can share a processed key; as with overwritten
        # objects, the most recently processed one answers
        hit = ev.orderBy(F.col("processed_at").desc(), F.col("path").desc()).select("content_hash").limit(1).collect()
        if not hit:
            return spark.createDataFrame([], "ingest_hash string")
        content_hash = hit[0].content_hash
    rows = read_processed(spark, t).where(F.col("ingest_hash") == content_hash)
    data = [c for c in rows.columns if c not in META_COLS]
    counts = rows.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in data]).first() if data else None
    used = [c for c in data if counts and counts[c] > 0]
    # (a key present only with JSON null values is indistinguishable from an
    # absent one in the shared table and is dropped here)
    return rows.select(*[F.col(f"`{c}`") for c in used], *META_COLS)


def read_processed(spark: SparkSession, t: IngestTables) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(t.processed)
