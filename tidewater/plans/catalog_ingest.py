"""Queries for the file-ingestion operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import naming as N
from ..operators import features as FT
from ..operators import lifecycle as L
from ..operators import manifest as M
from ..operators import store as S
from ..operators.ingest import IngestTables, ingest_landing, quarantined_bytes, read_processed
from ..session import scratch_path
from ..sources import landing as LD
from ..sources import notifications as NT
from ..sources.tables import table
from .common import TS_US_FMT, prep, ts_text, vfiles, vfiles_with_bytes
from .oracle_sql import FIRST, VFILES, with_ctes
from .registry import query

AS_OF = "2026-05-17 01:00:00"


# ---------------------------------------------------------------- A05 A06 A07
@query("content_hash", with_ctes(VFILES) + """
SELECT doc_id, path, content_hash, length FROM vf""")
def q_content_hash(spark: SparkSession, sf: str) -> DataFrame:
    f = vfiles_with_bytes(spark, sf)
    return f.select("doc_id", "path", C.content_hash("content").alias("content_hash"), "length")


@query("detect_format", with_ctes(VFILES) + """
SELECT doc_id, key, format FROM vf""")
def q_detect_format(spark, sf):
    f = vfiles_with_bytes(spark, sf)
    return f.select("doc_id", "key", C.detect_format("key", "content").alias("format"))


@query("validate", with_ctes(VFILES) + """
SELECT doc_id, path, format, length, reason,
       CASE WHEN reason IS NULL THEN 1 ELSE 0 END AS is_valid FROM vfc""")
def q_validate(spark, sf):
    f = vfiles(spark, sf)
    return f.select("doc_id", "path", "format", "length", "reason",
                    F.when(F.col("reason").isNull(), 1).otherwise(0).alias("is_valid"))


# ---------------------------------------------------------------------- A04
@query("source_date_from_key", with_ctes(VFILES) + """
SELECT doc_id, regexp_extract(key, 'source=([^/]*)/', 1) AS key_source,
       regexp_extract(key, 'date=([^/]*)/', 1) AS key_date,
       regexp_replace(key, '\\.[^./]*$', '') || '.parquet' AS base_key
FROM vf""")
def q_source_date(spark, sf):
    f = vfiles(spark, sf)
    return f.select("doc_id", C.source_from_key("key").alias("key_source"),
                    C.date_from_key("key").alias("key_date"),
                    N.base_key("key").alias("base_key"))


# ---------------------------------------------------------------------- A02
@query("notification_decode", """
SELECT page_id // 4 AS message_id,
       CAST(row_number() OVER (PARTITION BY page_id // 4 ORDER BY page_id) - 1 AS INTEGER) AS record_index,
       'landing' AS bucket, url AS key, CAST(octet_length(encode(html)) AS BIGINT) AS size,
       md5(html) AS etag, 's3://landing/' || url AS path
FROM pages""")
def q_notification_decode(spark, sf):
    prep(spark)
    pages = table(spark, sf, "pages")
    rec = F.struct(
        F.col("page_id"),
        F.struct(F.struct(
            F.struct(F.lit("landing").alias("name")).alias("bucket"),
            F.struct(F.url_encode("url").alias("key"),
                     F.octet_length(F.encode("html", "UTF-8")).cast("bigint").alias("size"),
                     F.md5("html").alias("eTag")).alias("object")).alias("s3")).alias("r"))
    msgs = (pages.groupBy(F.floor(F.col("page_id") / 4).alias("message_id"))
            .agg(F.array_sort(F.collect_list(rec)).alias("rs"))
            .select("message_id",
                    F.to_json(F.struct(F.transform("rs", lambda x: x["r"]).alias("Records"))).alias("value")))
    recs, _rejected = NT.decode(msgs, keep=("message_id",))
    return recs.select("message_id", "record_index", "bucket", "key", "size", "etag", "path")


# ------------------------------------------------------------------ A15-A17
def _scenario(spark, sf):
    files = vfiles(spark, sf)
    return files, L.replayed_log(files)


@query("manifest_current", with_ctes(VFILES, FIRST) + """
SELECT path, content_hash, source, status,
       strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
       strftime(processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at, reason
FROM mcur""")
def q_manifest_current(spark, sf):
    _, log = _scenario(spark, sf)
    cur = M.current(log)
    return cur.select("path", "content_hash", "source", "status",
                      ts_text("created_at").alias("created_at"),
                      ts_text("processed_at").alias("processed_at"), "reason")


@query("manifest_lookup", with_ctes(VFILES, FIRST) + """
SELECT v.doc_id, v.content_hash, m.status, m.path AS manifest_path
FROM vf v JOIN mcur m USING (content_hash)""")
def q_manifest_lookup(spark, sf):
    files, log = _scenario(spark, sf)
    cur = M.current(log)
    hits = M.lookup(cur, files.select("content_hash"))
    return (files.select("doc_id", "content_hash")
            .join(hits.select("content_hash", "status", F.col("path").alias("manifest_path")),
                  "content_hash"))


@query("manifest_stuck", with_ctes(VFILES, FIRST) + f"""
SELECT path, content_hash, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
FROM mcur WHERE status = 'processing'
  AND created_at < TIMESTAMP '{AS_OF}' - INTERVAL 31 MINUTE""")
def q_manifest_stuck(spark, sf):
    _, log = _scenario(spark, sf)
    s = M.stuck(M.current(log), F.lit(AS_OF).cast("timestamp"))
    return s.select("path", "content_hash", ts_text("created_at").alias("created_at"))


@query("manifest_recent", with_ctes(VFILES, FIRST) + """
SELECT path, status, content_hash, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
FROM mcur ORDER BY created_at DESC, path LIMIT 10""")
def q_manifest_recent(spark, sf):
    _, log = _scenario(spark, sf)
    r = M.recent(M.current(log), 10)
    return r.select("path", "status", "content_hash", ts_text("created_at").alias("created_at"))


# ------------------------------------------------------------------ A13 A14
_B1 = "lang IN ('en', 'fr')"

_IDEMP = with_ctes(VFILES, FIRST.replace("FROM vfc) WHERE rn = 1", f"FROM vfc WHERE {_B1}) WHERE rn = 1"), """
allfirst AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY received_at, path) AS rn
    FROM vfc) WHERE rn = 1
)""")


@query("ingest_idempotent", _IDEMP + """
SELECT a.content_hash, a.path, a.doc_id FROM allfirst a
WHERE a.content_hash NOT IN (SELECT content_hash FROM mcur WHERE status <> 'pending')""")
def q_ingest_idempotent(spark, sf):
    files = vfiles(spark, sf)
    log1 = L.replayed_log(files.where(F.col("lang").isin("en", "fr")))
    todo = M.skip_known(files, log1)
    return todo.select("content_hash", "path", "doc_id")


@query("manifest_insert", _IDEMP + """
SELECT a.content_hash, a.path, 'pending' AS status,
       strftime(a.received_at, '%Y-%m-%d %H:%M:%S') AS created_at
FROM allfirst a WHERE a.content_hash NOT IN (SELECT content_hash FROM mcur)""")
def q_manifest_insert(spark, sf):
    files = vfiles(spark, sf)
    log1 = L.replayed_log(files.where(F.col("lang").isin("en", "fr")))
    todo = M.skip_known(files, log1)
    rows = M.insert_if_absent(todo, log1, F.col("received_at"), batch_id=2)
    return rows.select("content_hash", "path", "status", ts_text("at").alias("created_at"))


# ---------------------------------------------------------------------- A19
@query("quarantine", with_ctes(VFILES) + """
SELECT path, content_hash, reason, length,
       lower(hex(content[1:4])) AS head_hex
FROM vfc JOIN vf0 USING (doc_id) WHERE reason IS NOT NULL""")
def q_quarantine(spark, sf):
    f = vfiles_with_bytes(spark, sf)
    q = S.quarantine_rows(f, F.lit(AS_OF).cast("timestamp"))
    return q.select("path", "content_hash", "reason", "length",
                    F.lower(F.hex(F.substring("content", 1, 4))).alias("head_hex"))


# ------------------------------------------------------------------ A21 A22
@query("part_sizing", """
WITH s AS (
  SELECT source, CAST(sum(octet_length(encode(text))) AS BIGINT) AS total_bytes,
         CAST(count(*) AS BIGINT) AS record_count FROM documents GROUP BY source
), r AS (
  SELECT *, CASE WHEN record_count <= 0 THEN 0 WHEN total_bytes <= 0 THEN record_count
    ELSE least(greatest(1, 201326592 // greatest(1, total_bytes // record_count)),
               greatest(1, 268435456 // greatest(1, total_bytes // record_count))) END AS rows_per_part
  FROM s)
SELECT source, total_bytes, record_count, CAST(rows_per_part AS BIGINT) AS rows_per_part,
       CAST((record_count + rows_per_part - 1) // rows_per_part AS BIGINT) AS n_parts FROM r""")
def q_part_sizing(spark, sf):
    prep(spark)
    d = table(spark, sf, "documents")
    s = d.groupBy("source").agg(
        F.sum(F.octet_length(F.encode("text", "UTF-8"))).cast("bigint").alias("total_bytes"),
        F.count(F.lit(1)).cast("bigint").alias("record_count"))
    rpp = N.records_per_chunk("total_bytes", "record_count")
    return (s.withColumn("rows_per_part", rpp)
            .withColumn("n_parts", N.part_count("record_count", "rows_per_part")))


@query("part_manifest", with_ctes(VFILES) + """
, p AS (
  SELECT doc_id, key, length AS total_bytes,
         CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS record_count
  FROM vf JOIN documents d USING (doc_id)
), r AS (
  SELECT *, CASE WHEN record_count <= 0 THEN 0 WHEN total_bytes <= 0 THEN record_count
    ELSE least(greatest(1, 201326592 // greatest(1, total_bytes // record_count)),
               greatest(1, 268435456 // greatest(1, total_bytes // record_count))) END AS rpp,
    regexp_replace(key, '\\.[^./]*$', '') AS stem
  FROM p
), n AS (
  SELECT *, (record_count + rpp - 1) // rpp AS n_parts FROM r
)
SELECT doc_id, stem || '.parquet' AS base_key, CAST(record_count AS BIGINT) AS record_count,
       CAST(rpp AS BIGINT) AS rows_per_part, CAST(n_parts AS BIGINT) AS n_parts,
       CASE WHEN n_parts <= 1 THEN stem || '.parquet' ELSE stem || '.manifest.json' END AS processed_key,
       CASE WHEN n_parts <= 1 THEN stem || '.parquet'
            ELSE array_to_string(list_transform(range(1, n_parts + 1),
                   lambda i: printf('%s.part-%05d.parquet', stem, i)), ',') END AS parts
FROM n""".replace("WITH ", "WITH ", 1).replace(")\n, p AS", "),\np AS"))
def q_part_manifest(spark, sf):
    prep(spark)
    d = table(spark, sf, "documents")
    f = vfiles(spark, sf).select("doc_id", "key", F.col("length").alias("total_bytes"))
    lines = d.select("doc_id", F.size(F.split("text", "\n")).cast("bigint").alias("record_count"))
    p = f.join(lines, "doc_id")
    return S.parts_plan(p, key="key", total_bytes="total_bytes", record_count="record_count").select(
        "doc_id", "base_key", "record_count", "rows_per_part", "n_parts", "processed_key",
        F.concat_ws(",", "parts").alias("parts"))


# ------------------------------------------------------- A01 A08-A12 A20 (real files)

EVENTS_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint",
                "event_type": "string", "value": "double", "props": "string"}
_EVENTS_SQL = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props
FROM events"""


def _events_landing(spark, sf, fmt):
    """Write events into a fresh landing area as ``fmt`` files, one folder
    per (event type, day); returns the landing root."""
    ev = table(spark, sf, "events")
    root = scratch_path(spark, f"landing-{fmt}")
    day = F.date_format("ts", "yyyy-MM-dd")
    if fmt == "parquet":
        body = ev
    else:
        body = ev.select(F.col("event_id").cast("string").alias("event_id"),
                         F.date_format("ts", TS_US_FMT).alias("ts"),
                         F.col("user_id").cast("string").alias("user_id"), "event_type",
                         F.col("value").cast("string").alias("value") if fmt == "csv" else F.col("value"),
                         "props")
    body = body.withColumn("source", F.col("event_type")).withColumn("date", day)
    opts = {"header": "true", "escape": '"'} if fmt == "csv" else {}
    LD.write_landing(body, root, fmt=fmt, options=opts)
    return root


def _ingest_events(spark, sf, fmt):
    prep(spark)
    land = _events_landing(spark, sf, fmt)
    t = IngestTables(scratch_path(spark, f"state-{fmt}"))
    ingest_landing(spark, land, t, batch_id=1)
    p = read_processed(spark, t)
    typed = FT.coerce(p.select(*EVENTS_TYPES), EVENTS_TYPES, flag=None)
    return typed.select("event_id", ts_text("ts", micros=True).alias("ts"), "user_id",
                        "event_type", "value", "props")


@query("ingest_csv", _EVENTS_SQL)
def q_ingest_csv(spark, sf):
    return _ingest_events(spark, sf, "csv")


@query("ingest_ndjson", _EVENTS_SQL)
def q_ingest_ndjson(spark, sf):
    return _ingest_events(spark, sf, "json")


@query("ingest_parquet", _EVENTS_SQL)
def q_ingest_parquet(spark, sf):
    return _ingest_events(spark, sf, "parquet")


# ------------------------------------------------------------------ A05 A19
RANGES_LIMIT, RANGES_BYTES, RANGES_BLOCK = 6000, 2500, 2000   # a lowered size limit, and small ranges


@query("quarantine_ranges", f"""
WITH f AS (SELECT event_type AS source, strftime(DATE '2024-01-01' + CAST(event_id // {RANGES_BLOCK} AS INTEGER), '%Y-%m-%d') AS date,
                  'event_id,user_id,event_type' || chr(10)
                  || string_agg(event_id || ',' || user_id || ',' || event_type || chr(10), '' ORDER BY event_id) AS body
           FROM events GROUP BY ALL),
o AS (SELECT *, unnest(range((length(body) + {RANGES_BYTES - 1}) // {RANGES_BYTES})) AS seq FROM f WHERE length(body) > {RANGES_LIMIT})
SELECT source, date, sha256(body) AS content_hash, 'quarantined' AS status,
       'file size exceeds maximum limit of {RANGES_LIMIT} bytes' AS reason, seq,
       length(substr(body, seq * {RANGES_BYTES} + 1, {RANGES_BYTES}))::INTEGER AS n_bytes,
       sha256(substr(body, seq * {RANGES_BYTES} + 1, {RANGES_BYTES})) AS range_hash FROM o
UNION ALL
SELECT source, date, sha256(body), 'done', NULL, NULL, NULL, NULL FROM f WHERE length(body) <= {RANGES_LIMIT}""")
def q_quarantine_ranges(spark, sf):
    """Events land as CSV files of up to 2,000 consecutive ids a type; those over the lowered
    limit are quarantined in ranges."""
    prep(spark)
    ev = table(spark, sf, "events")
    land, t = scratch_path(spark, "landing-ranges"), IngestTables(scratch_path(spark, "state-ranges"))
    block = F.expr(f"date_add(date '2024-01-01', int(event_id div {RANGES_BLOCK}))")
    files = ev.select("event_id", "user_id", "event_type", F.col("event_type").alias("source"),
                      F.date_format(block, "yyyy-MM-dd").alias("date"))
    files = files.repartition("source", "date").sortWithinPartitions("source", "date", "event_id")
    LD.write_landing(files, land, fmt="csv", options={"header": "true"}, max_bytes=None)     # one file a folder, in order
    out = ingest_landing(spark, land, t, batch_id=1, max_bytes=RANGES_LIMIT, range_bytes=RANGES_BYTES)
    kept = quarantined_bytes(spark, t).select("path", "seq", F.length("content").alias("n_bytes"),
                                              F.sha2("content", 256).alias("range_hash"))
    return (out.join(kept, "path", "left")
            .select(C.source_from_key("path").alias("source"), C.date_from_key("path").alias("date"), "content_hash",
                    "status", "reason", "seq", "n_bytes", "range_hash"))


# ---------------------------------------------------------------------- A03
@query("landing_write", """
SELECT event_id, event_type AS source, strftime(ts, '%Y-%m-%d') AS date, value FROM events""")
def q_landing_write(spark, sf):
    prep(spark)
    ev = table(spark, sf, "events")
    root = scratch_path(spark, "landing-push")
    body = ev.select("event_id", "value", F.col("event_type").alias("source"),
                     F.date_format("ts", "yyyy-MM-dd").alias("date"))
    LD.write_landing(body, root, fmt="json")
    back = spark.read.schema("event_id bigint, value double, source string, date string").json(root)
    return back.select("event_id", "source", "date", "value")


# ---------------------------------------------------------------------- A12
@query("merge_sources", """
SELECT event_id, event_type, value,
       CASE WHEN event_type IN ('click', 'view') THEN 'a' ELSE 'b' END AS adapter
FROM events""")
def q_merge_sources(spark, sf):
    from ..streaming.ingest import merge_streams
    prep(spark)
    ev = table(spark, sf, "events").select("event_id", "event_type", "value")
    ra, rb = scratch_path(spark, "adapter-a"), scratch_path(spark, "adapter-b")
    ev.where(F.col("event_type").isin("click", "view")).write.parquet(ra)
    ev.where(~F.col("event_type").isin("click", "view")).write.parquet(rb)
    schema = "event_id bigint, event_type string, value double"
    sa = spark.readStream.schema(schema).parquet(ra).withColumn("adapter", F.lit("a"))
    sb = spark.readStream.schema(schema).parquet(rb).withColumn("adapter", F.lit("b"))
    out = scratch_path(spark, "merged")
    merge_streams([sa, sb], out, scratch_path(spark, "merged-ckpt"))
    return spark.read.parquet(out).select("event_id", "event_type", "value", "adapter")


# ------------------------------------------------------------------ A23 A24
_DONE_SQL = with_ctes(VFILES, FIRST) + """
SELECT m.content_hash AS key, 's3' AS source, m.path, m.content_hash, m.format, m.length AS size,
       strftime(m.received_at, '%Y-%m-%d %H:%M:%S') AS received_at,
       strftime(m.processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at,
       'processed' AS processed_bucket,
       regexp_replace(m.key, '\\.[^./]*$', '') || '.parquet' AS processed_key,
       'landing' AS meta_bucket, m.key AS meta_key
FROM mcur m WHERE m.status = 'done'"""


def _done_events(spark, sf):
    from ..streaming import topics as TP
    files, log = _scenario(spark, sf)
    cur = M.current(log).where(F.col("status") == "done")
    done = (cur.select("content_hash", "processed_at")
            .join(files.select("content_hash", "path", "key", "format", "length", "received_at"),
                  ["content_hash"])
            .join(M.first_by_hash(files).select("content_hash", "path"), ["content_hash", "path"]))
    done = done.withColumn("processed_key", N.processed_key(N.base_key("key"), F.lit(1)))
    return TP.event_json(done, "processed", F.col("processed_at"))


def _event_cols(d):
    return d.select("key", F.col("e.source").alias("source"), F.col("e.path").alias("path"),
                    F.col("e.content_hash").alias("content_hash"), F.col("e.format").alias("format"),
                    F.col("e.size").alias("size"),
                    ts_text(F.col("e.received_at")).alias("received_at"),
                    ts_text(F.col("e.processed_at")).alias("processed_at"),
                    F.col("e.processed_bucket").alias("processed_bucket"),
                    F.col("e.processed_key").alias("processed_key"),
                    F.col("e.metadata")["bucket"].alias("meta_bucket"),
                    F.col("e.metadata")["key"].alias("meta_key"))


@query("publish_processed", _DONE_SQL)
def q_publish_processed(spark, sf):
    from ..streaming import topics as TP
    msgs = _done_events(spark, sf)
    return _event_cols(TP.decode_events(msgs))


@query("consume_processed", _DONE_SQL)
def q_consume_processed(spark, sf):
    """Topic with every done event twice (redelivery) plus one undecodable
    message per quarantined file; the consumer keeps one effect per hash."""
    from ..streaming import topics as TP
    msgs = _done_events(spark, sf).withColumn("batch_id", F.lit(1).cast("bigint"))
    files, log = _scenario(spark, sf)
    junk = (M.current(log).where(F.col("status") == "quarantined")
            .select(F.col("content_hash").alias("key"), F.col("reason").alias("value"),
                    F.col("processed_at").alias("timestamp"), F.lit(0).alias("partition"),
                    F.lit(1).cast("bigint").alias("batch_id")))
    topic = scratch_path(spark, "topic")
    msgs.unionByName(msgs).unionByName(junk).write.parquet(topic)
    out, dl = scratch_path(spark, "consumed"), scratch_path(spark, "dead-letter")
    TP.consume(spark, topic, out, dl, scratch_path(spark, "consumer-ckpt"))
    got = TP.read_consumed(spark, out)
    return got.select(
        "key", "source", "path", "content_hash", "format", "size",
        ts_text("received_at").alias("received_at"), ts_text("processed_at").alias("processed_at"),
        "processed_bucket", "processed_key", F.col("metadata")["bucket"].alias("meta_bucket"),
        F.col("metadata")["key"].alias("meta_key"))


# ---------------------------------------------------------------------- A18
@query("recover_stuck", with_ctes(VFILES, FIRST) + f"""
, stuck AS (
  SELECT * FROM mcur WHERE status = 'processing'
    AND created_at < TIMESTAMP '{AS_OF}' - INTERVAL 31 MINUTE
)
SELECT s.content_hash, s.path,
       CASE WHEN l.doc_id IS NULL THEN 'failed' ELSE 'pending' END AS new_status,
       CASE WHEN l.doc_id IS NULL THEN 'payload not found' END AS reason,
       CASE WHEN l.doc_id IS NULL THEN NULL ELSE s.format END AS format
FROM stuck s LEFT JOIN labels l ON l.doc_id = s.doc_id""".replace(")\n, stuck AS", "),\nstuck AS"))
def q_recover_stuck(spark, sf):
    from ..operators.recovery import recover
    files, log = _scenario(spark, sf)
    cur = M.current(log)
    # landing still holds the objects of labelled documents (the rest expired)
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id"), "doc_id",
                                              "left_semi")
    from ..sources.virtual import virtual_files
    landing = virtual_files(docs).select("path", "key", "content", "length")
    rows = recover(cur, landing, F.lit(AS_OF).cast("timestamp"))
    return rows.select("content_hash", "path", "new_status", "reason", "format")


# ------------------------------------------------------------- A01 (stream)
@query("ingest_stream", _EVENTS_SQL)
def q_ingest_stream(spark, sf):
    """A01 as a stream: NDJSON event files picked up by the landing stream in
    several micro-batches (``maxFilesPerTrigger``), each one ingest batch."""
    from ..streaming.ingest import run_ingest_stream
    prep(spark)
    land = _events_landing(spark, sf, "json")
    n_files = len(spark.read.format("binaryFile").load(land).inputFiles())
    t = IngestTables(scratch_path(spark, "state-stream"))
    run_ingest_stream(spark, land, t, scratch_path(spark, "ingest-ckpt"),
                      max_files_per_trigger=max(1, -(-n_files // 3)))
    p = read_processed(spark, t)
    typed = FT.coerce(p.select(*EVENTS_TYPES), EVENTS_TYPES, flag=None)
    return typed.select("event_id", ts_text("ts", micros=True).alias("ts"), "user_id",
                        "event_type", "value", "props")


# --------------------------------------------------- A06 A07 A11 A19 A20 mixed
@query("ingest_mixed", _EVENTS_SQL + """
WHERE event_type <> 'error'""")
def q_ingest_mixed(spark, sf):
    """One landing area, one batch, every format: click/view events as CSV,
    purchases as NDJSON, signups as Parquet, errors as .txt (unsupported →
    quarantined). The processed table is the union of the parsed files;
    re-typed it must equal the non-error events."""
    prep(spark)
    ev = table(spark, sf, "events")
    root = scratch_path(spark, "landing-mixed")
    day = F.date_format("ts", "yyyy-MM-dd")
    text_cols = [F.col("event_id").cast("string").alias("event_id"), F.date_format("ts", TS_US_FMT).alias("ts"),
                 F.col("user_id").cast("string").alias("user_id"), "event_type",
                 F.col("value").cast("string").alias("value"), "props"]

    csv_part = ev.where(F.col("event_type").isin("click", "view"))
    LD.write_landing(csv_part.select(*text_cols, F.col("event_type").alias("source"), day.alias("date")),
                     root, fmt="csv", options={"header": "true", "escape": '"'})
    js = ev.where(F.col("event_type") == "purchase")
    LD.write_landing(js.select(*text_cols[:4], F.col("value"), "props", F.col("event_type").alias("source"),
                               day.alias("date")), root, fmt="json")
    pq = ev.where(F.col("event_type") == "signup")
    LD.write_landing(pq.select("*", F.col("event_type").alias("source"), day.alias("date")),
                     root, fmt="parquet")
    tx = ev.where(F.col("event_type") == "error")
    LD.write_landing(tx.select(F.to_json(F.struct(*text_cols)).alias("value"),
                               F.col("event_type").alias("source"), day.alias("date")),
                     root, fmt="text")
    t = IngestTables(scratch_path(spark, "state-mixed"))
    ingest_landing(spark, root, t, batch_id=1)
    p = read_processed(spark, t)
    typed = FT.coerce(p.select(*EVENTS_TYPES), EVENTS_TYPES, flag=None)
    return typed.select("event_id", ts_text("ts", micros=True).alias("ts"), "user_id",
                        "event_type", "value", "props")


# ------------------------------------------------------------ A02 → ingest
@query("ingest_notified", _EVENTS_SQL)
def q_ingest_notified(spark, sf):
    """The reference's main path: every landed object is announced by an
    object-store notification (keys URL-encoded, several records per
    message); the decoded notifications drive the ingest."""
    from ..operators.ingest import ingest_notifications
    prep(spark)
    land = _events_landing(spark, sf, "json")
    listing = LD.read_landing(spark, land).select("key")          # metadata only
    rec = F.struct(F.struct(
        F.struct(F.lit("landing").alias("name")).alias("bucket"),
        F.struct(F.url_encode("key").alias("key"), F.lit(0).cast("bigint").alias("size"),
                 F.md5("key").alias("eTag")).alias("object")).alias("s3"))
    # one message per landing folder (a source's files of one day)
    msgs = (listing.groupBy(F.regexp_replace("key", "/[^/]*$", "").alias("m"))
            .agg(F.collect_list(rec).alias("Records"))
            .select(F.to_json(F.struct("Records")).alias("value")))
    t = IngestTables(scratch_path(spark, "state-notified"))
    ingest_notifications(spark, msgs, land, t, batch_id=1)
    p = read_processed(spark, t)
    typed = FT.coerce(p.select(*EVENTS_TYPES), EVENTS_TYPES, flag=None)
    return typed.select("event_id", ts_text("ts", micros=True).alias("ts"), "user_id",
                        "event_type", "value", "props")
