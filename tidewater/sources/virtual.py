"""Virtual landing files: every ``documents`` row seen as one landed object.

This lets the per-file operators (hash, sniff, validate, idempotency,
manifest, quarantine, naming, publish) run over the whole documents table
without first materialising tens of thousands of tiny objects.

Scheme (ours, deterministic from the row):
- key ``source=<source>/date=2026-05-17/doc_<doc_id>.<ext>`` in bucket ``landing``,
  ext cycling by ``doc_id % 7`` through csv, json, ndjson, jsonl, parquet, txt, CSV
- bytes = UTF-8 text, prefixed with ``PAR1`` when ``doc_id % 11 = 0``, else with
  0x1f 0x8b when ``doc_id % 13 = 0``
- arrival = 2026-05-17 00:00:00 UTC + doc_id seconds
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C

EXTENSIONS = ("csv", "json", "ndjson", "jsonl", "parquet", "txt", "CSV")
LANDING_BUCKET = "landing"
LANDING_DATE = "2026-05-17"
ARRIVAL_EPOCH = 1778976000  # 2026-05-17 00:00:00 UTC


def virtual_files(documents: DataFrame) -> DataFrame:
    d = documents
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTENSIONS]),
                       (F.col("doc_id") % len(EXTENSIONS) + 1).cast("int"))
    prefix = (F.when(F.col("doc_id") % 11 == 0, F.unhex(F.lit("50415231")))
              .when(F.col("doc_id") % 13 == 0, F.unhex(F.lit("1F8B")))
              .otherwise(F.unhex(F.lit(""))))
    key = F.format_string("source=%s/date=%s/doc_%d.%s", F.col("source"),
                          F.lit(LANDING_DATE), F.col("doc_id"), ext)
    content = F.concat(prefix, F.encode(F.col("text"), "UTF-8"))
    extra = [c for c in ("lang",) if c in d.columns]
    return d.select(
        "doc_id", *extra,
        F.concat(F.lit(f"s3://{LANDING_BUCKET}/"), key).alias("path"),
        key.alias("key"),
        content.alias("content"),
        F.col("source"),
        F.lit(LANDING_DATE).alias("date"),
        F.timestamp_seconds(F.lit(ARRIVAL_EPOCH) + F.col("doc_id")).alias("received_at"),
    ).withColumn("length", F.octet_length("content").cast("bigint"))


def classified(files: DataFrame, expected_hash: str | None = None) -> DataFrame:
    """Adds content_hash, format and validation reason; drops the bytes."""
    out = files.select(
        "*",
        C.content_hash("content").alias("content_hash"),
        C.detect_format("key", "content").alias("format"),
    )
    out = out.withColumn(
        "reason",
        C.validation_reason("format", "length", "content_hash",
                            expected_hash if expected_hash else None))
    return out.drop("content")
