"""Quarantine, processed encoding and part planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import naming as N
from ..functions.text import as_text


def quarantine_rows(files: DataFrame, at: Column) -> DataFrame:
    """Files failing validation, with their bytes and reason.

    ``files`` needs path, key, content, length; hashing and sniffing happen
    here so callers can pass raw landing rows.
    """
    h = C.content_hash("content")
    fmt = C.detect_format("key", "content")
    r = C.validation_reason(fmt, F.col("length"), h)
    return (files.select("path", "content", "length", h.alias("content_hash"), r.alias("reason"))
            .where(F.col("reason").isNotNull())
            .withColumn("quarantined_at", at.cast("timestamp")))


def parts_plan(df: DataFrame, key: str, total_bytes: str, record_count: str) -> DataFrame:
    """A21 + A22 per file: rows per part, part count, keys and the published key."""
    rpp = N.records_per_chunk(total_bytes, record_count)
    out = (df.withColumn("rows_per_part", rpp)
           .withColumn("n_parts", N.part_count(record_count, "rows_per_part"))
           .withColumn("base_key", N.base_key(key)))
    return (out.withColumn("parts", N.part_keys("base_key", "n_parts"))
            .withColumn("processed_key", N.processed_key("base_key", "n_parts")))


def all_string(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every column as nullable text; nested values as compact JSON."""
    return df.select(*[F.col(f"`{f.name}`") if f.name in keep
                       else as_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
                       for f in df.schema.fields])
