"""Processed-object sizing and naming as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .classify import key_of


def records_per_chunk(total_bytes: Column | str, record_count: Column | str) -> Column:
    """Rows per processed part, with the reference's integer arithmetic.

    0 when there are no records; all records when the byte size is unknown;
    else min(target, max) where bytes-per-record = max(1, bytes div n),
    target = max(1, 192 MiB div bpr) and max = max(1, 256 MiB div bpr).
    """
    b = _c(total_bytes).cast("bigint")
    n = _c(record_count).cast("bigint")
    bpr = F.greatest(F.lit(1).cast("bigint"), _div(b, n))
    target = F.greatest(F.lit(1).cast("bigint"), _div(F.lit(K.PART_TARGET_BYTES).cast("bigint"), bpr))
    mx = F.greatest(F.lit(1).cast("bigint"), _div(F.lit(K.PART_MAX_BYTES).cast("bigint"), bpr))
    return (F.when(n <= 0, F.lit(0).cast("bigint"))
            .when(b <= 0, n)
            .otherwise(F.least(target, mx)))


def part_count(record_count: Column | str, chunk: Column | str) -> Column:
    """Number of parts the records are cut into (chunk <= 0 means one part)."""
    n = _c(record_count).cast("bigint")
    c = _c(chunk).cast("bigint")
    eff = F.when(c <= 0, n).otherwise(c)
    return F.when(n <= 0, F.lit(0).cast("bigint")).otherwise(_div(n + eff - 1, eff))


def _strip_ext(key: Column) -> Column:
    # path.Ext: suffix from the last '.' of the last '/'-separated element
    return F.regexp_replace(key, r"\.[^./]*$", "")


def base_key(key: Column | str) -> Column:
    """Landing key -> processed base key (``…/x.csv`` -> ``…/x.parquet``)."""
    k = F.regexp_replace(_c(key), r"^/+", "")
    return F.concat(_strip_ext(k), F.lit(".parquet"))


def base_key_from_path(path: Column | str) -> Column:
    """Base key when only the ``s3://bucket/key`` path is known."""
    return base_key(key_of(path))


def part_key(base: Column | str, part: Column | str) -> Column:
    return F.format_string("%s.part-%05d.parquet", _strip_ext(_c(base)), _c(part).cast("int"))


def manifest_key(base: Column | str) -> Column:
    return F.concat(_strip_ext(_c(base)), F.lit(".manifest.json"))


def part_keys(base: Column | str, n_parts: Column | str) -> Column:
    """All object keys written for one file: the base key alone, or parts 1..n."""
    b = _c(base)
    n = _c(n_parts).cast("int")
    return F.when(n <= 1, F.array(b)).otherwise(
        F.transform(F.sequence(F.lit(1), n), lambda i: part_key(b, i)))


def processed_key(base: Column | str, n_parts: Column | str) -> Column:
    """The key published for the file: base key, or the parts manifest key."""
    return F.when(_c(n_parts) <= 1, _c(base)).otherwise(manifest_key(base))


def _div(a: Column, b: Column) -> Column:
    """Exact 64-bit integer division (SQL ``div``), no detour through doubles."""
    return F.call_function("div", a, b)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def records_per_chunk_py(total_bytes: int, record_count: int) -> int:
    """Driver-side twin of ``records_per_chunk`` for writer options."""
    if record_count <= 0:
        return 0
    if total_bytes <= 0:
        return record_count
    bpr = max(1, total_bytes // record_count)
    return min(max(1, K.PART_TARGET_BYTES // bpr), max(1, K.PART_MAX_BYTES // bpr))
