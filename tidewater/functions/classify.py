"""Per-file classification as Column expressions.

Everything here is a plain Catalyst expression, so it stays inside
whole-stage codegen and is evaluated where the bytes already are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import constants as K


def content_hash(content: Column | str) -> Column:
    """Lowercase hex SHA-256 of the bytes."""
    return F.sha2(_c(content), 256)


def extension(key: Column | str) -> Column:
    """Text after the last '.' anywhere in the key ('' when there is none).

    Like the reference this scans the whole key, so a dot in a folder name
    with an extension-less file name yields a non-matching "extension".
    """
    return F.regexp_extract(_c(key), r"\.([^.]*)$", 1)


def detect_format(key: Column | str, content: Column | str) -> Column:
    """Magic bytes first, then the case-sensitive extension."""
    body = _c(content)
    ext = extension(key)
    by_ext = F.lit("unknown")
    for e, fmt in reversed(list(K.EXTENSION_FORMATS.items())):
        by_ext = F.when(ext == F.lit(e), F.lit(fmt)).otherwise(by_ext)
    return (
        F.when(F.hex(F.substring(body, 1, 4)) == F.lit(K.PARQUET_MAGIC_HEX), F.lit("parquet"))
        .when(F.hex(F.substring(body, 1, 2)) == F.lit(K.GZIP_MAGIC_HEX), F.lit("gzip"))
        .otherwise(by_ext)
    )


def validation_reason(fmt: Column | str, length: Column | str,
                      actual_hash: Column | str,
                      expected_hash: Column | str | None = None) -> Column:
    """The first failing check's message, or null when the file is valid.

    Order: unknown format -> empty -> larger than 500 MiB -> hash mismatch.
    The hash check only applies where an expected hash is known (D08).
    """
    fmt, length, actual = _c(fmt), _c(length), _c(actual_hash)
    chain = (
        F.when(fmt == F.lit("unknown"), F.lit(K.MSG_UNSUPPORTED))
        .when(length == F.lit(0), F.lit(K.MSG_EMPTY))
        .when(length > F.lit(K.MAX_FILE_SIZE), F.lit(K.MSG_TOO_BIG))
    )
    if expected_hash is not None:
        exp = _c(expected_hash)
        chain = chain.when(
            exp.isNotNull() & (exp != actual),
            F.format_string("content hash mismatch: expected %s, got %s", exp, actual),
        )
    return chain.otherwise(F.lit(None).cast(T.StringType()))


def parse_reason(fmt: Column | str) -> Column:
    """Formats that pass validation but have no parser (gzip)."""
    fmt = _c(fmt)
    return F.when(~fmt.isin(*K.PARSEABLE_FORMATS),
                  F.format_string("unsupported format: %s", fmt))


def key_of(path: Column | str) -> Column:
    """Object key: the path without scheme and bucket/authority.

    ``s3://landing/source=a/date=d/x.csv`` -> ``source=a/date=d/x.csv``;
    ``file:/tmp/l/source=a/...`` -> ``source=a/...`` when the landing root is
    stripped by the caller; here only ``scheme://bucket/`` is removed.
    """
    p = _c(path)
    return F.when(p.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/"),
                  F.regexp_replace(p, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/", "")
                  ).otherwise(F.regexp_replace(p, r"^/+", ""))


def source_from_key(path: Column | str, default: str = K.INGRESS) -> Column:
    """``source=`` path segment, the ingress name when absent."""
    v = F.regexp_extract(_c(path), r"(?:^|/)source=([^/]*)/", 1)
    return F.when(v == F.lit(""), F.lit(default)).otherwise(v)


def date_from_key(path: Column | str) -> Column:
    """``date=`` path segment as text (null when absent)."""
    v = F.regexp_extract(_c(path), r"(?:^|/)date=([^/]*)/", 1)
    return F.when(v == F.lit(""), F.lit(None).cast(T.StringType())).otherwise(v)


def is_hidden_name(path: Column | str) -> Column:
    """Names Spark's file listing never returns (``_x``, ``.x``)."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1).rlike(r"^[_.]")


def file_id(c: Column | str = "_metadata.file_path") -> Column:
    """Canonical file id: Spark's encoded file URI, ``file:///x`` → ``file:/x``."""
    return F.regexp_replace(_c(c), "^file:///", "file:/")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x
