"""Rendering any column as text (the processed tables are all-string)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def utf8(content: Column) -> Column:
    """Bytes as text; bytes that are not UTF-8 become U+FFFD, never an error."""
    return F.make_valid_utf8(content.cast("string"))


def as_text(c: Column, dtype: T.DataType) -> Column:
    """Nested values as compact JSON, bytes as UTF-8 (U+FFFD for what is not),
    everything else cast."""
    t = dtype.typeName()
    if t in ("struct", "array", "map"):
        return F.to_json(c)
    if t == "binary":
        return utf8(c)
    return c.cast("string")
