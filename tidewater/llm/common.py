"""Shared pieces of the text operators: table access, scratch tables, Arrow helpers."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, scratch_path
from ..sources.tables import table


ARROW_ROWS = "2000"       # whole texts of a few kB each travel in batches of some MB


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return table(spark, sf_dir, name)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read it
    back: lineage ends there, and a lost executor costs a reread, not a rerun."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_worker(name: str, build: Callable):
    """``build()`` once per Python worker process, kept between its tasks until
    a task asks for another name: a worker holds one such object at a time."""
    held = sys.modules.setdefault("_tidewater_llm_worker", types.ModuleType("_tidewater_llm_worker")).__dict__
    if held.get("name") != name:
        held.pop("value", None)
        held["value"] = build()
        held["name"] = name
    return held["value"]


def utf8(column) -> Iterator[bytes]:
    """The texts of an Arrow string column as bytes; null is empty."""
    import pyarrow as pa

    for v in column.cast(pa.binary()):
        yield v.as_py() or b""


def slices(batch, column: str | int, most_bytes: int = 4 << 20) -> Iterator:
    """Consecutive slices of an Arrow batch holding about ``most_bytes`` of
    ``column`` each (one row at least), so that work arrays stay small."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Helper column names that do not clash with those of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))
