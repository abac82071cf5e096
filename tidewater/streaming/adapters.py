"""Unlike sources into one ingest.

An adapter turns its own stream into items of one shape, and :func:`run_adapters` runs their
union as one streaming query, each adapter with its own progress in the query's checkpoint:

* :func:`landing_adapter`: files that land below a folder, named by the file source;
* :func:`notification_adapter`: object-store event messages that name files (A02);
* :func:`message_adapter`: rows that carry a payload, which becomes a landed file (A03).

Items hold names and payloads, never the bytes of landed files. A micro-batch writes its items
once, collects the paths that they name (bounded by the adapters' triggers) and gives all of them
to one ``ingest_batch``, so equal bytes from two adapters are one entry of the manifest, in one batch
or in different ones, and a file that two adapters name is read once.

The list of adapters belongs to the checkpoint: a query that is started again on the same
checkpoint must be given the same adapters in the same order.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import IngestTables, _write_stage, ingest_batch, notified_files, purge_staging, writer_base
from ..sources import landing as LD

ITEM = "kind string, root string, path string, value string, source string, date string, name string, body binary"


def _items(stream: DataFrame, **columns) -> DataFrame:
    fields = [f.split() for f in ITEM.split(", ")]
    return stream.select(*[columns.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields])


def landing_adapter(spark: SparkSession, root: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """New files below ``root``: their paths only, no bytes."""
    return _items(LD.stream_landing(spark, root, max_files_per_trigger),
                  kind=F.lit("file"), root=F.lit(root), path=F.col("path"))


def notification_adapter(messages: DataFrame, root: str, value_col: str = "value") -> DataFrame:
    """A stream of notification messages about objects below ``root``."""
    return _items(messages, kind=F.lit("notice"), root=F.lit(root), value=F.col(value_col))


def message_adapter(messages: DataFrame, root: str, source: str = "source", name: str = "name", body: str = "body",
                    received: str = "received_at") -> DataFrame:
    """A stream of rows with a payload (text or bytes), landed below ``root`` by source and UTC day of receipt."""
    return _items(messages, kind=F.lit("payload"), root=F.lit(root), source=F.col(source), name=F.col(name),
                  body=F.col(body), date=F.date_format(F.col(received), "yyyy-MM-dd"))


def ingest_items(spark: SparkSession, items: DataFrame, t: IngestTables, batch_id: int, now: _dt.datetime,
                 empties: DataFrame | None = None) -> DataFrame:
    """One batch of items (and of landing rows of empty files) through ``ingest_batch``; returns its result."""
    items = _write_stage(items, t.staging(batch_id, "items"))
    paths = {r.path for r in items.where(F.col("kind") == "file").select("path").distinct().collect()}
    none = [] if empties is None else [empties]
    payloads = items.where(F.col("kind") == "payload")
    roots = [(r.kind, r.root) for r in items.where(F.col("kind") != "file").select("kind", "root").distinct().collect()]
    for i, (kind, root) in enumerate(sorted(roots)):
        if kind == "notice":
            notes = items.where((F.col("kind") == kind) & (F.col("root") == root)).select("value")
            found, missing = notified_files(spark, notes, root, t, batch_id, now)
            paths.update(found)
            none += [] if missing is None else [missing]
        else:
            put = _write_stage(LD.write_payloads(payloads.where(F.col("root") == root), root),
                               t.staging(batch_id, f"payloads-{i}")).distinct()
            paths.update(r.path for r in put.where("length > 0").select("path").collect())
            none.append(LD.empty_rows(put.where("length = 0").select(LD.norm_uri(F.col("path")).alias("file_id"))))
    landed = LD.read_files(spark, sorted(paths))
    for rows in none:
        landed = landed.unionByName(rows)
    if none:       # an empty file that two adapters name; the others are read once
        landed = landed.where("length > 0").unionByName(landed.where("length = 0").dropDuplicates(["file_id"]))
    return ingest_batch(spark, landed, t, batch_id, now)


def run_adapters(spark: SparkSession, adapters: list[DataFrame], t: IngestTables, checkpoint: str,
                 landing_roots: list[str] = (), available_now: bool = True, keep_staging: int = 5):
    """All ``adapters`` as one streaming query into the ingest. ``landing_roots``: folders
    swept for empty files, which the file source never gives (D19)."""
    from .ingest import new_empty_files

    merged = adapters[0]
    for a in adapters[1:]:
        merged = merged.unionByName(a)
    base = writer_base(spark, checkpoint)

    def handle(df: DataFrame, batch_id: int) -> None:
        batch_id, empties = base + int(batch_id), None
        if landing_roots:
            empties = new_empty_files(spark, list(landing_roots), t, batch_id)
        ingest_items(spark, df, t, batch_id, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), empties)
        purge_staging(spark, t, batch_id, keep_staging)

    w = merged.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")).start()
    if available_now:
        q.awaitTermination()
    return q
