"""Files too large for one row, read in ranges inside tasks.

``binaryFile`` gives a file as one value, so a file over the size limit never goes
through it. Here a task opens the file itself and reads ``RANGE`` bytes at a time:

* :func:`hash_files` streams each file once through SHA-256 (a file is one task's
  work, since the hash is sequential) and keeps its first bytes for sniffing;
* :func:`copy_ranges` makes one row of every range of every file, dealt over all
  tasks, so a huge file is copied by many of them.

No row and no task ever holds more than one range of a file's bytes. ``file:`` paths
are opened directly (a folder that all executors mount), others through
``pyarrow.fs`` (s3, gs, hdfs, abfs with the credentials of the environment). A file
that is gone gives no row; any other failure fails the task, and the batch is run again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE = 8 << 20
TASK_BYTES = 8 << 20       # of a task's pieces, about
HEAD = 4                  # bytes that format detection looks at


def _tasks(spark, n: int, size: int) -> int:
    """Tasks for ``n`` pieces of ``size`` bytes in all: as many as the pieces, but once all cores are
    busy no more than the bytes ask for, since a task costs more than a small piece."""
    return int(max(1, min(n, 10_000, max(4 * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))))


def open_file(file_id: str):
    """A seekable reader of the file with this encoded URI."""
    from urllib.parse import unquote, urlsplit

    scheme = urlsplit(file_id).scheme
    if scheme in ("", "file"):
        return open(re.sub("^file:/+", "/", unquote(file_id)), "rb")
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(re.sub("^(s3[an]|abfss):", lambda m: {"a": "abfs", "s": "s3"}[m[0][0]] + ":", file_id))
    return store.open_input_file(path)


def write_file(path: str, body: bytes) -> None:
    """A file with these bytes at ``path`` (a plain URI or local path); a local one appears whole."""
    import os
    import uuid
    from urllib.parse import urlsplit

    if urlsplit(path).scheme in ("", "file"):
        place = re.sub("^file:/+", "/", path)
        folder, name = os.path.split(place)
        os.makedirs(folder, exist_ok=True)
        part = f"{folder}/.{name[:64]}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.write(body)
        os.replace(part, place)
        return
    from pyarrow import fs
    store, place = fs.FileSystem.from_uri(re.sub("^(s3[an]|abfss):", lambda m: {"a": "abfs", "s": "s3"}[m[0][0]] + ":", path))
    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(place) as f:
        f.write(body)


def hash_files(files: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """file_id, content_hash (SHA-256 of all bytes, lowercase hex), head (first bytes) and
    n_bytes of ``files`` (file_id)."""
    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        for b in batches:
            for file_id in b.column("file_id").to_pylist():
                digest, head, n = hashlib.sha256(), b"", 0
                try:
                    with open_file(file_id) as f:
                        while part := f.read(range_bytes):
                            head = head or part[:HEAD]
                            digest.update(part)
                            n += len(part)
                except FileNotFoundError:
                    continue
                yield pa.RecordBatch.from_pydict({"file_id": [file_id], "content_hash": [digest.hexdigest()],
                                                  "head": pa.array([head], pa.binary()), "n_bytes": pa.array([n], pa.int64())})
    n, size = files.agg(F.count(F.lit(1)), F.sum("length") if "length" in files.columns else F.lit(None)).first()
    # a number given, so that no coalescing joins them
    return files.select("file_id").repartition(_tasks(files.sparkSession, n, n * TASK_BYTES if size is None else size)).mapInArrow(
        run, "file_id string, content_hash string, head binary, n_bytes long")


def copy_ranges(files: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """A row for every range of ``files`` (file_id, length and others, which stay): seq from
    0, at (the offset) and content."""
    kept = [c for c in files.columns if c != "length"]
    ranges = files.where(F.col("length") > 0).select(
        *kept, "length", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {range_bytes}"))).alias("seq"))
    ranges = ranges.withColumn("at", F.col("seq") * range_bytes)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema if f.name != "length") + ", content binary"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).drop_columns(["length"])
                try:
                    with open_file(row.column("file_id")[0].as_py()) as f:
                        f.seek(row.column("at")[0].as_py())
                        part = f.read(range_bytes)
                except FileNotFoundError:
                    continue
                yield row.append_column("content", pa.array([part], pa.binary()))
    n, size = files.agg(F.sum(F.expr(f"(length + {range_bytes - 1}) div {range_bytes}")), F.sum("length")).first()
    return ranges.repartition(_tasks(files.sparkSession, n or 0, size or 0)).mapInArrow(run, schema)
