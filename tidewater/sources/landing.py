"""Landing area: read (A01, batch and stream), write (A03), path columns.

Layout: ``<root>/source=<s>/date=<yyyy-MM-dd>/<file>``. ``source`` and ``date``
are taken from the path; files elsewhere under the root are landed files too.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import classify as C
from ..functions import constants as K
from ..session import configure
from .ranges import write_file

BINARY_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


LANDED_SCHEMA = ("file_id string, path string, key string, modificationTime timestamp, length bigint, "
                 "content binary, source string, date string")


def literal(path: str) -> str:
    """A path for Spark's readers, which take paths for patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _shape(df: DataFrame) -> DataFrame:
    """Common landing columns: file_id is Spark's encoded file URI (the same
    form every file reader reports in ``_metadata.file_path``)."""
    key = F.regexp_extract("path", r"((?:^|/)source=[^/]*/date=[^/]*/.*)$", 1)
    key = F.when(key == "", F.regexp_extract("path", r"([^/]*)$", 1)).otherwise(
        F.regexp_replace(key, "^/", ""))
    return df.select(
        C.file_id().alias("file_id"),
        "path", key.alias("key"), "modificationTime", "length", "content",
        (F.coalesce(F.col("source"), C.source_from_key("path")) if "source" in df.columns
         else C.source_from_key("path")).alias("source"),
        (F.coalesce(F.col("date"), C.date_from_key("path")) if "date" in df.columns
         else C.date_from_key("path")).alias("date"),
    )


def read_landing(spark: SparkSession, root: str, path_filter: str | None = None,
                 dates: list[str] | None = None) -> DataFrame:
    """A01 batch: one row per non-empty landed file (optionally only the
    ``date=`` folders in ``dates``)."""
    configure(spark)
    # files at any depth, in the layout or not: source and date come from the path
    r = spark.read.format("binaryFile").option("ignoreMissingFiles", "true").option("recursiveFileLookup", "true")
    if path_filter:
        r = r.option("pathGlobFilter", path_filter)
    target = literal(root) if not dates else f"{literal(root.rstrip('/'))}/source=*/date={{{','.join(dates)}}}"
    try:
        return _shape(r.load(target))
    except Exception as e:  # noqa: BLE001
        if dates and ("PATH_NOT_FOUND" in str(e) or "does not exist" in str(e)):
            # no folder for these dates: an empty batch, not an error
            return spark.createDataFrame([], LANDED_SCHEMA)
        raise


def stream_landing(spark: SparkSession, root: str, max_files_per_trigger: int = 1000,
                   archive_dir: str | None = None) -> DataFrame:
    """A01 stream: new files as they land; the checkpoint's file log makes the
    pick-up durable (nothing is held only in memory, unlike a channel).

    The file source lists ``root`` on every trigger; with ``archive_dir``
    processed files are moved there (``cleanSource=archive``) so the listing
    stays the size of the backlog instead of the whole history. Recovery
    (A18) then looks for stuck files in the archive as well.
    """
    configure(spark)
    r = (spark.readStream.format("binaryFile").option("ignoreMissingFiles", "true").schema(BINARY_SCHEMA)
         .option("recursiveFileLookup", "true")
         .option("maxFilesPerTrigger", max_files_per_trigger))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return _shape(r.load(root))


def empty_files(spark: SparkSession, root: str, seen: DataFrame | None = None,
                dates: list[str] | None = None) -> DataFrame:
    """Zero-length files, which binaryFile never returns.

    The listing (file metadata on the driver, as for any file scan) minus
    the files that came back and minus ``seen``. With ``dates`` only those
    ``date=`` partitions are listed (one brace glob), so a trigger never
    lists the whole landing history.
    """
    none = empty_rows(spark.createDataFrame([], "file_id string"))
    r = spark.read.format("binaryFile").option("ignoreMissingFiles", "true").option("recursiveFileLookup", "true")
    target = literal(root)
    if dates is not None:
        if not dates:
            return none
        target = f"{literal(root.rstrip('/'))}/source=*/date={{{','.join(dates)}}}"
    try:
        listed = r.load(target)
        every = listed.inputFiles()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return none
        raise
    # metadata columns only: the file bytes are never read here
    nonempty = listed.select(norm_uri(F.col("_metadata.file_path")).alias("file_id"))
    if seen is not None:
        nonempty = nonempty.unionByName(seen.select(norm_uri(F.col("file_id")).alias("file_id")))
    all_df = spark.createDataFrame([(p,) for p in every], "file_id string").select(
        norm_uri(F.col("file_id")).alias("file_id"))
    return empty_rows(all_df.join(nonempty, "file_id", "left_anti"))


SETTLED_MS = 60_000       # a folder that changed in the last minute may still change within its recorded time


def sweep_empty_files(spark: SparkSession, root: str, known: dict[str, int]) -> tuple[DataFrame, dict[str, int]]:
    """D19 for a stream: (zero-length files as ``file_id``, folders to remember).

    Only folders that changed are listed. ``known`` maps folders that hold no
    folders to their modification time when they were last listed: a file system that
    keeps such times changes them whenever a file is created or moved there, so an
    equal time means nothing new. Folders that hold folders (the root, ``source=``)
    are listed each time, for the times of what they hold. Times younger than a minute
    are not remembered, nor are those of stores without folder times (zero, or always
    the present): these folders are listed again. A file cut to nothing in
    place is not noticed; a missing root holds nothing."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    settled = jvm.java.lang.System.currentTimeMillis() - SETTLED_MS
    empty: list[str] = []
    leaves: dict[str, int] = {}
    todo = [fs.getFileStatus(top)] if fs.exists(top) else []
    while todo:
        folder = todo.pop()
        uri, changed = folder.getPath().toUri().toString(), folder.getModificationTime()
        if known.get(uri) == changed:
            continue
        try:
            held = list(fs.listStatus(folder.getPath()))
        except Exception as e:  # noqa: BLE001
            if _gone(e):
                continue        # removed since its parent was listed
            raise
        leaf = True
        for st in held:
            name = st.getPath().getName()
            if name.startswith(".") or name.startswith("_") and "=" not in name:
                continue        # D26: hidden from every reader
            if st.isDirectory():
                leaf = False
                todo.append(st)
            elif st.getLen() == 0:
                empty.append(st.getPath().toUri().toString())
        if leaf and 0 < changed < settled:
            leaves[uri] = changed
    rows = spark.createDataFrame([(p,) for p in empty], "file_id string")
    return rows.select(norm_uri(F.col("file_id")).alias("file_id")), leaves


def _gone(e: Exception) -> bool:
    java = getattr(e, "java_exception", None)
    return java is not None and java.getClass().getName() == "java.io.FileNotFoundException"


def read_files(spark: SparkSession, paths: list[str], archive_dir: str | None = None) -> DataFrame:
    """A01 for known paths: one row for each that exists, nothing else is
    listed or read. With ``archive_dir`` a file that is gone is looked up
    where ``cleanSource=archive`` puts it; its row keeps the original path."""
    configure(spark)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def there(p: str) -> bool:
        q = jvm.org.apache.hadoop.fs.Path(p)
        return q.getFileSystem(conf).exists(q)

    now: dict[str, str] = {}      # where the file is → the path it landed at
    for p in paths:
        places = [p]
        if archive_dir:
            places.append(archive_dir.rstrip("/") + jvm.org.apache.hadoop.fs.Path(p).toUri().getPath())
        if found := next((x for x in places if there(x)), None):
            now[jvm.org.apache.hadoop.fs.Path(found).toString()] = p
    if not now:
        return spark.createDataFrame([], LANDED_SCHEMA)
    rows = _shape(spark.read.format("binaryFile").load([literal(p) for p in now]))
    if not archive_dir:
        return rows
    plain = F.regexp_replace("path", "^file:/+", "/")
    moved = spark.createDataFrame([(re.sub("^file:/+", "/", a), b) for a, b in now.items()], "place string, landed string")
    back = rows.withColumn("place", plain).join(F.broadcast(moved), "place").drop("place")
    return _shape_at(back)


def _shape_at(rows: DataFrame) -> DataFrame:
    """Landing columns of rows read elsewhere, as of the path ``landed``."""
    key = F.regexp_extract("landed", r"((?:^|/)source=[^/]*/date=[^/]*/.*)$", 1)
    key = F.when(key == "", F.regexp_extract("landed", r"([^/]*)$", 1)).otherwise(F.regexp_replace(key, "^/", ""))
    return rows.select("file_id", F.col("landed").alias("path"), key.alias("key"), "modificationTime", "length", "content",
                       C.source_from_key("landed").alias("source"), C.date_from_key("landed").alias("date"))


def norm_uri(c):
    return C.file_id(c)


def empty_rows(empties: DataFrame) -> DataFrame:
    """Landing-shaped rows for zero-length files given their encoded ids."""
    path = F.regexp_replace(F.regexp_replace("file_id", r"\+", "%2B"), "^file:///", "file:/")
    path = F.try_url_decode(path)
    key = F.regexp_extract(path, r"((?:^|/)source=[^/]*/date=[^/]*/.*)$", 1)
    key = F.when(key == "", F.regexp_extract(path, r"([^/]*)$", 1)).otherwise(
        F.regexp_replace(key, "^/", ""))
    return empties.select(
        "file_id", path.alias("path"), key.alias("key"),
        F.current_timestamp().alias("modificationTime"),
        F.lit(0).cast("bigint").alias("length"),
        F.unhex(F.lit("")).alias("content"),
        C.source_from_key(path).alias("source"), C.date_from_key(path).alias("date"))


def write_landing(df: DataFrame, root: str, source: str = "source", date: str = "date",
                  fmt: str = "json", mode: str = "append", options: dict | None = None,
                  max_bytes: int | None = K.MAX_FILE_SIZE) -> None:
    """File rows under ``source=<s>/date=<d>/`` (one or more files per pair).

    ``date`` must already be ``yyyy-MM-dd`` text (UTC) — D01. No file is larger than
    ``max_bytes``, the size from which the ingest refuses files, but for a single row that is. Rows
    of a pair are brought together and large pairs split over tasks; a file ends at the number of rows that
    the largest row of its size class allows. Classes are powers of 16, each written by itself, so one
    huge row makes no other file small. A row's size is that of its text as CSV, JSON or a line,
    before compression; for other formats its JSON text stands for it. Mode ``overwrite`` replaces the
    whole area (pairs, if ``spark.sql.sources.partitionOverwriteMode`` is ``dynamic``). None: the rows
    are written as they are dealt, without a bound and without a pass over them to measure it."""
    w = (df.withColumnRenamed(source, "source") if source != "source" else df)
    w = (w.withColumnRenamed(date, "date") if date != "date" else w)
    options = options or {}
    if max_bytes is None:
        return _write_files(w, root, fmt, mode, options)
    body = F.struct(*[F.col(f"`{c}`") for c in w.columns if c.lower() not in ("source", "date")])
    head = 0
    if fmt == "csv":
        line = F.to_csv(body, {k: str(v) for k, v in options.items() if k != "header"})
        head = sum(2 * len(c.encode()) + 3 for c in w.columns)      # a header line at its longest
    elif fmt == "text":
        line = F.col(next(c for c in w.columns if c.lower() not in ("source", "date")))
    else:
        line = F.to_json(body, {k: str(v) for k, v in options.items()} if fmt == "json" else {"ignoreNullFields": "false"})
    size = F.coalesce(F.octet_length(line), F.lit(0)) + 2
    grade = F.length(F.hex(size))         # hexadecimal digits: classes that differ 16 times
    classes = w.select(grade.alias("c"), size.alias("n")).groupBy("c").agg(F.max("n").alias("n")).collect()     # 16 rows at most
    for i, row in enumerate(sorted(classes)):
        rows = max(1, (max_bytes - head) // row["n"])
        part = w if len(classes) == 1 else w.where(grade == row["c"])
        _write_files(part.hint("rebalance", "source", "date"), root, fmt, mode if i == 0 else "append", {**options, "maxRecordsPerFile": rows})
    if not classes:
        _write_files(w, root, fmt, mode, options)


def _write_files(df: DataFrame, root: str, fmt: str, mode: str, options: dict) -> None:
    df.write.mode(mode).partitionBy("source", "date").format(fmt).options(**options).save(root)


def landing_key(source: str, filename: str, t: _dt.datetime | None = None) -> str:
    """A03 key for one pushed payload; the date is the UTC day."""
    if not filename or filename.startswith(("_", ".")):
        raise ValueError(f"{K.MSG_HIDDEN}: {filename!r}")  # D26
    t = t or _dt.datetime.now(_dt.timezone.utc)
    if t.tzinfo is not None:
        t = t.astimezone(_dt.timezone.utc)
    return f"source={source}/date={t.strftime('%Y-%m-%d')}/{filename}"


def put_payload(spark: SparkSession, root: str, source: str, body: bytes,
                filename: str | None = None, t: _dt.datetime | None = None) -> str:
    """A03 for one pushed payload (what the HTTP push did): write ``body`` to
    ``<root>/source=<s>/date=<UTC day>/<filename>`` through the cluster file
    system; returns the full path. The landing stream picks it up (D02)."""
    key = landing_key(source, filename or default_filename(t), t)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{key}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(p, True)
    try:
        out.write(bytearray(body))
    finally:
        out.close()
    return p.toString()


def default_filename(t: _dt.datetime | None = None) -> str:
    """Name for a push without a file name: ``<unix nanoseconds>.json``."""
    t = t or _dt.datetime.now(_dt.timezone.utc)
    return f"{int(t.timestamp() * 1_000_000) * 1000}.json"


def write_payloads(payloads: DataFrame, root: str) -> DataFrame:
    """A03 for many pushed payloads: every row (source, date as ``yyyy-MM-dd``, name, body)
    becomes a file below ``root``, written inside tasks. Returns (path, length).

    The file is ``source=<s>/date=<d>/<SHA-256 of the body>-<name>``, so different bodies
    under one name stay apart, and a task that runs again writes the same file. A null body is
    an empty file, a null name ``payload.json``, a null source ``unknown``; characters other than
    letters, digits, ``.``, ``_`` and ``-`` become ``_`` in both. ``file:`` roots must be mounted by all
    executors; others go through ``pyarrow.fs``."""
    safe = lambda c, default: F.regexp_replace(F.when(F.length(c) > 0, c).otherwise(F.lit(default)), r"[^\w.-]", "_")
    body = F.coalesce(F.col("body"), F.unhex(F.lit("")))
    named = payloads.select(
        F.concat(F.lit(root.rstrip("/") + "/source="), safe(F.col("source"), "unknown"), F.lit("/date="),
                 safe(F.col("date").cast("string"), "unknown"), F.lit("/"), F.sha2(body, 256), F.lit("-"),
                 safe(F.col("name"), "payload.json")).alias("path"), body.alias("body"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            bodies = b.column("body")
            for i, path in enumerate(b.column("path").to_pylist()):
                write_file(path, bodies[i].as_py())
            yield pa.RecordBatch.from_pydict({
                "path": b.column("path"), "length": pa.array([len(x.as_py()) for x in bodies], pa.int64())})
    return named.mapInArrow(run, "path string, length long")
