"""Format readers with fail-the-whole-file semantics.

Every reader turns a set of landed files into
  records: (file_id, record map<string,string>)
  verdict: (file_id, n_records, parse_error)
where ``parse_error`` is null for a file whose every row parsed. The caller
drops all rows of a failed file (the reference rejects a file on its first
bad row) and treats 0 records as "no records found in file".

Native, splittable Spark readers do the parsing; the driver only sees the
list of files of one batch and their distinct CSV headers / Parquet schemas
(metadata, bounded by the trigger size).
"""

from __future__ import annotations

import csv
import hashlib
import io
from collections import defaultdict
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import classify as C
from ..functions import constants as K
from ..functions import json_values as J
from ..functions.text import as_text, utf8
from .landing import literal

RECORDS_SCHEMA = "file_id string, record map<string,string>"
VERDICT_SCHEMA = "file_id string, n_records bigint, parse_error string"

# Delete well-formed quoted fields; any quote left breaks the strict reader
QUOTED_FIELD = r'(^|[,\n])"[^"]*+(?:""[^"]*+)*+"(?=[,\r\n]|$)'


def csv_head(content) -> "F.Column":
    """First line of a CSV payload (the whole line, however long)."""
    txt = utf8(content)
    return F.regexp_replace(F.substring_index(txt, "\n", 1), "\r$", "")


def csv_bad_quotes(content) -> "F.Column":
    """True when the payload has a quote the strict reader refuses.

    Only payloads containing a quote byte (checked on the raw bytes, no
    decoding) are decoded and scanned with the regex.
    """
    has_q = F.contains(content, F.unhex(F.lit("22")))
    left = F.regexp_replace(utf8(content), QUOTED_FIELD, "$1")
    return F.when(has_q, F.instr(left, '"') > 0).otherwise(F.lit(False))


def _header_names(line: str) -> list[str]:
    try:
        row = next(csv.reader(io.StringIO(line)))
    except StopIteration:
        row = [""]
    return row


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _union(dfs: list[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    if not dfs:
        return _empty(spark, schema)
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


# --------------------------------------------------------------------- CSV
def read_csv(spark: SparkSession, files: list[tuple[str, str, str]]) -> DataFrame:
    """A08. ``files`` = [(file_id, path, header_line)].

    One native multi-line CSV read per distinct header (D20), with a
    positional all-string schema; rows with a wrong field count land in the
    corrupt column and fail their file. Empty fields become '' (D16); a
    repeated header name keeps the last value (D18).
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for _fid, path, head in files:
        groups[head if head is not None else ""].append(path)
    recs = []
    for head, paths in groups.items():
        names = _header_names(head)
        fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]
        schema = T.StructType(fields + [T.StructField("_corrupt", T.StringType())])
        df = (spark.read.schema(schema)
              .option("header", "true").option("multiLine", "true")
              .option("escape", '"').option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt")
              .option("enforceSchema", "true")
              .csv([literal(p) for p in paths]))
        rec = F.map_from_arrays(F.array(*[F.lit(n) for n in names]),
                                F.array(*[F.coalesce(F.col(f"c{i}"), F.lit("")) for i in range(len(names))]))
        recs.append(df.select(C.file_id().alias("file_id"),
                              rec.alias("record"),
                              F.col("_corrupt").isNotNull().alias("bad")))
    return _union(recs, spark, RECORDS_SCHEMA + ", bad boolean")


CSV_GROUPS_PER_JOB = 64  # headers whose native reads are planned together


def native_csv(head: str | None) -> bool:
    """Whether Spark's reader takes the file: its first line is the whole
    header. A blank first line, or a line break inside a quoted header name, goes
    to the per-file parser. A property of the file alone."""
    return bool(head) and head.count('"') % 2 == 0


def split_csv_records(text: str):
    """Per-file strict CSV parse: header row, then records with exactly as
    many fields; blank lines skipped; a repeated header keeps the last value.
    Yields one JSON object text per record; raises ``ValueError`` for the whole
    file on any malformed row."""
    import json as _json
    head = None
    try:
        for r in csv.reader(io.StringIO(text, newline=""), strict=True):
            if not r:
                continue
            if head is None:
                head = r
            elif len(r) != len(head):
                raise ValueError(f"row has {len(r)} fields but expected {len(head)} based on headers")
            else:
                yield _json.dumps(dict(zip(head, r)), ensure_ascii=False)
    except csv.Error as e:
        raise ValueError(f"malformed CSV: {e}") from None
    if head is None:
        raise ValueError("missing header")


def split_csv_files(landing: DataFrame) -> DataFrame:
    """Per-file CSV path: (file_id, content) → (file_id, record, error), a few
    thousand records at a time; a file with an error row fails whole."""
    def fn(batches):
        for pdf in batches:
            for fid, content in zip(pdf["file_id"], pdf["content"]):
                text = bytes(content).decode("utf-8", "replace") if content is not None else ""
                values, error, part = split_csv_records(text), None, []
                while part is not None:
                    part = []
                    try:
                        for v in values:
                            part.append(v)
                            if len(part) == 5000:
                                break
                    except ValueError as e:
                        error = f"{K.MSG_PARSE_CSV}: {e}"
                    done = error is not None or len(part) < 5000
                    yield pd.DataFrame({"file_id": [fid] * len(part), "value": part, "error": [None] * len(part)},
                                       dtype="object")
                    if done:
                        part = None
                if error:
                    yield pd.DataFrame({"file_id": [fid], "value": [None], "error": [error]}, dtype="object")

    out = landing.select("file_id", "content").mapInPandas(
        fn, "file_id string, value string, error string")
    return out.select("file_id",
                      F.when(F.col("error").isNull(), J.line_record(F.col("value"))).alias("record"),
                      F.col("error"))


# ------------------------------------------------------------------ NDJSON
def read_ndjson_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A09 fast path over text lines: (file_id, record, bad) per non-blank line."""
    import uuid
    nonce = uuid.uuid4().hex + uuid.uuid4().hex
    lines = spark.read.text([literal(p) for p in paths]).select(C.file_id().alias("file_id"),
                                          F.col("value"))
    lines = lines.where(~J.is_blank(F.col("value")))
    return lines.select("file_id", J.line_record(F.col("value")).alias("record"),
                        (~J.strict_object_line(F.col("value"), nonce)).alias("bad"))


def split_json_files(landing: DataFrame) -> DataFrame:
    """A09 slow path: whole payloads → one row per value, or one error row.

    ``landing`` = (file_id, content). Runs the small decode helper per file
    inside Arrow batches; the JVM then renders each value with ``from_json``
    exactly like the fast path.
    """
    def fn(batches):
        for pdf in batches:
            ids, vals, errs = [], [], []
            for fid, content in zip(pdf["file_id"], pdf["content"]):
                text = bytes(content).decode("utf-8", "replace") if content is not None else ""
                try:
                    values = J.split_values(text)
                except ValueError as e:
                    ids.append(fid); vals.append(None); errs.append(f"{K.MSG_PARSE_JSON}: {e}")
                    continue
                for v in values:
                    ids.append(fid); vals.append(v); errs.append(None)
            yield pd.DataFrame({"file_id": ids, "value": vals, "error": errs})

    out = landing.select("file_id", "content").mapInPandas(
        fn, "file_id string, value string, error string")
    return out.select("file_id",
                      F.when(F.col("error").isNull(), J.line_record(F.col("value"))).alias("record"),
                      F.col("error"))


# ----------------------------------------------------------------- Parquet
def _string_cols(df: DataFrame) -> list:
    return [as_text(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]


def read_parquet(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """A10 with D27: one read per distinct file schema; files without a
    readable footer are returned as failures. Returns (records, unreadable_paths).

    The scan goes on past damaged pages, so a damaged file gives part of its
    rows; ``parquet_verdict`` finds these files by their row counts."""
    groups: list[tuple[list[str], DataFrame]] = []
    bad: list[str] = []
    try:
        df = (spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", "true")
              .parquet(*[literal(p) for p in paths]))
        groups = [(paths, df)]
    except Exception:  # conflicting column types across files, or no footer to infer from
        groups, bad = [], []
        for ps in _by_schema(spark, paths, bad):
            groups.append((ps, spark.read.schema(spark.read.parquet(literal(ps[0])).schema)
                           .option("ignoreCorruptFiles", "true").parquet(*[literal(p) for p in ps])))
    recs = []
    for _ps, df in groups:
        names = [f.name for f in df.schema.fields]
        rec = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*_string_cols(df)))
        recs.append(df.select(C.file_id().alias("file_id"), rec.alias("record"),
                              F.lit(False).alias("bad")))
    return _union(recs, spark, RECORDS_SCHEMA + ", bad boolean"), bad


def _by_schema(spark: SparkSession, paths: list[str], bad: list[str]) -> list[list[str]]:
    """``paths`` in groups of one file schema. Footers are decoded in tasks; a file whose footer does
    not decode goes to ``bad``. A file that cannot be read fails the batch: the failure is not the file's."""
    def fn(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        for pdf in batches:
            kinds = []
            for content in pdf["content"]:
                try:
                    f = pq.ParquetFile(pa.BufferReader(bytes(content)))
                except Exception:  # any failure to decode these bytes is the file's
                    kinds.append(None)
                    continue
                own = (f.metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
                kinds.append(hashlib.sha256(str(f.schema).split("\n", 1)[1].encode() + own).hexdigest())
            yield pd.DataFrame({"file_id": pdf["file_id"], "kind": kinds})

    read = (spark.read.format("binaryFile").load([literal(p) for p in paths])
            .select(C.file_id().alias("file_id"), "content").mapInPandas(fn, "file_id string, kind string"))
    out: dict = defaultdict(list)
    for file_id, kind in read.collect():
        (bad if kind is None else out[kind]).append(unquote(file_id))
    return [sorted(ps) for _, ps in sorted(out.items())]


def parquet_verdict(spark: SparkSession, paths: list[str], read: DataFrame) -> DataFrame:
    """(file_id) of the Parquet files that did not read whole.

    ``read`` = (file_id, n_records) as scanned. Row counts come from the footers
    (a scan of no columns reads no pages). Files whose counts differ, or that
    gave no row at all, are read again byte by byte and decoded in tasks: one that
    does not decode is damaged; one that does decode, with rows the scan did
    not give, means a failed read, and the batch fails rather than the file."""
    schema = "file_id string, rows bigint"
    whole = (spark.read.option("ignoreCorruptFiles", "true").parquet(*[literal(p) for p in paths])
             .select(C.file_id().alias("file_id")).groupBy("file_id").agg(F.count(F.lit(1)).alias("rows")))
    doubtful = (spark.read.format("binaryFile").load([literal(p) for p in paths])
                .select(C.file_id().alias("file_id"), "path", "length")
                .join(whole, "file_id", "left").join(read, "file_id", "left")
                .where("rows is null or n_records is null or rows <> n_records")
                .select("path", F.coalesce("n_records", F.lit(0)).alias("n_records")).collect())
    if not doubtful:
        return spark.createDataFrame([], "file_id string")

    def fn(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        for pdf in batches:
            rows = []
            for content in pdf["content"]:
                try:
                    f = pq.ParquetFile(pa.BufferReader(bytes(content)))
                    rows.append(sum(b.num_rows for b in f.iter_batches()))
                except Exception:  # any failure to decode these bytes is the file's
                    rows.append(None)
            yield pd.DataFrame({"file_id": pdf["file_id"], "rows": pd.array(rows, "Int64")})

    decoded = {r.file_id: r.rows for r in
               spark.read.format("binaryFile").load([literal(r.path) for r in doubtful])
               .select(C.file_id().alias("file_id"), "content").mapInPandas(fn, schema).collect()}
    scanned = {r.file_id: r.n_records for r in read.collect()} if decoded else {}
    damaged = []
    for fid, rows in decoded.items():
        if rows is None:
            damaged.append((fid,))
        elif rows != (scanned.get(fid) or 0):
            raise RuntimeError(f"{fid}: {scanned.get(fid) or 0} of {rows} rows were read; the batch must run again")
    return spark.createDataFrame(damaged, "file_id string")
