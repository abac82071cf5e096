"""Change-data capture.

Envelope: key, before struct, after struct, op ('c' insert, 'r' snapshot
read, 'u' update, 'd' delete), ts_ms, offset. Latest state per key is an
aggregate (max_by over (ts_ms, offset)), so a key with a huge change history
still combines map-side instead of sorting in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def apply_changes(changes: DataFrame, key: str, as_of_ms: Column | None = None) -> DataFrame:
    """B18 (and B25 with ``as_of_ms``): current rows = latest change per key
    by (ts_ms, offset), deletes removed; columns of ``after`` plus ``op``."""
    c = changes if as_of_ms is None else changes.where(F.col("ts_ms") <= as_of_ms)
    g = c.groupBy(key).agg(F.max_by(F.struct("op", "after"), F.struct("ts_ms", "offset")).alias("__l"))
    live = g.where(F.col("__l.op") != "d")
    return live.select(key, "__l.after.*", F.col("__l.op").alias("op"))


def diff_columns(changes: DataFrame, key: str, columns: list[str],
                 render: dict[str, Column] | None = None) -> DataFrame:
    """One row per (change, column) whose value differs (null-safe):
    key, ts_ms, column, old, new — both sides unpivoted as text."""
    up = changes.where(F.col("op") == "u")
    render = render or {}
    pairs = []
    for c in columns:
        fmt = render.get(c)
        old = fmt(F.col(f"before.{c}")) if fmt else F.col(f"before.{c}").cast("string")
        new = fmt(F.col(f"after.{c}")) if fmt else F.col(f"after.{c}").cast("string")
        pairs.append(F.struct(F.lit(c).alias("column"), old.alias("old"), new.alias("new"),
                              (~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}"))).alias("changed")))
    ex = up.select(key, "ts_ms", F.explode(F.array(*pairs)).alias("__p"))
    return ex.where("__p.changed").select(key, "ts_ms", "__p.column", "__p.old", "__p.new")


_STATE = ["after", "op", "ts_ms", "offset"]


def _versions(spark, target_path: str) -> list[int]:
    """Numbers of the complete state versions under ``target_path``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(target_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()
                  and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{target_path}/{n}/_SUCCESS")))


def foreach_batch_apply(target_path: str, key: str, keep: int = 2):
    """Streaming form of B18: a ``foreachBatch`` function that merges each
    micro-batch of changes into the state of the versions before.

    The state keeps each key's latest change with (ts_ms, offset) and op,
    deletes included, so a change that comes late never wins over a newer one
    and never brings back a deleted key. Batch n writes version n from the newest
    complete version below n: a replayed batch starts from the same state and
    replaces its own version. ``read_current`` reads the newest version."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changes = batch.select(key, *_STATE)
        have = [v for v in _versions(spark, target_path) if v < batch_id]
        if have:
            changes = changes.unionByName(spark.read.parquet(f"{target_path}/v{have[-1]}").select(key, *_STATE))
        latest = changes.groupBy(key).agg(
            F.max_by(F.struct("after", "op", "ts_ms", "offset"), F.struct("ts_ms", "offset")).alias("l"))
        latest.select(key, "l.*").write.mode("overwrite").parquet(f"{target_path}/v{batch_id}")
        fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for v in have[:max(0, len(have) + 1 - keep)]:
            old = fs_path(f"{target_path}/v{v}")
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return handle


def read_current(spark, target_path: str, key: str) -> DataFrame | None:
    """The live rows of the newest version: key, the columns of ``after``, op.
    None before the first batch."""
    have = _versions(spark, target_path)
    if not have:
        return None
    state = spark.read.parquet(f"{target_path}/v{have[-1]}")
    return state.where(F.col("op") != "d").select(key, "after.*", "op")


# ------------------------------------------------- B18 state by key bucket
_LIVE = "bucket int, kind string, version long"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _latest(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy("bucket", key).agg(
        F.max_by(F.struct(*_STATE), F.struct("ts_ms", "offset")).alias("l")).select("bucket", key, "l.*")


def _part(target_path: str, kind: str, version: int, bucket: int) -> str:
    return f"{target_path}/{kind}/v{version}/bucket={bucket}"


def _live(spark, target_path: str, before: int | None = None) -> tuple[int | None, list]:
    """The newest commit (below ``before``) and the parts it names: at most
    buckets x (fold + 1) rows."""
    have = [v for v in _versions(spark, f"{target_path}/commits") if before is None or v < before]
    if not have:
        return None, []
    return have[-1], [tuple(r) for r in spark.read.schema(_LIVE).parquet(f"{target_path}/commits/v{have[-1]}").collect()]


def _read_parts(spark, target_path: str, parts: list, schema) -> DataFrame:
    """Rows of these (bucket, kind, version) parts, each with its bucket. Folders are
    read by kind and version, so the bucket comes from the folder's name."""
    out = None
    by_version: dict = {}
    for bucket, kind, version in parts:
        by_version.setdefault((kind, version), []).append(bucket)
    for (kind, version), held in sorted(by_version.items()):
        root = f"{target_path}/{kind}/v{version}"
        rows = (spark.read.schema(schema).option("basePath", root)
                .parquet(*[_part(target_path, kind, version, b) for b in sorted(held)])
                .withColumn("bucket", F.col("bucket").cast("int")))
        out = rows if out is None else out.unionByName(rows)
    return out


def foreach_batch_buckets(target_path: str, key: str, buckets: int = 64, fold: int = 8, keep: int = 2):
    """Streaming form of B18 whose writes grow with the batch, not with the state.

    A key belongs to the bucket of its hash. Micro-batch n writes its latest change of each
    key as delta files of the buckets it touches (``delta/vN/bucket=B``); a bucket that has
    ``fold`` deltas is folded with its base into a new base (``base/vN/bucket=B``), all others
    stay as they are. So a batch of 10 keys rewrites at most 10 buckets. ``commits/vN``, written last,
    names the live parts: readers see whole batches, and a replayed batch starts from the commit
    before it and replaces its own parts. As in :func:`foreach_batch_apply` each key keeps its latest change, deletes
    included, so late changes never win. The last ``keep`` commits and their parts stay.

    Null keys are one key. ``buckets`` and ``key`` belong to the state and must not change: a
    state written with another count of buckets is refused."""
    if buckets < 1 or fold < 1 or keep < 1:
        raise ValueError("buckets, fold and keep must be at least 1")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _same_buckets(spark, target_path, buckets)
        before, live = _live(spark, target_path, batch_id)
        changes = _latest(batch.select(_bucket(key, buckets).alias("bucket"), key, *_STATE), key)
        schema = changes.schema
        seen = Observation("touched buckets")
        (changes.observe(seen, F.collect_set("bucket").alias("held")).repartition("bucket").write.mode("overwrite")
         .partitionBy("bucket").parquet(f"{target_path}/delta/v{batch_id}"))
        live += [(b, "delta", batch_id) for b in sorted(seen.get["held"])]
        full = [b for b in sorted(seen.get["held"]) if sum(x[0] == b and x[1] == "delta" for x in live) >= fold]
        if full:
            old = [x for x in live if x[0] in full]
            (_latest(_read_parts(spark, target_path, old, schema), key).repartition("bucket").write.mode("overwrite")
             .partitionBy("bucket").parquet(f"{target_path}/base/v{batch_id}"))
            live = [x for x in live if x[0] not in full] + [(b, "base", batch_id) for b in full]
        spark.createDataFrame(live, _LIVE).coalesce(1).write.mode("overwrite").parquet(f"{target_path}/commits/v{batch_id}")
        _drop_unnamed(spark, target_path, batch_id, keep)
    return handle


def _same_buckets(spark, target_path: str, buckets: int) -> None:
    """The count of buckets is written once, beside the state."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{target_path}/buckets")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{target_path}/buckets/{buckets}"))
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    if names != [str(buckets)]:
        raise ValueError(f"the state at {target_path} has {', '.join(names)} buckets, not {buckets}")


def _drop_unnamed(spark, target_path: str, newest: int, keep: int) -> None:
    """Drop commits older than the last ``keep`` up to ``newest``, and the parts that none of the kept names."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(target_path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    have = [v for v in _versions(spark, f"{target_path}/commits") if v <= newest]
    named = {_part("", kind, version, b) for v in have[-keep:]
             for b, kind, version in spark.read.schema(_LIVE).parquet(f"{target_path}/commits/v{v}").collect()}
    for v in have[:-keep]:
        fs.delete(path(f"{target_path}/commits/v{v}"), True)
    for kind in ("delta", "base"):
        root = path(f"{target_path}/{kind}")
        for st in fs.listStatus(root) if fs.exists(root) else []:
            version = st.getPath().getName()
            if int(version[1:]) > newest:        # another attempt's, replaced by its own replay
                continue
            parts = [p.getPath().getName() for p in fs.listStatus(st.getPath()) if p.isDirectory()]
            gone = [p for p in parts if f"/{kind}/{version}/{p}" not in named]
            if len(gone) == len(parts):
                fs.delete(st.getPath(), True)
            else:
                for p in gone:
                    fs.delete(path(f"{target_path}/{kind}/{version}/{p}"), True)


def read_buckets(spark, target_path: str, key: str, schema, as_of: int | None = None) -> DataFrame:
    """The live rows of the newest commit (of the newest up to batch ``as_of``): key, the columns of
    ``after``, op. Bases and deltas are merged by key. ``schema`` has the changes' key, after, op, ts_ms and offset;
    before the first batch the result is empty."""
    _, live = _live(spark, target_path, None if as_of is None else as_of + 1)
    fields = {f.name: f for f in schema.fields}
    wanted = T.StructType([*[fields[c] for c in (key, *_STATE)]])
    if not live:
        rows = spark.createDataFrame([], wanted)
    else:
        rows = _latest(_read_parts(spark, target_path, live, T.StructType([*wanted.fields, T.StructField("bucket", T.IntegerType())])), key)
    return rows.where(F.col("op") != "d").select(key, "after.*", "op")
