"""B24 in place: small files of a table packed into files near a target size.

A file of 0.5 to 1.5 times the target is fine and keeps its name and bytes. The others of a
partition folder are grouped by first fit, largest first: smaller ones share a bin up to the
target, a larger one is a bin of its own that is cut into equal pieces. What is left over and under half the
target joins the smallest bin or fine file of its folder where both fit 1.5 times the target; a
folder with less than half the target in all gets one file. Partition values come from folders, so
null partitions need no join.

Only files that change are read. Each bin is written by one task, large ones by one for each
piece. The list of files is on the driver, as Spark's own listing of a table is; grouping is by
folder on it.

New files are written below ``_packing`` in the table, which readers skip, with a list of what
they replace; then they are moved in and the old ones are deleted. A run that was
stopped is finished, or dropped if its list was not complete, by the next one. Between the moves and the
deletes readers would see rows twice: nothing may read the table meanwhile.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .layout import TARGET_FILE_BYTES

LOW, HIGH = 0.5, 1.5
_PLAN = "folder string, file string, bytes long, bin long, pieces int"
_STAGE = "_packing"


def first_fit(sizes: list[tuple[str, int]], target: int) -> list[list[str]]:
    """Files (name, bytes) of one folder in bins of at most ``target`` bytes: each file, largest
    first, goes to the first bin with room. The bins' room is a tree of maxima, so n files
    take n log n steps."""
    width = 1
    while width < max(1, len(sizes)):
        width *= 2
    room, bins = [0] * (2 * width), []
    for name, size in sorted(sizes, key=lambda s: (-s[1], s[0])):
        at = 1
        if room[1] < size:            # no bin has room: a new one
            bins.append([])
            at = width + len(bins) - 1
            room[at] = max(target, size)
        while at < width:
            at = 2 * at if room[2 * at] >= size else 2 * at + 1
        bins[at - width].append(name)
        room[at] -= size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return bins


def plan_folder(files: list[tuple[str, int]], target: int) -> list[tuple[list[str], int]]:
    """The bins of one folder's files that must be written anew, each with its count of pieces."""
    size = dict(files)
    fine = [f for f, n in files if LOW * target <= n <= HIGH * target]
    bins = first_fit([(f, n) for f, n in files if n < LOW * target], target)
    held = lambda b: sum(size[f] for f in b)
    out = [([f], max(1, round(n / target))) for f, n in files if n > HIGH * target]
    short = [b for b in bins if held(b) < LOW * target]        # at most one, by first fit
    whole = [b for b in bins if held(b) >= LOW * target]
    for b in short:
        beside = min([*whole, *[[f] for f in fine]], key=held, default=None)
        if beside is not None and held(beside) + held(b) <= HIGH * target:
            whole = [w for w in whole if w is not beside]
            whole.append([*beside, *b])
        elif len(b) > 1:
            whole.append(b)
    return out + [(b, 1) for b in whole if len(b) > 1]


def packing_plan(spark, path: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """The files that :func:`pack_files` would replace: folder, file, bytes, bin, pieces. Files are listed, not read."""
    return spark.createDataFrame(_plan(spark, path, target_bytes), _PLAN)


def _fs(spark, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _list(spark, path: str) -> dict:
    """folder below ``path`` → its Parquet files (name, bytes); hidden folders and files are left out."""
    P, fs, out = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, _fs(spark, path), {}

    def walk(folder: str) -> None:
        for st in fs.listStatus(P(f"{path}/{folder}" if folder else path)):
            name = st.getPath().getName()
            if name[:1] in "._":
                continue
            if st.isDirectory():
                walk(f"{folder}/{name}" if folder else name)
            elif name.endswith(".parquet"):
                out.setdefault(folder, []).append((name, st.getLen()))
    walk("")
    return out


def _plan(spark, path: str, target: int) -> list:
    if target < 1:
        raise ValueError("the target must be at least one byte")
    rows, number = [], 0
    for folder, files in sorted(_list(spark, path.rstrip("/")).items()):
        size = dict(files)
        for names, pieces in plan_folder(sorted(files), target):
            rows += [(folder, f, size[f], number, pieces) for f in names]
            number += 1
    return rows


def pack_files(spark, path: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Pack the small files, and cut the large ones, of the partitioned Parquet table at ``path``.
    Rows stay the same, in other order. Returns the plan that was carried out."""
    from ..sources.landing import literal

    path = path.rstrip("/")
    finish_packing(spark, path)
    rows = _plan(spark, path, target_bytes)
    if not rows:
        return spark.createDataFrame([], _PLAN)
    stage = f"{path}/{_STAGE}/{uuid.uuid4().hex}"
    place = lambda folder, file: f"{path}/{folder}/{file}" if folder else f"{path}/{file}"
    plan = spark.createDataFrame(rows, _PLAN)
    names = spark.read.parquet(path).columns
    columns = [c for c in names if c not in {part.split("=", 1)[0] for folder in {r[0] for r in rows} for part in folder.split("/")}]
    schema = spark.read.parquet(path).select(*columns).schema
    # the reader's name of a file: its folder below the table and its name, decoded
    uri = F.try_url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    data = (spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[literal(place(r[0], r[1])) for r in rows])
            .select("*", F.regexp_extract(uri, r"([^/]*)$", 1).alias("__file"), F.col("_metadata.row_index").alias("__row"),
                    F.regexp_replace(uri, r"/[^/]*$", "").alias("__at")))
    root = _fs(spark, path).makeQualified(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)).toUri().getPath()
    data = data.withColumn("__at", F.regexp_replace("__at", r"^[a-z0-9+.-]+:(//[^/]*)?", ""))
    where = plan.select(F.col("file").alias("__f"), F.when(F.col("folder") == "", root).otherwise(F.concat(F.lit(root + "/"), "folder")).alias("__d"),
                        F.col("bin").alias("__bin"), "pieces")
    dealt = data.join(where, (F.regexp_replace(data["__at"], "^/+", "/") == where["__d"]) & (data["__file"] == where["__f"]))
    dealt = dealt.withColumn("__piece", F.pmod(F.xxhash64("__file", "__row"), F.col("pieces")))
    (dealt.select(*[F.col(f"`{c}`") for c in columns], "__bin", "__piece").repartition("__bin", "__piece")
     .write.option("maxRecordsPerFile", 0).partitionBy("__bin", "__piece").parquet(f"{stage}/new"))
    plan.coalesce(1).write.parquet(f"{stage}/old")        # complete: from here on the run is finished
    finish_packing(spark, path)
    return plan


def finish_packing(spark, path: str) -> int:
    """Move in what stopped runs have written in full and delete what it replaces; drop what
    is incomplete. Returns the number of runs finished. Doing it twice is harmless."""
    P, fs, done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, _fs(spark, path), 0
    stage = f"{path.rstrip('/')}/{_STAGE}"
    if not fs.exists(P(stage)):
        return done
    for run in [st.getPath() for st in fs.listStatus(P(stage))]:
        if fs.exists(P(f"{stage}/{run.getName()}/old/_SUCCESS")):
            old = spark.read.schema(_PLAN).parquet(f"{stage}/{run.getName()}/old").collect()
            folder = {r.bin: r.folder for r in old}
            here = lambda f: f"{path.rstrip('/')}/{f}" if f else path.rstrip("/")
            for b in fs.listStatus(P(f"{stage}/{run.getName()}/new")):
                if not b.isDirectory():
                    continue
                home = here(folder[int(b.getPath().getName().split("=", 1)[1])])
                for piece in fs.listStatus(b.getPath()):
                    for f in fs.listStatus(piece.getPath()):
                        # the name in the table is the bin's and the piece's own: no two files share it
                        name = f"{b.getPath().getName()[6:]}-{piece.getPath().getName()[8:]}-{f.getPath().getName()}"
                        if not fs.rename(f.getPath(), P(f"{home}/packed-{name}")):
                            raise OSError(f"{f.getPath().toString()} could not be moved to {home}")
            for r in old:
                fs.delete(P(f"{here(r.folder)}/{r.file}"), False)
            done += 1
        fs.delete(run, True)
    fs.delete(P(stage), True)
    return done
