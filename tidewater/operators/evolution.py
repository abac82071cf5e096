"""B21 by type widening: text batches into a table whose columns widen as values ask for it.

Types form one line, int < long < double < string. A batch's type of a column is the least that all of its
values cast to, and a table's column takes the wider of its own and the batch's. Every
change of the schema is a new version in the log (``schemas/vN``), and rows are stored under the version that they were
written with (``data/vN/batch=B``), so old files are never rewritten: ``read_versions`` reads
each version by its own schema and casts it to the newest. A declared type that is narrower than the table's is refused.

A long that becomes a double is rounded beyond 2^53, as in any cast. Numbers that become text
are written as Spark casts them. A column with no values in any batch is an int. Column names are taken as they are, and
told apart by case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cdc import _versions

LATTICE = ("int", "long", "double", "string")
_LOG = "position int, name string, type string"
_WHOLE = r"^[+-]?[0-9]+$"
_REAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def wider(a: str | None, b: str | None) -> str | None:
    """The join of two types; None (no values) is below all."""
    return max((t for t in (a, b) if t is not None), key=LATTICE.index, default=None)


def batch_types(df: DataFrame) -> dict[str, str | None]:
    """The least type of each text column of a batch, None where it has no values: one aggregate of all rows.
    Values with spaces around, and NaN or infinity in letters, are text."""
    def level(c: str):
        x = F.col(f"`{c}`")
        whole, real = x.rlike(_WHOLE), x.rlike(_REAL)
        finite = F.abs(x.try_cast("double")) < float("inf")
        return F.max(F.when(x.isNull(), None).when(whole & x.try_cast("int").isNotNull(), 0).when(whole & x.try_cast("long").isNotNull(), 1)
                     .when(real & finite, 2).otherwise(3))
    if not df.columns:
        return {}
    levels = df.agg(*[level(c).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return {c: None if n is None else LATTICE[n] for c, n in zip(df.columns, levels)}


def schema_versions(spark, root: str) -> dict[int, list[tuple[str, str]]]:
    """The log: version → (name, type) in order."""
    return {v: [(r.name, r.type) for r in spark.read.schema(_LOG).parquet(f"{root}/schemas/v{v}").orderBy("position").collect()]
            for v in _versions(spark, f"{root}/schemas")}


def append_batch(df: DataFrame, root: str, batch_id: int, declared: dict[str, str] | None = None) -> int:
    """Append a batch of text columns; returns the version it is stored under. ``declared`` columns take that type: it must
    not be narrower than the table's, and the batch's values must fit it. A batch that is appended again (same
    ``batch_id``) replaces itself. One writer at a time."""
    spark = df.sparkSession
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    log = schema_versions(spark, root)
    version = max(log, default=0)
    table = dict(log.get(version, []))
    seen = batch_types(text)
    for c, t in (declared or {}).items():
        if t not in LATTICE:
            raise ValueError(f"{c}: {t} is none of {', '.join(LATTICE)}")
        if c in table and wider(t, table[c]) != t:
            raise ValueError(f"{c} is {table[c]}: {t} would narrow it")
        if wider(t, seen.get(c)) != t:
            raise ValueError(f"{c}: the batch holds {seen[c]} values, not {t}")
    wanted = {c: wider(wider(table.get(c), seen.get(c)), (declared or {}).get(c)) or "int" for c in [*table, *[c for c in seen if c not in table]]}
    if wanted != table or not log:
        version += 1
        spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(wanted.items())], _LOG).coalesce(1).write.mode("overwrite").parquet(f"{root}/schemas/v{version}")
    out = text.select(*[(F.col(f"`{c}`") if c in seen else F.lit(None)).cast(t).alias(c) for c, t in wanted.items()])
    # the batch's folder of another version, left by a run that was stopped or repeated, is replaced too
    _drop(spark, root, batch_id, [v for v in log if v != version])
    out.write.mode("overwrite").parquet(f"{root}/data/v{version}/batch={batch_id}")
    return version


def _drop(spark, root: str, batch_id: int, versions: list[int]) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for v in versions:
        fs.delete(path(f"{root}/data/v{v}/batch={batch_id}"), True)


def read_versions(spark, root: str) -> DataFrame | None:
    """All rows under the newest schema; columns that a version did not have are null. None before the first batch."""
    log = schema_versions(spark, root)
    if not log:
        return None
    newest = log[max(log)]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in newest))
    for v, fields in sorted(log.items()):
        folder = f"{root}/data/v{v}"
        if not fs.exists(path(folder)) or not fs.listStatus(path(folder)):
            continue
        kinds = dict(fields)
        rows = spark.read.schema(", ".join(f"`{c}` {t}" for c, t in fields)).option("recursiveFileLookup", "true").parquet(folder)
        out = out.unionByName(rows.select(*[(F.col(f"`{c}`") if c in kinds else F.lit(None)).cast(t).alias(c) for c, t in newest]))
    return out
