"""Landing files within a size bound, the sweep for empty files, retention from folders."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from tidewater.operators import layout as LY
from tidewater.operators.ingest import IngestTables
from tidewater.sources import landing as LD
from tidewater.streaming.ingest import new_empty_files


def _files(root):
    return [f for f in glob.glob(f"{root}/source=*/date=*/*") if not os.path.basename(f).startswith(("_", "."))]


def _rows(spark):
    small = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit('a "quoted", text é '), "id")).alias("body"),
        F.when(F.col("id") % 3 == 0, "crm").otherwise("web").alias("source"), F.lit("2024-01-02").alias("date"))
    big = spark.range(3).select((F.col("id") + 5000).alias("id"), F.repeat(F.lit("x"), 15_000).alias("body"), F.lit("web").alias("source"),
                                F.lit("2024-01-02").alias("date"))
    return small.unionByName(big)


def test_landing_files_stay_under_the_bound(spark, tmp_root):
    rows = _rows(spark)
    want = sorted(map(tuple, rows.collect()), key=repr)
    schema = "id bigint, body string, source string, date string"
    for fmt, options in (("csv", {"header": "true", "escape": '"'}), ("json", {})):
        root = f"{tmp_root}/{fmt}"
        LD.write_landing(rows, root, fmt=fmt, options=options, max_bytes=20_000)
        files = _files(root)
        assert max(map(os.path.getsize, files)) <= 20_000
        # the large rows do not make the others' files small
        assert len(files) < 3 + 2 + 3 * sum(map(os.path.getsize, files)) / 20_000
        back = spark.read.schema(schema).options(**options).format(fmt).load(root)
        assert sorted(map(tuple, back.select("id", "body", "source", "date").collect()), key=repr) == want


def test_landing_a_row_over_the_bound_is_a_file_alone(spark, tmp_root):
    LD.write_landing(_rows(spark).select("body", "source", "date").where("body is not null"), f"{tmp_root}/t", fmt="text", max_bytes=4_000)
    sizes = sorted(map(os.path.getsize, _files(f"{tmp_root}/t")))
    assert sizes[-3:] == [15_001] * 3 and sizes[-4] <= 4_000
    LD.write_landing(_rows(spark).limit(0), f"{tmp_root}/none", fmt="json")
    assert _files(f"{tmp_root}/none") == []


def _put(path, body=b""):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(body)


def _age(root):
    for folder, _, _ in os.walk(root):
        os.utime(folder, (1_700_000_000, 1_700_000_000))


def test_sweep_lists_only_folders_that_changed(spark, tmp_root):
    root = f"{tmp_root}/land"
    for d in range(1, 6):
        _put(f"{root}/source=a b/date=2024-01-0{d}/empty é.csv")
        _put(f"{root}/source=a b/date=2024-01-0{d}/full.csv", b"x\n1\n")
        _put(f"{root}/source=a b/date=2024-01-0{d}/_hidden.csv")
    _age(root)
    first, known = LD.sweep_empty_files(spark, root, {})
    same = LD.empty_files(spark, root)
    assert sorted(r.file_id for r in first.collect()) == sorted(r.file_id for r in same.collect())
    assert first.count() == 5 and len(known) == 5
    assert LD.sweep_empty_files(spark, root, known)[0].count() == 0
    # a new file in one old folder: that folder alone is listed; a folder of the last minute is not remembered
    _put(f"{root}/source=a b/date=2024-01-03/late.csv")
    again, more = LD.sweep_empty_files(spark, root, known)
    assert sorted(r.file_id.rsplit("/", 2)[1] for r in again.collect()) == ["date=2024-01-03"] * 2 and more == {}
    assert LD.sweep_empty_files(spark, f"{tmp_root}/missing", {})[0].count() == 0


def test_sweep_gives_each_empty_file_once_and_again_to_a_batch_run_again(spark, tmp_root):
    root, t = f"{tmp_root}/land", IngestTables(f"{tmp_root}/state")
    _put(f"{root}/source=a/date=2024-01-01/e1.csv")
    _put(f"{root}/top.json")
    _age(root)
    names = lambda b: sorted(os.path.basename(r.path) for r in new_empty_files(spark, [root], t, b).collect())
    assert names(1) == ["e1.csv", "top.json"]
    assert names(1) == ["e1.csv", "top.json"]       # the same batch, run again
    assert names(2) == []
    _put(f"{root}/source=a/date=2024-01-01/e2.csv")
    assert names(3) == ["e2.csv"]
    assert names(4) == []


def test_expired_dates_of_folders_read_no_column(spark, tmp_root):
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(["2024-01-01", "2024-01-01", "2024-01-09", "2024-01-10", None])], "x int, date string")
    rows.write.partitionBy("date").parquet(f"{tmp_root}/t")
    out = LY.expired_dates(spark.read.parquet(f"{tmp_root}/t"), "date", dt.date(2024, 1, 20), {"raw": 10, "processed": 15})
    assert sorted(map(tuple, out.collect())) == [("processed", "2024-01-01", 2), ("raw", "2024-01-01", 2), ("raw", "2024-01-09", 1)]
    plan = out._jdf.queryExecution().toString()
    assert "ReadSchema: struct<>" in plan and "(date" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_expired_dates_of_a_column_reach_the_scan(spark, tmp_root):
    stamps = [dt.datetime(2024, 1, 9, 23, 59, 59), dt.datetime(2024, 1, 10), None]
    spark.createDataFrame([(s,) for s in stamps], "ts timestamp").write.parquet(f"{tmp_root}/t")
    out = LY.expired_dates(spark.read.parquet(f"{tmp_root}/t"), "ts", dt.date(2024, 1, 20), {"raw": 10})
    assert list(map(tuple, out.collect())) == [("raw", "2024-01-09", 1)]
    assert "LessThan(ts" in out._jdf.queryExecution().toString()
