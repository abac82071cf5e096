"""The rows and files of one task stay bounded when the input grows."""

import datetime as dt
import glob
import json
import os
import re

from tidewater.operators import ingest as I
from tidewater.plans import catalog_tables as CT
from tidewater.sources import ranges as RG
from tidewater.streaming import features as SF


def test_processed_rows_of_one_file_are_written_by_many_tasks(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(I, "PROCESSED_ROWS", 20)
    place = f"{tmp_root}/landing/source=a/date=2024-01-01"
    os.makedirs(place)
    with open(f"{place}/x.jsonl", "w") as f:
        f.writelines(json.dumps({"id": i}) + "\n" for i in range(400))
    t = I.IngestTables(f"{tmp_root}/state")
    I.ingest_landing(spark, f"{tmp_root}/landing", t)
    assert sorted(int(r.id) for r in I.read_processed(spark, t).collect()) == list(range(400))
    assert len(glob.glob(f"{t.processed}/**/part-*.parquet", recursive=True)) > 5


def test_small_files_are_written_by_more_tasks_for_more_rows(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(CT, "TRICKLE_ROWS", 100, raising=False)
    monkeypatch.setattr(CT, "scratch_path", lambda spark, name: f"{tmp_root}/{name}")
    day = dt.date(2024, 1, 1)
    rows = [(day + dt.timedelta(days=31 * (i % 30)), "ARN"[i % 3]) for i in range(1000)]
    spark.createDataFrame(rows, "l_shipdate date, l_returnflag string").write.parquet(f"{tmp_root}/sf/lineitem.parquet")
    out = CT.q_compact_plan(spark, f"{tmp_root}/sf").collect()
    assert sum(r.n_rows for r in out) == 1000 and all(r.target_files == 1 for r in out)
    files = glob.glob(f"{tmp_root}/lineitem-small-files/**/part-*.parquet", recursive=True)
    assert len({re.search(r"part-(\d+)", f).group(1) for f in files}) > 4


def test_small_files_share_tasks(spark, tmp_root):
    for i in range(100):
        with open(f"{tmp_root}/{i}", "wb") as f:
            f.write(b"x" * i)
    files = spark.createDataFrame([(f"file:{tmp_root}/{i}", i) for i in range(100)], "file_id string, length long")
    limit = 4 * spark.sparkContext.defaultParallelism
    hashed, copied = RG.hash_files(files, 7), RG.copy_ranges(files, 7)
    assert hashed.rdd.getNumPartitions() <= limit and copied.rdd.getNumPartitions() <= limit
    assert hashed.count() == 100 and copied.count() == sum(-(-i // 7) for i in range(100))


def test_quarantine_that_holds_nothing_reads_as_empty(spark, tmp_root):
    got = I.quarantined_bytes(spark, I.IngestTables(f"{tmp_root}/state"))
    assert got.columns == ["path", "content_hash", "reason", "seq", "at", "content"] and got.count() == 0


def test_state_partitions_follow_cores(spark):
    shuffles = "spark.sql.shuffle.partitions"
    before = spark.conf.get(shuffles)
    spark.conf.set(shuffles, "200")
    try:
        with SF.with_rocksdb(spark):
            assert int(spark.conf.get(shuffles)) == spark.sparkContext.defaultParallelism
        assert spark.conf.get(shuffles) == "200"
    finally:
        spark.conf.set(shuffles, before)
