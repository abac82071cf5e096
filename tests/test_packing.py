import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tidewater.operators import packing as PK


def _files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.path.getsize(os.path.join(d, f))
            for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _rows(spark, path):
    return Counter(map(tuple, spark.read.parquet(path).select("k", "v", "p", "q").collect()))


def _table(spark, path):
    """Three partitions, one null and one with odd characters: many small files, one fine, one large."""
    df = spark.range(30000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"),
                                   F.lit("x").alias("q"))
    part = lambda lo, hi, p, n: (df.where(f"k >= {lo} and k < {hi}").withColumn("p", F.lit(p).cast("string")).repartition(n)
                                 .write.mode("append").partitionBy("p", "q").parquet(path))
    part(0, 6000, "a b=c%:+{d}", 15)
    part(6000, 12000, None, 15)
    part(12000, 14500, "fine", 1)
    part(14500, 26000, "large", 1)
    part(26000, 26100, "tiny", 3)
    return path


def test_packs_in_place(spark, tmp_root):
    path = _table(spark, f"{tmp_root}/t")
    before, rows = _files(path), _rows(spark, path)
    target = next(n for f, n in before.items() if "p=fine" in f)
    plan = PK.pack_files(spark, path, target).collect()
    after = _files(path)
    assert _rows(spark, path) == rows and len(rows) == 26100
    # fine files keep name and size; all that were replaced are gone
    gone = {f"{r.folder}/{r.file}" for r in plan}
    assert all(after[f] == n for f, n in before.items() if f not in gone) and not gone & set(after)
    assert any("p=fine" in f for f in set(before) & set(after))
    for f, n in after.items():
        assert 0.5 * target <= n <= 1.5 * target or "p=tiny" in f, (f, n / target)
    assert sum("p=tiny" in f for f in after) == 1 and not os.path.exists(f"{path}/_packing")
    assert PK.pack_files(spark, path, target).collect() == [] and _files(path) == after


def test_stopped_runs(spark, tmp_root, monkeypatch):
    path = _table(spark, f"{tmp_root}/t")
    rows, target = _rows(spark, path), 60_000
    real = PK.finish_packing
    monkeypatch.setattr(PK, "finish_packing", lambda *a: 0)
    PK.pack_files(spark, path, target)                  # stopped before the first move
    assert _rows(spark, path) == rows
    monkeypatch.setattr(PK, "finish_packing", real)
    stage = f"{path}/_packing"
    run = os.listdir(stage)[0]
    # one file moved already, as by a run that stopped between moves
    new = next(os.path.join(d, f) for d, _, fs in os.walk(f"{stage}/{run}/new") for f in fs if f.endswith(".parquet"))
    b, piece = new.split("__bin=")[1].split("/")[0], new.split("__piece=")[1].split("/")[0]
    folder = next(r.folder for r in spark.read.parquet(f"{stage}/{run}/old").collect() if r.bin == int(b))
    os.rename(new, f"{path}/{folder}/packed-{b}-{piece}-{os.path.basename(new)}")
    os.makedirs(f"{stage}/incomplete/new")
    assert PK.finish_packing(spark, path) == 1 and _rows(spark, path) == rows and not os.path.exists(stage)


def test_flat_table(spark, tmp_root):
    path = f"{tmp_root}/flat"
    spark.range(5000).select("id", F.md5(F.col("id").cast("string")).alias("v")).repartition(8).write.parquet(path)
    PK.pack_files(spark, path, 1 << 30)
    assert len(_files(path)) == 1 and spark.read.parquet(path).agg(F.sum("id")).first()[0] == 5000 * 4999 // 2


def test_first_fit():
    rng = random.Random(5)
    sizes = [(f"f{i:03}", rng.randrange(1, 50)) for i in range(300)]
    bins, size = PK.first_fit(sizes, 100), dict(sizes)
    assert sorted(f for b in bins for f in b) == sorted(size)
    held = [sum(size[f] for f in b) for b in bins]
    assert max(held) <= 100 and sum(h <= 50 for h in held) <= 1
    naive: list = []          # first fit, bin by bin
    for f, n in sorted(sizes, key=lambda s: (-s[1], s[0])):
        home = next((b for b in naive if sum(size[x] for x in b) + n <= 100), None)
        naive.append([f]) if home is None else home.append(f)
    assert bins == naive and PK.first_fit([], 100) == []
    assert PK.plan_folder([("a", 100)], 100) == [] and PK.plan_folder([("a", 100), ("b", 10)], 100) == [(["a", "b"], 1)]
    with pytest.raises(ValueError):
        PK._plan(None, "x", 0)
