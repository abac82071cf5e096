"""Streaming time features against their batch forms."""

import math
import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidewater.operators import serving as SV
from tidewater.operators import temporal as TM
from tidewater.streaming import features as SF

T0 = datetime(2024, 1, 1)
SCHEMA = "id long, k string, ts timestamp, v double"


def _events(n=400, seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["hot"] * 5 + ["a", "b", None]), T0 + timedelta(seconds=rnd.randrange(36_000), microseconds=rnd.choice([0, 1, 500])),
             rnd.choice([None, 1.5, float(rnd.randrange(100))])) for i in range(n)]
    return rows + [(n + 1, "a", T0, 3.0), (n + 2, "a", T0, 4.0), (n + 3, "a", None, 5.0)]


def _stream(spark, folder, batches, schema=SCHEMA):
    for i, rows in enumerate([*batches, [(-1, None, datetime(2030, 1, 1), None)] * 2]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{i:02d}")
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(folder)


def _run(spark, out, tmp_root, name):
    SF.write_stream(spark, out, os.path.join(tmp_root, name), os.path.join(tmp_root, f"{name}-ckpt"))
    return spark.read.schema(out.schema).parquet(os.path.join(tmp_root, name)).where("id >= 0")


def _shuffled(rows, jitter=1800, batches=4):
    rnd = random.Random(2)
    order = sorted(rows, key=lambda r: ((r[2] or T0) - T0).total_seconds() + rnd.randrange(jitter))
    return [order[i * len(order) // batches:(i + 1) * len(order) // batches] for i in range(batches)]


def test_rolling_range_stream_equals_batch(spark, tmp_root):
    rows = _events()
    stream = _stream(spark, os.path.join(tmp_root, "in"), _shuffled(rows))
    out = _run(spark, SF.rolling_range_stream(stream, "k", "ts", "v", 600, "1 hour", sub_buckets=3), tmp_root, "out")
    want = TM.rolling_range(spark.createDataFrame(rows, SCHEMA).where("ts IS NOT NULL"), "k", "ts", "v", 600, sub_buckets=3)
    assert out.columns == want.columns
    fix = lambda df: sorted((r.id, r.k, r.ts, r.v, r.range600_count, r.range600_sum and round(r.range600_sum, 6),
                             r.range600_avg and round(r.range600_avg, 6)) for r in df.collect())
    assert fix(out) == fix(want)


def test_late_rows_are_dropped_and_state_goes(spark, tmp_root):
    """A row whose bucket is closed changes nothing, and the state holds only open buckets."""
    at = lambda s: T0 + timedelta(seconds=s)
    stream = _stream(spark, os.path.join(tmp_root, "in"), [
        [(1, "a", at(10), 1.0)], [(2, "a", at(5000), 2.0)], [(3, "a", at(20), 7.0), (4, "a", at(4990), 3.0)]])
    q = SF.rolling_range_stream(stream, "k", "ts", "v", 60, "100 seconds")
    path = os.path.join(tmp_root, "out")
    run = SF.write_stream(spark, q, path, os.path.join(tmp_root, "ckpt"))
    got = {r.id: (r.range60_count, r.range60_sum) for r in spark.read.schema(q.schema).parquet(path).collect() if r.id >= 0}
    assert got == {1: (1, 1.0), 4: (1, 3.0), 2: (2, 5.0)}
    kept = [p.stateOperators[0].numRowsTotal for p in run.recentProgress if p.stateOperators]
    assert kept[-1] <= 20          # only what the two closing rows left


def test_asof_stream_equals_batch(spark, tmp_root):
    rows = _events(500, seed=3)
    fea = [r for r in rows if r[0] % 3]
    lab = [r for r in rows if not r[0] % 3]
    a = _stream(spark, os.path.join(tmp_root, "labels"), _shuffled(lab))
    b = _stream(spark, os.path.join(tmp_root, "features"), _shuffled(fea, batches=3)).withColumnRenamed("v", "x")
    out = _run(spark, SF.asof_features_stream(a, b, "k", "ts", "ts", 900, ["x"], "id", "1 hour"), tmp_root, "out")
    static = lambda r: spark.createDataFrame(r, SCHEMA).where("ts IS NOT NULL")
    want = SV.asof_features(static(lab), static(fea).withColumnRenamed("v", "x"), "k", "ts", "ts", 900, ["x"], "id")
    assert out.columns == want.columns
    fix = lambda df: sorted((r.id, r.k, r.ts, r.feature_id, r.x) for r in df.collect())
    got = fix(out)
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in fix(want)]
    times = {r[0]: r[2] for r in fea}
    assert any(r[3] is not None for r in got) and all(r[3] is None or times[r[3]] <= r[2] for r in got)


def test_quality_counts_a_late_label_once(spark, tmp_root):
    at = lambda h: T0 + timedelta(hours=h)
    preds = [(i, T0 + timedelta(minutes=i), i % 2, 0.5) for i in range(8)]
    labels = [(0, at(1), 0), (1, at(2), 0), (1, at(2.5), 0), (2, at(11), 0), (2, at(11), 0), (3, at(13), 1)]
    ps, ls = "id long, ts timestamp, predicted int, score double", "id long, ts timestamp, actual int"
    end = datetime(2030, 1, 1)
    for i, (p, r) in enumerate([(preds, labels[:2]), ([(90, at(6), 0, 0.0)], labels[2:4]), ([], labels[4:]), ([(-1, end, 0, 0.0)], [(-2, end, 0)])]):
        for name, rows, schema in (("p", p, ps), ("l", r, ls)):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(tmp_root, name, str(i)))
    read = lambda name, schema: spark.readStream.schema(schema).option("recursiveFileLookup", "true").option(
        "maxFilesPerTrigger", 1).parquet(os.path.join(tmp_root, name))
    out = SF.quality_stream(read("p", ps), read("l", ls), "id", "ts", "ts", "predicted", "score", "actual", "12 HOURS", "1 day", "1 day")
    SF.write_stream(spark, out, os.path.join(tmp_root, "out"), os.path.join(tmp_root, "ckpt"))
    got = spark.read.parquet(os.path.join(tmp_root, "out")).where(F.year("window_start") == 2024).collect()
    assert [(r.n_predictions, r.n_unmatched, round(r.accuracy, 6), r.rmse) for r in got] == [(9, 6, round(2 / 3, 6), 0.5)]


def _many_keys(n=300):
    """Rows of n keys within one bucket, then a row that closes it."""
    return [(i, f"k{i}", T0 + timedelta(seconds=i % 50), float(i)) for i in range(n)]


def _state(run):
    ops = [p.stateOperators[0] for p in run.recentProgress if p.stateOperators]
    return max(o.numRowsTotal for o in ops), max(o.numShufflePartitions for o in ops)


def test_asof_state_follows_shards_not_keys(spark, tmp_root):
    rows = _many_keys()
    a = _stream(spark, os.path.join(tmp_root, "labels"), [[(r[0] + 1000, r[1], r[2] + timedelta(seconds=1), 0.0) for r in rows]])
    b = _stream(spark, os.path.join(tmp_root, "features"), [rows]).withColumnRenamed("v", "x")
    out = SF.asof_features_stream(a, b, "k", "ts", "ts", 60, ["x"], "id", "100 seconds", sub_buckets=1)
    path = os.path.join(tmp_root, "out")
    run = SF.write_stream(spark, out, path, os.path.join(tmp_root, "ckpt"), partitions=2)
    got = {r.id: (r.feature_id, r.x) for r in spark.read.schema(out.schema).parquet(path).collect() if r.id >= 0}
    assert got == {r[0] + 1000: (r[0], r[3]) for r in rows}
    held, partitions = _state(run)
    assert partitions == 2 and held < len(rows)


def test_rolling_state_follows_shards_not_keys(spark, tmp_root):
    rows = _many_keys() + [(900, "k7", T0 + timedelta(seconds=50), None), (901, None, T0, 1.0), (902, None, T0, 2.0)]
    q = SF.rolling_range_stream(_stream(spark, os.path.join(tmp_root, "in"), [rows]), "k", "ts", "v", 60, "100 seconds")
    path = os.path.join(tmp_root, "out")
    run = SF.write_stream(spark, q, path, os.path.join(tmp_root, "ckpt"), partitions=2)
    got = {r.id: (r.range60_count, r.range60_sum) for r in spark.read.schema(q.schema).parquet(path).collect() if r.id >= 0}
    want = TM.rolling_range(spark.createDataFrame(rows, SCHEMA), "k", "ts", "v", 60)
    assert got == {r.id: (r.range60_count, r.range60_sum) for r in want.collect()}
    held, partitions = _state(run)
    assert partitions == 2 and held < len(rows)


def test_state_follows_slabs_not_buckets(spark, tmp_root):
    """Rows over many buckets are one value of the state for each shard and slab, and what closed buckets
    leave behind serves the later buckets of their slab."""
    rows = [(i, f"k{i % 40}", T0 + timedelta(seconds=30 * i), float(i)) for i in range(400)]
    q = SF.rolling_range_stream(_stream(spark, os.path.join(tmp_root, "in"), [rows[:150], rows[150:151], rows[151:]]), "k", "ts", "v", 1200, "100 seconds", sub_buckets=2)
    path = os.path.join(tmp_root, "out")
    run = SF.write_stream(spark, q, path, os.path.join(tmp_root, "ckpt"), partitions=2)
    fix = lambda df: {r.id: (r.range1200_count, r.range1200_sum) for r in df.collect() if r.id >= 0}
    assert fix(spark.read.schema(q.schema).parquet(path)) == fix(TM.rolling_range(spark.createDataFrame(rows, SCHEMA), "k", "ts", "v", 1200, sub_buckets=2))
    buckets = 400 * 30 // 600 * min(40, SF.SHARDS)
    assert max(p.stateOperators[0].numRowsUpdated for p in run.recentProgress if p.stateOperators) < buckets / 4


def test_quality_state_follows_shards_not_rows(spark, tmp_root):
    """Predictions and labels that wait are one value of the state for each shard; labels may come first or
    later, again, without a key or out of reach, and predictions may repeat."""
    at = lambda h: T0 + timedelta(hours=h)
    preds = [(i, at(5), i % 2, 0.5) for i in range(400)] + [(0, at(5), 1, 0.0), (None, at(5), 1, 0.5), (500, None, 1, 0.5),
                                                                   (600, at(30), 1, None), (700, at(54), 1, float("nan"))]
    early = [(i, at(6), 1) for i in range(100)] + [(None, at(6), 1)]
    late = [(i, at(7), 1) for i in range(50, 200)] + [(200, at(4), 1), (201, at(18), 1), (202, at(17), None), (600, at(31), 1), (700, at(55), 1)]
    ps, ls = "id long, ts timestamp, predicted int, score double", "id long, ts timestamp, actual int"
    end = datetime(2030, 1, 1)
    for i, (p, r) in enumerate([([(900, at(1), 0, 0.0)], early), (preds, []), ([], late), ([(-1, end, 0, 0.0)], [(-2, end, 0)])]):
        for name, rows, schema in (("p", p, ps), ("l", r, ls)):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(tmp_root, name, str(i)))
    read = lambda name, schema: spark.readStream.schema(schema).option("recursiveFileLookup", "true").option(
        "maxFilesPerTrigger", 1).parquet(os.path.join(tmp_root, name))
    out = SF.quality_stream(read("p", ps), read("l", ls), "id", "ts", "ts", "predicted", "score", "actual", "12 HOURS", "1 day", "1 day")
    run = SF.write_stream(spark, out, os.path.join(tmp_root, "out"), os.path.join(tmp_root, "ckpt"), partitions=2)
    got = spark.read.parquet(os.path.join(tmp_root, "out")).where(F.year("window_start") == 2024).orderBy("window_start").collect()
    no_score, nan_score = got[1:]
    assert (no_score.n_unmatched, no_score.accuracy, no_score.rmse) == (0, 1.0, None) and nan_score.n_unmatched == 0 and math.isnan(nan_score.rmse)
    # 403 with a time; labels for 0 to 199 and twice for 0, and 202's without a value
    assert [(r.n_predictions, r.n_unmatched, round(r.accuracy, 6), round(r.rmse, 6)) for r in got[:1]] == [
        (403, 201, round(101 / 201, 6), round(((200 * 0.25 + 1) / 201) ** 0.5, 6))]
    assert max(o.numRowsTotal for p in run.recentProgress for o in p.stateOperators) <= SF.QUALITY_SHARDS
