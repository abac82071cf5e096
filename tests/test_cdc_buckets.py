import os
import random

import pytest
from pyspark.sql import types as T
from tidewater.operators import cdc as CD

SCHEMA = (T.StructType().add("k", "long").add("after", T.StructType().add("v", "long")).add("op", "string")
          .add("ts_ms", "long").add("offset", "long"))


def _expect(changes):
    last = {}
    for k, after, op, ts, off in changes:
        if k not in last or (ts, off) > last[k][0]:
            last[k] = ((ts, off), after, op)
    return sorted(((k, a[0], op) for k, (_, a, op) in last.items() if op != "d"), key=str)


def _got(spark, path, **kw):
    return sorted(((r.k, r.v, r.op) for r in CD.read_buckets(spark, path, "k", SCHEMA, **kw).collect()), key=str)


def _files(path, kind):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{path}/{kind}") for f in fs if f.endswith(".parquet")}


def test_batches_late_changes_and_replay(spark, tmp_root):
    rng, path, all_ = random.Random(3), f"{tmp_root}/state", []
    handle = CD.foreach_batch_buckets(path, "k", buckets=8, fold=3)
    assert _got(spark, path) == []
    states = {}
    for n in range(7):
        keys = [None, *range(40)] if n == 0 else rng.sample(range(60), 5)
        batch = [(k, None if (d := rng.random() < 0.2) else (rng.randrange(100),), "d" if d else "u", rng.randrange(50), i) for i, k in enumerate(keys)]
        batch = [(k, a, op, ts, 1000 * n + off) for k, a, op, ts, off in batch]
        handle(spark.createDataFrame(batch, SCHEMA), n)
        all_ += batch
        states[n] = _expect(all_)
        assert _got(spark, path) == states[n]
    assert _got(spark, path, as_of=5) == states[5]        # the commit before is kept
    handle(spark.createDataFrame(batch, SCHEMA), 6)       # replay
    assert _got(spark, path) == states[6] and _got(spark, path, as_of=5) == states[5]
    assert sorted(os.listdir(f"{path}/commits")) == ["v5", "v6"]


def test_small_batch_touches_its_buckets_only(spark, tmp_root):
    path = f"{tmp_root}/state"
    handle = CD.foreach_batch_buckets(path, "k", buckets=64, fold=1)
    handle(spark.createDataFrame([(k, (k,), "c", 1, k) for k in range(5000)], SCHEMA), 0)
    old = _files(path, "base")
    assert len(old) == 64
    handle(spark.createDataFrame([(k, (-1,), "u", 2, k) for k in range(10)], SCHEMA), 1)
    new = {f for f in _files(path, "base") if f not in old}
    assert 0 < len(new) <= 10
    assert _got(spark, path) == sorted([(k, -1 if k < 10 else k, "u" if k < 10 else "c") for k in range(5000)], key=str)
    lazy = CD.foreach_batch_buckets(path, "k", buckets=64, fold=4)
    have = _files(path, "base")
    lazy(spark.createDataFrame([(k, (-2,), "u", 3, k) for k in range(10)], SCHEMA), 2)
    assert {f for f in _files(path, "base") if f not in have} == set()      # deltas only
    assert sum(r[1] == -2 for r in _got(spark, path)) == 10


def test_empty_batch_and_other_bucket_count(spark, tmp_root):
    path = f"{tmp_root}/state"
    CD.foreach_batch_buckets(path, "k", buckets=4)(spark.createDataFrame([], SCHEMA), 0)
    assert _got(spark, path) == []
    CD.foreach_batch_buckets(path, "k", buckets=4)(spark.createDataFrame([(1, (5,), "c", 1, 1)], SCHEMA), 1)
    assert _got(spark, path) == [(1, 5, "c")]
    with pytest.raises(ValueError):
        CD.foreach_batch_buckets(path, "k", buckets=8)(spark.createDataFrame([], SCHEMA), 2)
