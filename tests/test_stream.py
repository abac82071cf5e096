import os

import fixtures_landing as FX
from tidewater.functions import constants as K
from tidewater.operators import manifest as M
from tidewater.operators.ingest import IngestTables, ingest_batch, read_processed
from tidewater.streaming import ingest as SI

PICK = ("ok.csv", "sparse.jsonl", "bad.jsonl", "upper.CSV", "short.csv", "many_per_line.json")


def _statuses(spark, t):
    return {r.path.rsplit("/", 1)[1]: r.status
            for r in M.ManifestTable(spark, t.manifest).current().collect()}


def test_stream_equals_batch(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {k: FX.CASES[k] for k in PICK})
    d = os.path.join(land, "source=t", "date=2026-05-17")
    open(os.path.join(d, "empty.csv"), "wb").close()
    t = IngestTables(os.path.join(tmp_root, "state"))
    SI.run_ingest_stream(spark, land, t, os.path.join(tmp_root, "ckpt"), max_files_per_trigger=2)
    got = _statuses(spark, t)
    exp = {k: FX.CASES[k][1] for k in PICK}
    exp["empty.csv"] = K.QUARANTINED
    assert got == exp
    n = read_processed(spark, t).count()
    assert n == 2 + 2 + 3
    # a later trigger with one more file processes only that file
    FX.write_cases(land, {"late.csv": (b"late\n1\n", K.DONE, 1)})
    SI.run_ingest_stream(spark, land, t, os.path.join(tmp_root, "ckpt"), max_files_per_trigger=2)
    assert _statuses(spark, t)["late.csv"] == K.DONE
    assert read_processed(spark, t).count() == n + 1


def test_crash_inside_batch_then_restart(spark, tmp_root, monkeypatch):
    """Failure after the processed write but before the batch commits: the
    rerun replays the same batch id and leaves no duplicate rows."""
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {k: FX.CASES[k] for k in ("ok.csv", "sparse.jsonl")})
    t = IngestTables(os.path.join(tmp_root, "state"))
    ckpt = os.path.join(tmp_root, "ckpt")
    import tidewater.streaming.ingest as mod
    calls = {"n": 0}

    def crashing(spark_, landed, t_, batch_id, now=None):
        out = ingest_batch(spark_, landed, t_, batch_id, now)
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("executor lost")
        return out

    monkeypatch.setattr(mod, "ingest_batch", crashing)
    try:
        SI.run_ingest_stream(spark, land, t, ckpt)
    except Exception:
        pass
    SI.run_ingest_stream(spark, land, t, ckpt)
    assert read_processed(spark, t).count() == 4
    assert spark.read.parquet(t.topic).count() == 2
    assert set(_statuses(spark, t).values()) == {K.DONE}


def test_recovery_and_metrics_stream(spark, tmp_root):
    import datetime as dt
    from pyspark.sql import functions as F
    from tidewater.operators.ingest import recover_stuck_files
    from tidewater.streaming.metrics import run_metrics_stream
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {k: FX.CASES[k] for k in ("ok.csv", "sparse.jsonl")})
    t = IngestTables(os.path.join(tmp_root, "state"))
    man = M.ManifestTable(spark, t.manifest)
    # two entries stuck in processing for an hour: one file still landed, one gone
    import hashlib
    old = dt.datetime(2026, 5, 17, 0, 0, 0)
    h_ok = hashlib.sha256(FX.CASES["ok.csv"][0]).hexdigest()
    ok_path = [p for p in os.listdir(os.path.join(land, "source=t", "date=2026-05-17")) if p == "ok.csv"][0]
    rows = [(h_ok, "file:" + os.path.join(land, "source=t", "date=2026-05-17", ok_path), "t", K.PROCESSING, old, 1, None, 0),
            ("gone", "file:/nowhere/x.csv", "t", K.PROCESSING, old, 1, None, 0)]
    man.append(spark.createDataFrame(rows, M.LOG_SCHEMA))
    res = recover_stuck_files(spark, land, t, batch_id=-1, now=old + dt.timedelta(hours=1))
    assert [r.status for r in res.collect()] == [K.DONE]
    cur = {r.content_hash: r.status for r in man.current().collect()}
    assert cur == {h_ok: K.DONE, "gone": K.FAILED}
    out, al = os.path.join(tmp_root, "m"), os.path.join(tmp_root, "a")
    # ingest the rest, then close the windows by a late arrival far ahead
    from tidewater.operators.ingest import ingest_landing
    ingest_landing(spark, land, t, batch_id=101, now=old + dt.timedelta(hours=1))
    from tidewater.streaming.metrics import FILE_EVENTS_SCHEMA
    ev = spark.read.schema(FILE_EVENTS_SCHEMA).parquet(t.file_events)
    n_files = ev.count()
    last = ev.agg(F.max("received_at")).first()[0]
    # a much later arrival moves the watermark past every real window
    late = ev.limit(1).withColumn("received_at", F.lit(last + dt.timedelta(hours=3)).cast("timestamp")) \
        .withColumn("batch_id", F.lit(999).cast("bigint"))
    late.write.mode("append").partitionBy("batch_id").parquet(t.file_events)
    run_metrics_stream(spark, t.file_events, out, al, os.path.join(tmp_root, "mck"))
    m = spark.read.parquet(out)
    assert m.agg(F.sum("files")).first()[0] == n_files


def test_recovery_hash_mismatch_d08(spark, tmp_root):
    """A stuck entry whose landed bytes were overwritten since: quarantined
    with a content hash mismatch, under the expected (stuck) hash."""
    import datetime as dt
    import hashlib
    from tidewater.operators.ingest import recover_stuck_files
    land = os.path.join(tmp_root, "landing")
    d = FX.write_cases(land, {"x.csv": (b"a\n2\n", K.DONE, 1)})
    t = IngestTables(os.path.join(tmp_root, "state"))
    old_hash = hashlib.sha256(b"a\n1\n").hexdigest()
    old = dt.datetime(2026, 5, 17)
    M.ManifestTable(spark, t.manifest).append(spark.createDataFrame(
        [(old_hash, "file:" + os.path.join(d, "x.csv"), "t", K.PROCESSING, old, 1, None, 0)], M.LOG_SCHEMA))
    res = recover_stuck_files(spark, land, t, batch_id=-1, now=old + dt.timedelta(hours=1)).collect()
    new_hash = hashlib.sha256(b"a\n2\n").hexdigest()
    assert [(r.status, r.content_hash, r.reason) for r in res] == [
        (K.QUARANTINED, old_hash, f"content hash mismatch: expected {old_hash}, got {new_hash}")]
    cur = {r.content_hash: r.status for r in M.ManifestTable(spark, t.manifest).current().collect()}
    assert cur == {old_hash: K.QUARANTINED}


def test_notification_stream(spark, tmp_root):
    from pyspark.sql import functions as F
    from tidewater.sources import notifications as NT
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {k: FX.CASES[k] for k in ("ok.csv", "sparse.jsonl", "upper.CSV")})
    msgs = os.path.join(tmp_root, "msgs")
    keys = [f"source=t/date=2026-05-17/{k}" for k in ("ok.csv", "sparse.jsonl")]
    spark.createDataFrame([(k,) for k in keys], "k string").select(
        NT.encode(F.lit("landing"), F.col("k"), F.lit(1).cast("bigint"), F.lit("e")).alias("value")
    ).write.parquet(msgs)
    t = IngestTables(os.path.join(tmp_root, "state"))
    SI.run_notification_stream(spark, msgs, land, t, os.path.join(tmp_root, "ck"))
    assert _statuses(spark, t) == {"ok.csv": K.DONE, "sparse.jsonl": K.DONE}   # upper.CSV not notified
    # a later message for the third file
    spark.createDataFrame([("source=t/date=2026-05-17/upper.CSV",)], "k string").select(
        NT.encode(F.lit("landing"), F.col("k"), F.lit(1).cast("bigint"), F.lit("e")).alias("value")
    ).write.mode("append").parquet(msgs)
    SI.run_notification_stream(spark, msgs, land, t, os.path.join(tmp_root, "ck"))
    assert _statuses(spark, t)["upper.CSV"] == K.QUARANTINED


def test_staging_is_purged(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {f"f{i}.csv": (f"a\n{i}\n".encode(), K.DONE, 1) for i in range(6)})
    t = IngestTables(os.path.join(tmp_root, "state"))
    SI.run_ingest_stream(spark, land, t, os.path.join(tmp_root, "ck"), max_files_per_trigger=1,
                         keep_staging=2)
    left = sorted(os.listdir(os.path.join(tmp_root, "state", "staging")))
    assert [int(b.split("=")[1]) & 0xFFFFFFFF for b in left] == [4, 5]
    assert len(_statuses(spark, t)) == 6
