import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions import constants as K
from tidewater.operators import manifest as M

T0 = dt.datetime(2026, 5, 17, 0, 0, 0)


def _log(spark, rows):
    return spark.createDataFrame(
        [(h, f"p/{h}", "s", st, T0 + dt.timedelta(minutes=m), seq, None, 1) for h, st, m, seq in rows],
        M.LOG_SCHEMA)


def test_current_processed_at_rules(spark):
    log = _log(spark, [("a", K.PENDING, 0, 0), ("a", K.PROCESSING, 0, 1), ("a", K.DONE, 5, 2),
                       ("b", K.PENDING, 0, 0), ("b", K.PROCESSING, 1, 1),
                       ("c", K.PENDING, 0, 0), ("c", K.FAILED, 2, 1), ("c", K.PENDING, 3, 2)])
    cur = {r.content_hash: r for r in M.current(log).collect()}
    assert cur["a"].status == K.DONE and cur["a"].processed_at == T0 + dt.timedelta(minutes=5)
    assert cur["b"].status == K.PROCESSING and cur["b"].processed_at is None
    assert cur["c"].status == K.PENDING and cur["c"].processed_at is None   # reset to NULL
    assert cur["b"].created_at == T0


def test_stuck_is_strict_and_processing_only(spark):
    log = _log(spark, [("a", K.PROCESSING, 0, 0), ("b", K.PROCESSING, 10, 0), ("c", K.PENDING, 0, 0)])
    cur = M.current(log)
    as_of = T0 + dt.timedelta(minutes=41)            # a: 41 min old, b: exactly 31 min
    assert [r.content_hash for r in M.stuck(cur, as_of).collect()] == ["a"]
    assert sorted(r.content_hash for r in M.stuck(cur, as_of, include_pending=True).collect()) == ["a", "c"]


def test_skip_known_and_insert_if_absent(spark):
    log = _log(spark, [("done", K.DONE, 0, 0), ("pend", K.PENDING, 0, 0), ("fail", K.FAILED, 0, 0),
                       ("q", K.QUARANTINED, 0, 0), ("proc", K.PROCESSING, 0, 0)])
    batch = spark.createDataFrame(
        [(h, f"x/{h}{i}", T0 + dt.timedelta(seconds=i)) for i, h in
         enumerate(["done", "pend", "fail", "q", "proc", "new", "new"])],
        "content_hash string, path string, received_at timestamp").withColumn("source", F.lit("s"))
    todo = M.skip_known(batch, log)
    got = {r.content_hash: r.path for r in todo.collect()}
    assert got == {"pend": "x/pend1", "new": "x/new5"}    # first of the two 'new' files
    ins = M.insert_if_absent(todo, log, F.lit(T0).cast("timestamp"))
    assert [(r.content_hash, r.status) for r in ins.collect()] == [("new", K.PENDING)]


def test_lookup_and_recent(spark):
    log = _log(spark, [(f"h{i:02d}", K.DONE, i, 0) for i in range(15)])
    cur = M.current(log)
    assert [r.content_hash for r in M.lookup(cur, ["h03", "zz"]).collect()] == ["h03"]
    rec = [r.content_hash for r in M.recent(cur, 10).collect()]
    assert rec == [f"h{i:02d}" for i in range(14, 4, -1)]


def test_manifest_table_roundtrip(spark, tmp_root):
    t = M.ManifestTable(spark, tmp_root + "/m")
    assert t.log().count() == 0
    t.append(_log(spark, [("a", K.PENDING, 0, 0)]))
    t.append(_log(spark, [("a", K.DONE, 1, 1)]))
    assert t.current().first().status == K.DONE


def test_compaction_keeps_current(spark, tmp_root):
    t = M.ManifestTable(spark, tmp_root + "/m")
    t.append(_log(spark, [("a", K.PENDING, 0, 0), ("a", K.PROCESSING, 0, 1), ("a", K.DONE, 3, 2),
                          ("b", K.PENDING, 1, 0)]))
    before = sorted(map(tuple, t.current().collect()))
    c = t.compact(tmp_root + "/m2")
    assert sorted(map(tuple, c.current().collect())) == before
    assert c.log().count() == 3


def test_pending_is_not_recovered_by_default_d22(spark):
    log = _log(spark, [("p", K.PENDING, 0, 0)])
    assert M.stuck(M.current(log), T0 + dt.timedelta(hours=2)).count() == 0


def test_relevant_log(spark):
    log = _log(spark, [("a", K.DONE, 0, 0), ("b", K.PENDING, 0, 0), ("c", K.FAILED, 0, 0)])
    batch = spark.createDataFrame([("a",), ("b",), ("zz",)], "content_hash string")
    assert sorted(r.content_hash for r in M.relevant_log(log, batch).collect()) == ["a", "b"]
    none = spark.createDataFrame([("zz",)], "content_hash string")
    assert M.relevant_log(log, none).count() == 0
