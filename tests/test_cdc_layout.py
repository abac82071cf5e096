import os

from pyspark.sql import functions as F

from tidewater.operators import cdc as CD
from tidewater.operators import layout as LY
from tidewater.operators import monitor as MO


def _changes(spark):
    row = "struct<v:int,s:string>"
    data = [(1, "c", 100, 0, None, (1, "a")), (1, "u", 200, 0, (1, "a"), (2, "a")),
            (2, "r", 50, 0, None, (5, "x")), (2, "d", 60, 0, (5, "x"), None),
            (3, "c", 10, 0, None, (9, "z")), (3, "u", 10, 1, (9, "z"), (9, "zz"))]
    return spark.createDataFrame(data, f"k int, op string, ts_ms long, offset long, before {row}, after {row}")


def test_apply_and_as_of(spark):
    ch = _changes(spark)
    cur = {r.k: (r.v, r.s, r.op) for r in CD.apply_changes(ch, "k").collect()}
    assert cur == {1: (2, "a", "u"), 3: (9, "zz", "u")}
    old = {r.k: r.v for r in CD.apply_changes(ch, "k", F.lit(55)).collect()}
    assert old == {2: 5, 3: 9}            # key 1 is only inserted at 100
    mid = {r.k: r.v for r in CD.apply_changes(ch, "k", F.lit(150)).collect()}
    assert mid == {1: 1, 3: 9}            # key 2 deleted at 60


def test_diff(spark):
    d = CD.diff_columns(_changes(spark), "k", ["v", "s"]).collect()
    assert sorted((r.k, r.column, r.old, r.new) for r in d) == [(1, "v", "1", "2"), (3, "s", "z", "zz")]


def test_enforce_schema(spark):
    df = spark.createDataFrame([("1", "2.5", "n"), ("x", "3", "m")], "a string, b string, extra string")
    ok, bad, added = LY.enforce_schema(df, {"a": "int", "b": "double", "c": "string"})
    assert added == ["extra"]
    assert [(r.a, r.b, r.c, r.extra) for r in ok.collect()] == [(1, 2.5, None, "n")]
    assert [r.reasons for r in bad.collect()] == [["a"]]
    ok2, bad2, _ = LY.enforce_schema(df, {"a": "int", "b": "double"}, allow_new=False)
    assert ok2.count() == 0 and bad2.count() == 2


def test_retention_drop_and_compaction(spark, tmp_root):
    df = spark.createDataFrame([(i, f"2024-01-{1 + i % 5:02d}", "s") for i in range(100)],
                               "id int, date string, source string")
    path = os.path.join(tmp_root, "t")
    df.repartition(8).write.partitionBy("date", "source").parquet(path)
    plan = LY.compaction_plan(spark, path, ["date", "source"]).collect()
    assert all(r.n_files > 1 and r.target_files == 1 for r in plan)
    out = os.path.join(tmp_root, "c")
    LY.compact(spark, path, out, ["date", "source"])
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(100))
    after = LY.compaction_plan(spark, out, ["date", "source"]).collect()
    assert all(r.n_files == 1 for r in after)
    gone = LY.drop_partitions(spark, path, "date", "2024-01-03")
    assert sorted(gone) == ["date=2024-01-01", "date=2024-01-02"]
    assert spark.read.parquet(path).count() == 60


def test_backfill_idempotent(spark, tmp_root):
    import datetime as dt
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 4)) for i in range(40)], "id int, ts timestamp")
    out = os.path.join(tmp_root, "f")
    comp = lambda d: d.select("id", (F.col("id") * 2).alias("f"), F.date_format("ts", "yyyy-MM-dd").alias("date"))
    LY.backfill(df, comp, "ts", "2024-01-01", "2024-01-04", out)
    LY.backfill(df, comp, "ts", "2024-01-02", "2024-01-03", out)
    assert spark.read.parquet(out).count() == 40


def test_alert_rules(spark):
    m = spark.createDataFrame([("2024-01-01 00:00:00", "s", 0.5, 2, 400.0), ("2024-01-01 00:10:00", "s", 0.0, 0, 10.0)],
                              "window_start string, source string, error_rate double, quarantined long, p99 double")
    a = sorted((r.window_start, r.rule) for r in MO.alerts(m).collect())
    assert a == [("2024-01-01 00:00:00", "error_rate"), ("2024-01-01 00:00:00", "latency_p99"),
                 ("2024-01-01 00:00:00", "quarantine")]


def test_streaming_cdc_apply(spark, tmp_root):
    ch = _changes(spark)
    src = os.path.join(tmp_root, "changes")
    ch.where("ts_ms <= 60").write.parquet(src)
    target = os.path.join(tmp_root, "snap")

    def run():
        q = (spark.readStream.schema(ch.schema).parquet(src).writeStream
             .foreachBatch(CD.foreach_batch_apply(target, "k"))
             .option("checkpointLocation", os.path.join(tmp_root, "ck")).trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    assert sorted(r.k for r in CD.read_current(spark, target, "k").collect()) == [3]
    ch.where("ts_ms > 60").write.mode("append").parquet(src)
    run()
    got = {r.k: (r.v, r.s) for r in CD.read_current(spark, target, "k").collect()}
    assert got == {1: (2, "a"), 3: (9, "zz")}


def test_streaming_cdc_late_deleted_and_replayed(spark, tmp_root):
    """Changes in any order and any batches, some batches twice: the batch result."""
    import random
    rows = [(k, ("x", k * 10 + t), "d" if (k + t) % 4 == 0 else "u", t, t) for k in range(12) for t in range(6)]
    schema = "k int, after struct<s: string, v: int>, op string, ts_ms bigint, offset bigint"
    want = {(r.k, r.v) for r in CD.apply_changes(spark.createDataFrame(rows, schema), "k").collect()}
    random.Random(3).shuffle(rows)
    target = os.path.join(tmp_root, "late")
    handle = CD.foreach_batch_apply(target, "k")
    assert CD.read_current(spark, target, "k") is None
    for n in range(4):
        batch = spark.createDataFrame(rows[n * 18:(n + 1) * 18], schema)
        handle(batch, n)
        if n % 2:
            handle(batch, n)
    assert {(r.k, r.v) for r in CD.read_current(spark, target, "k").collect()} == want


def test_compaction_reaches_its_target(spark, tmp_root):
    import glob
    src, out = os.path.join(tmp_root, "many"), os.path.join(tmp_root, "few")
    df = spark.range(60_000).selectExpr("id", "concat('2024-01-0', 1 + id % 2) AS date", "if(id % 10 < 8, 'a', 'b') AS source", "sha2(string(id), 256) AS body")
    df.repartition(30).write.partitionBy("date", "source").parquet(src)
    target = 200_000
    plan = {(r.date, r.source): r for r in LY.compact(spark, src, out, ["date", "source"], target).collect()}
    assert spark.read.parquet(out).select("id").distinct().count() == 60_000 == spark.read.parquet(out).count()
    for (date, source), r in plan.items():
        sizes = [os.path.getsize(f) for f in glob.glob(f"{out}/date={date}/source={source}/*.parquet")]
        assert max(sizes) <= 2 * target
        assert len(sizes) <= 2 * r.target_files + 1
        assert r.n_files == len(glob.glob(f"{src}/date={date}/source={source}/*.parquet"))


def test_retention_at_any_depth(spark, tmp_root):
    for d in ("a=1/b=2/c=3/date=2024-01-01", "a=1/b=2/c=3/date=2024-03-01"):
        os.makedirs(f"{tmp_root}/deep/{d}")
    gone = LY.drop_partitions(spark, f"{tmp_root}/deep", "date", "2024-02-01")
    assert gone == ["a=1/b=2/c=3/date=2024-01-01"]


def test_ml_model_apply(spark):
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.feature import VectorAssembler
    from tidewater.operators import serving as SV
    df = spark.createDataFrame([(float(i), 2.0 * i + 1.0) for i in range(20)], "x double, y double")
    model = LinearRegression(labelCol="y").fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(df))
    out = SV.predict_ml(df, model, ["x"], out="pred").collect()
    assert all(abs(r.pred - r.y) < 1e-6 for r in out)
    lin = SV.predict_linear(df, SV.fit_linear(df, "y", "x"), "x").collect()
    assert all(abs(r.prediction - r.y) < 1e-9 for r in lin)


def test_apply_retention_nested(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    for src in ("a", "b"):
        for d in ("2026-01-01", "2026-05-01"):
            os.makedirs(os.path.join(land, f"source={src}", f"date={d}"))
            open(os.path.join(land, f"source={src}", f"date={d}", "f.csv"), "w").write("x\n1\n")
    out = LY.apply_retention(spark, land, None, "2026-05-17")
    assert sorted(out["raw"]) == ["source=a/date=2026-01-01", "source=b/date=2026-01-01"]
    assert sorted(os.listdir(os.path.join(land, "source=a"))) == ["date=2026-05-01"]


def test_opaque_model_apply(spark):
    import numpy as np
    from tidewater.operators import serving as SV
    w = np.array([2.0, -1.0])

    class Model:                      # any object with a vectorised predict
        def predict(self, x):
            return x @ w + 0.5

    m = Model()
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(50)], "a double, b double")
    out = SV.predict_opaque(df, m.predict, ["a", "b"]).collect()
    assert all(abs(r.prediction - (2 * r.a - r.b + 0.5)) < 1e-12 for r in out)


def test_partitioned_layout_prunes(spark, tmp_root):
    df = spark.createDataFrame([(i, f"2024-01-{1 + i % 3:02d}", "s" if i % 2 else "t") for i in range(30)],
                               "id int, date string, source string")
    path = os.path.join(tmp_root, "t")
    LY.write_partitioned(df, path)
    q = spark.read.parquet(path).where("date = '2024-01-02'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-02" in plan
    assert q.count() == 10
    # date is the first folder level, source the second
    assert all(d.startswith("date=") for d in os.listdir(path) if not d.startswith((".", "_")))
