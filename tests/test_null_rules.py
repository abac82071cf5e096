"""Null categories and values, and state that stays as fitted."""

import re

from pyspark.sql import functions as F

from tidewater.operators import features as FT
from tidewater.operators import pipeline as PL
from tidewater.operators import temporal as TM


def test_rolling_rows_with_nulls(spark):
    rows = [("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0), ("a", 4, None), ("a", 5, None), (None, 1, 7.0), (None, 2, 8.0)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    out = {(r.k, r.t): (r.last2_count, r.last2_sum, r.last2_avg) for r in TM.rolling_rows(df, "k", ["t"], "v", 2, F.col("t") % 1).collect()}
    assert out[("a", 2)] == (2, 1.0, 1.0) and out[("a", 3)] == (2, 3.0, 3.0) and out[("a", 5)] == (2, None, None)
    assert out[(None, 2)] == (2, 15.0, 7.5)


def test_rolling_rows_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(TM, "ROWS_PER_BLOCK", 4)
    df = spark.range(50).selectExpr("id % 2 AS k", "id AS t", "double(id) AS v")
    out = {r.t: (r.last5_count, r.last5_sum) for r in TM.rolling_rows(df, "k", ["t"], "v", 5, F.floor(F.col("t") / 7)).collect()}
    for t in range(50):
        last = [x for x in range(t, -1, -2)][:5]
        assert out[t] == (len(last), float(sum(last)))


def test_rolling_rows_nan_stays_in_its_frame(spark):
    df = spark.createDataFrame([("a", t, float("nan") if t == 2 else float(t)) for t in range(1, 8)], "k string, t long, v double")
    out = {r.t: r.last2_sum for r in TM.rolling_rows(df, "k", ["t"], "v", 2, F.lit(0)).collect()}
    assert out[5] == 9.0 and out[2] != out[2] and out[3] != out[3]


def test_rolling_range_with_nulls(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 60, None), ("a", 120, 3.0)], "k string, s long, v double").withColumn("ts", F.timestamp_seconds("s"))
    out = {r.s: (r.range100_count, r.range100_avg) for r in TM.rolling_range(df, "k", "ts", "v", 100, sub_buckets=3).collect()}
    assert out == {0: (1, 1.0), 60: (2, 1.0), 120: (2, 3.0)}


def test_null_category_has_a_frequency(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",)], "c string")
    got = sorted((r.c or "", round(r.f, 6)) for r in FT.apply_frequency(df, FT.fit_frequency(df, "c"), "c", "f").collect())
    assert got == [("", 0.666667), ("", 0.666667), ("x", 0.333333)]


def test_state_stays_as_fitted(spark, tmp_root):
    src = f"{tmp_root}/src"
    spark.createDataFrame([("a", 1.0), ("b", 3.0)], "c string, v double").write.parquet(src)
    df = spark.read.parquet(src)
    steps = {"steps": [{"op": "minmax", "col": "v", "out": "m"}, {"op": "frequency", "col": "c", "out": "f"},
                       {"op": "standard", "col": "v", "out": "s"}, {"op": "target", "col": "c", "target": "v", "out": "t"}]}
    fitted = PL.fit(steps, df)
    before = sorted(tuple(r) for r in fitted.transform(df).collect())
    spark.createDataFrame([("a", 100.0)] * 5, "c string, v double").write.mode("append").parquet(src)
    assert sorted(tuple(r) for r in fitted.transform(df.limit(0).unionByName(
        spark.createDataFrame([("a", 1.0), ("b", 3.0)], "c string, v double"))).collect()) == before
    # the source is named once, whatever the number of fitted steps
    logical = fitted.transform(df)._jdf.queryExecution().analyzed().toString()
    assert len(re.findall(r"Relation \[c#\d+,v#", logical)) == 1


def test_tfidf_counts_runs(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, ["a"]), (3, [])], "id long, t array<string>")
    got = {(r.id, r.term): round(r.tf, 6) for r in FT.tfidf(df, "id", "t").collect()}
    assert got == {(1, "a"): 0.333333, (1, "b"): 0.666667, (2, "a"): 1.0}
