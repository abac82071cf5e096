import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import features as FT
from tidewater.operators import pipeline as PL
from tidewater.functions.json_values import split_values


def test_coerce_flags(spark):
    df = spark.createDataFrame([("1", "2024-01-01 00:00:01", "x"), ("y", None, "2.5")],
                               "a string, t string, d string")
    out = FT.coerce(df, {"a": "bigint", "t": "timestamp", "d": "double"}).collect()
    assert out[0].a == 1 and out[0].d is None and out[0].coerce_errors == ["d"]
    assert out[1].a is None and out[1].t is None and out[1].d == 2.5 and out[1].coerce_errors == ["a"]


def test_rules_split(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, x double")
    checked = FT.check_rules(df, {"positive": F.col("x") > 0, "small": F.col("x") < 10})
    ok, bad = FT.split_valid(checked)
    assert [r.id for r in ok.collect()] == [1]
    assert {r.id: r.reasons for r in bad.collect()} == {2: ["positive"], 3: ["positive", "small"]}


def test_minmax_constant_group_and_inverse(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 7.0), ("b", 7.0)], "g string, x double")
    st = FT.fit_minmax(df, "x", ["g"])
    out = FT.apply_minmax(df, st, "x", "s", ["g"])
    assert sorted((r.g, r.s) for r in out.collect()) == [("a", 0.0), ("a", 1.0), ("b", 0.0), ("b", 0.0)]
    back = FT.invert_minmax(out.drop("x"), st, "x", "s", "x2", ["g"])
    assert sorted(r.x2 for r in back.where("g = 'a'").collect()) == [1.0, 3.0]


def test_quantile_buckets_close_to_numpy(spark):
    vals = [float(v) for v in np.random.default_rng(1).normal(size=4000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    cuts = FT.quantile_cuts(df, "x", 4)
    got = np.array([r.b for r in FT.apply_quantile_buckets(df, cuts, "x", "b").collect()])
    counts = np.bincount(got, minlength=4)
    assert all(abs(c - 1000) < 60 for c in counts), counts


def test_onehot_cap_and_unseen(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",)], "c string")
    cats = FT.fit_onehot(df, "c")
    assert cats == ["x", "y"]
    new = spark.createDataFrame([("z",)], "c string")
    assert FT.apply_onehot(new, "c", cats).first().asDict() == {"c": "z", "c_x": 0, "c_y": 0}
    with pytest.raises(ValueError):
        FT.fit_onehot(df, "c", max_categories=1)


def test_target_encoding_unseen_is_global(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("b", 0.0)], "c string, y double")
    enc, glob = FT.fit_target(df, "c", "y", m=10.0)
    probe = spark.createDataFrame([("a",), ("zz",)], "c string")
    out = {r.c: r.te for r in FT.apply_target(probe, enc, glob, "c", "te").collect()}
    g = 10.0
    assert out["zz"] == pytest.approx(g)
    assert out["a"] == pytest.approx((2 * 15.0 + 10 * g) / 12)


def test_tokenize_unicode(spark):
    df = spark.createDataFrame([("Élan, vital! 42x -- ÉTÉ",)], "t string")
    assert df.select(FT.tokenize("t").alias("k")).first().k == ["élan", "vital", "42x", "été"]


def test_pipeline_json_roundtrip(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 3.0)], "id int, c string, v double")
    cfg = {"steps": [{"op": "minmax", "col": "v", "out": "vm"}, {"op": "onehot", "col": "c"}]}
    fitted = PL.fit(json.dumps(cfg), df)
    out = sorted((r.id, r.vm, r.c_a, r.c_b) for r in fitted.transform(df).collect())
    assert out == [(1, 0.0, 1, 0), (2, 1.0, 0, 1)]
    assert json.loads(fitted.to_json())["state"][1] == ["a", "b"]


@pytest.mark.parametrize("text,expected", [
    ('{"a":1}{"a":2}\n{"a":\n3}\n', ['{"a":1}', '{"a":2}', '{"a":3}']),
    ('null\n{"a":1}', ["{}", '{"a":1}']),
    ('{"a":1,"a":2}', ['{"a":2}']),
])
def test_split_values_ok(text, expected):
    assert split_values(text) == expected


@pytest.mark.parametrize("text", ['[{"a":1}]', '{"a":1}xx}', "{'a':1}", '{"a":1e400}', '{"a":NaN}', '"s"'])
def test_split_values_rejects(text):
    with pytest.raises(ValueError):
        split_values(text)


def test_pipeline_save_load(spark, tmp_root):
    df = spark.createDataFrame([(1, "a", 1.0, "x"), (2, "b", 3.0, "y"), (3, "a", 5.0, "x")],
                               "id int, c string, v double, g string")
    cfg = {"steps": [{"op": "minmax", "col": "v", "out": "vm", "by": ["g"]},
                     {"op": "onehot", "col": "c"},
                     {"op": "target", "col": "c", "target": "v", "out": "c_te"},
                     {"op": "frequency", "col": "g", "out": "g_freq"}]}
    fitted = PL.fit(cfg, df)
    fitted.save(tmp_root + "/p")
    again = PL.load(spark, tmp_root + "/p")
    a = sorted(map(tuple, fitted.transform(df).select("id", "vm", "c_a", "c_te", "g_freq").collect()))
    b = sorted(map(tuple, again.transform(df).select("id", "vm", "c_a", "c_te", "g_freq").collect()))
    assert a == b
