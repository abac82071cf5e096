import random

import pytest
from pyspark.sql import functions as F
from tidewater.operators import evolution as EV
from tidewater.operators import sketches as SK
from tidewater.operators.quantiles import exact_quantiles
from tidewater.sources import readers as R


def test_bucket_order_and_edges(spark):
    rng = random.Random(4)
    xs = [0.0, -0.0, 1.0, 2.0, 0.5, 8.0, 1 / 3, 5e-324, 2.3e-308, 1.7e308, -1.7e308, float("inf"), -float("inf"), float("nan")]
    xs += [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(2000)] + [2.0 ** k for k in range(-1000, 1000, 7)]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", SK.bucket(F.col("x")).alias("b"))
    rows = df.select("x", "b", SK.lower_edge(F.col("b")).alias("lo"), SK.lower_edge(F.col("b") + F.signum("b")).alias("hi")).collect()
    plain = sorted((r for r in rows if r.x == r.x), key=lambda r: r.x)
    assert [r.b for r in plain] == sorted(r.b for r in plain) and next(r.b for r in rows if r.x != r.x) > plain[-1].b
    for r in plain:
        if abs(r.x) > 1e-300 and abs(r.x) < 1e300:
            assert abs(r.lo) <= abs(r.x) < abs(r.hi) <= abs(r.lo) * (1 + 1 / 64) * (1 + 1e-12)


def test_drift_from_stored_sketches(spark, tmp_root):
    rng, path = random.Random(9), f"{tmp_root}/sketches"
    rows = [(f"2024-01-{d:02} 10:00:00", rng.lognormvariate(0, 1) * (1 if d < 8 else 1.5), None if d == 3 else rng.gauss(0, 5)) for d in range(1, 15) for _ in range(400)]
    df = spark.createDataFrame(rows, "ts string, a double, b double").withColumn("ts", F.to_timestamp("ts"))
    SK.write_sketches(SK.sketch_days(df.where("ts < '2024-01-08'"), "ts", ["a", "b"]), path)
    for _ in range(2):          # later days, delivered twice
        SK.write_sketches(SK.sketch_days(df.where("ts >= '2024-01-08'"), "ts", ["a", "b"]), path)
    stored = spark.read.parquet(path)
    base, cur = ("2024-01-01", "2024-01-07"), ("2024-01-08", "2024-01-14")
    out = SK.drift(stored, base, cur, 10)
    got = {r.column: r for r in out.collect()}
    assert all(path in f for f in out.inputFiles())           # no rows are read
    assert got["a"].n_baseline == 2800 and got["b"].n_baseline == 2400 and got["a"].n_current == 2800
    assert got["a"].alert == 1 and got["b"].alert == 0
    # cuts are within a bucket of the exact ones, and KL near that over exact bins
    cuts = SK.bin_of(SK.merged(stored, *base), 10).where("column = 'a'").orderBy("cut").select(SK.lower_edge(F.col("bucket") + 1)).collect()
    exact = exact_quantiles(df.where("ts < '2024-01-08'"), "a", [i / 10 for i in range(1, 10)])
    assert all(0 <= c[0] / e - 1 <= 1 / 64 + 1e-9 for c, e in zip(cuts, exact))
    assert SK.drift(stored, base, ("2025-01-01", "2025-01-02")).where("kl is null and alert = 0").count() == 2
    assert {r.column: r.kl for r in SK.drift(stored, base, base).collect()} == {"a": 0.0, "b": 0.0}


def test_three_versions_read_as_one(spark, tmp_root):
    make = lambda rows, cols: spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    assert EV.read_versions(spark, tmp_root) is None
    assert EV.append_batch(make([("1", "x", None), ("-7", None, None)], ["n", "t", "a.b"]), tmp_root, 0) == 1
    assert EV.append_batch(make([("3000000000", "5")], ["n", "new"]), tmp_root, 1) == 2
    assert EV.append_batch(make([("1.5", "y", "007"), (None, None, " 3")], ["n", "t", "new"]), tmp_root, 2) == 3
    assert EV.append_batch(make([("2", "z")], ["n", "t"]), tmp_root, 3) == 3          # narrower values widen nothing
    assert EV.append_batch(make([("2", "z")], ["n", "t"]), tmp_root, 3) == 3          # a replay replaces itself
    out = EV.read_versions(spark, tmp_root)
    assert dict(out.dtypes) == {"n": "double", "t": "string", "a.b": "int", "new": "string"}
    got = sorted(((r.n, r.t, r.new) for r in out.collect()), key=str)
    assert got == sorted([(1.0, "x", None), (-7.0, None, None), (3e9, None, "5"), (1.5, "y", "007"), (None, None, " 3"), (2.0, "z", None)], key=str)
    for declared in ({"n": "long"}, {"t": "int"}):
        with pytest.raises(ValueError, match="narrow"):
            EV.append_batch(make([("2", "1")], ["n", "t"]), tmp_root, 4, declared)
    with pytest.raises(ValueError, match="holds"):
        EV.append_batch(make([("x",)], ["fresh"]), tmp_root, 4, {"fresh": "double"})
    assert EV.append_batch(make([("2",)], ["fresh"]), tmp_root, 4, {"fresh": "double"}) == 4
    assert EV.batch_types(make([("NaN", "1e400", "+5", "9223372036854775808", None)], list("abcde"))) == {
        "a": "string", "b": "string", "c": "int", "d": "double", "e": None}


def test_unreadable_is_not_damaged(spark, tmp_root):
    """Files of different schemas: a damaged one is listed, one that cannot be read fails the batch."""
    spark.range(3).write.parquet(f"{tmp_root}/a")
    spark.range(3).select(F.col("id").cast("string")).write.parquet(f"{tmp_root}/b")
    with open(f"{tmp_root}/bad.parquet", "wb") as f:
        f.write(b"PAR1 no footer PAR1")
    part = lambda d: [p.replace("file://", "file:") for p in spark.read.parquet(f"{tmp_root}/{d}").inputFiles()]
    whole = part("a") + part("b")
    rows, bad = R.read_parquet(spark, [*whole, f"file:{tmp_root}/bad.parquet"])
    assert rows.count() == 6 and len(bad) == 1 and bad[0].endswith("bad.parquet")
    with pytest.raises(Exception):  # noqa: B017
        R.read_parquet(spark, [*whole, f"file:{tmp_root}/gone.parquet"])
