import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tidewater.operators import features as FT
from tidewater.operators.quantiles import exact_quantiles

QS = [0, 0.001, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1]


def brute(values, q):
    """Rank by exact decimal arithmetic in the sorted list; NaN last."""
    rows = sorted((v for v in values if v is not None), key=lambda v: (v != v, v if v == v else 0))
    rank = max(1, math.ceil(Decimal(str(q)) * len(rows)))
    return rows[rank - 1]


def check(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}").repartition(3)
    got = exact_quantiles(df, "x", QS)
    want = [brute(values, q) for q in QS]
    assert [repr(g) if g != g else g for g in got] == [repr(w) if w != w else w for w in want]


def test_doubles(spark):
    rng = random.Random(1)
    nan, inf = float("nan"), float("inf")
    check(spark, [rng.gauss(0, 1) for _ in range(3000)], "double")
    check(spark, [rng.choice([-1, 1]) * 10 ** rng.uniform(-320, 308) for _ in range(3000)] + [0.0, 5e-324, -5e-324, 1.7e308, -1.7e308], "double")
    check(spark, [7.5] * 900 + [None] * 300 + [nan] * 30 + [inf, -inf, 8.0], "double")
    check(spark, [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0)] * 50, "double")
    check(spark, [nan, None], "double")


def test_exact_numbers(spark):
    rng = random.Random(2)
    check(spark, [rng.randrange(-(1 << 63), 1 << 63) for _ in range(2000)] + [(1 << 63) - 1, -(1 << 63)], "long")
    check(spark, [(1 << 62) + rng.randrange(3) for _ in range(500)] + [None], "long")
    check(spark, [rng.randrange(10) for _ in range(500)], "int")
    check(spark, [Decimal(rng.randrange(-10 ** 11, 10 ** 11)) / 100 for _ in range(1000)] + [None], "decimal(18,2)")
    check(spark, [Decimal(rng.randrange(10 ** 30)) for _ in range(300)], "decimal(36,0)")


def test_nothing_and_refused(spark):
    assert exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]) == [None]
    with pytest.raises(TypeError):
        exact_quantiles(spark.createDataFrame([("a",)], "x string"), "x", [0.5])
    with pytest.raises(ValueError):
        exact_quantiles(spark.createDataFrame([(1.0,)], "x double"), "x", [1.5])


def test_buckets(spark):
    df = spark.createDataFrame([(float(v),) for v in [1] * 50 + list(range(50))] + [(None,)], "x double")
    out = FT.apply_quantile_buckets(df, FT.exact_quantile_cuts(df, "x", 4), "x", "b").where(F.col("x").isNotNull())
    cuts = [brute([r.x for r in out.collect()], q) for q in (0.25, 0.5, 0.75)]
    assert all(r.b == sum(c <= r.x for c in cuts) for r in out.collect())
    none = df.where("x is null")
    assert [r.b for r in FT.apply_quantile_buckets(none, FT.exact_quantile_cuts(none, "x", 4), "x", "b").collect()] == [None]
