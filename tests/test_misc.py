import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidewater.operators import layout as LY
from tidewater.operators import monitor as MO
from tidewater.sources import landing as LD


def test_landing_key_is_utc_day_d01():
    t = dt.datetime(2026, 5, 17, 23, 30, tzinfo=dt.timezone(dt.timedelta(hours=-5)))   # 04:30 UTC next day
    assert LD.landing_key("crm", "orders.csv", t) == "source=crm/date=2026-05-18/orders.csv"
    name = LD.default_filename(dt.datetime(2026, 5, 17, tzinfo=dt.timezone.utc))
    assert name.endswith(".json") and name[:-5].isdigit() and len(name[:-5]) == 19
    for bad in ("", "_x.csv", ".x.csv"):
        with pytest.raises(ValueError):
            LD.landing_key("s", bad)


def test_kl_drift_matches_hand_computation(spark):
    cur = spark.createDataFrame([("g", 1.0), ("g", 1.0), ("g", 30.0), ("g", 60.0)], "k string, v double")
    base = spark.createDataFrame([("g", 1.0), ("g", 30.0), ("g", 30.0), ("g", 30.0)], "k string, v double")
    out = MO.kl_drift(cur, base, ["k"], "v", 0.0, 25.0, 4).first()
    p = {0: 0.5, 1: 0.25, 2: 0.25}
    q = {0: 0.25, 1: 0.75}
    eps = 1e-6
    exp = sum(max(p.get(b, 0), eps) * math.log(max(p.get(b, 0), eps) / max(q.get(b, 0), eps))
              for b in set(p) | set(q))
    assert out.kl == pytest.approx(exp) and out.alert == 1


def test_expired_partitions(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, d),) for d in (1, 1, 2, 20)], "ts timestamp")
    out = LY.expired_partitions(df, "ts", F.lit("2026-01-25").cast("date"), 20).collect()
    assert sorted((r.date.isoformat(), r.n_rows) for r in out) == [("2026-01-01", 2), ("2026-01-02", 1)]
