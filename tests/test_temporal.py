"""Skew-safe window operators against brute force, on a hot-key fixture
(one key holds a third of all rows)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import serving as SV
from tidewater.operators import temporal as TM

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        user = 0 if i % 3 == 0 else rng.randrange(1, 20)      # user 0 is hot
        ts = T0 + dt.timedelta(seconds=rng.randrange(0, 10 * 86400))
        rows.append((i, user, ts, rng.choice(["view", "purchase", "click"]), round(rng.uniform(0, 100), 2)))
    return rows, spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, event_type string, value double")


def _by_user(rows):
    d = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        d.setdefault(r[1], []).append(r)
    return d


def test_days_since(events):
    rows, df = events
    out = {r.event_id: (r.days_since_prev, r.days_since_event) for r in
           TM.days_since(df, "user_id", "ts", "event_id", "event_type", "purchase", bucket_seconds=3600).collect()}
    for seq in _by_user(rows).values():
        last_p = None
        for j, r in enumerate(seq):
            prev = seq[j - 1][2] if j else None
            exp_prev = int((r[2] - prev).total_seconds() // 86400) if prev else None
            exp_ev = int((r[2] - last_p).total_seconds() // 86400) if last_p else None
            assert out[r[0]] == (exp_prev, exp_ev)
            if r[3] == "purchase":
                last_p = r[2]


def test_rolling_rows(events):
    rows, df = events
    chunk = F.floor(F.unix_seconds("ts") / 7200)
    out = {r.event_id: (r.last5_count, r.last5_sum) for r in
           TM.rolling_rows(df, "user_id", ["ts", "event_id"], "value", 5, chunk).collect()}
    for seq in _by_user(rows).values():
        for j, r in enumerate(seq):
            win = seq[max(0, j - 4): j + 1]
            c, s = out[r[0]]
            assert c == len(win) and s == pytest.approx(sum(x[4] for x in win))


@pytest.mark.parametrize("k", [1, 3])
def test_rolling_range(events, k):
    rows, df = events
    out = {r.event_id: (r.range3600_count, r.range3600_sum) for r in
           TM.rolling_range(df, "user_id", "ts", "value", 3600, sub_buckets=k).collect()}
    for seq in _by_user(rows).values():
        for r in seq:
            win = [x for x in seq if r[2] - dt.timedelta(seconds=3600) <= x[2] <= r[2]]
            c, s = out[r[0]]
            assert c == len(win) and s == pytest.approx(sum(x[4] for x in win))


@pytest.mark.parametrize("k", [1, 4, 7])
def test_asof_features(events, k):
    rows, df = events
    lab = df.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    fea = df.where("event_type = 'view'").select("event_id", "user_id", "ts", F.col("value").alias("v"))
    out = {r.event_id: (r.feature_event_id, r.v) for r in
           SV.asof_features(lab, fea, "user_id", "ts", "ts", 6 * 3600, ["v"], "event_id",
                            sub_buckets=k).collect()}
    for seq in _by_user(rows).values():
        for r in seq:
            if r[3] != "purchase":
                continue
            cands = [x for x in seq if x[3] == "view" and x[2] <= r[2]
                     and x[2] >= r[2] - dt.timedelta(hours=6)]
            best = max(cands, key=lambda x: (x[2], x[0])) if cands else None
            assert out[r[0]] == ((best[0], best[4]) if best else (None, None))


def test_latest_per_entity(events):
    rows, df = events
    as_of = T0 + dt.timedelta(days=5)
    out = {r.user_id: r.event_id for r in
           SV.latest_per_entity(df, "user_id", "ts", "event_id", F.lit(as_of), 86400).collect()}
    exp = {}
    for u, seq in _by_user(rows).items():
        live = [x for x in seq if as_of - dt.timedelta(days=1) < x[2] <= as_of]
        if live:
            exp[u] = live[-1][0]
    assert out == exp


def test_temporal_parts_iso_weekday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 13),), (dt.datetime(2024, 1, 7, 0),)], "ts timestamp")
    out = df.select(*TM.temporal_parts("ts")).collect()
    assert [(r.hour, r.iso_weekday) for r in out] == [(13, 1), (0, 7)]
