import datetime as dt
import os

from pyspark.sql import functions as F

from tidewater.streaming import topics as TP


def test_publish_decode_consume(spark, tmp_root):
    T = dt.datetime(2026, 5, 17, 1, 0, 0)
    done = spark.createDataFrame(
        [("s3://landing/source=a/date=d/x.csv", "source=a/date=d/x.csv", "h1", "csv", 10, T, "k1"),
         ("s3://landing/source=a/date=d/y.csv", "source=a/date=d/y.csv", "", "csv", 3, T, "k2")],
        "path string, key string, content_hash string, format string, length bigint, "
        "received_at timestamp, processed_key string")
    msgs = TP.event_json(done, "processed", F.lit(T).cast("timestamp"))
    rows = msgs.collect()
    assert [r.key for r in rows] == ["h1", "k2"]      # empty hash → processed key
    d = TP.decode_events(msgs).collect()
    assert d[0].e.metadata == {"bucket": "landing", "key": "source=a/date=d/x.csv"}
    assert d[0].e.size == 10 and d[0].e.processed_at == T
    topic = os.path.join(tmp_root, "topic")
    (msgs.withColumn("batch_id", F.lit(1).cast("bigint"))
     .unionByName(msgs.withColumn("batch_id", F.lit(2).cast("bigint")))   # redelivery
     .unionByName(spark.createDataFrame([("bad", "{oops", T, 0, 3, "2026-05-17")], TP.TOPIC_SCHEMA),
                  allowMissingColumns=True)
     .write.parquet(topic))
    out, dl = os.path.join(tmp_root, "out"), os.path.join(tmp_root, "dl")
    TP.consume(spark, topic, out, dl, os.path.join(tmp_root, "ck"))
    assert sorted(r.key for r in spark.read.parquet(out).collect()) == ["h1", "k2"]
    assert [r.value for r in spark.read.parquet(dl).collect()] == ["{oops"]
    # running again adds nothing (offsets are in the checkpoint)
    TP.consume(spark, topic, out, dl, os.path.join(tmp_root, "ck"))
    assert spark.read.parquet(out).count() == 2


def test_one_effect_after_crash_and_redelivery(spark, tmp_root, monkeypatch):
    """A crash after the write, the same message in later batches and a very late one: one effect
    per key, the earliest delivery of a batch; what was written is never read."""
    import json

    import pytest
    topic, out, dl, ck = (os.path.join(tmp_root, x) for x in ("topic", "out", "dl", "ck"))

    def deliver(*rows):
        msgs = [(k, json.dumps({"source": "s3", "path": p, "content_hash": k, "format": "csv"}) if p else "junk", t) for k, p, t in rows]
        (spark.createDataFrame(msgs, "key string, value string, timestamp timestamp").withColumn("partition", F.lit(0))
         .write.mode("append").parquet(topic))

    t0 = dt.datetime(2026, 5, 17)
    deliver(("a", "later", t0 + dt.timedelta(hours=1)), ("a", "first", t0), ("b", "b", t0), ("x", None, t0))
    write, calls = TP._replace_batch, []

    def crash(df, path):
        write(df, path)
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")
    monkeypatch.setattr(TP, "_replace_batch", crash)
    with pytest.raises(Exception, match="lost"):
        TP.consume(spark, topic, out, dl, ck)
    q = TP.consume(spark, topic, out, dl, ck)
    assert q.lastProgress.stateOperators[0].numRowsTotal >= 2
    deliver(("a", "again", t0 + dt.timedelta(days=2)), ("c", "old", t0 - dt.timedelta(days=400)), ("x", None, t0))
    TP.consume(spark, topic, out, dl, ck)
    deliver(("c", "old", t0), ("b", "b", t0))
    TP.consume(spark, topic, out, dl, ck)
    assert sorted((r.key, r.path) for r in TP.read_consumed(spark, out).collect()) == [("a", "first"), ("b", "b"), ("c", "old")]
    assert spark.read.parquet(dl).count() == 2


def test_publish_again_adds_nothing(spark, tmp_root):
    from types import SimpleNamespace
    t = SimpleNamespace(topic=os.path.join(tmp_root, "topic"), processed_bucket="processed")
    at = [dt.datetime(2026, 1, 1, 23, 59), dt.datetime(2026, 1, 2)]
    for n, when in zip((1, 3), at):          # the first run lost part of the batch
        done = spark.createDataFrame([(f"s3://l/k{i}", f"k{i}", f"h{i}", "csv", 1, when, f"p{i}") for i in range(n)],
                                     "path string, key string, content_hash string, format string, "
                                     "length bigint, received_at timestamp, processed_key string")
        TP.publish(spark, done, t, 5, F.lit(when).cast("timestamp"))
    assert sorted(r.key for r in spark.read.schema(TP.TOPIC_SCHEMA).parquet(t.topic).collect()) == ["h0", "h1", "h2"]


def test_topic_retention(spark, tmp_root):
    from types import SimpleNamespace
    topic = os.path.join(tmp_root, "topic")
    t = SimpleNamespace(topic=topic, processed_bucket="processed")
    days = [dt.datetime(2026, 1, 1), dt.datetime(2026, 3, 1), dt.datetime(2026, 3, 30)]
    for i, d in enumerate(days):
        done = spark.createDataFrame([(f"s3://l/k{i}", f"k{i}", f"h{i}", "csv", 1, d, f"p{i}")],
                                     "path string, key string, content_hash string, format string, "
                                     "length bigint, received_at timestamp, processed_key string")
        TP.publish(spark, done, t, i, F.lit(d).cast("timestamp"))
    now_ms = int(dt.datetime(2026, 4, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    gone = TP.expire_topic(spark, topic, "files.processed", now_ms)       # keeps 30 days
    assert sorted(gone) == ["day=2026-01-01", "day=2026-03-01"]
    assert [r.key for r in spark.read.schema(TP.TOPIC_SCHEMA).parquet(topic).collect()] == ["h2"]


def test_kafka_sink_needs_connector(spark):
    import pytest
    msgs = spark.createDataFrame([("k", "v", dt.datetime(2026, 5, 17))], "key string, value string, timestamp timestamp")
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        TP.publish_kafka(msgs, "localhost:9092")
