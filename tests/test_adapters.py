import datetime as dt
import json
import os

import fixtures_landing as FX
from pyspark.sql import functions as F
from tidewater.functions import constants as K
from tidewater.operators import manifest as M
from tidewater.operators.ingest import IngestTables, read_processed
from tidewater.sources import landing as LD
from tidewater.streaming import adapters as AD

CSV = b"a,b\n1,2\n3,4\n"
DAY = "source=t/date=2026-05-17"


def _notice(key):
    return json.dumps({"Records": [{"s3": {"bucket": {"name": "landing"}, "object": {"key": key, "size": 1}}}]})


def _messages(spark, path, rows):
    schema = "source string, name string, body binary, received_at timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def _run(spark, root, land, notes, msgs, t):
    schema = "value string"
    streams = [AD.landing_adapter(spark, land),
               AD.notification_adapter(spark.readStream.schema(schema).parquet(notes), f"{root}/second"),
               AD.message_adapter(msgs, f"{root}/pushed")]
    AD.run_adapters(spark, streams, t, f"{root}/ckpt", [land])


def test_three_adapters(spark, tmp_root):
    at = dt.datetime(2026, 5, 17, 12)
    land, notes, pushed, t = f"{tmp_root}/landing", f"{tmp_root}/notes", f"{tmp_root}/messages", IngestTables(f"{tmp_root}/state")
    FX.write_cases(land, {"one.csv": (CSV, K.DONE, 2), "empty.csv": (b"", K.QUARANTINED, 0)})
    FX.write_cases(f"{tmp_root}/second", {"same.csv": (CSV, K.DONE, 2), "own.csv": (b"x\n7\n", K.DONE, 1), "unnamed.csv": (b"x\n8\n", K.DONE, 1)})
    spark.createDataFrame([(_notice(f"{DAY}/same.csv"),), (_notice(f"{DAY}/own.csv"),), (_notice(f"{DAY}/gone.csv"),)], "value string").write.parquet(notes)
    msgs = _messages(spark, pushed, [("app", "p.csv", CSV, at), ("app", "p.csv", b"x\n9\n", at), (None, None, b'{"x": "10"}\n', at),
                                     ("a/b", "../x y.csv", b"x\n11\n", at), ("app", "none.csv", None, at)])
    _run(spark, tmp_root, land, notes, msgs, t)
    cur = M.ManifestTable(spark, t.manifest).current().collect()
    done = [r for r in cur if r.status == K.DONE]
    # equal bytes from three adapters in one batch: one entry; the unnamed file stays out; all empty files are one hash
    assert len(done) == 5 and sum(r.status == K.QUARANTINED for r in cur) == 1 and len(cur) == 6
    out = read_processed(spark, t)
    assert sorted(r.x for r in out.collect() if r.x) == ["10", "11", "7", "9"] and out.count() == 6

    # equal bytes from other adapters in a later batch change nothing; only what is new comes in
    FX.write_cases(land, {"again.csv": (b"x\n7\n", K.DONE, 1)})
    spark.createDataFrame([(_notice(f"{DAY}/unnamed.csv"),)], "value string").write.mode("append").parquet(notes)
    msgs = _messages(spark, pushed, [("late", "q.csv", CSV, at)])
    _run(spark, tmp_root, land, notes, msgs, t)
    cur = M.ManifestTable(spark, t.manifest).current().collect()
    assert sum(r.status == K.DONE for r in cur) == 6 and len(cur) == 7
    assert sorted(r.x for r in read_processed(spark, t).collect() if r.x) == ["10", "11", "7", "8", "9"]


def test_payload_files(spark, tmp_root):
    rows = spark.createDataFrame([("s", "2026-05-17", "a.csv", b"1"), ("s", "2026-05-17", "a.csv", b"2"), ("s", "2026-05-17", "a.csv", b"1")],
                                 "source string, date string, name string, body binary")
    put = LD.write_payloads(rows, tmp_root).distinct().collect()
    assert len(put) == 2 and all(open(r.path, "rb").read() in (b"1", b"2") and r.length == 1 for r in put)
    assert not [n for _, _, files in os.walk(tmp_root) for n in files if n.startswith(".")]


def test_items_hold_no_file_bytes(spark, tmp_root):
    land = f"{tmp_root}/landing"
    FX.write_cases(land, {"one.csv": (CSV, K.DONE, 2)})
    q = AD.landing_adapter(spark, land).writeStream.format("memory").queryName("adapter_items").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("adapter_items").where(F.col("body").isNotNull()).count() == 0 and spark.table("adapter_items").count() == 1
