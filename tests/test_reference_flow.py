"""The reference's end-to-end scenario, on our components: a unique CSV
payload is put under source=integration/date=<UTC day>/sample.csv, a
notification names it, the manifest ends ``done`` with the payload's
SHA-256 and the processed object key is …/sample.parquet."""

import datetime as dt
import hashlib
import os
import time

from pyspark.sql import functions as F

from tidewater.functions import constants as K
from tidewater.operators import manifest as M
from tidewater.operators.ingest import IngestTables, ingest_landing, ingest_notifications, read_processed
from tidewater.sources import landing as LD
from tidewater.sources import notifications as NT

# the reference's sample fixture: id,name,score,category with 5 rows
SAMPLE = b"id,name,score,category\n1,alice,42,a\n2,bob,7,b\n3,carol,99,a\n4,dave,55,c\n5,erin,81,b\n"


def test_upload_file_end_to_end(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    now = dt.datetime.now(dt.timezone.utc)
    payload = f"name,score\nalice,{time.time_ns()}\n".encode()
    LD.put_payload(spark, land, "integration", payload, "sample.csv", now)
    key = f"source=integration/date={now:%Y-%m-%d}/sample.csv"
    msg = spark.createDataFrame([(key,)], "k string").select(
        NT.encode(F.lit("landing"), F.col("k"), F.lit(len(payload)).cast("bigint"), F.lit("ignored")).alias("value"))
    t = IngestTables(os.path.join(tmp_root, "state"))
    res = ingest_notifications(spark, msg, land, t, batch_id=1).collect()
    assert [(r.status, r.content_hash) for r in res] == [(K.DONE, hashlib.sha256(payload).hexdigest())]
    cur = M.ManifestTable(spark, t.manifest).current().collect()
    assert [(r.status, r.content_hash) for r in cur] == [(K.DONE, hashlib.sha256(payload).hexdigest())]
    assert res[0].processed_key == f"source=integration/date={now:%Y-%m-%d}/sample.parquet"
    assert read_processed(spark, t).count() == 1


def test_sample_fixture_rows(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    LD.put_payload(spark, land, "crm", SAMPLE, "sample.csv", dt.datetime(2026, 5, 17))
    t = IngestTables(os.path.join(tmp_root, "state"))
    res = ingest_landing(spark, land, t, batch_id=1).collect()
    assert [(r.status, r.n_records) for r in res] == [(K.DONE, 5)]
    rows = sorted((r.id, r.name, r.score, r.category) for r in read_processed(spark, t).collect())
    assert rows == [("1", "alice", "42", "a"), ("2", "bob", "7", "b"), ("3", "carol", "99", "a"),
                    ("4", "dave", "55", "c"), ("5", "erin", "81", "b")]
    p = read_processed(spark, t)
    assert all(f.dataType.typeName() == "string" for f in p.schema.fields if f.name in ("id", "score"))
