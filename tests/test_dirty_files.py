"""Files that are not tidy: each gets its own verdict, none stops the others."""

import os
import random

import pyarrow as pa
import pyarrow.parquet as pq

from tidewater.functions import constants as K
from tidewater.operators.ingest import (IngestTables, ingest_landing, read_processed, recover_stuck_files)
from tidewater.streaming.ingest import run_ingest_stream


def put(root, name, body, folder="source=a/date=2026-05-17"):
    os.makedirs(f"{root}/{folder}", exist_ok=True)
    with open(f"{root}/{folder}/{name}", "wb") as f:
        f.write(body)


def dirty(root):
    put(root, "good.csv", b"id,name\n1,x\n")
    put(root, "latin.csv", "id,name\n1,caf\xe9\n".encode("latin-1"))
    put(root, "a[1].csv", b"id,v\n1,2\n2,3\n")
    put(root, "q{x}*.jsonl", b'{"id":1}\n')
    put(root, "upper.csv", b"ID,Name\n1,x\n")
    put(root, "case.jsonl", b'{"Id":1,"id":2}\n')
    put(root, "blank.csv", b"\nid,name\n1,x\n2,y\n")
    put(root, "newline.csv", b'"id","na\nme"\n1,x\n')
    put(root, "empty.csv", b"", "source=a/date=2026-01-05")
    put(root, "top.csv", b"id\n7\n", "")
    put(root, "deep.csv", b"id\n8\n9\n", "x/y/source=b/date=2026-05-18/z")
    table = pa.table({"id": list(range(200_000)), "r": [random.Random(i).random() for i in range(200_000)]})
    pq.write_table(table, "/tmp/tw-dirty.parquet", row_group_size=20_000)
    body = bytearray(open("/tmp/tw-dirty.parquet", "rb").read())
    put(root, "whole.parquet", bytes(body))
    at = int(len(body) * 0.7)
    body[at:at + 4000] = bytes(4000)
    put(root, "damaged.parquet", bytes(body))
    put(root, "cut.parquet", bytes(body[:len(body) // 2]))
    pq.write_table(pa.table({"b": [b"\xff\xfe", b"ok"]}), "/tmp/tw-dirty.parquet")
    put(root, "bytes.parquet", open("/tmp/tw-dirty.parquet", "rb").read())


WANT = {"good.csv": (K.DONE, 1), "latin.csv": (K.DONE, 1), "a[1].csv": (K.DONE, 2), "q{x}*.jsonl": (K.DONE, 1), "upper.csv": (K.DONE, 1),
        "case.jsonl": (K.DONE, 1), "blank.csv": (K.DONE, 2), "newline.csv": (K.DONE, 1), "empty.csv": (K.QUARANTINED, 0),
        "top.csv": (K.DONE, 1), "deep.csv": (K.DONE, 2), "whole.parquet": (K.DONE, 200_000), "damaged.parquet": (K.FAILED, None),
        "cut.parquet": (K.FAILED, None), "bytes.parquet": (K.DONE, 2)}


def verdicts(rows):
    return {r.path.rsplit("/", 1)[1]: (r.status, r.n_records if r.status != K.FAILED else None) for r in rows}


def test_batch(spark, tmp_root):
    land = f"{tmp_root}/landing"
    dirty(land)
    t = IngestTables(f"{tmp_root}/state")
    assert verdicts(ingest_landing(spark, land, t).collect()) == WANT
    out = read_processed(spark, t)
    assert {"ID", "Id", "id", "na\nme"} <= set(out.columns)
    by = {r["ingest_path"].rsplit("/", 1)[1]: r for r in out.where("ingest_path not like '%parquet'").collect()}
    assert (by["case.jsonl"]["Id"], by["case.jsonl"]["id"]) == ("1", "2") and by["latin.csv"]["name"] == "caf�"
    assert out.where("ingest_path like '%damaged%' or ingest_path like '%cut%'").count() == 0
    assert by["top.csv"]["id"] == "7" and by["deep.csv"]["ingest_source"] == "b"


def test_stream(spark, tmp_root):
    land = f"{tmp_root}/landing"
    dirty(land)
    t = IngestTables(f"{tmp_root}/state")
    run_ingest_stream(spark, land, t, f"{tmp_root}/ckpt", max_files_per_trigger=6)
    assert verdicts(spark.read.parquet(t.file_events).collect()) == WANT


def test_wide_file(spark, tmp_root):
    land = f"{tmp_root}/landing"
    put(land, "wide.jsonl", ("{" + ",".join(f'"k{i}":{i}' for i in range(1500)) + "}\n").encode())
    put(land, "good.csv", b"id\n1\n")
    t = IngestTables(f"{tmp_root}/state")
    assert verdicts(ingest_landing(spark, land, t).collect()) == {"wide.jsonl": (K.DONE, 1), "good.csv": (K.DONE, 1)}


def test_batches_never_share_an_id(spark, tmp_root):
    """Two calls, two streams and two recoveries on one state root keep all rows."""
    import datetime as dt

    from pyspark.sql import functions as F

    from tidewater.operators import manifest as M
    t = IngestTables(f"{tmp_root}/state")
    for n in range(2):
        put(f"{tmp_root}/batch{n}", "f.csv", f"id\nb{n}\n".encode())
        ingest_landing(spark, f"{tmp_root}/batch{n}", t)
        put(f"{tmp_root}/stream{n}", "f.csv", f"id\ns{n}\n".encode())
        run_ingest_stream(spark, f"{tmp_root}/stream{n}", t, f"{tmp_root}/ckpt{n}")
    old = dt.datetime(2026, 1, 1)
    man = M.ManifestTable(spark, t.manifest)
    for n in range(2):
        # the second one has been moved to the archive
        land, archive = f"{tmp_root}/stuck", f"{tmp_root}/archive"
        put(land if n == 0 else f"{archive}{land}", f"r{n}.csv", f"id\nr{n}\n".encode())
        import hashlib
        row = spark.createDataFrame([(hashlib.sha256(f"id\nr{n}\n".encode()).hexdigest(), f"file:{land}/source=a/date=2026-05-17/r{n}.csv", "a")],
                                    "content_hash string, path string, source string")
        man.append(M.log_rows(row, K.PROCESSING, F.lit(old).cast("timestamp"), 1, 5))
        got = recover_stuck_files(spark, land, t, now=old + dt.timedelta(hours=1), archive_dir=archive).collect()
        assert [(r.path.rsplit("/", 1)[1], r.status) for r in got] == [(f"r{n}.csv", K.DONE)]
    assert sorted(r.id for r in read_processed(spark, t).select("id").collect()) == ["b0", "b1", "r0", "r1", "s0", "s1"]
