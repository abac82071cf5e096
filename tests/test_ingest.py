import os

import pytest
from pyspark.sql import functions as F

import fixtures_landing as FX
from tidewater.functions import constants as K
from tidewater.operators import manifest as M
from tidewater.operators.ingest import IngestTables, ingest_landing, quarantined_bytes, read_processed


def _by_name(rows):
    return {r.path.rsplit("/", 1)[1]: r for r in rows}


@pytest.fixture(scope="module")
def ingested(spark):
    import tempfile
    base = tempfile.mkdtemp(prefix="tw-ingest-")
    land = os.path.join(base, "landing")
    cases = dict(FX.CASES)
    cases.update(FX.parquet_cases())
    d = FX.write_cases(land, cases)
    open(os.path.join(d, "empty.csv"), "wb").close()
    cases["empty.csv"] = (b"", K.QUARANTINED, None)
    t = IngestTables(os.path.join(base, "state"))
    res = ingest_landing(spark, land, t, batch_id=1).collect()
    return spark, land, t, cases, res


def test_every_fixture_status(ingested):
    _spark, _land, _t, cases, res = ingested
    got = _by_name(res)
    assert set(got) == set(cases)
    for name, (_body, status, n) in cases.items():
        assert got[name].status == status, (name, got[name])
        if n is not None:
            assert got[name].n_records == n, name


def test_reasons(ingested):
    got = _by_name(ingested[4])
    assert got["upper.CSV"].reason == K.MSG_UNSUPPORTED
    assert got["empty.csv"].reason == K.MSG_EMPTY
    assert got["g.csv"].reason == "unsupported format: gzip"
    assert got["header_only.csv"].reason == K.MSG_NO_RECORDS
    assert got["zero_rows.parquet"].reason == K.MSG_NO_RECORDS


def test_processed_values(ingested):
    spark, _land, t, _cases, res = ingested
    p = read_processed(spark, t)
    name = F.regexp_extract("ingest_path", r"([^/]*)$", 1)
    rows = p.withColumn("f", name).collect()
    by = {}
    for r in rows:
        by.setdefault(r.f, []).append(r.asDict())
    assert sorted((r["id"], r["name"]) for r in by["ok.csv"]) == [("1", 'x "q" y'), ("2", "")]  # D16
    assert [r["a"] for r in by["dup.csv"]] == ["2"]                                              # last wins
    assert [(r["a"], r["b"]) for r in by["quoted_newline.csv"]] == [("x\ny", "2")]
    assert sorted((r["a"] or "", r["b"] or "") for r in by["ok.jsonl"]) == [
        ("1.5", '{"c":[1]}'), ("12345678901234567890", "")]
    assert sorted(r["a"] for r in by["many_per_line.json"]) == ["1", "2", "3"]
    assert sorted(str(r["a"]) for r in by["null_value.json"]) == ["1", "None"]
    assert sorted((str(r["id"]), str(r["z"])) for f in ("p1.parquet", "p2.parquet") for r in by[f]) == [
        ("1", "None"), ("2", "None"), ("x", "1.5")]                                             # D27
    assert by["o k+é%.csv"][0]["a"] == "odd"                                                    # D19 names
    # failed files leave no rows behind
    assert "short.csv" not in by and "bad.jsonl" not in by


def test_manifest_and_topic(ingested):
    spark, _land, t, cases, _res = ingested
    cur = {r.path.rsplit("/", 1)[1]: r for r in M.ManifestTable(spark, t.manifest).current().collect()}
    assert {k: v.status for k, v in cur.items()} == {k: v[1] for k, v in cases.items()}
    assert all(v.processed_at is not None for v in cur.values())
    topic = spark.read.parquet(t.topic).collect()
    done = sorted(k for k, v in cases.items() if v[1] == K.DONE)
    assert len(topic) == len(done)
    q = spark.read.parquet(t.quarantine).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in q) == ["empty.csv", "upper.CSV"]
    assert [r.content for r in q if r.path.endswith("upper.CSV")] == [bytearray(b"a\n1\n")]


def test_second_batch_skips_everything(ingested):
    spark, land, t, _cases, _res = ingested
    before = read_processed(spark, t).count()
    res2 = ingest_landing(spark, land, t, batch_id=2).collect()
    assert {r.status for r in res2} == {"skipped"}
    assert read_processed(spark, t).count() == before
    assert spark.read.parquet(t.topic).count() == sum(1 for v in ingested[3].values() if v[1] == K.DONE)


def test_replaying_a_batch_does_not_duplicate(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {k: FX.CASES[k] for k in ("ok.csv", "sparse.jsonl")})
    t = IngestTables(os.path.join(tmp_root, "state"))
    ingest_landing(spark, land, t, batch_id=7).collect()
    n1 = read_processed(spark, t).count()
    # same batch id again (a replay after a crash before the checkpoint commit)
    res = ingest_landing(spark, land, t, batch_id=7).collect()
    assert {r.status for r in res} == {K.DONE}
    assert read_processed(spark, t).count() == n1 == 4
    assert spark.read.parquet(t.topic).count() == 2


def test_empty_bin_reports_format_first(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    d = FX.write_cases(land, {})
    open(os.path.join(d, "empty.bin"), "wb").close()
    t = IngestTables(os.path.join(tmp_root, "state"))
    res = ingest_landing(spark, land, t, batch_id=1).collect()
    assert [(r.status, r.reason) for r in res] == [(K.QUARANTINED, K.MSG_UNSUPPORTED)]     # D07


def test_same_bytes_two_paths(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {"a.csv": FX.CASES["ok.csv"], "b.csv": FX.CASES["ok.csv"]})
    t = IngestTables(os.path.join(tmp_root, "state"))
    res = _by_name(ingest_landing(spark, land, t, batch_id=1).collect())
    assert res["a.csv"].status == K.DONE and res["b.csv"].status == "skipped"


def test_per_file_csv_path_matches_native(spark, tmp_root, monkeypatch):
    """With every CSV sent to the per-file parser, the outcomes are the same."""
    from tidewater.sources import readers as R
    monkeypatch.setattr(R, "native_csv", lambda head: False)
    names = ("ok.csv", "quoted_newline.csv", "short.csv", "long.csv", "header_only.csv", "dup.csv",
             "bare_quote.csv", "after_quote.csv")
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {k: FX.CASES[k] for k in names})
    t = IngestTables(os.path.join(tmp_root, "state"))
    got = _by_name(ingest_landing(spark, land, t, batch_id=1).collect())
    for k in names:
        assert got[k].status == FX.CASES[k][1], (k, got[k])
        if FX.CASES[k][2] is not None:
            assert got[k].n_records == FX.CASES[k][2]
    rows = {r.ingest_path.rsplit("/", 1)[1]: r for r in read_processed(spark, t).collect()
            if r.ingest_path.endswith("dup.csv")}
    assert rows["dup.csv"]["a"] == "2"


def test_push_then_notification_ingest(spark, tmp_root):
    import datetime as dt
    from tidewater.operators.ingest import ingest_notifications
    from tidewater.sources import landing as LD
    from tidewater.sources import notifications as NT
    land = os.path.join(tmp_root, "landing")
    when = dt.datetime(2026, 5, 17, 12, 0, 0)
    p1 = LD.put_payload(spark, land, "crm", b"a,b\n1,2\n", "orders.csv", when)
    p2 = LD.put_payload(spark, land, "crm", b'{"x":1}\n', None, when)
    assert p1.endswith("source=crm/date=2026-05-17/orders.csv") and p2.endswith(".json")
    d = os.path.join(land, "source=crm", "date=2026-05-17")
    with open(os.path.join(d, "_hidden.csv"), "wb") as f:
        f.write(b"a\n1\n")
    keys = ["source=crm/date=2026-05-17/orders.csv", "source=crm/date=2026-05-17/" + p2.rsplit("/", 1)[1],
            "source=crm/date=2026-05-17/_hidden.csv", "source=crm/date=2026-05-17/missing.csv"]
    msgs = spark.createDataFrame([(k,) for k in keys], "k string").select(
        NT.encode(F.lit("landing"), F.col("k"), F.lit(1).cast("bigint"), F.lit("e")).alias("value"))
    t = IngestTables(os.path.join(tmp_root, "state"))
    res = _by_name(ingest_notifications(spark, msgs, land, t, batch_id=1).collect())
    assert {k: r.status for k, r in res.items()} == {"orders.csv": K.DONE, p2.rsplit("/", 1)[1]: K.DONE}
    cur = {r.path.rsplit("/", 1)[1]: (r.status, r.reason) for r in M.ManifestTable(spark, t.manifest).current().collect()}
    assert cur["_hidden.csv"] == (K.FAILED, K.MSG_HIDDEN)
    assert "missing.csv" not in cur
    import pytest
    with pytest.raises(ValueError):
        LD.landing_key("s", ".dot.csv")


def test_same_stem_two_formats_d12(spark, tmp_root):
    """A.csv and a.json share one processed key in the reference and
    overwrite each other; here both keep their rows (hash column)."""
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {"a.csv": (b"x\n1\n", K.DONE, 1), "a.json": (b'{"x":"2"}\n', K.DONE, 1)})
    t = IngestTables(os.path.join(tmp_root, "state"))
    res = ingest_landing(spark, land, t, batch_id=1).collect()
    assert {r.status for r in res} == {K.DONE}
    assert len({r.processed_key for r in res}) == 1                   # same name, as in the reference
    assert sorted(r.x for r in read_processed(spark, t).collect()) == ["1", "2"]


def test_source_defaults_to_ingress_d04(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    os.makedirs(os.path.join(land, "flat"))
    with open(os.path.join(land, "flat", "f.csv"), "wb") as f:
        f.write(b"q\n1\n")
    from tidewater.sources import landing as LD
    rows = LD.read_landing(spark, os.path.join(land, "flat")).collect()
    assert [(r.source, r.date, r.key) for r in rows] == [(K.INGRESS, None, "f.csv")]


def test_oversize_files_by_ranges(spark, tmp_root):
    """Files over the limit (64 bytes here; the real one is 500 MiB) have their real hash, and
    their bytes are kept in ranges; equal files give one manifest row."""
    import hashlib
    land = os.path.join(tmp_root, "landing")
    big, odd = b"a\n" + b"1\n" * 100, bytes(range(256)) * 3
    FX.write_cases(land, {"big.csv": (big, K.QUARANTINED, None), "copy of %big+.csv": (big, K.QUARANTINED, None),
                          "odd.bin": (odd, K.QUARANTINED, None), "small.csv": (b"a\n1\n", K.DONE, 1),
                          "tiny.bin": (b"x", K.QUARANTINED, None), "p.csv": (b"PAR1" + b"0" * 100, K.QUARANTINED, None)})
    t = IngestTables(os.path.join(tmp_root, "state"))
    got = _by_name(ingest_landing(spark, land, t, batch_id=1, max_bytes=64, range_bytes=50).collect())
    assert got["small.csv"].status == K.DONE
    assert sorted((got["big.csv"].status, got["copy of %big+.csv"].status)) == [K.QUARANTINED, "skipped"]
    assert got["odd.bin"].reason == K.MSG_UNSUPPORTED
    assert got["p.csv"].reason == "file size exceeds maximum limit of 64 bytes"
    assert got["big.csv"].content_hash == got["copy of %big+.csv"].content_hash == hashlib.sha256(big).hexdigest()
    cur = M.ManifestTable(spark, t.manifest).current().where(F.col("content_hash") == hashlib.sha256(big).hexdigest())
    assert [r.status for r in cur.collect()] == [K.QUARANTINED]
    rows = quarantined_bytes(spark, t).collect()
    assert max(len(r.content) for r in rows) <= 64
    joined = {}
    for r in sorted(rows, key=lambda r: r.seq):
        assert r.at == 50 * r.seq
        joined[r.content_hash] = joined.get(r.content_hash, b"") + bytes(r.content)
    assert joined == {hashlib.sha256(x).hexdigest(): x for x in (big, odd, b"x", b"PAR1" + b"0" * 100)}
    # a second run over the same landing area adds nothing
    again = _by_name(ingest_landing(spark, land, t, batch_id=2, max_bytes=64, range_bytes=50).collect())
    assert {r.status for r in again.values()} == {"skipped"}
    assert quarantined_bytes(spark, t).count() == len(rows)


def test_hash_files_skips_missing_and_fails_on_errors(spark, tmp_root):
    from tidewater.sources import ranges
    p = os.path.join(tmp_root, "f.bin")
    with open(p, "wb") as f:
        f.write(b"abc" * 1000)
    ids = spark.createDataFrame([(f"file:{p}",), (f"file:{tmp_root}/gone",)], "file_id string")
    assert [(r.file_id, r.n_bytes, bytes(r.head)) for r in ranges.hash_files(ids, 7).collect()] == [(f"file:{p}", 3000, b"abca")]
    with pytest.raises(Exception, match="IsADirectory"):
        ranges.hash_files(spark.createDataFrame([(f"file:{tmp_root}",)], "file_id string")).collect()


def test_processed_file_view(ingested):
    import hashlib
    from tidewater.operators.ingest import processed_file
    spark, _land, t, _cases, res = ingested
    dup = processed_file(spark, t, content_hash=hashlib.sha256(FX.CASES["dup.csv"][0]).hexdigest())
    assert [c for c in dup.columns if not c.startswith("ingest_")] == ["a"]
    assert [r.a for r in dup.collect()] == ["2"]
    key = _by_name(res)["quoted_newline.csv"].processed_key
    qn = processed_file(spark, t, processed_key=key)
    assert sorted(c for c in qn.columns if not c.startswith("ingest_")) == ["a", "b"]
    assert [(r.a, r.b) for r in qn.collect()] == [("x\ny", "2")]


def test_record_key_colliding_with_table_column(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {"c.jsonl": (b'{"ingest_hash":"mine","x":"1"}\n', K.DONE, 1)})
    t = IngestTables(os.path.join(tmp_root, "state"))
    ingest_landing(spark, land, t, batch_id=1).collect()
    r = read_processed(spark, t).first()
    assert r["ingest_hash__data"] == "mine" and r["x"] == "1" and len(r["ingest_hash"]) == 64


def test_multi_part_file(spark, tmp_root, monkeypatch):
    """A21/A22 end to end with tiny part sizes: a 2-row file becomes 2 parts,
    a parts manifest is written and its key is the published processed key."""
    monkeypatch.setattr(K, "PART_TARGET_BYTES", 4)
    monkeypatch.setattr(K, "PART_MAX_BYTES", 8)
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {"two.csv": (b"col\nfirst\nsecond\n", K.DONE, 2)})
    t = IngestTables(os.path.join(tmp_root, "state"))
    res = ingest_landing(spark, land, t, batch_id=1).collect()
    assert res[0].processed_key == "source=t/date=2026-05-17/two.manifest.json"
    man = spark.read.json(t.parts).collect()
    assert [(m.base_key, m.parts, m.record_count) for m in man] == [(
        "source=t/date=2026-05-17/two.parquet",
        ["source=t/date=2026-05-17/two.part-00001.parquet", "source=t/date=2026-05-17/two.part-00002.parquet"],
        2)]
    files = read_processed(spark, t).select(F.input_file_name()).distinct().count()
    assert files >= 2                 # maxRecordsPerFile = rows per part


def test_ingest_selected_dates(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {"a.csv": (b"a\n1\n", K.DONE, 1)}, date="2026-05-16")
    FX.write_cases(land, {"b.csv": (b"b\n2\n", K.DONE, 1)}, date="2026-05-17")
    t = IngestTables(os.path.join(tmp_root, "state"))
    res = ingest_landing(spark, land, t, batch_id=1, dates=["2026-05-17"]).collect()
    assert [r.path.rsplit("/", 1)[1] for r in res] == ["b.csv"]


def test_ingest_dates_without_folders(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, {"a.csv": (b"a\n1\n", K.DONE, 1)}, date="2026-05-16")
    t = IngestTables(os.path.join(tmp_root, "state"))
    assert ingest_landing(spark, land, t, batch_id=1, dates=["2030-01-01"]).collect() == []
