import hashlib

from pyspark.sql import functions as F

from tidewater.functions import classify as C
from tidewater.functions import naming as N
from tidewater.functions import constants as K


def _one(spark, exprs, rows, schema):
    return spark.createDataFrame(rows, schema).select(*exprs).collect()


def test_detect_format_magic_then_extension(spark):
    rows = [
        ("a/b.csv", b"PAR1xxxx", "parquet"),        # magic beats extension
        ("a/b.json", b"\x1f\x8bzz", "gzip"),
        ("a/b.csv", b"x", "csv"),
        ("a/b.json", b"x", "ndjson"),
        ("a/b.ndjson", b"x", "ndjson"),
        ("a/b.jsonl", b"x", "ndjson"),
        ("a/b.parquet", b"x", "parquet"),
        ("a/b.CSV", b"x", "unknown"),               # case-sensitive
        ("a/b.txt", b"x", "unknown"),
        ("a.csv/b", b"x", "unknown"),               # last dot of the whole key
        ("noext", b"x", "unknown"),
        ("a/b.csv", b"PA", "csv"),                  # too short for magic
    ]
    out = _one(spark, [C.detect_format("k", "c").alias("f")], [(k, c) for k, c, _ in rows],
               "k string, c binary")
    assert [r.f for r in out] == [e for *_, e in rows]


def test_validation_order_and_limits(spark):
    rows = [
        ("unknown", 0, "h", None, K.MSG_UNSUPPORTED),   # D07: format checked before emptiness
        ("csv", 0, "h", None, K.MSG_EMPTY),
        ("csv", 524_288_000, "h", None, None),          # exactly 500 MiB is fine
        ("csv", 524_288_001, "h", None, K.MSG_TOO_BIG),
        ("csv", 10, "h", "h", None),
        ("csv", 10, "h", "x", "content hash mismatch: expected x, got h"),
    ]
    df = spark.createDataFrame([r[:4] for r in rows], "f string, n bigint, h string, e string")
    out = df.select(C.validation_reason("f", "n", "h", "e").alias("r")).collect()
    assert [r.r for r in out] == [r[4] for r in rows]


def test_sha256_matches_hashlib(spark):
    bodies = [b"", b"abc", "é\n".encode(), bytes(range(256))]
    out = spark.createDataFrame([(b,) for b in bodies], "c binary").select(
        C.content_hash("c").alias("h")).collect()
    assert [r.h for r in out] == [hashlib.sha256(b).hexdigest() for b in bodies]


def test_source_date_from_key(spark):
    rows = [("s3://landing/source=crm/date=2026-05-17/orders.csv", "crm", "2026-05-17"),
            ("s3://landing/x/orders.csv", K.INGRESS, None),
            ("file:/l/source=01/date=2026-01-02/a.json", "01", "2026-01-02")]
    out = spark.createDataFrame([(r[0],) for r in rows], "p string").select(
        C.source_from_key("p").alias("s"), C.date_from_key("p").alias("d")).collect()
    assert [(r.s, r.d) for r in out] == [(s, d) for _, s, d in rows]


def test_hidden_names(spark):
    out = spark.createDataFrame([("a/_h.csv",), ("a/.d.csv",), ("a/ok.csv",)], "p string").select(
        C.is_hidden_name("p").alias("h")).collect()
    assert [r.h for r in out] == [True, True, False]


def test_part_sizing_fixture_cases(spark):
    cases = [(0, 10, 10), (1000, 0, 0), (1000, 10, 2_013_265), (5, 10, 201_326_592),
             (2_000_000_000, 2, 1)]
    out = spark.createDataFrame([(b, n) for b, n, _ in cases], "b bigint, n bigint").select(
        N.records_per_chunk("b", "n").alias("r")).collect()
    assert [r.r for r in out] == [e for *_, e in cases]
    assert [N.records_per_chunk_py(b, n) for b, n, _ in cases] == [e for *_, e in cases]


def test_part_names(spark):
    df = spark.createDataFrame([("source=t/date=2026-05-17/x.csv", 3), ("/a/b.json", 1)],
                               "k string, n int")
    out = df.select(N.base_key("k").alias("b")).select(
        "b", N.part_keys("b", F.lit(3)).alias("p3"), N.processed_key("b", F.lit(3)).alias("m"),
        N.processed_key("b", F.lit(1)).alias("one")).collect()
    assert out[0].b == "source=t/date=2026-05-17/x.parquet"
    assert out[0].p3 == ["source=t/date=2026-05-17/x.part-00001.parquet",
                         "source=t/date=2026-05-17/x.part-00002.parquet",
                         "source=t/date=2026-05-17/x.part-00003.parquet"]
    assert out[0].m == "source=t/date=2026-05-17/x.manifest.json"
    assert out[0].one == out[0].b
    assert out[1].b == "a/b.parquet"


def test_part_count(spark):
    out = spark.createDataFrame([(10, 3), (9, 3), (0, 3), (5, 0)], "n bigint, c bigint").select(
        N.part_count("n", "c").alias("p")).collect()
    assert [r.p for r in out] == [4, 3, 0, 1]
