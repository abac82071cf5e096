from pyspark.sql import functions as F

from tidewater.sources import notifications as NT


def test_decode_keys_and_rejects(spark):
    good = ('{"Records":[{"s3":{"bucket":{"name":"landing"},"object":{"key":"source%3Da/x+y.csv",'
            '"size":3,"eTag":"e"}}},{"s3":{"bucket":{"name":"landing"},"object":{"key":"bad%zzkey"}}}]}')
    rows = [(1, good), (2, "not json"), (3, '{"Records":[]}'), (4, '[1,2]')]
    msgs = spark.createDataFrame(rows, "id int, value string")
    recs, rejected = NT.decode(msgs, keep=("id",))
    r = recs.collect()
    assert [(x.id, x.bucket, x.key, x.size, x.path) for x in r] == [
        (1, "landing", "source=a/x y.csv", 3, "s3://landing/source=a/x y.csv")]
    assert sorted(x.id for x in rejected.collect()) == [2, 4]


def test_encode_roundtrip(spark):
    df = spark.createDataFrame([("b", "source=s/date=d/a b+c%.csv", 5, "t")], "b string, k string, s bigint, e string")
    msgs = df.select(NT.encode(F.col("b"), F.col("k"), F.col("s"), F.col("e")).alias("value"))
    recs, _ = NT.decode(msgs)
    assert recs.first().key == "source=s/date=d/a b+c%.csv"
