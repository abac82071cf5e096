"""Object-store event notifications → (bucket, key) records.

A message whose JSON does not decode is rejected as a whole; inside a good
message, a record whose key does not URL-decode is skipped (D: logged and
skipped by the reference). Keys use form decoding: ``+`` is a space.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOTIFICATION_SCHEMA = (
    "Records array<struct<s3:struct<bucket:struct<name:string>,"
    "object:struct<key:string,size:bigint,eTag:string>>>>"
)


def decode(messages: DataFrame, value_col: str = "value",
           keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Returns (records, rejected_messages).

    records: keep…, record_index, bucket, key, size, etag, path (``s3://bucket/key``)
    """
    parsed = messages.select(*keep, F.col(value_col).alias("_value"),
                             F.from_json(F.col(value_col), NOTIFICATION_SCHEMA).alias("_n"))
    # a message is accepted when it parses to a JSON object (Records may be absent)
    ok = F.col("_n").isNotNull() & F.trim(F.col("_value")).startswith("{")
    rejected = parsed.where(~ok | F.col("_n").isNull()).select(*keep, F.col("_value").alias(value_col))
    recs = (parsed.where(ok)
            .select(*keep, F.posexplode("_n.Records").alias("record_index", "r")))
    key = F.try_url_decode(F.col("r.s3.object.key"))
    out = recs.select(
        *keep,
        "record_index",
        F.col("r.s3.bucket.name").alias("bucket"),
        key.alias("key"),
        F.col("r.s3.object.size").alias("size"),
        F.col("r.s3.object.eTag").alias("etag"),
    ).where(F.col("key").isNotNull())
    return out.withColumn("path", F.format_string("s3://%s/%s", F.col("bucket"), F.col("key"))), rejected


def encode(bucket, key, size, etag):
    """Build one notification JSON document (one record) from columns."""
    rec = F.struct(F.struct(
        F.struct(bucket.alias("name")).alias("bucket"),
        F.struct(F.url_encode(key).alias("key"), size.alias("size"), etag.alias("eTag")).alias("object"),
    ).alias("s3"))
    return F.to_json(F.struct(F.array(rec).alias("Records")))
