"""Labelled rows to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, mod ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def labelled_sample(labels: DataFrame, label: str, held_out: Column, most: int, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label) of about ``most`` rows at most that are not held out,
    chosen by a hash of doc_id. Of several labels for an id the largest
    counts; null labels and ids do not."""
    known = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out)
             .groupBy(F.col(doc_id).alias("sample_id")).agg(F.max(F.col(label).cast("int")).alias("sample_label")))
    have = known.count()
    if have <= most:
        return known
    # a second hash, so that the choice is independent of the split
    return known.where(F.pmod(F.xxhash64("sample_id", F.lit("sample")), F.lit(1 << 30)) < int(most / have * (1 << 30)))


def lessons(docs: DataFrame, chosen: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(text, sample_label): one row for each id of ``chosen`` (a
    ``labelled_sample``) that ``docs`` has, however many rows hold it: the one
    whose text has the smallest hash, a null text only if there is no other."""
    body = docs.select(F.col(f"`{doc_id}`").alias("sample_id"), F.col(f"`{text}`").alias("text"))
    # ``chosen`` has a bounded number of rows
    found = body.join(F.broadcast(chosen), "sample_id")
    least = F.min(F.struct(F.col("text").isNull().alias("absent"), F.md5("text").alias("hash"), "text"))
    return found.groupBy("sample_id", "sample_label").agg(least.alias("least")).select("least.text", "sample_label")
