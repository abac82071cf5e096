"""Manifest history for the virtual files of the query catalog (test data).

The manifest queries (current, lookup, stuck, top-k, recovery, metrics) need
a log holding every status, in-flight and stuck files included. ``replayed_log``
writes the transitions pending → processing → outcome for the documents
table seen as landed files (SURVEY §2.5). The first-by-hash choice, the
validation verdict (→ quarantined) and the missing-parser verdict
(→ failed) come from the real operators. The outcome of the files that
passed is assigned from ``doc_id``: the documents' prose is not CSV or
JSON, so real parses would all fail and leave no done, stuck or pending
files to query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import constants as K
from . import manifest as M

# Our scenario: outcome of a validated, parseable virtual file by doc_id % 4.
SCENARIO_OUTCOMES = (K.DONE, K.FAILED, K.PROCESSING, K.PENDING)


def secs(ts: Column, n) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.timestamp_seconds(F.unix_seconds(ts) + n)


def scenario_outcome(first: DataFrame) -> DataFrame:
    """Adds ``outcome`` and ``outcome_reason`` for each first-by-hash file."""
    pr = C.parse_reason("format")
    sim = F.element_at(F.array(*[F.lit(s) for s in SCENARIO_OUTCOMES]),
                       (F.col("doc_id") % len(SCENARIO_OUTCOMES) + 1).cast("int"))
    outcome = (F.when(F.col("reason").isNotNull(), F.lit(K.QUARANTINED))
               .when(pr.isNotNull(), F.lit(K.FAILED))
               .otherwise(sim))
    why = (F.when(F.col("reason").isNotNull(), F.col("reason"))
           .when(pr.isNotNull(), pr)
           .when(sim == F.lit(K.FAILED), F.lit(K.MSG_PARSE_CSV))
           .otherwise(F.lit(None).cast("string")))
    return first.withColumn("outcome", outcome).withColumn("outcome_reason", why)


def replayed_log(classified: DataFrame, batch_id: int = 1) -> DataFrame:
    """Manifest log for a batch of (virtual) files: insert → processing → outcome.

    pending at arrival (seq 0), processing at arrival (seq 1), outcome row at
    arrival + (doc_id % 4 + 1) minutes (seq 2), none when the outcome is
    ``processing`` (a stuck file). One pass: the three rows of a file are
    generated together and exploded.
    """
    first = scenario_outcome(M.first_by_hash(classified))
    t0 = F.col("received_at")
    done_at = secs(t0, (F.col("doc_id") % 4 + 1) * 60)
    none = F.lit(None).cast("string")
    rows = F.array(
        F.struct(F.lit(K.PENDING).alias("status"), t0.alias("at"), F.lit(0).alias("seq"), none.alias("reason")),
        F.struct(F.lit(K.PROCESSING).alias("status"), t0.alias("at"), F.lit(1).alias("seq"), none.alias("reason")),
        F.struct(F.col("outcome").alias("status"), done_at.alias("at"), F.lit(2).alias("seq"),
                 F.col("outcome_reason").alias("reason")))
    ex = first.select("content_hash", "path", "source", F.explode(rows).alias("r"))
    ex = ex.where(~((F.col("r.seq") == 2) & (F.col("r.status") == K.PROCESSING)))
    return ex.select(
        "content_hash", "path", "source", F.col("r.status").alias("status"),
        F.col("r.at").cast("timestamp").alias("at"), F.col("r.seq").cast("int").alias("seq"),
        F.col("r.reason").alias("reason"), F.lit(batch_id).cast("bigint").alias("batch_id"))
