"""Tables that grow: drift between ranges of stored sketches, columns that widen."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evolution as EV
from ..operators import sketches as SK
from ..session import scratch_path
from ..sources.tables import table
from .common import prep, r6
from .registry import query

BASELINE = ("2024-01-01", "2024-01-10")
RANGES = {"second": ("2024-01-11", "2024-01-20"), "third": ("2024-01-21", "2024-01-31"), "last_day": ("2024-01-30", "2024-01-30")}


@query("drift_sketch", f"""
WITH v AS (SELECT strftime(ts, '%Y-%m-%d') AS day, 'value' AS col, value AS x FROM events
           UNION ALL SELECT strftime(ts, '%Y-%m-%d'), 'user_id', CAST(user_id AS DOUBLE) FROM events),
b AS (SELECT day, col, CASE WHEN x = 0 THEN 0 ELSE CAST(floor(log2(x)) * 64 + floor((x / pow(2, floor(log2(x))) - 1) * 64) + 70400 AS BIGINT) END AS bucket
      FROM v WHERE x IS NOT NULL),
base AS (SELECT col, bucket, count(*) AS n FROM b WHERE day BETWEEN '{BASELINE[0]}' AND '{BASELINE[1]}' GROUP BY 1, 2),
up AS (SELECT col, bucket, sum(n) OVER (PARTITION BY col ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY col) AS total FROM base),
cuts AS (SELECT col, i, min(bucket) AS cut FROM up, range(1, 10) t(i) WHERE upto * 10 >= i * total GROUP BY 1, 2),
r AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{a}', '{z}')" for k, (a, z) in RANGES.items())}) t(name, a, z)),
p AS (SELECT name, col, (SELECT count(*) FROM cuts c WHERE c.col = b.col AND c.cut < b.bucket) AS part, count(*) AS n FROM b JOIN r ON day BETWEEN a AND z GROUP BY ALL),
q AS (SELECT col, (SELECT count(*) FROM cuts c WHERE c.col = b.col AND c.cut < b.bucket) AS part, sum(n) AS n FROM base b GROUP BY ALL),
j AS (SELECT r.name, c.col, t.i AS part, coalesce(q.n, 0) AS qn, coalesce(p.n, 0) AS pn
      FROM (SELECT DISTINCT col FROM cuts) c CROSS JOIN range(10) t(i) CROSS JOIN r LEFT JOIN q ON q.col = c.col AND q.part = t.i
      LEFT JOIN p ON p.name = r.name AND p.col = c.col AND p.part = t.i),
s AS (SELECT *, sum(qn) OVER w AS qt, sum(pn) OVER w AS pt FROM j WINDOW w AS (PARTITION BY name, col)),
k AS (SELECT name, col, sum(qn) AS nq, sum(pn) AS np, sum(greatest(pn / pt, 1e-6) * ln(greatest(pn / pt, 1e-6) / greatest(qn / qt, 1e-6))) AS kl FROM s GROUP BY 1, 2)
SELECT name AS days, col AS "column", CAST(nq AS BIGINT) AS n_baseline, CAST(np AS BIGINT) AS n_current, round(kl, 6) AS kl, CASE WHEN kl > 0.05 THEN 1 ELSE 0 END AS alert FROM k""")
def q_drift_sketch(spark, sf):
    """B29 from sketches stored once: three ranges of days against the first ten, tenths of the baseline as bins."""
    prep(spark)
    path = scratch_path(spark, "sketches")
    SK.write_sketches(SK.sketch_days(table(spark, sf, "events"), "ts", ["value", "user_id"]), path)
    stored, out = spark.read.parquet(path), None
    for name, days in RANGES.items():
        part = SK.drift(stored, BASELINE, days, 10).select(F.lit(name).alias("days"), "column", "n_baseline", "n_current", r6("kl").alias("kl"), "alert")
        out = part if out is None else out.unionByName(part)
    return out


@query("schema_widening", """
SELECT event_id + CASE WHEN event_id % 3 = 1 THEN 5000000000 ELSE 0 END AS event_id,
       CASE WHEN event_id % 3 = 2 THEN 'u' || user_id ELSE CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN event_id % 3 = 0 THEN floor(value) ELSE value END AS value,
       CASE WHEN event_id % 3 = 2 THEN props END AS props FROM events""")
def q_schema_widening(spark, sf):
    """Three batches whose columns widen (int to long, int to double, int to text) and a new column, read as one table."""
    prep(spark)
    ev, root = table(spark, sf, "events"), scratch_path(spark, "widening")
    text = lambda c: c.cast("string")
    batches = [
        ev.where("event_id % 3 = 0").select(text(F.col("event_id")).alias("event_id"), text(F.col("user_id")).alias("user_id"), text(F.floor("value")).alias("value")),
        ev.where("event_id % 3 = 1").select(text(F.col("event_id") + 5_000_000_000).alias("event_id"), text(F.col("user_id")).alias("user_id"), text(F.col("value")).alias("value")),
        ev.where("event_id % 3 = 2").select(text(F.col("event_id")).alias("event_id"), F.concat(F.lit("u"), "user_id").alias("user_id"), text(F.col("value")).alias("value"), "props")]
    for i, batch in enumerate(batches):
        EV.append_batch(batch, root, i)
    return EV.read_versions(spark, root)
