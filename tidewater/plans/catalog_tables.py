"""Queries for CDC, table layout, serving and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc as CD
from ..operators import layout as LY
from ..operators import lifecycle as L
from ..operators import manifest as M
from ..operators import monitor as MO
from ..operators import serving as SV
from ..operators import store as S
from ..operators import temporal as TM
from ..session import scratch_path
from ..sources.tables import table
from .common import prep, r6, ts_text, vfiles
from .oracle_sql import FIRST, VFILES, with_ctes
from .registry import query

# ------------------------------------------------------------------ B18-B20 B25
# Change stream derived from orders (our scenario): every order is inserted
# ('r' snapshot read before 1996, else 'c'); open orders are updated a day
# later (closed, +100 on the price); low-priority orders are deleted two
# days after the insert.
CHANGES_SQL = """
ch AS (
  SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'r' ELSE 'c' END AS op,
         epoch_ms(o_orderdate) AS ts_ms, 0 AS off,
         o_custkey AS a_custkey, o_orderstatus AS a_status, o_totalprice AS a_price, o_orderpriority AS a_prio,
         NULL AS b_status, NULL AS b_price
  FROM orders
  UNION ALL
  SELECT o_orderkey, 'u', epoch_ms(o_orderdate) + 86400000, 1,
         o_custkey, 'F', o_totalprice + 100, o_orderpriority, o_orderstatus, o_totalprice
  FROM orders WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT o_orderkey, 'd', epoch_ms(o_orderdate) + 172800000, 2, NULL, NULL, NULL, NULL,
         o_orderstatus, o_totalprice
  FROM orders WHERE o_orderpriority = '5-LOW'
),
cur AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ts_ms DESC, off DESC) AS rn
                 FROM ch) WHERE rn = 1 AND op <> 'd'
)"""


def order_changes(spark, sf):
    prep(spark)
    o = table(spark, sf, "orders")
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    row = F.struct("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    upd = F.struct("o_custkey", F.lit("F").alias("o_orderstatus"),
                   (F.col("o_totalprice") + 100).alias("o_totalprice"), "o_orderpriority")
    null_row = F.lit(None).cast(o.select(row.alias("x")).schema["x"].dataType)
    ins = o.select("o_orderkey", F.when(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"),
                                        "r").otherwise("c").alias("op"),
                   ms.alias("ts_ms"), F.lit(0).cast("bigint").alias("offset"),
                   null_row.alias("before"), row.alias("after"))
    up = o.where(F.col("o_orderstatus") == "O").select(
        "o_orderkey", F.lit("u").alias("op"), (ms + 86_400_000).alias("ts_ms"),
        F.lit(1).cast("bigint").alias("offset"), row.alias("before"), upd.alias("after"))
    de = o.where(F.col("o_orderpriority") == "5-LOW").select(
        "o_orderkey", F.lit("d").alias("op"), (ms + 172_800_000).alias("ts_ms"),
        F.lit(2).cast("bigint").alias("offset"), row.alias("before"), null_row.alias("after"))
    return ins.unionByName(up).unionByName(de)


@query("cdc_apply", with_ctes(CHANGES_SQL) + """
SELECT o_orderkey, a_custkey AS o_custkey, a_status AS o_orderstatus, round(a_price, 6) AS o_totalprice,
       a_prio AS o_orderpriority, op FROM cur""")
def q_cdc_apply(spark, sf):
    cur = CD.apply_changes(order_changes(spark, sf), "o_orderkey")
    return cur.select("o_orderkey", "o_custkey", "o_orderstatus", r6("o_totalprice").alias("o_totalprice"),
                      "o_orderpriority", "op")


@query("cdc_stream", with_ctes(CHANGES_SQL) + """
SELECT o_orderkey, a_custkey AS o_custkey, a_status AS o_orderstatus, round(a_price, 6) AS o_totalprice,
       a_prio AS o_orderpriority, op FROM cur""")
def q_cdc_stream(spark, sf):
    """B18 as a stream: the changes as files in no order of time, a few files a
    micro-batch; the state after the last one is the batch result."""
    src, target, ckpt = (scratch_path(spark, f"cdc-{n}") for n in ("changes", "state", "checkpoint"))
    ch = order_changes(spark, sf).select("o_orderkey", "after", "op", "ts_ms", "offset")
    ch.repartition(6, F.xxhash64("ts_ms", "offset")).write.parquet(src)
    q = (spark.readStream.schema(ch.schema).option("maxFilesPerTrigger", 2).parquet(src).writeStream
         .foreachBatch(CD.foreach_batch_apply(target, "o_orderkey")).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    cur = CD.read_current(spark, target, "o_orderkey")
    return cur.select("o_orderkey", "o_custkey", "o_orderstatus", r6("o_totalprice").alias("o_totalprice"),
                      "o_orderpriority", "op")


@query("cdc_buckets", with_ctes(CHANGES_SQL) + """
SELECT o_orderkey, a_custkey AS o_custkey, a_status AS o_orderstatus, round(a_price, 6) AS o_totalprice,
       a_prio AS o_orderpriority, op FROM cur""")
def q_cdc_buckets(spark, sf):
    """B18 as a stream into a state of key buckets, folded after two deltas."""
    src, target, ckpt = (scratch_path(spark, f"cdc-buckets-{n}") for n in ("changes", "state", "checkpoint"))
    ch = order_changes(spark, sf).select("o_orderkey", "after", "op", "ts_ms", "offset")
    ch.repartition(6, F.xxhash64("ts_ms", "offset")).write.parquet(src)
    q = (spark.readStream.schema(ch.schema).option("maxFilesPerTrigger", 2).parquet(src).writeStream
         .foreachBatch(CD.foreach_batch_buckets(target, "o_orderkey", 16, fold=2)).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    cur = CD.read_buckets(spark, target, "o_orderkey", ch.schema)
    return cur.select("o_orderkey", "o_custkey", "o_orderstatus", r6("o_totalprice").alias("o_totalprice"),
                      "o_orderpriority", "op")


@query("cdc_diff", with_ctes(CHANGES_SQL) + """
SELECT o_orderkey, ts_ms, 'o_orderstatus' AS "column", b_status AS old, a_status AS new
FROM ch WHERE op = 'u' AND b_status IS DISTINCT FROM a_status
UNION ALL
SELECT o_orderkey, ts_ms, 'o_totalprice', printf('%.2f', b_price), printf('%.2f', a_price)
FROM ch WHERE op = 'u' AND b_price IS DISTINCT FROM a_price""")
def q_cdc_diff(spark, sf):
    ch = order_changes(spark, sf)
    money = {"o_totalprice": lambda c: F.format_string("%.2f", c)}
    return CD.diff_columns(ch, "o_orderkey", ["o_orderstatus", "o_totalprice"], money)


@query("cdc_join", with_ctes(CHANGES_SQL) + """
SELECT cur.o_orderkey, c.c_name, c.c_mktsegment, round(cur.a_price, 6) AS o_totalprice
FROM cur LEFT JOIN customer c ON c.c_custkey = cur.a_custkey""")
def q_cdc_join(spark, sf):
    cur = CD.apply_changes(order_changes(spark, sf), "o_orderkey")
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name",
                                               "c_mktsegment")
    j = cur.join(cust, "o_custkey", "left")
    return j.select("o_orderkey", "c_name", "c_mktsegment", r6("o_totalprice").alias("o_totalprice"))


AS_OF_MS = 899164800000  # 1998-06-30 00:00:00 UTC


@query("as_of_table", with_ctes(CHANGES_SQL) + f"""
SELECT o_orderkey, a_status AS o_orderstatus, round(a_price, 6) AS o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ts_ms DESC, off DESC) AS r2
  FROM ch WHERE ts_ms <= {AS_OF_MS}) WHERE r2 = 1 AND op <> 'd'""")
def q_as_of_table(spark, sf):
    cur = CD.apply_changes(order_changes(spark, sf), "o_orderkey", F.lit(AS_OF_MS))
    return cur.select("o_orderkey", "o_orderstatus", r6("o_totalprice").alias("o_totalprice"))


# --------------------------------------------------------------------- B21
@query("schema_enforce", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS accepted,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'o_totalprice' ELSE '' END AS reasons,
       CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice END AS o_totalprice,
       'priority ' || o_orderpriority AS o_comment,
       CAST(NULL AS VARCHAR) AS o_orderdate
FROM orders""")
def q_schema_enforce(spark, sf):
    prep(spark)
    o = table(spark, sf, "orders")
    incoming = S.all_string(o.drop("o_orderdate")).withColumn(
        "o_totalprice", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("n/a"))
        .otherwise(F.col("o_totalprice"))).withColumn(
        "o_comment", F.concat(F.lit("priority "), F.col("o_orderpriority")))
    target = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
              "o_totalprice": "double", "o_orderdate": "timestamp", "o_orderpriority": "string"}
    ok, bad, _added = LY.enforce_schema(incoming, target, allow_new=True)
    ok = ok.withColumn("reasons", F.lit("")).withColumn("accepted", F.lit(1))
    bad = bad.withColumn("reasons", F.concat_ws(",", "reasons")).withColumn("accepted", F.lit(0)) \
        .withColumn("o_totalprice", F.lit(None).cast("double"))
    both = ok.unionByName(bad)
    return both.select("o_orderkey", "accepted", "reasons", "o_totalprice", "o_comment",
                       F.col("o_orderdate").cast("string").alias("o_orderdate"))


# --------------------------------------------------------------------- B22
@query("retention", """
WITH m AS (SELECT CAST(max(o_orderdate) AS DATE) AS a FROM orders)
SELECT 'raw' AS kind, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date, count(*) AS n_rows
FROM orders, m WHERE CAST(o_orderdate AS DATE) < a - 90 GROUP BY ALL
UNION ALL
SELECT 'processed', strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d'), count(*)
FROM orders, m WHERE CAST(o_orderdate AS DATE) < a - 365 GROUP BY ALL""")
def q_retention(spark, sf):
    prep(spark)
    o = table(spark, sf, "orders")
    as_of, = o.agg(F.max("o_orderdate").cast("date")).first()
    if as_of is None:       # no orders
        return spark.createDataFrame([], "kind string, date string, n_rows bigint")
    return LY.expired_dates(o, "o_orderdate", as_of, LY.RETENTION_DAYS)


# ----------------------------------------------------------------- B23 B24
def _lineitem_by_month(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.withColumn("date", F.date_format("l_shipdate", "yyyy-MM")).withColumn(
        "source", F.col("l_returnflag"))


@query("partitioned_table", """
SELECT strftime(l_shipdate, '%Y-%m') AS date, l_returnflag AS source, count(*) AS n_rows,
       round(sum(l_quantity), 6) AS sum_qty
FROM lineitem GROUP BY ALL""")
def q_partitioned_table(spark, sf):
    prep(spark)
    path = scratch_path(spark, "lineitem-by-date")
    LY.write_partitioned(_lineitem_by_month(spark, sf), path)
    back = spark.read.parquet(path)
    return back.groupBy("date", "source").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                                              r6(F.sum("l_quantity")).alias("sum_qty"))


TRICKLE_ROWS = 500_000      # four tasks write so many


@query("compact_plan", """
SELECT strftime(l_shipdate, '%Y-%m') AS date, l_returnflag AS source, count(*) AS n_rows,
       CAST(1 AS BIGINT) AS target_files
FROM lineitem GROUP BY ALL""")
def q_compact_plan(spark, sf):
    prep(spark)
    path, out = scratch_path(spark, "lineitem-small-files"), scratch_path(spark, "lineitem-compacted")
    # many small files per partition, as a trickle of appends would leave: four of each, in more tasks the more rows
    t = _lineitem_by_month(spark, sf)
    wide = max(1, -(-t.count() // TRICKLE_ROWS))
    part, append = F.pmod(F.xxhash64("date", "source"), F.lit(wide)), F.floor(F.rand(0) * 4)
    (t.repartitionById(4 * wide, (append * wide + part).cast("int"))
     .write.partitionBy("date", "source").parquet(path))
    plan = LY.compact(spark, path, out, ["date", "source"])
    back = spark.read.parquet(out).groupBy("date", "source").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"))
    return back.join(plan.select("date", "source", "target_files"), ["date", "source"])


# ------------------------------------------------------------------ B26 B27
@query("pit_features", """
WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id AS fid, user_id, ts AS fts, value FROM events WHERE event_type = 'view')
SELECT l.event_id,
       CASE WHEN v.fts >= l.ts - INTERVAL 1 DAY THEN v.fid END AS feature_event_id,
       CASE WHEN v.fts >= l.ts - INTERVAL 1 DAY THEN v.value END AS view_value
FROM l ASOF LEFT JOIN v ON l.user_id = v.user_id AND l.ts >= v.fts""")
def q_pit_features(spark, sf):
    prep(spark)
    ev = table(spark, sf, "events")
    lab = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    fea = ev.where(F.col("event_type") == "view").select(
        "event_id", "user_id", "ts", F.col("value").alias("view_value"))
    out = SV.asof_features(lab, fea, "user_id", "ts", "ts", 86400, ["view_value"], "event_id")
    return out.select("event_id", "feature_event_id", "view_value")


@query("materialize_latest", """
WITH m AS (SELECT max(ts) AS a FROM events)
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, value FROM (
  SELECT e.*, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events e, m WHERE e.ts > m.a - INTERVAL 7 DAY AND e.ts <= m.a) WHERE rn = 1""")
def q_materialize_latest(spark, sf):
    prep(spark)
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    # as-of = latest event time: a one-row aggregate carried as a column (no eager job)
    with_as_of = ev.crossJoin(F.broadcast(ev.agg(F.max("ts").cast("timestamp").alias("__as_of"))))
    out = SV.latest_per_entity(with_as_of, "user_id", "ts", "event_id", F.col("__as_of"), 7 * 86400)
    return out.select("user_id", "event_id", ts_text("ts", micros=True).alias("ts"), "event_type", "value")


# --------------------------------------------------------------------- B28
@query("batch_predict", """
WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s,
                  regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem)
SELECT l_orderkey, l_linenumber, round(i + s * l_quantity, 2) AS prediction FROM lineitem, m""")
def q_batch_predict(spark, sf):
    prep(spark)
    li = table(spark, sf, "lineitem")
    model = SV.fit_linear(li, "l_extendedprice", "l_quantity")
    out = scratch_path(spark, "predictions")
    SV.predict_linear(li.select("l_orderkey", "l_linenumber", "l_quantity"), model, "l_quantity") \
        .write.parquet(out)
    back = spark.read.parquet(out)
    return back.select("l_orderkey", "l_linenumber", F.round("prediction", 2).alias("prediction"))


def _plane_sql(y: str) -> str:
    """Least squares of y on quantity and discount, in closed form."""
    return f"""
t AS (SELECT *, {y} AS y, l_quantity AS a, l_discount AS b FROM lineitem),
v AS (SELECT var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(y, a) AS ya, covar_pop(y, b) AS yb,
             avg(y) AS my, avg(a) AS ma, avg(b) AS mb FROM t),
c AS (SELECT (ya * bb - yb * ab) / (aa * bb - ab * ab) AS ca, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS cb, my, ma, mb FROM v),
m AS (SELECT ca, cb, my - ca * ma - cb * mb AS c0 FROM c)"""


@query("batch_predict_many", "WITH" + _plane_sql("l_extendedprice") + """
SELECT l_orderkey, l_linenumber, round(c0 + ca * a + cb * b, 1) AS prediction FROM t, m""")
def q_batch_predict_many(spark, sf):
    """B28 with two features."""
    prep(spark)
    li = table(spark, sf, "lineitem")
    xs = ["l_quantity", "l_discount"]
    out = SV.predict_linear_many(li, SV.fit_linear_many(li, "l_extendedprice", xs), xs)
    return out.select("l_orderkey", "l_linenumber", F.round("prediction", 1).alias("prediction"))


_RETURNED_SQL = "WITH" + _plane_sql("CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END") + """
SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-(c0 + ca * a + cb * b))), 6) AS prediction FROM t, m"""


def _returned_model(spark, sf):
    prep(spark)
    li = table(spark, sf, "lineitem")
    xs = ["l_quantity", "l_discount"]
    return li, xs, SV.fit_linear_many(li, (F.col("l_returnflag") == "R").cast("double"), xs)


@query("batch_predict_logistic", _RETURNED_SQL)
def q_batch_predict_logistic(spark, sf):
    """B28, logistic form: a linear score as a probability, in expressions."""
    li, xs, model = _returned_model(spark, sf)
    out = SV.predict_logistic(li, model, xs)
    return out.select("l_orderkey", "l_linenumber", r6("prediction").alias("prediction"))


@query("batch_predict_opaque", _RETURNED_SQL)
def q_batch_predict_opaque(spark, sf):
    """B28, opaque form: the same model as a function on Arrow batches."""
    import numpy as np
    li, xs, (c0, beta) = _returned_model(spark, sf)
    out = SV.predict_opaque(li, lambda x: 1 / (1 + np.exp(-(c0 + x @ np.array(beta)))), xs)
    return out.select("l_orderkey", "l_linenumber", r6("prediction").alias("prediction"))


# --------------------------------------------------------------------- B29
@query("drift_kl", """
WITH b AS (SELECT event_type, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'q' ELSE 'p' END AS side,
                  CAST(least(greatest(floor(value / 25), 0), 19) AS INTEGER) AS bin FROM events),
h AS (SELECT event_type, side, bin,
             count(*) / sum(count(*)) OVER (PARTITION BY event_type, side) AS pr
      FROM b GROUP BY event_type, side, bin),
j AS (SELECT coalesce(p.event_type, q.event_type) AS et,
             greatest(coalesce(p.pr, 0), 1e-6) AS pp, greatest(coalesce(q.pr, 0), 1e-6) AS qq
      FROM (SELECT * FROM h WHERE side = 'p') p
      FULL OUTER JOIN (SELECT * FROM h WHERE side = 'q') q ON p.event_type = q.event_type AND p.bin = q.bin)
SELECT et AS event_type, round(sum(pp * ln(pp / qq)), 6) AS kl,
       CASE WHEN sum(pp * ln(pp / qq)) > 0.05 THEN 1 ELSE 0 END AS alert
FROM j GROUP BY et""")
def q_drift_kl(spark, sf):
    prep(spark)
    ev = table(spark, sf, "events")
    base = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    out = MO.kl_drift(ev.where(~base), ev.where(base), ["event_type"], "value", 0.0, 25.0, 20)
    return out.select("event_type", r6("kl").alias("kl"), "alert")


# --------------------------------------------------------------------- B30
@query("rolling_quality", """
WITH x AS (
  SELECT d.source, d.doc_id, l.quality,
         CASE WHEN CASE WHEN d.n_chars >= 1000 THEN 1 ELSE 0 END = l.quality THEN 1.0 ELSE 0.0 END AS correct,
         pow(least(d.n_chars / 2000.0, 1.0) - l.quality, 2) AS sq
  FROM labels l JOIN documents d USING (doc_id))
SELECT doc_id, round(avg(correct) OVER w, 6) AS acc20, round(sqrt(avg(sq) OVER w), 6) AS rmse20
FROM x WINDOW w AS (PARTITION BY source ORDER BY doc_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def q_rolling_quality(spark, sf):
    prep(spark)
    lab = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    x = lab.join(docs, "doc_id").select(
        "source", "doc_id", "quality",
        F.when(F.when(F.col("n_chars") >= 1000, 1).otherwise(0) == F.col("quality"), 1.0)
        .otherwise(0.0).alias("correct"),
        F.pow(F.least(F.col("n_chars") / 2000.0, F.lit(1.0)) - F.col("quality"), 2).alias("sq"))
    chunk = F.floor(F.col("doc_id") / 1000).cast("bigint")
    a = TM.rolling_rows(x, "source", ["doc_id"], ["correct", "sq"], 20, chunk, prefix="w")
    return a.select("doc_id", r6("w20_correct_avg").alias("acc20"), r6(F.sqrt("w20_sq_avg")).alias("rmse20"))


# --------------------------------------------------------------------- B31
_METRICS_SQL = with_ctes(VFILES, FIRST) + """
, mt AS (
  SELECT time_bucket(INTERVAL 10 MINUTE, received_at) AS ws, source, count(*) AS files,
         CAST(sum(length) AS BIGINT) AS bytes,
         avg(CASE WHEN status IN ('failed', 'quarantined') THEN 1 ELSE 0 END) AS error_rate,
         CAST(sum(CASE WHEN status = 'quarantined' THEN 1 ELSE 0 END) AS BIGINT) AS quarantined,
         quantile_cont(CASE WHEN status = 'done' THEN floor(epoch(processed_at) - epoch(received_at)) END, 0.5) AS p50,
         quantile_cont(CASE WHEN status = 'done' THEN floor(epoch(processed_at) - epoch(received_at)) END, 0.95) AS p95,
         quantile_cont(CASE WHEN status = 'done' THEN floor(epoch(processed_at) - epoch(received_at)) END, 0.99) AS p99
  FROM mcur GROUP BY ALL
)"""


def _metrics(spark, sf):
    files = vfiles(spark, sf)
    cur = M.current(L.replayed_log(files))
    f = cur.join(files.select("content_hash", "path", "length", "received_at"), ["content_hash", "path"])
    return MO.pipeline_metrics(f.select("received_at", "processed_at", "source", "status", "length"))


@query("ingest_metrics", _METRICS_SQL.replace(")\n, mt AS", "),\nmt AS") + """
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, source, files, bytes,
       round(error_rate, 6) AS error_rate, quarantined, round(p50, 6) AS p50, round(p95, 6) AS p95,
       round(p99, 6) AS p99 FROM mt""")
def q_ingest_metrics(spark, sf):
    m = _metrics(spark, sf)
    return m.select(ts_text("window_start").alias("window_start"), "source", "files", "bytes",
                    r6("error_rate").alias("error_rate"), "quarantined", r6("p50").alias("p50"),
                    r6("p95").alias("p95"), r6("p99").alias("p99"))


@query("alerts", _METRICS_SQL.replace(")\n, mt AS", "),\nmt AS") + """
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, source, 'error_rate' AS rule,
       round(error_rate, 6) AS observed FROM mt WHERE error_rate > 0.01
UNION ALL
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S'), source, 'quarantine', CAST(quarantined AS DOUBLE)
FROM mt WHERE quarantined > 0
UNION ALL
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S'), source, 'latency_p99', round(p99, 6) FROM mt WHERE p99 > 300""")
def q_alerts(spark, sf):
    a = MO.alerts(_metrics(spark, sf))
    return a.select(ts_text("window_start").alias("window_start"), "source", "rule",
                    r6("observed").alias("observed"))
