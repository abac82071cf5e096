"""Queries for the feature operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import pipeline as PL
from ..operators import store as S
from ..operators import temporal as TM
from ..operators.quantiles import exact_quantiles
from ..session import scratch_path
from ..sources.tables import table
from .common import prep, r6, ts_text
from .registry import query

DUCK_US = "'%Y-%m-%d %H:%M:%S.%f'"


def _events(spark, sf):
    prep(spark)
    return table(spark, sf, "events")


# --------------------------------------------------------------------- B01
@query("coerce", f"""
SELECT event_id, strftime(ts, {DUCK_US}) AS ts, user_id, value,
       TRY_CAST(event_type AS INTEGER) AS event_type_int,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       concat_ws(',', CASE WHEN TRY_CAST(event_type AS INTEGER) IS NULL THEN 'event_type' END,
                 CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL THEN 'k' END)
         AS errors
FROM events""")
def q_coerce(spark, sf):
    ev = _events(spark, sf)
    text = S.all_string(ev.withColumn("k", F.get_json_object("props", "$.k")))
    target = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint",
              "value": "double", "event_type": "int", "k": "int"}
    typed = FT.coerce(text, target, flag="errs")
    return typed.select("event_id", ts_text("ts", micros=True).alias("ts"), "user_id", "value",
                        F.col("event_type").alias("event_type_int"), "k",
                        F.concat_ws(",", "errs").alias("errors"))


# --------------------------------------------------------------------- B02
RULES_SQL = """
SELECT l_orderkey, l_linenumber,
       concat_ws(',',
         CASE WHEN NOT coalesce(l_quantity BETWEEN 1 AND 50, false) THEN 'qty_range' END,
         CASE WHEN NOT coalesce(l_discount BETWEEN 0 AND 0.1, false) THEN 'discount_range' END,
         CASE WHEN NOT coalesce(l_tax <= 0.06, false) THEN 'tax_cap' END,
         CASE WHEN NOT coalesce(l_extendedprice >= 1000, false) THEN 'price_floor' END,
         CASE WHEN l_shipdate IS NULL THEN 'shipdate_present' END,
         CASE WHEN NOT coalesce(l_linestatus IN ('O', 'F'), false) THEN 'linestatus_known' END
       ) AS reasons
FROM lineitem"""


@query("validate_rules", f"""
SELECT l_orderkey, l_linenumber, reasons, CASE WHEN reasons = '' THEN 1 ELSE 0 END AS is_valid
FROM ({RULES_SQL})""")
def q_validate_rules(spark, sf):
    prep(spark)
    li = table(spark, sf, "lineitem")
    rules = {
        "qty_range": F.col("l_quantity").between(1, 50),
        "discount_range": F.col("l_discount").between(0, 0.1),
        "tax_cap": F.col("l_tax") <= 0.06,
        "price_floor": F.col("l_extendedprice") >= 1000,
        "shipdate_present": F.col("l_shipdate").isNotNull(),
        "linestatus_known": F.col("l_linestatus").isin("O", "F"),
    }
    c = FT.check_rules(li, rules)
    return c.select("l_orderkey", "l_linenumber", F.concat_ws(",", "reasons").alias("reasons"),
                    F.when(F.size("reasons") == 0, 1).otherwise(0).alias("is_valid"))


# ------------------------------------------------------------- B03 B04 B15
@query("minmax", """
SELECT event_id,
  round(CASE WHEN max(value) OVER () = min(value) OVER () THEN 0
        ELSE (value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()) END, 6) AS value_mm,
  round(CASE WHEN max(value) OVER t = min(value) OVER t THEN 0
        ELSE (value - min(value) OVER t) / (max(value) OVER t - min(value) OVER t) END, 6) AS value_mm_type
FROM events WINDOW t AS (PARTITION BY event_type)""")
def q_minmax(spark, sf):
    ev = _events(spark, sf)
    g = FT.apply_minmax(ev, FT.fit_minmax(ev, "value"), "value", "value_mm")
    g = FT.apply_minmax(g, FT.fit_minmax(ev, "value", ["event_type"]), "value", "value_mm_type",
                        ["event_type"])
    return g.select("event_id", r6("value_mm").alias("value_mm"), r6("value_mm_type").alias("value_mm_type"))


@query("standardize", """
SELECT event_id,
  round(CASE WHEN stddev_pop(value) OVER () = 0 THEN 0
        ELSE (value - avg(value) OVER ()) / stddev_pop(value) OVER () END, 6) AS value_z,
  round(CASE WHEN stddev_pop(value) OVER t = 0 THEN 0
        ELSE (value - avg(value) OVER t) / stddev_pop(value) OVER t END, 6) AS value_z_type
FROM events WINDOW t AS (PARTITION BY event_type)""")
def q_standardize(spark, sf):
    ev = _events(spark, sf)
    g = FT.apply_standard(ev, FT.fit_standard(ev, "value"), "value", "value_z")
    g = FT.apply_standard(g, FT.fit_standard(ev, "value", ["event_type"]), "value", "value_z_type",
                          ["event_type"])
    return g.select("event_id", r6("value_z").alias("value_z"), r6("value_z_type").alias("value_z_type"))


@query("inverse", """
SELECT event_id, round(value, 6) AS value_back, event_type AS type_back, round(value, 6) AS value_back_z
FROM events""")
def q_inverse(spark, sf):
    ev = _events(spark, sf)
    mm = FT.fit_minmax(ev, "value", ["event_type"])
    sd = FT.fit_standard(ev, "value")
    cats = FT.fit_onehot(ev, "event_type")
    fwd = FT.apply_minmax(ev, mm, "value", "s", ["event_type"])
    fwd = FT.apply_standard(fwd, sd, "value", "z")
    fwd = FT.apply_onehot(fwd, "event_type", cats).drop("value")
    back = FT.invert_minmax(fwd, mm, "value", "s", "value_back", ["event_type"])
    back = FT.invert_standard(back, sd, "value", "z", "value_back_z")
    back = back.withColumn("type_back", FT.invert_onehot(back, "event_type", cats))
    return back.select("event_id", r6("value_back").alias("value_back"), "type_back",
                       r6("value_back_z").alias("value_back_z"))


# --------------------------------------------------------------------- B05
CUTS = [10.0, 50.0, 100.0, 250.0]


@query("bucketize", """
SELECT event_id,
  CASE WHEN value < 10 THEN 0 WHEN value < 50 THEN 1 WHEN value < 100 THEN 2
       WHEN value < 250 THEN 3 ELSE 4 END AS value_bucket,
  CAST(least(greatest(floor(value / 50), 0), 9) AS INTEGER) AS value_bin10
FROM events""")
def q_bucketize(spark, sf):
    ev = _events(spark, sf)
    width = FT.bucketize(F.col("value"), [50.0 * i for i in range(1, 10)])
    return ev.select("event_id", FT.bucketize("value", CUTS).alias("value_bucket"),
                     width.alias("value_bin10"))


# --------------------------------------------------------------------- B06
@query("onehot", """
SELECT event_id,
  CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS event_type_click,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS event_type_error,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS event_type_purchase,
  CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS event_type_signup,
  CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS event_type_view
FROM events""")
def q_onehot(spark, sf):
    ev = _events(spark, sf)
    cats = FT.fit_onehot(ev, "event_type")
    return FT.apply_onehot(ev.select("event_id", "event_type"), "event_type", cats).drop("event_type")


# ------------------------------------------------------------------ B07 B08
@query("target_enc", """
WITH g AS (SELECT avg(p_retailprice) AS gm FROM part),
b AS (SELECT p_brand, count(p_retailprice) AS n, avg(p_retailprice) AS m FROM part GROUP BY p_brand)
SELECT p.p_partkey, round((b.n * b.m + 10 * g.gm) / (b.n + 10), 6) AS brand_te
FROM part p JOIN b USING (p_brand) CROSS JOIN g""")
def q_target_enc(spark, sf):
    prep(spark)
    part = table(spark, sf, "part")
    enc, glob = FT.fit_target(part, "p_brand", "p_retailprice", 10.0)
    out = FT.apply_target(part, enc, glob, "p_brand", "brand_te")
    return out.select("p_partkey", r6("brand_te").alias("brand_te"))


@query("freq_enc", """
SELECT c_custkey, round(count(*) OVER (PARTITION BY c_mktsegment) / count(*) OVER (), 6) AS seg_freq
FROM customer""")
def q_freq_enc(spark, sf):
    prep(spark)
    c = table(spark, sf, "customer")
    out = FT.apply_frequency(c, FT.fit_frequency(c, "c_mktsegment"), "c_mktsegment", "seg_freq")
    return out.select("c_custkey", r6("seg_freq").alias("seg_freq"))


# ------------------------------------------------------------- B09 B10 B11
@query("temporal_parts", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) AS INTEGER) AS iso_weekday,
       CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month
FROM events""")
def q_temporal_parts(spark, sf):
    ev = _events(spark, sf)
    return ev.select("event_id", *TM.temporal_parts("ts"))


@query("days_since", """
SELECT event_id,
  CAST(floor((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 86400000000) AS BIGINT) AS days_since_prev,
  CAST(floor((epoch_us(ts) - max(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END)
       OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) / 86400000000) AS BIGINT)
       AS days_since_event
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def q_days_since(spark, sf):
    ev = _events(spark, sf)
    out = TM.days_since(ev, "user_id", "ts", "event_id", "event_type", "purchase", bucket_seconds=3600)
    return out.select("event_id", "days_since_prev", "days_since_event")


@query("rolling_rows", """
SELECT event_id,
  count(*) OVER w AS last5_count, round(sum(value) OVER w, 6) AS last5_sum,
  round(avg(value) OVER w, 6) AS last5_avg
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                         ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def q_rolling_rows(spark, sf):
    ev = _events(spark, sf)
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(3_600_000_000)).cast("bigint")
    out = TM.rolling_rows(ev, "user_id", ["ts", "event_id"], "value", 5, hour)
    return out.select("event_id", "last5_count", r6("last5_sum").alias("last5_sum"),
                      r6("last5_avg").alias("last5_avg"))


@query("rolling_range", """
SELECT event_id,
  count(*) OVER w AS range3600_count, round(sum(value) OVER w, 6) AS range3600_sum,
  round(avg(value) OVER w, 6) AS range3600_avg
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts)
                         RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW)""")
def q_rolling_range(spark, sf):
    ev = _events(spark, sf)
    out = TM.rolling_range(ev, "user_id", "ts", "value", 3600, sub_buckets=6)
    return out.select("event_id", "range3600_count", r6("range3600_sum").alias("range3600_sum"),
                      r6("range3600_avg").alias("range3600_avg"))


# ------------------------------------------------------------------ B12 B13
_TOK_SQL = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"


@query("tokenize", f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, CAST(len(list_distinct(t)) AS BIGINT) AS n_distinct,
       md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, {_TOK_SQL} AS t FROM documents)""")
def q_tokenize(spark, sf):
    prep(spark)
    d = table(spark, sf, "documents")
    t = d.select("doc_id", FT.tokenize("text").alias("t"))
    return t.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"),
                    F.size(F.array_distinct("t")).cast("bigint").alias("n_distinct"),
                    F.md5(F.array_join("t", " ")).alias("tokens_md5"))


@query("tfidf", f"""
WITH d AS (SELECT doc_id, {_TOK_SQL} AS t FROM documents),
terms AS (SELECT doc_id, unnest(t) AS term FROM d),
tf AS (SELECT doc_id, term, count(*) AS cnt FROM terms GROUP BY ALL),
n AS (SELECT count(*) AS nd FROM d),
df AS (SELECT term, count(*) AS dfc FROM tf GROUP BY term)
SELECT tf.doc_id, tf.term, round(tf.cnt / len(d.t), 6) AS tf,
       round(ln((1 + n.nd) / (1 + df.dfc)) + 1, 6) AS idf,
       round(tf.cnt / len(d.t) * (ln((1 + n.nd) / (1 + df.dfc)) + 1), 6) AS tfidf
FROM tf JOIN d USING (doc_id) JOIN df USING (term) CROSS JOIN n""")
def q_tfidf(spark, sf):
    prep(spark)
    d = table(spark, sf, "documents")
    t = d.select("doc_id", FT.tokenize("text").alias("t"))
    out = FT.tfidf(t, "doc_id", "t")
    return out.select("doc_id", "term", r6("tf").alias("tf"), r6("idf").alias("idf"),
                      r6("tfidf").alias("tfidf"))


# ------------------------------------------------------------- B14 B16 B17
PIPELINE = {
    "steps": [
        {"op": "temporal", "col": "ts"},
        {"op": "minmax", "col": "value", "out": "value_mm"},
        {"op": "bucketize", "col": "value", "cuts": CUTS, "out": "value_bucket"},
        {"op": "onehot", "col": "event_type"},
        {"op": "frequency", "col": "user_id", "out": "user_freq"},
    ]
}
PIPE_COLS = ["event_id", "hour", "iso_weekday", "value_mm", "value_bucket", "event_type_click",
             "event_type_error", "event_type_purchase", "event_type_signup", "event_type_view",
             "user_freq"]
_PIPE_SQL = """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) AS INTEGER) AS iso_weekday,
  round((value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()), 6) AS value_mm,
  CASE WHEN value < 10 THEN 0 WHEN value < 50 THEN 1 WHEN value < 100 THEN 2
       WHEN value < 250 THEN 3 ELSE 4 END AS value_bucket,
  CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS event_type_click,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS event_type_error,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS event_type_purchase,
  CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS event_type_signup,
  CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS event_type_view,
  round(count(*) OVER (PARTITION BY user_id) / count(*) OVER (), 6) AS user_freq
FROM events"""


def _pipe_out(df):
    return df.select(*[r6(c).alias(c) if c in ("value_mm", "user_freq") else F.col(c) for c in PIPE_COLS])


@query("feature_chain", _PIPE_SQL)
def q_feature_chain(spark, sf):
    ev = _events(spark, sf)
    fitted = PL.fit(PIPELINE, ev)
    return _pipe_out(fitted.transform(ev))


@query("backfill", f"""
SELECT p.*, strftime(e.ts, '%Y-%m-%d') AS date FROM ({_PIPE_SQL}) p JOIN events e USING (event_id)""")
def q_backfill(spark, sf):
    """Features recomputed for the date range [first day, last day] and
    written by date with dynamic partition overwrite — run twice; the table
    afterwards equals one clean run."""
    from ..operators.layout import backfill
    ev = _events(spark, sf)
    fitted = PL.fit(PIPELINE, ev)
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    out = scratch_path(spark, "features")
    feats = lambda d: fitted.transform(d).select(
        *[r6(c).alias(c) if c in ("value_mm", "user_freq") else F.col(c) for c in PIPE_COLS],
        F.date_format("ts", "yyyy-MM-dd").alias("date"))
    for _ in range(2):
        backfill(ev, feats, "ts", lo.strftime("%Y-%m-%d"), hi.strftime("%Y-%m-%d"), out)
    return spark.read.parquet(out).select(*PIPE_COLS, "date")


@query("backfill_range", f"""
SELECT p.*, strftime(e.ts, '%Y-%m-%d') AS date,
  CASE WHEN CAST(e.ts AS DATE) BETWEEN (SELECT CAST(min(ts) AS DATE) + 5 FROM events)
                                   AND (SELECT CAST(min(ts) AS DATE) + 9 FROM events) THEN 2 ELSE 1 END AS run
FROM ({_PIPE_SQL}) p JOIN events e USING (event_id)""")
def q_backfill_range(spark, sf):
    """B17 with a real sub-range: everything is written as run 1, then five
    days again as run 2; only their partitions change."""
    from ..operators.layout import backfill
    ev = _events(spark, sf)
    fitted = PL.fit(PIPELINE, ev)
    lo, hi = ev.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    out = scratch_path(spark, "features-range")

    def feats(run):
        return lambda d: fitted.transform(d).select(
            *[r6(c).alias(c) if c in ("value_mm", "user_freq") else F.col(c) for c in PIPE_COLS],
            F.lit(run).alias("run"), F.date_format("ts", "yyyy-MM-dd").alias("date"))
    backfill(ev, feats(1), "ts", lo.isoformat(), hi.isoformat(), out)
    day = _dt.timedelta(days=1)
    backfill(ev, feats(2), "ts", (lo + 5 * day).isoformat(), (lo + 9 * day).isoformat(), out)
    return spark.read.parquet(out).select(*PIPE_COLS, "date", "run")


@query("skew_check", f"""
SELECT 'batch_only' AS side, * FROM ({_PIPE_SQL}) WHERE event_id % 50 = 0
UNION ALL SELECT 'stream_only', * REPLACE (value_bucket + 100 AS value_bucket) FROM ({_PIPE_SQL}) WHERE event_id % 50 = 0""")
def q_skew_check(spark, sf):
    """The fitted pipeline run as a batch job and as a stream over the
    same files. A control: the serving side shifts the bucket of every fiftieth
    event, and exactly those rows come out, from either side."""
    from ..streaming.skew import serving_skew
    ev = _events(spark, sf)
    fitted = PL.fit(PIPELINE, ev)
    src = scratch_path(spark, "skew-src")
    ev.write.parquet(src)
    faulty = F.when(F.col("event_id") % 50 == 0, F.col("value_bucket") + 100).otherwise(F.col("value_bucket"))
    diff = serving_skew(spark, src, ev.schema, lambda d: _pipe_out(fitted.transform(d)), scratch_path(spark, "skew-out"),
                        serving=lambda d: _pipe_out(fitted.transform(d)).withColumn("value_bucket", faulty))
    return diff.select("side", *PIPE_COLS)


@query("quantile_buckets", """
WITH c AS (SELECT quantile_disc(value, [0.25, 0.5, 0.75]) AS q FROM events)
SELECT event_id, CASE WHEN value IS NOT NULL THEN len(list_filter(q, lambda x: x <= value)) END::INTEGER AS bucket
FROM events, c""")
def q_quantile_buckets(spark, sf):
    """B05, quantile variant: quarters of the value range by count."""
    ev = _events(spark, sf)
    return FT.apply_quantile_buckets(ev, FT.quantile_cuts(ev, "value", 4, 1_000_000), "value", "bucket").select("event_id", "bucket")


@query("quantile_exact", """
WITH l AS (SELECT CASE WHEN l_orderkey % 11 <> 0 THEN l_extendedprice * (l_linenumber - 4) END AS signed, l_orderkey, CAST(l_quantity AS DECIMAL(12, 2)) AS l_quantity FROM lineitem),
q AS (SELECT unnest([0, 0.001, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.999, 1]) AS q,
  unnest((SELECT quantile_disc(signed, [0, 0.001, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.999, 1]) FROM l)) AS signed,
  unnest((SELECT quantile_disc(l_orderkey, [0, 0.001, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.999, 1]) FROM l)) AS orderkey,
  unnest((SELECT quantile_disc(l_quantity, [0, 0.001, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.999, 1]) FROM l)) AS quantity)
SELECT CAST(q AS DOUBLE) AS q, signed, CAST(orderkey AS BIGINT) AS orderkey, CAST(quantity AS DOUBLE) AS quantity FROM q""")
def q_quantile_exact(spark, sf):
    """Exact quantiles of a double column of both signs with nulls, of a long and of a decimal column."""
    prep(spark)
    li = table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 11 != 0, F.col("l_extendedprice") * (F.col("l_linenumber") - 4)).alias("signed"),
        "l_orderkey", F.col("l_quantity").cast("decimal(12,2)").alias("l_quantity"))
    qs = [0.0, 0.001, *[i / 10 for i in range(1, 10)], 0.999, 1.0]
    got = zip(qs, *(exact_quantiles(li, c, qs) for c in ("signed", "l_orderkey", "l_quantity")))
    return spark.createDataFrame([(q, a, b, None if c is None else float(c)) for q, a, b, c in got],
                                 "q double, signed double, orderkey long, quantity double")


@query("quantile_buckets_exact", """
WITH c AS (SELECT quantile_disc(l_extendedprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(len(list_filter(q, lambda x: x <= l_extendedprice)) AS INTEGER) AS bucket
FROM lineitem, c""")
def q_quantile_buckets_exact(spark, sf):
    """B05, quantile variant with exact cuts: tenths of the price."""
    prep(spark)
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return FT.apply_quantile_buckets(li, FT.exact_quantile_cuts(li, "l_extendedprice", 10), "l_extendedprice", "bucket")
