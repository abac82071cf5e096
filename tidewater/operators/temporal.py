"""Time features per key (B09-B11) built to survive a hot key.

A window partitioned by the entity key alone sends a key holding a third of
all rows to one task. Here every window is partitioned by (key, time
bucket) instead, and what a bucket needs from earlier buckets travels as a
small per-(key, bucket) aggregate joined back on unique keys:

* previous event / last event of a type: latest row of earlier buckets
  (window over the aggregated bucket table, one row per bucket);
* last-N-rows sums: a row's number in its key = carried bucket counts + its
  number in the bucket; blocks of consecutive numbers, each with the last
  N - 1 rows of the block before, are the window partitions;
* last-T-seconds sums: buckets of width T; each row is also copied into the
  next bucket as context, so a window over (key, bucket) sees [ts - T, ts].
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86400


def temporal_parts(ts: Column | str) -> list[Column]:
    """Hour and ISO weekday (Monday 1 … Sunday 7), day, month."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return [F.hour(t).alias("hour"), (F.weekday(t) + 1).alias("iso_weekday"),
            F.dayofmonth(t).alias("day"), F.month(t).alias("month")]


def _bucket(ts: str, width: int) -> Column:
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(width * 1_000_000)).cast("bigint")


def days_since(df: DataFrame, key: str, ts: str, tiebreak: str, event_col: str | None = None,
               event_value: str | None = None, bucket_seconds: int = DAY) -> DataFrame:
    """Whole days from the key's previous event (``days_since_prev``) and,
    when given, from its last earlier event with ``event_col = event_value``
    (``days_since_event``). Null when there is none."""
    b = "__b"
    d = df.withColumn(b, _bucket(ts, bucket_seconds))
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    is_ev = (F.col(event_col) == F.lit(event_value)) if event_col else F.lit(False)
    d = d.withColumn("__us", us).withColumn("__ev_us", F.when(is_ev, F.col("__us")))
    w = Window.partitionBy(key, b).orderBy("__us", tiebreak)
    d = (d.withColumn("__prev_in", F.lag("__us").over(w))
         .withColumn("__ev_in", F.max("__ev_us").over(w.rowsBetween(Window.unboundedPreceding, -1))))
    agg = d.groupBy(key, b).agg(F.max("__us").alias("__last"), F.max("__ev_us").alias("__ev_last"))
    wb = Window.partitionBy(key).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = agg.select(F.col(key).alias("__key"), F.col(b).alias("__b2"), F.max("__last").over(wb).alias("__prev_carry"),
                       F.max("__ev_last").over(wb).alias("__ev_carry"))
    # a null key is a partition like any other, as in SQL's windows
    j = d.join(carry, d[key].eqNullSafe(carry["__key"]) & d[b].eqNullSafe(carry["__b2"]), "left").drop("__key", "__b2")
    prev = F.coalesce("__prev_in", "__prev_carry")
    ev = F.coalesce("__ev_in", "__ev_carry")
    day_us = F.lit(DAY * 1_000_000)
    out = j.withColumn("days_since_prev", F.floor((F.col("__us") - prev) / day_us).cast("bigint"))
    if event_col:
        out = out.withColumn("days_since_event", F.floor((F.col("__us") - ev) / day_us).cast("bigint"))
    return out.drop(b, "__us", "__ev_us", "__prev_in", "__ev_in", "__prev_carry", "__ev_carry")


ROWS_PER_BLOCK = 4096     # rows of a key that one window partition holds (plus n - 1 of context)


def rolling_rows(df: DataFrame, key: str, order: list[str], value: str | list[str], n: int,
                 chunk: Column, prefix: str = "last") -> DataFrame:
    """B11 (rows): count, and sum / avg of each value column, over the key's
    last ``n`` rows (current included) in ``order``; nulls count as rows but
    not in sum and avg, as in SQL. ``chunk`` is a monotone bucket of the order
    (e.g. the hour) that bounds the windows that number a key's rows.

    Rows are numbered through the whole key (chunk counts carried forward plus
    the number inside the chunk) and dealt to blocks of ``ROWS_PER_BLOCK``
    numbers; the last n - 1 rows of a block also go into the next one as
    context. So every frame is summed directly, in a partition of bounded size.

    Output columns: ``{prefix}{n}_count`` and, per value column v,
    ``{prefix}{n}_sum`` / ``{prefix}{n}_avg`` for a single value, else
    ``{prefix}{n}_{v}_sum`` / ``{prefix}{n}_{v}_avg``.
    """
    values = [value] if isinstance(value, str) else list(value)
    d = df.withColumn("__chunk", chunk)
    d = d.withColumn("__rn", F.row_number().over(Window.partitionBy(key, "__chunk").orderBy(*order)))
    agg = d.groupBy(key, "__chunk").agg(F.count(F.lit(1)).alias("__cnt"))
    before = Window.partitionBy(key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = agg.select(F.col(key).alias("__key"), F.col("__chunk").alias("__chunk2"),
                       F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__before"))
    j = (d.join(carry, d[key].eqNullSafe(carry["__key"]) & d["__chunk"].eqNullSafe(carry["__chunk2"]), "left")
         .withColumn("__idx", F.col("__before") + F.col("__rn") - 1))
    size = max(ROWS_PER_BLOCK, n)
    block = F.floor(F.col("__idx") / size).cast("bigint")
    is_context = F.col("__idx") % size >= size - (n - 1)
    both = (j.withColumn("__block", F.explode(F.when(is_context, F.array(block, block + 1)).otherwise(F.array(block))))
            .withColumn("__real", F.col("__block") == block))
    w = Window.partitionBy(key, "__block").orderBy("__idx").rowsBetween(-(n - 1), 0)
    out = both.withColumn(f"{prefix}{n}_count", F.count(F.lit(1)).over(w))
    for v in values:
        tag = f"{prefix}{n}" if len(values) == 1 else f"{prefix}{n}_{v}"
        x = F.col(v).cast("double")
        out = out.withColumn(f"{tag}_sum", F.sum(x).over(w)).withColumn(f"{tag}_avg", F.avg(x).over(w))
    out = out.where("__real")
    return out.drop(*[x for x in out.columns if x not in df.columns and x.startswith("__")])


def rolling_range(df: DataFrame, key: str, ts: str, value: str, seconds: int,
                  prefix: str = "range", sub_buckets: int = 1) -> DataFrame:
    """B11 (time): count / sum / avg over rows of the key with
    ts in [ts - seconds, ts] (peers included, like SQL RANGE).

    Buckets of width seconds / ``sub_buckets``; every row also goes, as
    context, into the next ``sub_buckets`` buckets, so a window over
    (key, bucket) sees everything in range. More sub-buckets = smaller
    window partitions for a hot key, at (k + 1)× rows through the shuffle.
    """
    k = max(1, int(sub_buckets))
    width_us = seconds * 1_000_000
    b_us = max(1, width_us // k)
    d = df.withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp")))
    d = d.withColumn("__b0", F.floor(F.col("__us") / F.lit(b_us)).cast("bigint"))
    both = (d.select("*", F.explode(F.sequence(F.lit(0), F.lit(k))).alias("__off"))
            .withColumn("__b", F.col("__b0") + F.col("__off"))
            .withColumn("__real", F.col("__off") == 0))
    w = Window.partitionBy(key, "__b").orderBy("__us").rangeBetween(-width_us, 0)
    out = (both.withColumn(f"{prefix}{seconds}_count", F.count(F.lit(1)).over(w))
           .withColumn(f"{prefix}{seconds}_sum", F.sum(F.col(value).cast("double")).over(w))
           .withColumn(f"{prefix}{seconds}_avg", F.avg(F.col(value).cast("double")).over(w))
           .where("__real"))
    return out.drop("__us", "__b0", "__off", "__b", "__real")
