"""B29 over any two ranges of days from stored, mergeable sketches.

A sketch of a column and day is its counts by value bucket: powers of two cut into ``STEPS``
equal parts, by sign, so a bucket is at most 1/``STEPS`` of its values wide and at most some
thousand exist however many rows there are. Counts add up, so sketches merge
exactly, in any order. Bins are cut at bucket borders near the baseline's quantiles; the shares of
baseline and current rows in these bins are then exact, and only the cuts differ from
the true quantiles, by less than one bucket (1/64 of the value).

Sketches are stored by day; a day that is computed again replaces its own. Drift between two ranges reads
sketches only, never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .monitor import DRIFT_ALERT, EPS

STEPS = 64
_ZERO = 1100 * STEPS         # beyond the bucket of the smallest double
_INF, _NAN = 1 << 20, 1 << 21


def bucket(x: Column) -> Column:
    """The bucket of a number: an integer that never falls as x rises; 0 for 0, NaN last. A wrong last
    digit of the logarithm changes nothing: the part then counts from the neighbouring power."""
    size = F.abs(x)
    power = F.floor(F.log2(size))
    # in two factors: the smallest doubles lie beyond 2^-1022
    part = size / F.pow(F.lit(2.0), F.floor(power / 2)) / F.pow(F.lit(2.0), power - F.floor(power / 2))
    at = (power * STEPS + F.floor((part - 1) * STEPS) + _ZERO).cast("long")
    return (F.when(F.isnan(x), _NAN).when(size == float("inf"), F.when(x > 0, _INF).otherwise(-_INF))
            .when(x == 0, 0).when(x > 0, at).otherwise(-at).cast("long"))


def lower_edge(b: Column) -> Column:
    """The smallest absolute value of a positive bucket, with the bucket's sign."""
    at = F.abs(b) - _ZERO
    power = F.floor(at / STEPS)
    value = (1 + (at - power * STEPS) / STEPS) * F.pow(F.lit(2.0), F.floor(power / 2)) * F.pow(F.lit(2.0), power - F.floor(power / 2))
    return (F.when(b == 0, 0.0).when(F.abs(b) == _INF, float("inf")).when(b == _NAN, float("nan")).otherwise(value)) * F.when(b < 0, -1.0).otherwise(1.0)


def sketch_days(df: DataFrame, ts_col: str, columns: list[str]) -> DataFrame:
    """day (``yyyy-MM-dd``), column, bucket, n: the sketches of ``columns``, nulls left out. A null time
    is a day of its own, null. Counted in tasks before the shuffle."""
    rows = df.select(F.date_format(ts_col, "yyyy-MM-dd").alias("day"), F.explode(F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("x")) for c in columns])).alias("v"))
    return (rows.where("v.x is not null").groupBy("day", F.col("v.column").alias("column"), bucket(F.col("v.x")).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Store sketches by day; days that they hold replace those stored."""
    (sketches.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def merged(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """column, bucket, n of the days from ``first`` to ``last``."""
    return sketches.where(F.col("day").between(first, last)).groupBy("column", "bucket").agg(F.sum("n").alias("n"))


def bin_of(baseline: DataFrame, bins: int) -> DataFrame:
    """column, cut (from 1), bucket: the bucket where the i-th cut of ``bins`` equal parts of the baseline lies,
    the first one with at least i/bins of the rows at or below it. One column has some thousand buckets at most."""
    up = Window.partitionBy("column").orderBy("bucket")
    whole = Window.partitionBy("column")
    below = baseline.select("column", "bucket", F.sum("n").over(up).alias("upto"), F.sum("n").over(whole).alias("total"))
    cuts = below.select("*", F.explode(F.sequence(F.lit(1), F.lit(bins - 1))).alias("cut")).where(F.col("upto") * bins >= F.col("cut") * F.col("total"))
    return cuts.groupBy("column", "cut").agg(F.min("bucket").alias("bucket"))


def drift(sketches: DataFrame, baseline: tuple[str, str], current: tuple[str, str], bins: int = 10, eps: float = EPS) -> DataFrame:
    """Column, n_baseline, n_current, kl, alert: KL(P‖Q) of the current days P against the baseline days Q
    over ``bins`` parts of the baseline, each share floored at eps. ``bins`` is 2 or more. A column with no rows in the current
    days has a null kl and no alert; one with none in the baseline is left out."""
    base = merged(sketches, *baseline)
    cuts = bin_of(base, bins).groupBy("column").agg(F.array_sort(F.collect_list("bucket")).alias("cuts"))     # bins - 1 values
    both = base.select("*", F.lit(0).alias("side")).unionByName(merged(sketches, *current).select("*", F.lit(1).alias("side")))
    part = F.size(F.filter("cuts", lambda c: c < F.col("bucket")))
    shares = (both.join(cuts, "column").groupBy("column", part.alias("part"))
              .agg(F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("q"), F.sum(F.when(F.col("side") == 1, F.col("n")).otherwise(0)).alias("p")))
    whole = Window.partitionBy("column")
    p, q = (F.greatest(F.col(c) / F.when(F.sum(c).over(whole) > 0, F.sum(c).over(whole)), F.lit(eps)) for c in "pq")
    terms = shares.select("column", "p", "q", F.when(F.sum("p").over(whole) > 0, p * F.log(p / q)).alias("term"))
    out = terms.groupBy("column").agg(F.sum("q").alias("n_baseline"), F.sum("p").alias("n_current"), F.sum("term").alias("kl"))
    return out.withColumn("alert", F.when(F.col("kl") > DRIFT_ALERT, 1).otherwise(0))
