"""Exact order statistics by rounds of histogram refinement.

No sort and no shuffle of values. A round counts, for each interval that still
holds a wanted rank, the values in up to ``BINS`` bins of it, with each bin's
smallest and largest value; the bin where the rank falls is the next interval. It ends when
an interval's smallest and largest value are one. The first round of doubles
bins by sign and power of two, so a later one works within one binade: 52 bits, at
most five rounds of 4,096 bins, whatever the distribution. Exact numbers (integers, decimals) are
divided evenly from the start.

The driver holds counts only: at most ``BINS`` rows for each different open interval. Each round
reads the column once, after the first only values inside open intervals.
"""

from __future__ import annotations

import math
from decimal import Context, Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 4096
_INF, _NAN = 5000, 6000        # beyond all exponents of doubles


def _same(a, b) -> bool:
    return a == b or (a != a and b != b)


def _binade(x: Column) -> Column:
    """An integer that never falls as x rises: sign and power of two."""
    power = F.floor(F.log2(F.abs(x))).cast("int") + F.lit(2000)
    return (F.when(F.isnan(x), _NAN).when(x == float("inf"), _INF).when(x == float("-inf"), -_INF)
            .when(x == 0, 0).when(x > 0, power).otherwise(-power))


def _even(x: Column, lo, hi, double: bool) -> Column:
    """The bin of x when [lo, hi] is divided evenly; lo is in the first, hi in the last."""
    if double:
        # halves: the difference of two doubles may be past the largest
        return F.floor((x / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2) * F.lit(float(BINS - 1))).cast("int") \
            if hi / 2 - lo / 2 > 0 else (x > F.lit(lo)).cast("int")
    # whole numbers of a scaled decimal: the step is at least one unit, so lo and hi part
    step = max(1, -(-(hi - lo + 1) // BINS))
    return F.expr(f"cast((__u - {lo}BD) div {step}BD as int)")


def exact_quantiles(df: DataFrame, col: str, qs: list[float]) -> list:
    """The values at quantiles ``qs`` (0 to 1) of a numeric column, as SQL's ``quantile_disc``
    gives them: the smallest value with at least a share q of the non-null rows at or below it (rank
    max(1, ceil(q n))). q counts as the decimal that it is written as. Nulls do not count; NaN
    is the largest value; -0.0 is 0.0. Without values every result is None."""
    if any(not 0 <= q <= 1 for q in qs):
        raise ValueError("quantiles lie between 0 and 1")
    kind = df.schema[col].dataType
    double = isinstance(kind, (T.DoubleType, T.FloatType))
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    if not double and not isinstance(kind, (T.IntegralType, T.DecimalType)):
        raise TypeError(f"{col} is not numeric")
    if isinstance(kind, T.DecimalType) and kind.precision + scale > 36:
        raise TypeError("a decimal's digits and decimal places are at most 36 together")
    rows = df.where(F.col(col).isNotNull()).select(F.col(col).alias("x"))
    if double:
        rows = rows.select((F.col("x").cast("double") + F.lit(0.0)).alias("x"))
    else:      # the unscaled integer
        rows = rows.select(F.col("x"), (F.col("x").cast(f"decimal({kind.precision if isinstance(kind, T.DecimalType) else 19}, {scale})")
                                        * F.lit(10 ** scale).cast(f"decimal({scale + 1}, 0)")).cast("decimal(38, 0)").alias("__u"))
    value = "x" if double else "__u"
    x = F.col(value)

    def count(grid: Column, outer: Column, source: DataFrame) -> dict:
        """interval → its bins from below: (rows, smallest, largest)"""
        out: dict = {}
        for r in (source.groupBy(outer.alias("o"), grid.alias("g"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).collect()):
            lo, hi = (r.lo, r.hi) if double else (int(r.lo), int(r.hi))
            out.setdefault(r.o, []).append((r.g, r.n, lo, hi))
        return {o: [b[1:] for b in sorted(bins)] for o, bins in out.items()}

    def descend(rank: int, bins: list) -> tuple:
        """(rank within, smallest, largest) of the bin that holds ``rank``"""
        for n, lo, hi in bins:
            if rank <= n:
                return rank, lo, hi
            rank -= n
        raise AssertionError("an interval holds its rank")

    first = count(_binade(x) if double else F.lit(0), F.lit(0), rows).get(0, [])
    total = sum(n for n, _, _ in first)
    if not total:
        return [None] * len(qs)
    state = [descend(max(1, math.ceil(Fraction(str(q)) * total)), first) for q in qs]
    while open_ := sorted({(lo, hi) for _, lo, hi in state if not _same(lo, hi)}):
        outer = grid = None       # open intervals do not overlap
        for i, (lo, hi) in enumerate(open_):
            inside = x.between(F.lit(lo), F.lit(hi)) if double else F.expr(f"__u between {lo}BD and {hi}BD")
            cell = _even(x, lo, hi, double)
            outer = F.when(inside, i) if outer is None else outer.when(inside, i)
            grid = F.when(inside, cell) if grid is None else grid.when(inside, cell)
        low, high = open_[0][0], open_[-1][1]
        near = rows.where(x.between(F.lit(low), F.lit(high)) if double else F.expr(f"__u between {low}BD and {high}BD"))
        bins = count(grid, outer, near.where(outer.isNotNull()))
        state = [s if _same(s[1], s[2]) else descend(s[0], bins[open_.index(s[1:])]) for s in state]
    found = [lo for _, lo, _ in state]
    if double:
        return found
    return [Decimal(v).scaleb(-scale, Context(prec=60)) for v in found] if isinstance(kind, T.DecimalType) else found
