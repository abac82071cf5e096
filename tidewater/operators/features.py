"""Feature operators over DataFrames.

Fitting means aggregating into a *small* state table (one row per category
or one global row); applying means joining that state back. Joins against
state let Spark pick a broadcast when the state is small (AQE measures it at
run time) and a shuffle join when a category set is large, so no state is
ever pulled to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles

from ..session import scratch_path

# --------------------------------------------------------------------- B01
_TS_TYPES = ("timestamp", "timestamp_ntz", "date")


def coerce(df: DataFrame, target: dict[str, str], flag: str | None = "coerce_errors") -> DataFrame:
    """Cast text columns to a declared schema; a value that does not
    cast becomes null and its column name is listed in ``flag``.

    Each cast is evaluated once (one projection keeps source and result);
    the flags are derived from those results.
    """
    casts = []
    for c in df.columns:
        if c not in target:
            continue
        t = target[c]
        src = F.col(f"`{c}`")
        if t in _TS_TYPES:
            v = F.try_to_timestamp(src)
            if t == "date":
                v = F.to_date(v)
            elif t == "timestamp_ntz":
                v = v.cast("timestamp_ntz")
        else:
            v = src.try_cast(t)
        casts.append((c, v))
    if not flag:
        done = dict(casts)
        return df.select(*[done[c].alias(c) if c in done else F.col(f"`{c}`") for c in df.columns])
    step = df.select("*", *[v.alias(f"__cast_{c}") for c, v in casts])
    errs = F.array_compact(F.array(*[
        F.when(F.col(f"`{c}`").isNotNull() & F.col(f"__cast_{c}").isNull(), F.lit(c)) for c, _ in casts]))
    done = {c for c, _ in casts}
    return step.select(*[F.col(f"__cast_{c}").alias(c) if c in done else F.col(f"`{c}`") for c in df.columns],
                       (errs if casts else F.array().cast("array<string>")).alias(flag))


# --------------------------------------------------------------------- B02
def check_rules(df: DataFrame, rules: dict[str, Column], reasons: str = "reasons") -> DataFrame:
    """Evaluate named boolean rules; ``reasons`` lists the failed ones
    (a rule evaluating to null counts as failed)."""
    fails = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    return df.withColumn(reasons, F.array_compact(F.array(*fails)))


def split_valid(checked: DataFrame, reasons: str = "reasons") -> tuple[DataFrame, DataFrame]:
    ok = F.size(reasons) == 0
    return checked.where(ok).drop(reasons), checked.where(~ok)


# ------------------------------------------------------------- B03 B04 B15
def _stats(df: DataFrame, col: str, by: list[str] | None, aggs: dict[str, Column]) -> DataFrame:
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(*[a.alias(n) for n, a in aggs.items()])


def _attach(df: DataFrame, stats: DataFrame, by: list[str] | None) -> DataFrame:
    if by:
        # a null group is a group like any other, as in SQL's PARTITION BY
        keyed = stats.withColumnsRenamed({b: f"__by_{b}" for b in by})
        same = [F.col(b).eqNullSafe(F.col(f"__by_{b}")) for b in by]
        return df.join(keyed, same, "left").drop(*[f"__by_{b}" for b in by])
    # one global row: a broadcast of exactly one row is bounded by construction
    return df.crossJoin(F.broadcast(stats))


def fit_minmax(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    return _stats(df, col, by, {f"{col}__min": F.min(col), f"{col}__max": F.max(col)})


def apply_minmax(df: DataFrame, state: DataFrame, col: str, out: str,
                 by: list[str] | None = None) -> DataFrame:
    """(x - min) / (max - min); 0 when max = min."""
    j = _attach(df, state, by)
    lo, hi = F.col(f"{col}__min"), F.col(f"{col}__max")
    v = F.when(hi == lo, F.lit(0.0)).otherwise((F.col(col) - lo) / (hi - lo))
    return j.withColumn(out, v).drop(f"{col}__min", f"{col}__max")


def invert_minmax(df: DataFrame, state: DataFrame, col: str, scaled: str, out: str,
                  by: list[str] | None = None) -> DataFrame:
    """Min + s * (max - min)."""
    j = _attach(df, state, by)
    lo, hi = F.col(f"{col}__min"), F.col(f"{col}__max")
    return j.withColumn(out, lo + F.col(scaled) * (hi - lo)).drop(f"{col}__min", f"{col}__max")


def fit_standard(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    return _stats(df, col, by, {f"{col}__mean": F.avg(col), f"{col}__sd": F.stddev_pop(col)})


def apply_standard(df: DataFrame, state: DataFrame, col: str, out: str,
                   by: list[str] | None = None) -> DataFrame:
    """(x - mean) / stddev_pop; 0 when the deviation is 0."""
    j = _attach(df, state, by)
    mu, sd = F.col(f"{col}__mean"), F.col(f"{col}__sd")
    v = F.when(sd == 0, F.lit(0.0)).otherwise((F.col(col) - mu) / sd)
    return j.withColumn(out, v).drop(f"{col}__mean", f"{col}__sd")


def invert_standard(df: DataFrame, state: DataFrame, col: str, scaled: str, out: str,
                    by: list[str] | None = None) -> DataFrame:
    j = _attach(df, state, by)
    return (j.withColumn(out, F.col(f"{col}__mean") + F.col(scaled) * F.col(f"{col}__sd"))
            .drop(f"{col}__mean", f"{col}__sd"))


# --------------------------------------------------------------------- B05
def bucketize(col: Column | str, cuts: list[float]) -> Column:
    """Index of the left-closed interval [cuts[i], cuts[i+1]) holding x;
    0 below the first cut, len(cuts) at or above the last; null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    out = F.lit(len(cuts))
    for i in range(len(cuts) - 1, -1, -1):
        out = F.when(c < F.lit(cuts[i]), F.lit(i)).otherwise(out)
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


def quantile_cuts(df: DataFrame, col: str, n: int, accuracy: int = 10000) -> DataFrame:
    """B05 quantile variant, fit side: one row with the n-1 inner cut points
    (``percentile_approx``: bounded memory per task at any size)."""
    qs = [i / n for i in range(1, n)]
    return df.agg(F.percentile_approx(col, qs, accuracy).alias(f"{col}__cuts"))


def exact_quantile_cuts(df: DataFrame, col: str, n: int) -> DataFrame:
    """As ``quantile_cuts``, with the exact values of ``quantile_disc`` (rounds of histogram refinement,
    see :mod:`.quantiles`). Null cuts, where the column has no values, are left out."""
    cuts = [q for q in exact_quantiles(df, col, [i / n for i in range(1, n)]) if q is not None]
    kind = df.schema[col].dataType.simpleString()
    return df.sparkSession.range(1).select(F.array(*[F.lit(q) for q in cuts]).cast(f"array<{kind}>").alias(f"{col}__cuts"))


def apply_quantile_buckets(df: DataFrame, cuts: DataFrame, col: str, out: str) -> DataFrame:
    j = df.crossJoin(F.broadcast(cuts))
    arr = F.col(f"{col}__cuts")
    idx = F.size(F.filter(arr, lambda q: q <= F.col(col)))
    return j.withColumn(out, F.when(F.col(col).isNull(), None).otherwise(idx)).drop(f"{col}__cuts")


# --------------------------------------------------------------------- B06
def fit_onehot(df: DataFrame, col: str, max_categories: int | None = None) -> list[str]:
    """B06 fit: sorted distinct categories. They become output columns; a
    caller who wants no more than so many can say so with ``max_categories``."""
    cats = [r[0] for r in df.select(F.col(col).cast("string")).where(F.col(col).isNotNull()).distinct().collect()]
    if max_categories is not None and len(cats) > max_categories:
        raise ValueError(f"{col}: more than {max_categories} categories for one-hot")
    return sorted(cats)


def apply_onehot(df: DataFrame, col: str, cats: list[str], prefix: str | None = None) -> DataFrame:
    """One int 0/1 column per fitted category; unseen → all 0."""
    p = prefix or f"{col}_"
    return df.select("*", *[F.when(F.col(col).cast("string") == F.lit(c), 1).otherwise(0)
                            .alias(f"{p}{c}") for c in cats])


def invert_onehot(df: DataFrame, col: str, cats: list[str], prefix: str | None = None) -> Column:
    """Category of the (single) set indicator; null when none is set."""
    p = prefix or f"{col}_"
    out = F.lit(None).cast("string")
    for c in reversed(cats):
        out = F.when(F.col(f"{p}{c}") == 1, F.lit(c)).otherwise(out)
    return out


# ------------------------------------------------------------------ B07 B08
def fit_target(df: DataFrame, cat: str, target: str, m: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """B07 fit: per category (n·mean + m·global) / (n + m); plus the global mean."""
    glob = df.agg(F.avg(target).alias("__global"))
    per = df.groupBy(cat).agg(F.count(target).alias("__n"), F.avg(target).alias("__mean"))
    enc = (per.crossJoin(F.broadcast(glob))
           .select(cat, ((F.col("__n") * F.col("__mean") + F.lit(m) * F.col("__global"))
                         / (F.col("__n") + F.lit(m))).alias(f"{cat}__te")))
    return enc, glob


def apply_target(df: DataFrame, enc: DataFrame, glob: DataFrame, cat: str, out: str) -> DataFrame:
    """Joined encoding; null is a category like any other, unseen category → global mean."""
    e = enc.withColumnRenamed(cat, "__cat")
    j = df.join(e, df[cat].eqNullSafe(e["__cat"]), "left").drop("__cat").crossJoin(F.broadcast(glob))
    return j.withColumn(out, F.coalesce(F.col(f"{cat}__te"), F.col("__global"))).drop(
        f"{cat}__te", "__global")


def fit_frequency(df: DataFrame, cat: str) -> DataFrame:
    """B08 fit: count / total per category (partial aggregation; the total is
    a second aggregate over the small per-category table)."""
    per = df.groupBy(cat).agg(F.count(F.lit(1)).alias("__c"))
    tot = per.agg(F.sum("__c").alias("__t"))
    return per.crossJoin(F.broadcast(tot)).select(cat, (F.col("__c") / F.col("__t")).alias(f"{cat}__freq"))


def apply_frequency(df: DataFrame, freq: DataFrame, cat: str, out: str) -> DataFrame:
    """Joined frequency; null is a category like any other, an unseen one has 0."""
    f = freq.select(F.col(cat).alias("__cat"), F.col(f"{cat}__freq").alias("__freq"))
    return (df.join(f, df[cat].eqNullSafe(f["__cat"]), "left")
            .withColumn(out, F.coalesce(F.col("__freq"), F.lit(0.0))).drop("__cat", "__freq"))


# ------------------------------------------------------------------ B12 B13
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokenize(text: Column | str) -> Column:
    """Lowercase, split on runs of non-letters/digits, drop empties."""
    t = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(t), TOKEN_SPLIT), "")


def tfidf(docs: DataFrame, id_col: str, tokens: str) -> DataFrame:
    """Per (doc, term): tf = count / doc length, idf = ln((1+N)/(1+df)) + 1.

    Exact (no hashing). A document is one row, so its terms are counted inside
    the row: the sorted tokens' runs begin where a token differs from the one
    before, and a run's length is the distance to the next beginning. No
    shuffle by document. The (doc, term) rows are stored once and used for both the
    document counts and the join back on ``term``; AQE broadcasts the idf table
    when the vocabulary is small and splits hot-term partitions otherwise.
    """
    n = F.size("__t")
    begins = F.filter(F.transform("__t", lambda x, i: F.when((i == 0) | (x != F.element_at("__t", F.greatest(i, F.lit(1)))), i)),
                      lambda i: i.isNotNull())
    runs = F.transform("__b", lambda i, k: F.struct(
        F.element_at("__t", i + 1).alias("term"),
        (F.coalesce(F.try_element_at("__b", k + 2), n) - i).alias("cnt")))
    rows = (docs.select(id_col, F.array_sort(tokens).alias("__t")).withColumn("__b", begins)
            .select(id_col, n.alias("__len"), F.explode(runs).alias("__r")))
    tf = rows.select(id_col, F.col("__r.term").alias("term"), F.col("__r.cnt").alias("__cnt"), "__len")
    path = scratch_path(docs.sparkSession, "tfidf-terms")
    tf.write.parquet(path)
    tf = docs.sparkSession.read.schema(tf.schema).parquet(path)
    n_docs = docs.select(id_col).agg(F.count(F.lit(1)).alias("__N"))
    df_ = tf.groupBy("term").agg(F.count(F.lit(1)).alias("__df"))
    idf = df_.crossJoin(F.broadcast(n_docs)).select(
        "term", (F.log((1 + F.col("__N")) / (1 + F.col("__df"))) + 1).alias("idf"))
    out = tf.join(idf, "term")
    return out.select(id_col, "term", (F.col("__cnt") / F.col("__len")).alias("tf"), "idf",
                      (F.col("__cnt") / F.col("__len") * F.col("idf")).alias("tfidf"))
