"""Exact top-k search by distributed histogram selection.

Every round scores all rows against all open queries and counts the scores in
``BINS`` equal bins of each query's interval, first the whole range that norms
allow. The counts, summed over tasks, tell which bin holds the query's k-th score;
that bin is the next round's interval. A query closes when its bin is one value
wide, or when at most ``ENOUGH`` * k rows lie at or above the bin's lower end. Then
one pass keeps what reaches that end, and ties go to the smaller id.

A task leaves out bins below its own k-th score: the k-th of all rows cannot lie
below the k-th of some. For the same reason the last pass takes at most k rows of
a query from a task. Nothing is dropped by either, and a crowd of equal scores
never travels.

Scores are not stored (their number is queries times rows); a round computes them
again, block by block.

Rows whose vector is null or holds null or non-finite components, and rows with a
null id, take no part; zero and empty vectors do. Only vectors of equal length meet.
Rows that share an id are different rows: each is a candidate of the other, and each
is a query of its own if its id is one. Repeated rows are all returned. A query with
fewer than k candidates gets all of them; an empty table gives no rows. Other
columns of the table are not read. Scores beyond +-2^60 count as +-2^60.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import vector_blocks as V
from .common import load, materialise

BINS = 256
ENOUGH = 4
FACTOR = 1024


class Histogram:
    """Counts of a tile's scores by query and bin; state is (lo, width)."""

    def __init__(self, queries, k: int):
        import numpy as np

        self.q, self.k = queries, k
        self.counts = np.zeros((len(queries.row), BINS), np.int64)

    def add(self, c) -> None:
        import numpy as np

        for s in range(0, len(self.q.row), V.PART):
            part = slice(s, s + V.PART)
            lo, width = self.q.state[part, 0], self.q.state[part, 1]
            bins = (V.products(self.q.codes[part], c.codes) - lo[:, None]) // width[:, None]
            ok = (bins >= 0) & (bins < BINS) & (self.q.row[part][:, None] != c.row[None, :])
            flat = (bins + BINS * np.arange(len(lo))[:, None])[ok]
            self.counts[part] += np.bincount(flat, minlength=BINS * len(lo)).reshape(-1, BINS)

    def result(self):
        import numpy as np

        # from the top, the bins before which fewer than k scores were met
        above = np.cumsum(self.counts[:, ::-1], axis=1)[:, ::-1] - self.counts
        q, b = np.nonzero((self.counts > 0) & (above < self.k))
        return self.q.row[q], b, self.counts[q, b]


class Reached:
    """The tile's best k candidates at or above each query's lower end; state is (lo, width)."""

    def __init__(self, queries, k: int):
        import numpy as np

        n = len(queries.row)
        self.q, self.k = queries, k
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * n

    def add(self, c) -> None:
        import numpy as np

        for s in range(0, len(self.q.row), V.PART):
            part = slice(s, s + V.PART)
            scores = V.products(self.q.codes[part], c.codes)
            hits = (scores >= self.q.state[part, 0][:, None]) & (self.q.row[part][:, None] != c.row[None, :])
            for i in np.flatnonzero(hits.any(axis=1)):
                got, ids = self.best[s + i]
                got = np.concatenate((got, scores[i, hits[i]]))
                ids = np.concatenate((ids, c.id[hits[i]]))
                keep = V.keep_best(got, ids, self.k)
                self.best[s + i] = got[keep], ids[keep]

    def result(self):
        import numpy as np

        sizes = [len(s) for s, _ in self.best]
        return (np.repeat(self.q.row, sizes), np.concatenate([i for _, i in self.best]),
                np.concatenate([s for s, _ in self.best]))


def _ranges(queries: DataFrame, blocks: DataFrame, factor: int) -> DataFrame:
    """key, lo, width: a range that holds every score of the query, from norms."""
    def norms(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            out = []
            for vec, dim, n in zip(b.column("vec"), b.column("dim").to_pylist(), b.column("n").to_pylist()):
                v = np.frombuffer(vec.as_py(), "<f8").reshape(n, dim)
                # |floor(factor x)| <= factor |x| + 1; the excess covers rounding
                with np.errstate(over="ignore"):
                    out.append(float((factor * np.sqrt((v * v).sum(axis=1)) + dim ** 0.5).max() * (1 + 1e-9)))
            yield pa.RecordBatch.from_arrays([b.column("dim"), b.column("at"), pa.array(out, pa.float64())],
                                             names=["dim", "at", "norm"])
    schema = "dim int, at long, norm double"
    # one number for each vector length
    most = blocks.mapInArrow(norms, schema).groupBy("dim").agg(F.max("norm").alias("most"))
    q = queries.mapInArrow(norms, schema)
    reach = F.least(F.ceil(F.least(F.col("norm") * F.col("most"), F.lit(float(V.TOP)))) + 1, F.lit(V.TOP))
    return (q.join(most, "dim").select(F.col("at").alias("key"), reach.cast("long").alias("reach"))
            .select("key", (-F.col("reach")).alias("lo"),
                    F.expr(f"(2 * reach + {BINS}) div {BINS}").alias("width")))


def top_k(blocks: DataFrame, queries: DataFrame, k: int, factor: int = FACTOR, groups: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every query. ``blocks`` are
    stored blocks of :func:`vector_blocks.pack`, ``queries`` single rows of them."""
    queries = materialise(queries, "topk-queries")
    state = materialise(_ranges(queries, blocks, factor).select("*", F.lit(0).cast("long").alias("above"),
                                                                F.lit(True).alias("open")), "topk-range")
    closed = []
    while True:
        asked = queries.join(state.select("key", F.array("lo", "width").alias("state")), "key")
        counts = V.meet(asked, blocks, lambda q: Histogram(q, k), "key long, bin long, n long", factor, groups)
        counts = counts.groupBy("key", "bin").agg(F.sum("n").alias("n"))
        # a query has at most BINS counts
        down = W.partitionBy("key").orderBy(F.col("bin").desc())
        met = counts.select("*", F.sum("n").over(down).alias("met")).join(state, "key")
        kth = (met.where(F.col("above") + F.col("met") >= k).groupBy("key")
               .agg(F.max_by(F.struct("bin", "n", "met", "lo", "width", "above"), "bin").alias("b")))
        # the k-th score lies in bin b; without one the query has fewer than k candidates
        width = F.col("b.width")
        lo = F.col("b.lo") + F.col("b.bin") * width
        reached = F.col("b.above") + F.col("b.met")
        new = state.select("key", "lo").join(kth, "key", "left").select(
            "key", F.coalesce(lo, F.col("lo")).alias("lo"), F.expr(f"coalesce((b.width + {BINS - 1}) div {BINS}, 1)").alias("width"),
            F.coalesce(reached - F.col("b.n"), F.lit(0)).alias("above"),
            (F.col("b").isNotNull() & (width > 1) & (reached > ENOUGH * k)).alias("open"))
        new = materialise(new, "topk-round")
        closed.append(new.where(~F.col("open")))
        state = new.where("open")
        if state.isEmpty():
            break
    ends = closed[0]
    for c in closed[1:]:
        ends = ends.unionByName(c)
    asked = queries.join(ends.select("key", F.array("lo", "width").alias("state")), "key")
    found = V.meet(asked, blocks, lambda q: Reached(q, k), "key long, vec_id long, score long", factor, groups)
    # at most k rows of a query from each group of blocks
    order = W.partitionBy("key").orderBy(F.col("score").desc(), "vec_id")
    best = found.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)
    return best.join(queries.select("key", "query_id"), "key").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products for every hundredth vector of ``embeddings``."""
    v = F.col("embedding").cast("array<double>")
    rows = (load(spark, sf_dir, "embeddings").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
            .select(F.col("vec_id").cast("long").alias("id"), F.lit(0).cast("long").alias("label"), v.alias("vec"))
            .where(V.finite(F.col("vec"))))
    blocks = materialise(V.pack(rows), "topk-blocks")
    return top_k(blocks, V.rows_of(blocks, lambda ids: ids % 100 == 0), 10)


OP12_SQL = """
WITH v AS (SELECT row_number() OVER () AS rw, vec_id,
                  list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.rw, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.rw <> c.rw AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rw ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""
