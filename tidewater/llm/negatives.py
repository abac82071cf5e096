"""Hard negatives by angular triangle filtering.

Every row stores its angles to ``DIRECTIONS`` reference directions. For an anchor at
angles a_r and a row at b_r, the angle between the two lies within

    max_r |a_r - b_r|  and  min_r min(a_r + b_r, 2 pi - a_r - b_r),

so its cosine lies in an interval, and times both norms so does the score. Angles are
widened by ``SLACK`` and the products by their rounding, so the bounds hold for the
exact integer score. Blocks are cut from rows in order of their nearest direction and
the angle to it; a block's range of angles bounds all its rows at once. A pair is
scored in integers only if its bounds reach

1. an anchor's fifth best row of its own label so far (its positives), then
2. the score window of one of its positives, for rows of another label.

Directions are chosen from a bounded sample (``SAMPLE`` rows in hash order), each the
one farthest from those before it. They decide how much is scored, never the result.

Rows with a null label, id or vector, or a null or non-finite component, take no part;
zero and empty vectors do. Only vectors of equal length meet. Rows that share an id are
different rows, repeated rows too: each can be anchor, positive and negative. Ties go to
the smaller id. An anchor without positives, or a positive without negatives in its
window (so every negative positive_score), gives no rows; nor does an empty table. Other
columns are not read. Scores beyond +-2^60 count as +-2^60.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import vector_blocks as V
from .common import load, materialise

FACTOR = 256
DIRECTIONS = 16
SAMPLE = 2000             # rows from which directions are chosen
SLACK = 1e-5              # radians: stored as float32, arc cosines of rounded sums


def _unit(codes):
    """Directions of integer vectors, and their norms; zero vectors stay zero."""
    import numpy as np

    v = codes.astype(np.float64)
    v = v / np.maximum(np.abs(v).max(axis=1, keepdims=True, initial=0), 1.0)   # squares of huge components
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(norm == 0, 1.0, norm)


def _norms(codes):
    import numpy as np

    v = codes.astype(np.float64)
    top = np.maximum(np.abs(v).max(axis=1, initial=0), 1.0)
    # two norms of 1e150 already give bounds beyond the largest score, or 0
    return np.minimum(np.sqrt(((v / top[:, None]) ** 2).sum(axis=1)) * np.minimum(top, 1e150), 1e150)


def directions(rows: DataFrame, factor: int = FACTOR, count: int = DIRECTIONS, sample: int = SAMPLE) -> dict:
    """{dim: directions} for the vector lengths of a bounded sample of ``rows``."""
    import numpy as np

    picked = rows.orderBy(F.xxhash64("id", "vec"), "id").limit(sample).select("vec").collect()
    by_dim: dict = {}
    for r in picked:
        by_dim.setdefault(len(r.vec), []).append(r.vec)
    out = {}
    for dim, vecs in by_dim.items():
        if dim == 0:
            continue
        u = _unit(V.codes(np.array(vecs, np.float64), factor))
        u = u[(u != 0).any(axis=1)]
        chosen: list = []
        near = np.full(len(u), -2.0)
        while len(u) and len(chosen) < count and near.min() < 1 - 1e-9:
            at = int(near.argmin())
            chosen.append(u[at])
            near = np.maximum(near, u @ u[at])
        if chosen:
            out[dim] = np.array(chosen)
    return out


def angles_to(codes, refs):
    """Angles of integer vectors to ``refs`` (those of zero vectors mean nothing: their scores are 0)."""
    import numpy as np

    return np.arccos(np.clip(_unit(codes) @ refs.T, -1, 1)).astype("<f4")


def angle_blocks(rows: DataFrame, refs: dict, factor: int = FACTOR) -> DataFrame:
    """Stored blocks of ``rows`` with angles, cut in order of nearest direction and angle to it."""
    spark = rows.sparkSession

    def measure(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            ids, labels, flat, starts, lens = V.arrays(b)
            near, angle = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, np.float32)
            for dim in np.unique(lens):
                if dim in refs:
                    at = np.flatnonzero(lens == dim)
                    a = angles_to(V.codes(flat[starts[at][:, None] + np.arange(dim)], factor), refs[dim])
                    near[at], angle[at] = a.argmin(axis=1), a.min(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), b.column("vec"), pa.array(lens.astype(np.int32)),
                                              pa.array(near), pa.array(angle)], names=["id", "label", "vec", "dim", "near", "angle"])

    measured = materialise(rows.mapInArrow(measure, "id long, label long, vec array<double>, dim int, near int, angle float"), "neg-rows")
    # the hash lets equal vectors of a crowd fall to several tasks
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["dim", "near", "angle", F.xxhash64("id")]
    laid = measured.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "label", "vec")

    def add(batches: Iterator) -> Iterator:
        import numpy as np

        for b in batches:
            for r in b.to_pylist():
                if r["dim"] in refs:
                    v = np.frombuffer(r["vec"], "<f8").reshape(r["n"], r["dim"])
                    r["angle"] = angles_to(V.codes(v, factor), refs[r["dim"]]).tobytes()
                yield V.record([r])
    return materialise(V.pack(laid).mapInArrow(add, V.BLOCK), "neg-blocks")


def _cosines(low, high):
    """Cosine interval of an interval of angles, widened."""
    import numpy as np

    low = np.clip(low - SLACK, 0, np.pi)
    high = np.clip(high + SLACK, 0, np.pi)
    return np.cos(high), np.cos(low)


def _scores(cos_low, cos_high, qn, cn):
    """Bounds of integer scores: cosines times norms, the excess covering rounding."""
    import numpy as np

    size = qn[:, None] * cn[None, :]
    lower, upper = cos_low * size, cos_high * size
    slack = 1e-9 * size + 1
    return np.clip(lower - slack, -V.TOP, V.TOP), np.clip(upper + slack, -V.TOP, V.TOP)


def block_bounds(q, qn, c, cn):
    """Upper and lower score bounds of each query against all rows of a block."""
    import numpy as np

    if not c.angle.shape[1]:
        low, high = np.zeros(len(qn)), np.full(len(qn), np.pi)
    else:
        a, b0, b1 = q.angle.astype(np.float64), c.angle.min(axis=0).astype(np.float64), c.angle.max(axis=0).astype(np.float64)
        low = np.maximum(np.maximum(a - b1, b0 - a), 0).max(axis=1)
        high = np.minimum(a + b1, 2 * np.pi - a - b0).min(axis=1)
    cos_low, cos_high = _cosines(low, high)
    # a negative cosine is worst with the longest row, and a positive one best
    lower, upper = _scores(cos_low[:, None], cos_high[:, None], qn, np.array([cn.max()]))
    return np.minimum(lower[:, 0], -1.0), np.maximum(upper[:, 0], 1.0)


def pair_bounds(a, qn, c, cn):
    """Lower and upper score bounds of every pair."""
    import numpy as np

    low, high = np.zeros((len(qn), len(cn)), np.float32), np.full((len(qn), len(cn)), np.pi, np.float32)
    for r in range(c.angle.shape[1]):
        x, y = a[:, r, None], c.angle[None, :, r]
        total = x + y
        np.maximum(low, np.abs(x - y), out=low)
        np.minimum(high, np.minimum(total, np.float32(2 * np.pi) - total), out=high)
    return _scores(*_cosines(low.astype(np.float64), high.astype(np.float64)), qn, cn)


class _Scan:
    """Filters pairs of a tile by bounds and scores the rest."""

    def __init__(self, queries, k: int):
        self.q, self.k = queries, k
        self.norm = _norms(queries.codes)

    def wanted(self, at, lower, upper):
        """Which of the queries ``at`` (rows of the bounds) can use a score within the bounds."""
        raise NotImplementedError

    def eligible(self, at, c):
        raise NotImplementedError

    def take(self, i: int, scores, ids) -> None:
        raise NotImplementedError

    def add(self, c) -> None:
        import numpy as np

        cn = _norms(c.codes)
        lower, upper = block_bounds(self.q, self.norm, c, cn)
        near = np.flatnonzero(self.wanted(slice(None), lower[:, None], upper[:, None])[:, 0])
        for s in range(0, len(near), V.PART):
            at = near[s:s + V.PART]
            lower, upper = pair_bounds(self.q.angle[at], self.norm[at], c, cn)
            pairs = self.wanted(at, lower, upper) & self.eligible(at, c) & (self.q.row[at][:, None] != c.row[None, :])
            if not pairs.any():
                continue
            if pairs.mean() > 0.1:
                scores = V.products(self.q.codes[at], c.codes)
            else:
                scores = np.zeros(pairs.shape, np.int64)
                qi, ci = np.nonzero(pairs)
                scores[qi, ci] = V.pair_products(self.q.codes[at[qi]], c.codes[ci])
            for i in np.flatnonzero(pairs.any(axis=1)):
                self.take(at[i], scores[i, pairs[i]], c.id[pairs[i]])


class Positives(_Scan):
    """The best k rows of each query's own label."""

    def __init__(self, queries, k: int):
        import numpy as np

        super().__init__(queries, k)
        self.floor = np.full(len(queries.row), -np.inf)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries.row)

    def wanted(self, at, lower, upper):
        return upper >= self.floor[at][:, None]

    def eligible(self, at, c):
        return self.q.label[at][:, None] == c.label[None, :]

    def take(self, i, scores, ids):
        import numpy as np

        scores, ids = np.concatenate((self.best[i][0], scores)), np.concatenate((self.best[i][1], ids))
        keep = V.keep_best(scores, ids, self.k)
        self.best[i] = scores[keep], ids[keep]
        if len(keep) == self.k:
            self.floor[i] = scores[keep[-1]]

    def result(self):
        import numpy as np

        sizes = [len(s) for s, _ in self.best]
        return (np.repeat(self.q.row, sizes), np.concatenate([i for _, i in self.best]),
                np.concatenate([s for s, _ in self.best]))


class Negatives(_Scan):
    """The best k rows of other labels in each window of a query; state is the
    windows' upper ends (-1: none), one for each positive."""

    def __init__(self, queries, k: int):
        import numpy as np

        super().__init__(queries, k)
        self.high = queries.state
        # 80 * high <= 100 * score; a full window rises to its k-th score
        self.low = np.where(self.high >= 0, -((-4 * self.high) // 5), V.TOP + 1)
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.best = {(i, j): none for i, j in zip(*np.nonzero(self.high >= 0))}

    def wanted(self, at, lower, upper):
        import numpy as np

        out = np.zeros(lower.shape, bool)
        for j in range(self.high.shape[1]):
            out |= (upper >= self.low[at, j][:, None]) & (lower <= self.high[at, j][:, None])
        return out

    def eligible(self, at, c):
        return self.q.label[at][:, None] != c.label[None, :]

    def take(self, i, scores, ids):
        import numpy as np

        for j in range(self.high.shape[1]):
            ok = (scores >= self.low[i, j]) & (scores <= self.high[i, j])
            if ok.any():
                s, n = self.best[i, j]
                s, n = np.concatenate((s, scores[ok])), np.concatenate((n, ids[ok]))
                keep = V.keep_best(s, n, self.k)
                self.best[i, j] = s[keep], n[keep]
                if len(keep) == self.k:
                    self.low[i, j] = s[keep[-1]]

    def result(self):
        import numpy as np

        full = [(i, j, s, n) for (i, j), (s, n) in self.best.items() if len(s)]
        sizes = [len(s) for _, _, s, _ in full]
        cat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return (np.repeat(self.q.row[[i for i, *_ in full]], sizes), np.repeat([j for _, j, *_ in full], sizes),
                cat([n for *_, n in full]), cat([s for _, _, s, _ in full]))


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k best of the at most k rows that each task gave for a key."""
    order = W.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
    return found.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor, positives: int = 5, negatives: int = 5, factor: int = FACTOR,
                   groups: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` are (id long, label long, vec array<double>) without nulls or non-finite
    components; ``is_anchor`` picks anchors from an array of ids. Negatives are the
    best rows of another label that score from 80 to 100 % of the positive."""
    blocks = angle_blocks(rows, directions(rows, factor), factor)
    anchors = materialise(V.rows_of(blocks, is_anchor), "neg-anchors")
    asked = anchors.withColumn("state", F.array().cast("array<bigint>"))
    own = _first(V.meet(asked, blocks, lambda q: Positives(q, positives), "key long, vec_id long, score long", factor, groups),
                 ["key"], positives)
    own = materialise(own.select("key", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"),
                                 F.col("score").alias("positive_score")), "neg-positives")
    windows = own.groupBy("key").agg(*[F.max(F.when(F.col("place") == j, F.col("positive_score"))).alias(f"s{j}")
                                       for j in range(positives)])
    windows = windows.select("key", F.array(*[F.greatest(F.coalesce(f"s{j}", F.lit(-1)), F.lit(-1)).cast("long")
                                              for j in range(positives)]).alias("state"))
    asked = anchors.join(windows, "key")
    found = V.meet(asked, blocks, lambda q: Negatives(q, negatives), "key long, place int, vec_id long, score long", factor, groups)
    return (_first(found, ["key", "place"], negatives).join(own, ["key", "place"]).join(anchors.select("key", "query_id"), "key")
            .select(F.col("query_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
                    F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def labelled(df: DataFrame) -> DataFrame:
    """id, label, vec of the rows of ``df`` (vec_id, label, embedding) that take part;
    every seventh row's label is moved on by one."""
    v = F.col("embedding").cast("array<double>")
    label = F.col("label").cast("long")
    return (df.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
            .select(F.col("vec_id").cast("long").alias("id"),
                    F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), v.alias("vec"))
            .where(V.finite(F.col("vec"))))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five negatives for each of five positives of every hundredth vector of ``embeddings``."""
    return hard_negatives(labelled(load(spark, sf_dir, "embeddings")), lambda ids: ids % 100 == 0)


OP11_SQL = """
WITH v AS (SELECT row_number() OVER () AS rw, vec_id,
                  CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rw, a.vec_id AS anchor_id, a.label = c.label AS same, c.rw AS crw, c.vec_id,
             list_inner_product(a.e, c.e)::BIGINT AS score
      FROM v a JOIN v c ON a.rw <> c.rw AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY rw ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.rw, p.place ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.rw = p.rw AND NOT s.same AND p.place <= 5
       AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
