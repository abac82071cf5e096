"""Nearest neighbours by a block matrix join.

Vectors are packed into blocks of up to ``BLOCK`` rows: ids, the original
values, int8 codes with one scale for each vector, and the norm of what the
codes leave out. Query blocks and candidate blocks meet in tiles; a tile's
product of codes (exact: a sum of at most dim·127² stays below 2^24 in float32,
larger dims are summed in slices) gives every distance with a bound

    | d(q, x) - d(q̂, x̂) | <= |q - q̂| + |x - x̂|,

pairs whose lower bound is above the k-th best upper bound are dropped, the
rest are computed in double precision from the original values and go to each
query's heap. So the result is exact.

Tiles are dealt over a grid: candidate blocks to groups, query blocks to every
group, so no task holds more than a tile of queries and one candidate block at
a time. Each group gives k rows a query, and a second pass merges them.

Vectors null, empty, zero, or holding null or non-finite components, and rows
with a null id, take no part. Only vectors of equal length meet. Ties go to the
smaller id. With the row numbers of :func:`numbered` every row is a query or candidate of its
own, also where ids repeat: a query's candidates are all rows but itself, and two
queries of one id give a list each. Without them a row is known by its id: repeated ids are one
query, and no row with that id is its candidate.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise

BLOCK = 2048              # vectors in a block
QUERY_TILE = 8192         # queries that a task holds at once
SLICE = 512               # dims summed exactly in float32: 512 * 127 * 127 < 2^24

_BLOCK = "dim int, block long, n int, rows binary, ids binary, vecs binary, codes binary, scale binary, rest binary"


def _pack(rows, ids, vecs) -> dict:
    """One block: codes are round(v / scale), scale = max|v| / 127."""
    import numpy as np

    v = vecs.astype(np.float64)
    scale = np.abs(v).max(axis=1) / 127.0
    # components far below the least normal number would give a scale of 0
    scale[scale == 0] = np.finfo(np.float64).tiny
    codes = np.rint(v / scale[:, None]).clip(-127, 127).astype(np.int8)
    rest = np.sqrt(((v - codes * scale[:, None]) ** 2).sum(axis=1))
    return {"dim": v.shape[1], "n": len(ids), "rows": rows.tobytes(), "ids": ids.tobytes(), "vecs": v.tobytes(),
            "codes": codes.tobytes(), "scale": scale.tobytes(), "rest": rest.tobytes()}


def pack_blocks(vectors: DataFrame) -> DataFrame:
    """Blocks of the usable rows of ``vectors`` (id long, vec array<double>, perhaps row long)."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from pyspark import TaskContext
        at = TaskContext.get().partitionId() << 32
        names = ["dim", "block", "n", "rows", "ids", "vecs", "codes", "scale", "rest"]
        types = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 6
        for b in batches:
            ids = b.column("id").to_numpy(zero_copy_only=False).astype("<i8")
            keys = b.column("row").to_numpy(zero_copy_only=False).astype("<i8") if "row" in b.schema.names else ids
            col = b.column("vec")
            flat = col.flatten().to_numpy(zero_copy_only=False).astype("<f8")
            lens = np.diff(col.offsets.to_numpy())
            starts = np.concatenate(([0], np.cumsum(lens)[:-1])) if len(lens) else lens
            for dim in np.unique(lens):
                rows = np.flatnonzero(lens == dim)
                for s in range(0, len(rows), BLOCK):
                    r = rows[s:s + BLOCK]
                    block = _pack(keys[r], ids[r], flat[starts[r][:, None] + np.arange(dim)])
                    block["block"] = at
                    at += 1
                    yield pa.RecordBatch.from_arrays([pa.array([block[c]], t) for c, t in zip(names, types)], names=names)
    return vectors.mapInArrow(run, _BLOCK)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), v.alias("vec"))
            .where(finite & F.exists("vec", lambda x: x != 0)))


def numbered(vectors: DataFrame) -> DataFrame:
    """``vectors`` (as made by :func:`usable`), stored with a number for each row, by which queries
    taken from it are told from their candidates."""
    return materialise(vectors.withColumn("row", F.monotonically_increasing_id()), "ann-rows")


def _unpack(row: dict, vecs: bool = True) -> dict:
    import numpy as np

    n, dim = row["n"], row["dim"]
    return {"rows": np.frombuffer(row["rows"], "<i8"), "ids": np.frombuffer(row["ids"], "<i8"), "scale": np.frombuffer(row["scale"], "<f8"),
            "rest": np.frombuffer(row["rest"], "<f8"), "vecs": np.frombuffer(row["vecs"], "<f8").reshape(n, dim),
            "codes": np.frombuffer(row["codes"], np.int8).reshape(n, dim).astype(np.float32)}


def _exact(q, x):
    """Euclidean distance of row pairs, summed component by component."""
    import numpy as np

    total = np.zeros(len(q))
    for j in range(q.shape[1]):
        total += (q[:, j] - x[:, j]) ** 2
    return np.sqrt(total)


def _tile(q: dict, c: dict, k: int, best_s, best_i, rows) -> None:
    """Merge candidates ``c`` into the heaps (best_s, best_i)[rows] of queries ``q``."""
    import numpy as np

    dots = np.zeros((len(q["ids"]), len(c["ids"])))
    for s in range(0, q["codes"].shape[1], SLICE):
        dots += q["codes"][:, s:s + SLICE] @ c["codes"][:, s:s + SLICE].T
    dots *= q["scale"][:, None] * c["scale"][None, :]
    norm = lambda b: (b["codes"].astype(np.float64) ** 2).sum(axis=1) * b["scale"] ** 2
    qn, cn = norm(q), norm(c)
    near = np.sqrt(np.maximum(qn[:, None] + cn[None, :] - 2 * dots, 0))
    # quantisation error, and rounding of the squared terms above
    slack = q["rest"][:, None] + c["rest"][None, :] + 1e-6 * np.sqrt(qn[:, None] + cn[None, :])
    own = q["rows"][:, None] == c["rows"][None, :]
    upper = np.where(own, np.inf, near + slack)
    kth = best_s[rows, k - 1]
    if upper.shape[1] >= k:
        kth = np.minimum(kth, np.partition(upper, k - 1, axis=1)[:, k - 1])
    qi, ci = np.nonzero((near - slack <= kth[:, None]) & ~own)
    if not len(qi):
        return
    score = _exact(q["vecs"][qi], c["vecs"][ci])
    # pairs come in order of queries: each query's are one run
    starts = np.flatnonzero(np.diff(qi, prepend=-1))
    for i, lo, hi in zip(qi[starts], starts, [*starts[1:], len(qi)]):
        at = slice(lo, hi)
        s = np.concatenate((best_s[rows[i]], score[at]))
        n = np.concatenate((best_i[rows[i]], c["ids"][ci[at]]))
        keep = np.lexsort((n, s))[:k]
        best_s[rows[i]], best_i[rows[i]] = s[keep], n[keep]


def nearest(queries: DataFrame, candidates: DataFrame, k: int, groups: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest candidates of every query.

    Both inputs are (id, vec) as made by :func:`usable`, or both parts of one
    table of :func:`numbered`. ``groups`` is the number of candidate groups (default: the session's shuffle partitions).
    """
    spark = candidates.sparkSession
    groups = groups or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = materialise(pack_blocks(candidates), "ann-candidates")
    asked = materialise(pack_blocks(queries.repartition(F.col("id"))), "ann-queries")
    # a query tile is a run of query blocks holding about QUERY_TILE queries;
    # candidate blocks are copied once for each tile, query blocks once for each group
    held = asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tiles = max(1, -(-held // QUERY_TILE))
    tile = F.pmod(F.xxhash64("block"), F.lit(tiles)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (asked.select("*", tile.alias("tile"), F.lit(0).alias("side")).select("*", each(groups).alias("grp")))
    right = (blocks.select("*", F.lit(1).alias("side"), F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("grp"))
             .select(*blocks.columns, each(tiles).alias("tile"), "side", "grp").select(left.columns))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        out = ["row", "id", "vec_id", "score"]
        key, asked_now, best = None, [], None

        def flush():
            if not asked_now:
                return
            r, q, s, n = [], [], [], []
            for b, (bs, bi) in zip(asked_now, best):
                ok = np.isfinite(bs)
                r.append(np.repeat(b["rows"], ok.sum(axis=1)))
                q.append(np.repeat(b["ids"], ok.sum(axis=1)))
                s.append(bs[ok])
                n.append(bi[ok])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (r, q, n, s)], names=out)

        for b in batches:
            for row in b.to_pylist():
                now = (row["tile"], row["grp"], row["dim"])
                if now != key:
                    yield from flush()
                    key, asked_now, best = now, [], []
                got = _unpack(row)
                if row["side"] == 0:
                    asked_now.append(got)
                    best.append((np.full((row["n"], k), np.inf), np.zeros((row["n"], k), np.int64)))
                    continue
                for q, (bs, bi) in zip(asked_now, best):
                    for s in range(0, len(q["ids"]), 256):
                        part = {f: v[s:s + 256] for f, v in q.items()}
                        _tile(part, got, k, bs, bi, np.arange(s, min(s + 256, len(q["ids"]))))
        yield from flush()

    met = (left.unionByName(right).repartition(max(1, tiles * groups), "tile", "grp")
           .sortWithinPartitions("tile", "grp", "dim", "side", "block"))
    partial = met.mapInArrow(run, "row long, id long, vec_id long, score double")
    best = F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k)
    # k rows a query from each group: a bounded list
    return (partial.groupBy("row", "id").agg(best.alias("best"))
            .select(F.col("id").alias("query_id"), F.posexplode("best").alias("pos", "b"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
                    F.col("b.score").alias("score")))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows of ``embeddings`` for every hundredth vector."""
    vectors = numbered(usable(load(spark, sf_dir, "embeddings"), "vec_id", "embedding"))
    return nearest(vectors.where(F.col("id") % 100 == 0), vectors, 10)


OP9_SQL = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS own, vec_id, embedding::DOUBLE[] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.own, q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
      FROM v q JOIN v c ON q.own <> c.own AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""
