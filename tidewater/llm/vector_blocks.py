"""Integer vectors in blocks, for operators that score query rows against all rows.

A component x counts as floor(factor * x), x as double; a row's score against a
query is the integer inner product. Rows get a key of their own, ``row``, so that
rows with the same id stay apart. Scores beyond +-2^60 count as +-2^60.

Query rows and blocks of rows meet in a grid of tiles of queries and groups of
blocks (:func:`meet`): a task holds one tile and one block at a time, and its
number is given, not hashed, so no two cells share a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 18     # of vectors in a block
QUERY_TILE = 16384        # queries that a task holds at once
PART = 64                 # queries scored at once against a block
TOP = 1 << 60

BLOCK = ("dim int, at long, n int, row binary, id binary, label binary, vec binary, angle binary")
_FIELDS = ["dim", "at", "n", "row", "id", "label", "vec", "angle"]


def finite(vec: Column) -> Column:
    return F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def arrays(batch):
    """Ids, labels, flat values, starts and lengths of an (id, label, vec) batch."""
    import numpy as np

    col = batch.column("vec")
    off = col.offsets.to_numpy()
    flat = col.values.to_numpy(zero_copy_only=False).astype("<f8")
    get = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype("<i8")
    return get("id"), get("label"), flat, off[:-1].astype(np.int64), np.diff(off)


def block_rows(dim: int) -> int:
    return max(1, min(4096, BLOCK_BYTES // (8 * max(dim, 1))))


def record(rows: list[dict]):
    """Blocks as one Arrow batch."""
    import pyarrow as pa

    types = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(_FIELDS, types)], names=_FIELDS)


def pack(vectors: DataFrame) -> DataFrame:
    """Blocks of the rows of ``vectors`` (id long, label long, vec array<double>),
    each row with a key. Store the result: keys are drawn by partition."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np

        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        row = at = part << 40
        for b in batches:
            ids, labels, flat, starts, lens = arrays(b)
            for dim in np.unique(lens):
                rows = np.flatnonzero(lens == dim)
                for s in range(0, len(rows), block_rows(dim)):
                    r = rows[s:s + block_rows(dim)]
                    keys = row + np.arange(len(r), dtype="<i8")
                    row += len(r)
                    yield record([{"dim": int(dim), "at": at, "n": len(r), "row": keys.tobytes(), "id": ids[r].tobytes(),
                                   "label": labels[r].tobytes(), "angle": b"",
                                   "vec": flat[starts[r][:, None] + np.arange(dim)].tobytes()}])
                    at += 1
    return vectors.mapInArrow(run, BLOCK)


def rows_of(blocks: DataFrame, where: Callable) -> DataFrame:
    """Single-row blocks of the rows whose ids satisfy ``where``, with each one's ``key`` and id, ``query_id``."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                ids = np.frombuffer(r["id"], "<i8")
                for hit in np.array_split(np.flatnonzero(where(ids)), 1 + len(ids) // 256):
                    if not len(hit):
                        continue
                    angles = len(r["angle"]) // max(r["n"], 1)
                    cut = lambda c, w: [r[c][i * w:(i + 1) * w] for i in hit]
                    keys = np.frombuffer(r["row"], "<i8")[hit]
                    cols = [pa.array([r["dim"]] * len(hit), pa.int32()), pa.array(keys), pa.array([1] * len(hit), pa.int32()),
                            *[pa.array(cut(c, w), pa.binary()) for c, w in
                              (("row", 8), ("id", 8), ("label", 8), ("vec", 8 * r["dim"]), ("angle", angles))], pa.array(keys), pa.array(ids[hit])]
                    yield pa.RecordBatch.from_arrays(cols, names=[*_FIELDS, "key", "query_id"])
    return blocks.mapInArrow(run, BLOCK + ", key long, query_id long")


def codes(values, factor: int):
    """floor(factor * x): doubles where they hold all products and sums exactly, else Python integers."""
    import numpy as np

    with np.errstate(over="ignore"):
        out = np.floor(values * factor)
    if out.size and not np.abs(out).max() < 2.0 ** 26 / max(1, values.shape[1]) ** 0.5:
        exact = [int(x) * factor if abs(x) >= 2.0 ** 53 else int(np.floor(x * factor)) for x in values.ravel()]
        return np.array(exact, object).reshape(values.shape)
    return out


def products(q, c):
    """Integer inner products of the rows of ``q`` and ``c``, as long."""
    import numpy as np

    if q.dtype == object or c.dtype == object:
        out = q.astype(object) @ c.astype(object).T if q.shape[1] else np.zeros((len(q), len(c)), object)
        return np.clip(out, -TOP, TOP).astype(np.int64)
    return (q @ c.T).astype(np.int64)      # every sum stays below 2^52


def pair_products(q, c):
    """The same for pairs of rows."""
    import numpy as np

    if q.dtype == object or c.dtype == object:
        out = (q.astype(object) * c.astype(object)).sum(axis=1) if q.shape[1] else np.zeros(len(q), object)
        return np.clip(out, -TOP, TOP).astype(np.int64)
    return np.einsum("ij,ij->i", q, c).astype(np.int64)


class Rows:
    """Unpacked rows of equal dim: keys, ids, labels, codes, angles, and ``state`` as a table."""

    def __init__(self, blocks: list[dict], factor: int):
        import numpy as np

        dim, n = blocks[0]["dim"], sum(b["n"] for b in blocks)
        whole = lambda c, t: np.frombuffer(b"".join(b[c] for b in blocks), t)
        self.row, self.id, self.label = (whole(c, "<i8") for c in ("row", "id", "label"))
        self.vec = whole("vec", "<f8").reshape(n, dim)
        self.codes = codes(self.vec, factor)
        self.angle = whole("angle", "<f4").reshape(n, -1)
        states = [b["state"] for b in blocks if b.get("state") is not None]
        self.state = np.array(states, np.int64).reshape(len(states), len(states[0]) if states else 0)


def meet(queries: DataFrame, blocks: DataFrame, step: Callable, schema: str, factor: int,
         groups: int | None = None) -> DataFrame:
    """``step(tile)`` for each tile of ``queries`` (single-row blocks with ``key`` and
    state array<long>) in each group of ``blocks``: an object with ``add(rows)`` for a
    block and ``result()`` giving columns of ``schema`` (of int and long). Only equal dims meet."""
    spark = blocks.sparkSession
    n_blocks, n_queries = blocks.count(), queries.count()      # two numbers decide the grid
    groups = max(1, min(groups or int(spark.conf.get("spark.sql.shuffle.partitions")), n_blocks))
    tiles = max(1, -(-n_queries // QUERY_TILE))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # blocks number on within a partition and partitions start one apart, so the groups are even
    grp = F.pmod(F.shiftright("at", 40) + F.col("at").bitwiseAND((1 << 40) - 1), F.lit(groups)).cast("int")
    cell = (F.col("tile") * groups + F.col("grp")).cast("int").alias("cell")
    left = queries.select(*_FIELDS, "state", F.pmod(F.xxhash64("key"), F.lit(tiles)).cast("int").alias("tile"), each(groups).alias("grp"))
    right = (blocks.select(*_FIELDS, F.lit(None).cast("array<bigint>").alias("state"), grp.alias("grp"))
             .select(*_FIELDS, "state", each(tiles).alias("tile"), "grp"))
    both = left.select(*_FIELDS, "state", cell, F.lit(0).alias("side")).unionByName(
        right.select(*_FIELDS, "state", cell, F.lit(1).alias("side")))
    dealt = both.repartitionById(tiles * groups, "cell").sortWithinPartitions("cell", "dim", "side", "at")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = {"int": pa.int32(), "long": pa.int64()}
        arrow = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(",")])
        key, asked, tile = None, [], None

        def results():
            if tile is not None:
                cols = tile.result()
                if len(cols[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, arrow.types)], schema=arrow)

        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i].as_py() for c in (*_FIELDS, "state", "cell", "side")}
                if (now := (r["cell"], r["dim"])) != key:
                    yield from results()
                    key, asked, tile = now, [], None
                if r["side"] == 0:
                    asked.append(r)
                elif asked or tile:
                    if asked:
                        tile, asked = step(Rows(asked, factor)), []
                    tile.add(Rows([r], factor))
        yield from results()
    return dealt.mapInArrow(run, schema)


def keep_best(scores, ids, k: int):
    """Places of the k best: higher scores, then smaller ids."""
    import numpy as np

    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))[:k]
