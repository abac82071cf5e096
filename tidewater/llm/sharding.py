"""Sharding by histogram sort, with DataFrame functions only.

Documents are ordered by (60-bit text hash, doc_id), so equal texts are
neighbours, and rows equal in both by a number that they get when they are stored. The
splitters that cut this order into shards of equal bytes are
found by counting, not by sampling: a round counts the exact bytes and rows
below a grid of candidate boundaries, keeps for each splitter only the one
interval that holds its target, and divides that interval again, until every
interval is a single key (tolerance 0) or its bytes are within the tolerance.
Then the rows are exchanged once.

A hash that a third of all rows share is no special case: once an interval is
one hash, the rounds go on over doc_id, and once it is one doc_id over the stored number. So rows
repeated any number of times are cut like all others.

The driver holds at most ``GRID`` counts for each open splitter. The exchange
is by cells, row-count splitters found the same way, so a cell has about
rows / ``CELLS`` rows whatever the key distribution, and slots are numbered
inside a cell and offset by the counts of the cells before it.

Null text counts as empty; null doc_id sorts first; rows equal in text and
doc_id are ordered arbitrarily. A very long text is one row of its size, the smallest unit
of a cut. Columns of the input beside text and doc_id are not read, whatever their names.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import load, materialise, unused

HASH_BITS = 60
STEP_BITS = 12            # a round divides an interval into 4,096
GRID = 1 << STEP_BITS
CELLS = 64                # exchange cells beside the shard boundaries
ROW_BYTES = 8             # fixed size of a document beside its text
LEAST = -(1 << 63)


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body).cast("long") + F.lit(ROW_BYTES)).alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(body), 64 - HASH_BITS).alias("h"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST)).alias("d"),
        F.monotonically_increasing_id().alias("e"))


def _histogram(rows: DataFrame, grid: Column, outer: Column | None, where: Column | None) -> dict:
    """(outer interval, grid cell) → [bytes, rows], for the open intervals only."""
    rows = rows if where is None else rows.where(where)
    out: dict = {}
    for r in (rows.groupBy((F.lit(0).cast("long") if outer is None else outer).alias("o"), grid.alias("g"))
              .agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()):
        out.setdefault(r["o"], {})[r["g"]] = (r["b"], r["n"])
    return out


class _Search:
    """One splitter on its way: ``target`` twice the measure wanted below it,
    ``below`` the measure before its interval."""

    def __init__(self, target, weight: int):
        self.target, self.weight, self.below, self.key = target, weight, 0, 0
        self.done = None

    def descend(self, cells: dict) -> int:
        """The cell where the target lies: the last whose start is not past it."""
        at, grid = self.below, sorted(cells)
        for g in grid:
            m = cells[g][self.weight]
            if 2 * (at + m) > self.target or g == grid[-1]:
                self.below = at
                return g
            at += m
        raise AssertionError("an open interval has rows")


def find_splitters(rows: DataFrame, targets: list[tuple[float, int]], tolerance: float = 0.0) -> list[tuple[int, int, int]]:
    """Keys (h, d, e) such that rows below the i-th key have about targets[i]
    bytes (weight 0) or rows (weight 1).

    ``rows`` has h, d, e (the row's own number), size. With tolerance 0 a key is the first whose
    midpoint lies at or past the target, the nearest possible cut. A tolerance (in the
    target's unit) lets a search end at any probed boundary that close, which
    keeps groups of equal texts whole where that costs nothing.
    """
    found: list = [None] * len(targets)
    searches = {i: _Search(2 * t, w) for i, (t, w) in enumerate(targets)}

    def probe(open_: dict, bits_left: int, col: str, hashes: bool) -> None:
        """Refine all open searches by STEP_BITS of ``col``."""
        step = min(STEP_BITS, bits_left)
        shift = bits_left - step
        if hashes:
            outer = F.shiftrightunsigned("h", bits_left)
            where = None if bits_left == HASH_BITS else outer.isin([s.key for s in open_.values()])
            outer = None if bits_left == HASH_BITS else outer
            hist = _histogram(rows, F.shiftrightunsigned("h", shift), outer, where)
        for i, s in open_.items():
            cells = hist.get(s.key if bits_left != HASH_BITS else 0)
            s.key = s.descend(cells)
            m = cells[s.key][s.weight]
            for edge, at in ((s.key, s.below), (s.key + 1, s.below + m)):
                if tolerance and found[i] is None and abs(2 * at - s.target) <= 2 * tolerance:
                    found[i] = (edge << shift, LEAST, LEAST)

    bits = HASH_BITS
    while bits and (open_ := {i: s for i, s in searches.items() if found[i] is None}):
        probe(open_, bits, "h", True)
        bits -= min(STEP_BITS, bits)

    # one hash left for each open search: go on over doc_id within it, then over the row's number
    open_ = {i: s for i, s in searches.items() if found[i] is None}
    if not open_:
        return found
    prefix = {i: (s.key,) for i, s in open_.items()}
    for names in (("h", "d"), ("h", "d", "e")):
        prefix = _narrow(rows, open_, prefix, names)
    # a single row holds the target: cut before it if its midpoint is past the target
    h, d, e = zip(*prefix.values())
    last = {(r.h, r.d, r.e): (r.size, 1) for r in
            rows.where(F.col("h").isin(list(h)) & F.col("d").isin(list(d)) & F.col("e").isin(list(e)))
            .select("h", "d", "e", "size").collect()}
    for i, s in open_.items():
        h, d, e = prefix[i]
        found[i] = (h, d, e) if 2 * s.below + last[h, d, e][s.weight] >= s.target else (h, d, e + 1)
    return found


def _narrow(rows: DataFrame, open_: dict, prefix: dict, names: tuple) -> dict:
    """Each open search, whose interval is one value of all columns but the last of ``names``, down to one
    value of the last: rounds of ``GRID`` even parts of the values' range."""
    col = names[-1]
    values = {p: None for p in prefix.values()}
    within = None
    for p in values:
        here = _equal(names, p)
        within = here if within is None else within | here
    for r in (rows.where(within).groupBy(*names[:-1]).agg(F.min(col).alias("lo"), F.max(col).alias("hi")).collect()):
        values[tuple(r)[:-2]] = (r.lo, r.hi)
    span = {i: (p, *values[p]) for i, p in prefix.items()}
    while live := sorted({v for v in span.values() if v[1] != v[2]}):
        grid = outer = where = None
        for n, (p, lo, hi) in enumerate(live):
            width = (hi - lo) // GRID + 1
            # the difference may pass 63 bits when values span the whole range: decimal arithmetic
            step = F.floor((F.col(col).cast("decimal(20,0)") - F.lit(lo).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)")).cast("long") \
                if hi - lo >= 1 << 62 else F.expr(f"({col} - ({lo}L)) div {width}L")
            cond = _equal(names, p) & F.col(col).between(lo, hi)
            grid = F.when(cond, step) if grid is None else grid.when(cond, step)
            outer = F.when(cond, F.lit(n)) if outer is None else outer.when(cond, F.lit(n))
            where = cond if where is None else where | cond
        hist = _histogram(rows, grid, outer, where)
        for i, s in open_.items():
            if span[i] not in live:
                continue
            p, lo, hi = span[i]
            width = (hi - lo) // GRID + 1
            g = s.descend(hist[live.index(span[i])])
            span[i] = (p, lo + g * width, min(hi, lo + (g + 1) * width - 1))
    return {i: (*p, lo) for i, (p, lo, _) in span.items()}


def _equal(names: tuple, values: tuple) -> Column:
    cond = None
    for c, v in zip(names, values):
        cond = (F.col(c) == F.lit(v)) if cond is None else cond & (F.col(c) == F.lit(v))
    return cond


def _number_below(splitters: list[tuple[int, int, int]], hash_col: str = "h", id_col: str = "d", row_col: str = "e") -> Column:
    """How many splitters are at or below a row's key: a balanced tree of
    comparisons, so a row costs log2 of their number."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        h, d, e = splitters[mid]
        same = F.col(hash_col) == h
        low = (F.col(hash_col) < h) | (same & (F.col(id_col) < F.lit(d))) | (same & (F.col(id_col) == F.lit(d)) & (F.col(row_col) < F.lit(e)))
        return F.when(low, tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return tree(0, len(splitters))


def assign_shards(docs: DataFrame, shards: int, tolerance: float = 0.0, text: str = "text",
                  doc_id: str = "doc_id", name: str = "shards") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs``.

    Shards are consecutive ranges of (text hash, doc_id) with equal bytes, to
    the nearest document (or to ``tolerance`` bytes). Slots number a shard's
    rows from 0 in that order.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    rows = materialise(_keyed(docs, text, doc_id), name)
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not count:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    want = [(total * k / shards, 0) for k in range(1, shards)] + [(count * k / CELLS, 1) for k in range(1, CELLS)]
    keys = find_splitters(rows, want, tolerance)
    cuts = sorted(set(keys))
    bounds = sorted(keys[:shards - 1])
    # the shard of each cell between two neighbouring cuts
    shard_of, at = [], 0
    for c in [(-1, 0, 0), *cuts]:
        while at < len(bounds) and bounds[at] <= c:
            at += 1
        shard_of.append(at)
    placed = rows.withColumn("cell", _number_below(cuts))
    held = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    offset, seen = [], {}
    for cell, shard in enumerate(shard_of):
        offset.append(seen.get(shard, 0))
        seen[shard] = seen.get(shard, 0) + held.get(cell, 0)
    pick = lambda values, kind: F.element_at(F.array([F.lit(v).cast(kind) for v in values]), F.col("cell") + 1)
    order = Window.partitionBy("cell").orderBy("h", "d", "e")
    return (placed.withColumn("slot", F.row_number().over(order) - 1)
            .select("doc_id", "size", "text_crc32", pick(shard_of, "int").alias("shard"),
                    (F.col("slot") + pick(offset, "long")).alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int, tolerance: float = 0.0, text: str = "text",
                 doc_id: str = "doc_id", max_rows_per_file: int = 1_000_000) -> None:
    """Write ``docs`` to ``path`` with one folder for each shard, ``shard=N``
    (``shard_`` if the input has a column of that name)."""
    body = F.coalesce(F.col(text), F.lit(""))
    h, d, e, size, shard = unused(docs, "h", "d", "e", "size", "shard")
    # stored once with their numbers, by which repeated rows are told apart
    keyed = materialise(docs.withColumns({h: F.shiftrightunsigned(F.xxhash64(body), 64 - HASH_BITS),
                                          d: F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST)),
                                          e: F.monotonically_increasing_id(),
                                          size: F.octet_length(body).cast("long") + F.lit(ROW_BYTES)}), "shards")
    rows = keyed.select(F.col(h).alias("h"), F.col(d).alias("d"), F.col(e).alias("e"), F.col(size).alias("size"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    keys = sorted(find_splitters(rows, [(total * k / shards, 0) for k in range(1, shards)], tolerance)) if total else []
    (keyed.withColumn(shard, _number_below(keys, h, d, e)).drop(h, d, e, size).hint("rebalance", F.col(shard))
     .write.option("maxRecordsPerFile", max_rows_per_file).partitionBy(shard).parquet(path))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 of equal bytes."""
    out = assign_shards(load(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
