"""SimHash near-duplicates: documents linked at a few differing bits.

A fingerprint bit is 1 if it is set in more than half of the XXH64 hashes
(seed 42) of a text's word shingles, repeats included. Equal fingerprints are
one node from the start, so groups of copies of any size cost one row.

Candidates: with radius 3 two fingerprints agree on one of four 16-bit blocks,
and on one of four 12-bit parts of what remains, so every fingerprint is dealt
to 16 keys of 28 bits. A key with more than ``TILE`` fingerprints is split into
blocks, and every pair of blocks is a tile of its own: no candidate is lost and
no task gets an unbounded group. Inside a tile fingerprints are compared bit by
bit plane (see :mod:`bitslice`), and only links that join two parts not yet
connected are given out. :mod:`components` does the rest.

Null, empty and wordless texts have fingerprint 0 and are linked like any
other. A component's id is its smallest doc_id; null doc_ids count only if
there is no other, and then the id is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitslice import link
from .common import load, materialise, unused, utf8
from .components import components

SEED = 42
TILE = 1024
CHUNK = 1 << 16           # shingles whose bits are counted at once
ROWS = 8192               # sorted rows compared at once, up to the end of a key


def shingles(words: list[bytes], size: int) -> Iterator[bytes]:
    if len(words) <= size:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(words[k:] for k in range(size))))


def fingerprint(text: bytes, size: int) -> int:
    """The 64-bit SimHash of a UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()              # bytes: A-Z and ASCII white space only
    count = max(1, len(words) - size + 1) if words else 0
    if not count:
        return 0
    hashes = map(xxh64_intdigest, shingles(words, size), repeat(SEED))
    ones = np.zeros(64, np.int64)
    for at in range(0, count, CHUNK):
        part = np.fromiter(hashes, ">u8", min(CHUNK, count - at))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count).view(">u8")[0])


def fingerprints(docs: DataFrame, size: int = 3, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``fp``, the fingerprint as a signed long."""
    body = "__text"
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(body))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != body) + ", fp long"
    names = [*keep, "fp"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            fp = np.array([fingerprint(t, size) for t in utf8(b.column(body))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in range(len(keep))], pa.array(fp)], names=names)
    return kept.mapInArrow(run, schema)


def _keys(fp: str) -> str:
    """SQL: the 16 keys of a fingerprint: which block and part, and their bits."""
    out = []
    for block in range(4):
        value = f"(shiftrightunsigned({fp}, {16 * block}) & 65535L)"
        low = f"({fp} & {(1 << 16 * block) - 1}L)"
        high = "0L" if block == 3 else f"shiftleft(shiftrightunsigned({fp}, {16 * block + 16}), {16 * block})"
        rest = f"({low} | {high})"
        for part in range(4):
            bits = f"(shiftrightunsigned({rest}, {12 * part}) & 4095L)"
            out.append(f"({(block * 4 + part) << 28}L | shiftleft({value}, 12) | {bits})")
    return f"array({', '.join(out)})"


def sorted_groups(batches: Iterator, columns: list[str], rows: int) -> Iterator[list]:
    """Numpy columns of consecutive rows from key-sorted Arrow batches, about
    ``rows`` at a time, cut only where the first column changes."""
    held: list = []
    count = 0
    for b in batches:
        part = [b.column(c).to_numpy(zero_copy_only=False) for c in columns]
        if not len(part[0]):
            continue
        held.append(part)
        count += len(part[0])
        if count >= rows:
            whole = [np.concatenate(x) for x in zip(*held)]
            edges = np.flatnonzero(whole[0][1:] != whole[0][:-1]) + 1
            start = 0
            while len(edges) and count - start >= rows:
                cut = edges[np.searchsorted(edges, start + rows)] if edges[-1] >= start + rows else edges[-1]
                if cut <= start:
                    break
                yield [x[start:cut] for x in whole]
                start = cut
            held = [[x[start:] for x in whole]]
            count -= start
    if count:
        yield [np.concatenate(x) for x in zip(*held)]


def linked_in_keys(keyed: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect the fingerprints ``fp`` that share a ``key``
    and are at most ``radius`` bits apart: enough for the components, not all
    pairs. ``keyed`` has fp and key (longs)."""
    crowded = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile)
               .select("key", F.ceil(F.col("n") / tile).cast("int").alias("cuts")))
    own = F.pmod(F.xxhash64("fp"), F.coalesce("cuts", F.lit(1))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("cuts", F.lit(1)) - 1))
    tiles = (keyed.join(crowded, "key", "left").select("fp", "key", own.alias("x"), other.alias("y"))
             .select("fp", F.xxhash64("key", F.least("x", "y"), F.greatest("x", "y")).alias("tile")))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for keys, fp in sorted_groups(batches, ["tile", "fp"], ROWS):
            i, j = link(keys, fp.view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(fp[i]), pa.array(fp[j])], names=["a", "b"])

    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a tile hash shared by two tiles only adds comparisons
    return (tiles.repartition(parts, "tile").sortWithinPartitions("tile").select("tile", "fp")
            .mapInArrow(run, "a long, b long"))


def linked(nodes: DataFrame) -> DataFrame:
    """Links that connect the distinct fingerprints ``fp`` of ``nodes`` at most 3 bits apart."""
    return linked_in_keys(nodes.select("fp", F.explode(F.expr(_keys("fp"))).alias("key")), 3)


def _rooted(docs: DataFrame, size: int, text: str, doc_id: str, keep: tuple[str, ...]) -> DataFrame:
    """doc_id, the ``keep`` columns, fp, root (a fingerprint, one for each
    component) and component_id: one row for each row of ``docs``."""
    known = materialise(fingerprints(docs, size, text, (doc_id, *keep)), "fingerprints")
    nodes = materialise(known.groupBy("fp").agg(F.min(doc_id).alias("least_id")), "nodes")
    roots = components(linked(nodes))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    placed = materialise(placed, "placed")
    ids = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_fp = placed.join(ids, "root").select("fp", "root", "component_id")
    return known.join(by_fp, "fp").select(doc_id, *keep, "fp", "root", "component_id")


def group_near_copies(docs: DataFrame, size: int = 3, text: str = "text", doc_id: str = "doc_id",
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the ``keep`` columns, fp (signed long), component_id: one row
    for each row of ``docs``. component_id is not unique where doc_ids are
    null or repeat."""
    return _rooted(docs, size, text, doc_id, keep).drop("root")


def keep_one(docs: DataFrame, size: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest
    doc_id (nulls last), the smallest text hash among equals."""
    mark, = unused(docs, "text_mark")
    marked = docs.withColumn(mark, F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    grouped = _rooted(marked, size, text, doc_id, (mark,))
    first = grouped.groupBy("root").agg(
        F.min(F.struct(F.col(doc_id).isNull().alias("absent"), F.col(doc_id).alias("id"), F.col(mark).alias("m"))).alias("f"))
    chosen = first.select(F.col("f.id").alias("keep_id"), F.col("f.m").alias("keep_mark"))
    same = marked[doc_id].eqNullSafe(chosen["keep_id"]) & (marked[mark] == chosen["keep_mark"])
    return marked.join(chosen, same, "left_semi").dropDuplicates([doc_id, mark]).select(*[f"`{c}`" for c in docs.columns])


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = group_near_copies(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
