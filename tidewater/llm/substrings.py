"""Exact substring deduplication over windows of words.

Every window of ``length`` words of every document gets a Rabin-Karp hash
(64 bits, from 64-bit word hashes). Windows are dealt to buckets by their hash;
a bucket's task sorts its hashes and finds those that more than one task sent.
Repeated windows of a document merge into maximal intervals, and the words they
cover are removed.

What travels: tasks gather windows into units of up to ``UNIT`` windows, look
for repeats inside a unit on the spot, and send each different hash once for
a unit, as packed arrays for each bucket: 7 bytes of hash (the bucket number is
the rest of it) and the distance to the bucket's last window. So a passage that
a third of all documents hold costs one entry for a unit, whatever its count.
Back come the positions found elsewhere, to the unit, which also sent ahead the
list of its texts. Results are kept by text, since equal texts lose equal words.

Two different windows are taken for equal only if their 64-bit hashes meet.
Null and empty texts, and texts under ``length`` words, lose nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise, slices, utf8
from .wordhash import BREAKS, Words, class_table, window_hashes

LENGTH = 35
UNIT = 2_000_000          # windows in a unit: about 80 MB of work arrays
PER_BUCKET = 2_000_000    # windows aimed at for a bucket
LEAST_BUCKETS = 256       # from here on the rest of a hash fits seven bytes

_SENT = "bucket int, unit long, n int, body binary, gaps binary, wide int"
_NAMES = ["bucket", "unit", "n", "body", "gaps", "wide"]


def _types():
    import pyarrow as pa
    return [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32()]


def _batch(rows: list[tuple]):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _types())], names=_NAMES)


def _unit_rows(unit: int, marks: list[bytes], counts: np.ndarray, hashes: np.ndarray, buckets: int) -> list[tuple]:
    """The rows a unit sends: a list of its texts (bucket -1), and its windows."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    repeated = np.zeros(len(hashes), bool)
    repeated[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))
    first = np.sort(order[np.concatenate(([True], ~same))]) if len(order) else order
    rows = [(-1, unit, len(marks), b"".join(marks) + counts.astype("<i8").tobytes(), np.packbits(repeated).tobytes(), 0)]
    h = hashes[first]
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    bucket, at = bucket[by], first[by]
    body = np.ascontiguousarray((h[by] // np.uint64(buckets)).astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :7]
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else bucket
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
        gaps = np.diff(at[a:b], prepend=0)
        wide = 1 if (m := int(gaps.max())) < 1 << 8 else 2 if m < 1 << 16 else 4
        rows.append((int(bucket[a]), unit, b - a, body[a:b].tobytes(), gaps.astype(f"<u{wide}").tobytes(), wide))
    return rows


def _send(length: int, buckets: int):
    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext
        unit = TaskContext.get().partitionId() << 32
        marks, counts, hashes, held = [], [], [], 0
        is_word = class_table(BREAKS)

        def flush():
            rows = _unit_rows(unit, marks, np.array(counts, np.int64), np.concatenate(hashes), buckets)
            for at in range(0, len(rows), 256):
                yield _batch(rows[at:at + 256])

        for whole in batches:
            for b in slices(whole, "text", 2 << 20):
                w = Words(b.column("text"), is_word)
                found = window_hashes(w.hashes(), length)
                fits = w.room()[:len(found)] >= length
                if not fits.any():
                    continue
                n = np.maximum(np.diff(w.first) - length + 1, 0)
                for d in np.flatnonzero(n).tolist():
                    marks.append(b.column("mark")[d].as_py())
                    counts.append(int(n[d]))
                hashes.append(found[fits])
                held += int(n.sum())
                if held >= UNIT:
                    yield from flush()
                    unit += 1
                    marks, counts, hashes, held = [], [], [], 0
        if held:
            yield from flush()
    return run


def _count(batches: Iterator) -> Iterator:
    """Bucket by bucket: the positions, by unit, of windows that another unit has too."""
    def found(rows: list[dict]) -> list[tuple]:
        sizes = [r["n"] for r in rows]
        h = np.zeros((sum(sizes), 8), np.uint8)
        at = 0
        for r in rows:
            h[at:at + r["n"], :7] = np.frombuffer(r["body"], np.uint8).reshape(-1, 7)
            at += r["n"]
        h = h.view("<u8").ravel()
        order = np.argsort(h)
        ranked = h[order]
        same = ranked[1:] == ranked[:-1]
        hit = np.zeros(len(h), bool)
        hit[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))
        out, at = [], 0
        for r in rows:
            mine = hit[at:at + r["n"]]
            at += r["n"]
            if mine.any():
                where = np.cumsum(np.frombuffer(r["gaps"], f"<u{r['wide']}").astype(np.int64))[mine]
                out.append((r["bucket"], r["unit"], len(where), where.astype("<u4").tobytes(), b"", 4))
        return out

    rows, bucket = [], None
    for b in batches:
        for r in b.to_pylist():
            if r["bucket"] == -1:
                yield _batch([tuple(r[c] for c in _NAMES)])
                continue
            if r["bucket"] != bucket and rows:
                if out := found(rows):
                    yield _batch(out)
                rows = []
            bucket = r["bucket"]
            rows.append(r)
    if rows and (out := found(rows)):
        yield _batch(out)


def _intervals(length: int):
    """Unit by unit: each text's word ranges covered by repeated windows."""
    def made(texts: dict | None, hits: list[dict]) -> Iterator[tuple[bytes, bytes]]:
        n = texts["n"]
        counts = np.frombuffer(texts["body"], "<i8", n, 16 * n)
        total = int(counts.sum())
        flag = np.unpackbits(np.frombuffer(texts["gaps"], np.uint8))[:total].astype(bool)
        for r in hits:
            flag[np.frombuffer(r["body"], "<u4")] = True
        ends = np.cumsum(counts)
        for d in range(n):
            at = np.flatnonzero(flag[ends[d] - counts[d]:ends[d]])
            if not len(at):
                continue
            # windows that overlap or touch are one range
            new = np.concatenate(([True], np.diff(at) > length))
            starts = at[new]
            stops = at[np.concatenate((new[1:], [True]))] + length
            yield texts["body"][16 * d:16 * d + 16], np.column_stack((starts, stops)).astype("<i4").tobytes()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(texts, hits):
            if texts is not None and (rows := list(made(texts, hits))):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows)], names=["mark", "ranges"])

        texts, hits = None, []
        for b in batches:
            for r in b.to_pylist():
                if r["bucket"] == -1:
                    yield from out(texts, hits)
                    texts, hits = r, []
                else:
                    hits.append(r)
        yield from out(texts, hits)
    return run


def repeated_ranges(docs: DataFrame, length: int = LENGTH, buckets: int | None = None) -> DataFrame:
    """mark (md5 of the text, binary), ranges: for every different text with
    repeated windows, its word ranges as pairs of little-endian int32.

    ``docs`` has mark and text. ``buckets`` defaults to what the size asks for.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        buckets = max(LEAST_BUCKETS, 2 * parts, size // 6 // PER_BUCKET)
    if buckets < LEAST_BUCKETS:
        raise ValueError(f"at least {LEAST_BUCKETS} buckets are needed")
    parts = max(parts, buckets // 8)
    sent = docs.select("mark", "text").mapInArrow(_send(length, buckets), _SENT)
    # text lists go along with windows, spread by unit
    place = F.when(F.col("bucket") >= 0, F.col("bucket").cast("long")).otherwise(-1 - F.xxhash64("unit") % 1000003)
    counted = (sent.repartition(parts, place).sortWithinPartitions("bucket").select(*_NAMES).mapInArrow(_count, _SENT))
    back = counted.repartition(parts, "unit").sortWithinPartitions("unit", "bucket").select(*_NAMES)
    # copies of a text in several units give equal ranges
    return back.mapInArrow(_intervals(length), "mark binary, ranges binary").groupBy("mark").agg(F.max("ranges").alias("ranges"))


def _mark():
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", doc_id: str = "doc_id",
                   buckets: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept: the words left, joined by one space."""
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).withColumn("mark", _mark())
    # stored, so that the join exchanges both sides itself and can split a text that many rows share
    ranges = materialise(repeated_ranges(given, length, buckets), "repeated-ranges")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for whole in batches:
            for b in slices(whole, "text"):
                total, gone, kept = [], [], []
                for t, r in zip(utf8(b.column("text")), b.column("ranges")):
                    words = t.split()
                    total.append(len(words))
                    n = 0
                    if r.is_valid:
                        for x, y in np.frombuffer(r.as_py(), "<i4").reshape(-1, 2)[::-1].tolist():
                            del words[x:y]
                            n += y - x
                    gone.append(n)
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"])
    kind = given.schema["doc_id"].dataType.simpleString()
    return (given.join(ranges, "mark", "left").select("doc_id", "text", "ranges")
            .mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document after removing repeated 35-word windows."""
    out = remove_repeats(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s FROM d, LATERAL (SELECT unnest(range(1, len(w) - 33)) AS i) WHERE len(w) >= 35),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM rep),
words AS (SELECT r, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(t, ' ' ORDER BY p) AS s FROM words ANTI JOIN gone USING (r, p) GROUP BY r),
cnt AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN cnt USING (r)
"""
