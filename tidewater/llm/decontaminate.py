"""Benchmark decontamination with a broadcast set of word windows.

Texts are lower-cased in A-Z and cut into words of digits, letters and bytes
from 0x80. A benchmark item's windows are its runs of ``length`` words; an item
with fewer words is one window of its own length. Every task scans its
documents' windows against the set: a bit table, then a sorted hash array, then
the words themselves, so a hit is never a mere hash collision.

The set is broadcast only while it has at most ``block`` windows; a larger
benchmark is cut by hash into several sets of that size, each scanned in its
own pass, and the hits are joined by document.

Null and wordless texts have no words and no hits. An item with null item_id
marks words but is not listed; item rows that repeat count once by id. An empty
benchmark leaves every document clean.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise, per_worker, slices, unused
from .wordhash import Words, class_table, window_hashes

# The bytes between words, 0x00-0x2F 0x3A-0x60 0x7B-0x7F after lower-casing.
BETWEEN = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LENGTH = 10
BLOCK = 1_000_000         # windows in one broadcast set: about 150 MB
TABLE_BITS = 20


def _windows(batch, column: str | int, length: int, lengths) -> Iterator:
    """(Words, window length, hashes, positions) for each wanted length.
    ``lengths`` None: every text's own length, at most ``length``."""
    w = Words(batch.column(column), class_table(BETWEEN), lower=True)
    h, room = w.hashes(), w.room()
    sizes = np.repeat(np.diff(w.first), np.diff(w.first))
    for n in range(1, length + 1) if lengths is None else lengths:
        found = window_hashes(h, n)
        fits = room[:len(found)] >= n
        if lengths is None and n < length:
            fits &= sizes[:len(found)] == n
        yield w, n, found, fits


def _text(w: Words, i: int, n: int) -> bytes:
    return b" ".join(w.buf[a:b].tobytes() for a, b in zip(w.start[i:i + n], w.end[i:i + n]))


def benchmark_windows(benchmark: DataFrame, length: int = LENGTH, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """hash, n, words, items: every distinct window and the ids of its items."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for whole in batches:
            for b in slices(whole, "text"):
                out = []
                for w, n, found, fits in _windows(b, "text", length, None):
                    at = np.flatnonzero(fits)
                    item = np.searchsorted(w.first, at, side="right") - 1
                    ids = b.column("item").take(pa.array(item)).to_pylist()
                    out += [(int(found[i].astype(np.int64)), n, _text(w, i, n), x) for i, x in zip(at, ids)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.string()))], names=["hash", "n", "words", "item"])
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    return (items.mapInArrow(run, "hash long, n int, words binary, item string")
            .groupBy("hash", "n", "words").agg(F.collect_set("item").alias("items")))


class _Set:
    """The lookup structure a task gets: by window length, sorted hashes and
    what each may stand for."""

    def __init__(self, rows):
        self.by_length: dict = {}
        for h, n, words, items in rows:
            self.by_length.setdefault(n, {}).setdefault(h & (1 << 64) - 1, {})[words] = items
        for n, entries in self.by_length.items():
            keys = np.array(sorted(entries), np.uint64)
            table = np.zeros(1 << TABLE_BITS, bool)
            table[keys >> np.uint64(64 - TABLE_BITS)] = True
            self.by_length[n] = table, keys, [entries[int(k)] for k in keys]

    def hits(self, batch, column: str | int, length: int):
        """Words, and a list of (position, window length, item ids)."""
        w, out = None, []
        for w, n, found, fits in _windows(batch, column, length, sorted(self.by_length) or [1]):
            if n not in self.by_length:
                break
            table, keys, entries = self.by_length[n]
            at = np.flatnonzero(table[found >> np.uint64(64 - TABLE_BITS)] & fits)
            place = np.minimum(np.searchsorted(keys, found[at]), len(keys) - 1)
            ok = keys[place] == found[at]
            for i, p in zip(at[ok].tolist(), place[ok].tolist()):
                items = entries[p].get(_text(w, i, n))
                if items is not None:
                    out.append((i, n, items))
        return w, out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_FOUND = "struct<n_words:bigint,spans:array<struct<a:int,b:int>>,bytes:array<struct<a:int,b:int>>,items:array<string>>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, text: str = "text",
                       item_id: str = "item_id", block: int = BLOCK) -> DataFrame:
    """``docs`` with a column ``found``: n_words, the hit word ranges ``spans``,
    the same as byte ranges of the text, and the ids of the items that occur."""
    spark = docs.sparkSession
    windows = materialise(benchmark_windows(benchmark, length, text, item_id), "benchmark-windows")
    blocks = max(1, -(-windows.count() // block))
    found, row, more = unused(docs, "found", "row", "more")
    rest = [c for c in docs.columns]

    def scan(source: DataFrame, part: DataFrame, keep: list[str], only_hits: bool) -> DataFrame:
        held = spark.sparkContext.broadcast([(r["hash"], r["n"], bytes(r["words"]), tuple(r["items"])) for r in part.collect()])
        name = f"windows-{uuid.uuid4().hex}"
        # the text travels once, also where it is kept
        body = keep.index(text) if text in keep else len(keep)
        kept = source.select(*[F.col(f"`{c}`") for c in keep], *([] if text in keep else [F.col(f"`{text}`")]))
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*[f"`{c}`" for c in keep]).schema]
                           + [f"`{found}` {_FOUND}"])

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa
            lookup = per_worker(name, lambda: _Set(held.value))
            pair = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            kind = pa.struct([("n_words", pa.int64()), ("spans", pair), ("bytes", pair), ("items", pa.list_(pa.string()))])
            for whole in batches:
                for b in slices(whole, body, 2 << 20):
                    w, hits = lookup.hits(b, body, length)
                    spans: dict = {}
                    items: dict = {}
                    docs_of = (np.searchsorted(w.first, [i for i, _, _ in hits], side="right") - 1).tolist()
                    for d, (i, n, ids) in zip(docs_of, hits):
                        f = int(w.first[d])
                        spans.setdefault(d, []).append((i - f, i - f + n))
                        items.setdefault(d, set()).update(ids)
                    out = []
                    for d, n in enumerate(np.diff(w.first).tolist()):
                        s, f, o = _merged(spans.get(d, [])), int(w.first[d]), int(w.off[d])
                        out.append({"n_words": n, "spans": [{"a": x, "b": y} for x, y in s], "items": sorted(items.get(d, ())),
                                    "bytes": [{"a": int(w.start[f + x]) - o, "b": int(w.end[f + y - 1]) - o} for x, y in s]})
                    made = pa.RecordBatch.from_arrays([*[b.column(c) for c in range(len(keep))], pa.array(out, kind)], names=[*keep, found])
                    if only_hits:
                        made = made.filter(pa.array([bool(x["spans"]) for x in out], pa.bool_()))
                    yield made
        return kept.mapInArrow(run, schema)

    if blocks == 1:
        return scan(docs, windows, rest, False)
    # more windows than one set may hold: a pass for each set, joined by a stored row number
    numbered = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    clean = scan(numbered, windows.limit(0), [*rest, row], False)
    passes = None
    for k in range(blocks):
        part = scan(numbered, windows.where(F.pmod("hash", F.lit(blocks)) == k), [row], True)
        passes = part if passes is None else passes.unionByName(part)
    gathered = passes.groupBy(row).agg(
        F.flatten(F.collect_list(f"{found}.spans")).alias("spans"), F.flatten(F.collect_list(f"{found}.bytes")).alias("bytes"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"{found}.items")))).alias("items"))

    def united(column: str):
        """Overlapping ranges of several passes as one."""
        step = lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["b"] >= x["a"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                     F.array(F.struct(F.element_at(done, -1)["a"].alias("a"), F.greatest(F.element_at(done, -1)["b"], x["b"]).alias("b"))))
        ).otherwise(F.concat(done, F.array(x)))
        return F.aggregate(F.array_sort(column), F.slice(column, 1, 0), step)
    gathered = gathered.select(row, F.struct(united("spans").alias("spans"), united("bytes").alias("bytes"), "items").alias(more))
    return (clean.join(gathered, row, "left")
            .withColumn(found, F.when(F.col(more).isNull(), F.col(found)).otherwise(F.struct(
                F.col(f"{found}.n_words").alias("n_words"), F.col(f"{more}.spans").alias("spans"),
                F.col(f"{more}.bytes").alias("bytes"), F.col(f"{more}.items").alias("items"))))
            .select(*[f"`{c}`" for c in rest], found))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The documents without a single benchmark window, unchanged."""
    out = find_contamination(docs, benchmark, **kw)
    return out.where(F.size(out[out.columns[-1]]["spans"]) == 0).drop(out.columns[-1])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **kw) -> DataFrame:
    """All documents; from their texts every hit word range is cut out."""
    out = find_contamination(docs, benchmark, text=text, **kw)
    found = out.columns[-1]
    raw = F.encode(F.col(f"`{text}`"), "utf-8")
    spans = F.col(f"{found}.bytes")
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda x: x["b"]))
    stops = F.concat(F.transform(spans, lambda x: x["a"]), F.array(F.octet_length(f"`{text}`")))
    kept = F.transform(F.arrays_zip(starts.alias("s"), stops.alias("e")), lambda x: F.decode(F.substring(raw, x["s"] + 1, x["e"] - x["s"]), "utf-8"))
    cut = F.when(F.size(spans) > 0, F.concat_ws("", kept)).otherwise(F.col(f"`{text}`"))
    return out.withColumn(text, cut).drop(found)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    found = find_contamination(load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, x: n + x["b"] - x["a"])
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP3_SQL = r"""
WITH b AS (SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
           FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
      FROM documents),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM d, lens, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) WHERE len(w) >= n),
h AS (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
       FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
