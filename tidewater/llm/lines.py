"""Fuzzy line deduplication.

With ``whole``, as the query and the pipeline ask for: lines of at least
``LEAST_WORDS`` words or ``LEAST_CHARS`` characters are normalised to their
words in lower case and equal after that are one node. Digits are 0 only in
the fingerprint, so lines that differ in digits are candidates, and are
verified with their digits. All other lines that are not blank are compared
as they stand: exactly equal ones are one node, of any length.

Without it, a line is normalised to its words (letters, digits, bytes from 0x80) in lower
case with every digit as 0. Lines of fewer than ``LEAST_WORDS`` words are left
alone: short lines are equal by chance. Lines equal after that are one node,
whatever their count.

Nodes get a 64-bit SimHash of their different words, each counted once, or the
common words of a language would make all its long lines alike. Two
fingerprints at most ``RADIUS`` bits apart agree on at least two of seven
blocks, so each is dealt to the 21 pairs of blocks (about 18 bits a key) and
compared there by their differing bits. Equal and linked fingerprints form candidate groups, in which pairs within the radius
are verified: edit similarity 1 - distance / longer length of at least
``SIMILAR`` on the normalised lines. Verified links make the final groups, and
of each group the first line stays: by doc_id (nulls last), then line number.

Crowded keys and groups are cut into tiles, every pair of tiles meets, and a
pair already connected is not compared again, so neither a key nor a group of
any size lands in one task, and no pair is lost.

Null text has no lines and stays null. Rows equal in doc_id and text are one
document here: what one keeps, the other keeps.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitslice import link
from .common import load, materialise, slices, unused, utf8
from .components import components
from .decontaminate import BETWEEN
from .simhash import linked_in_keys, sorted_groups
from .wordhash import BREAKS, M1, Words, class_table, range_hashes

LEAST_WORDS = 5
LEAST_CHARS = 20
RADIUS = 5
SIMILAR = 0.8
BORDERS = (0, 10, 19, 28, 37, 46, 55, 64)     # seven blocks of a fingerprint
PAIRS = tuple(combinations(range(7), 2))
CROWD = 2048              # fingerprints of one key that a task compares on its own
TILE = 256                # lines of a candidate group that meet in one half of a tile
UNIT = 500_000
RAW = 1                   # seed of the hashes of lines as they stand
KNOWN = 4_000_000         # candidate lines whose hashes are broadcast (32 MB); beyond it a join


# a byte's eight bits as the lowest bits of eight bytes
_SPREAD = (np.arange(256, dtype=np.uint64)[:, None] >> np.arange(8, dtype=np.uint64) & np.uint64(1)) @ (np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64))


def majority(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each run of uint64 hashes (the runs begin at ``first``): a bit is 1 if it is set in over half
    of them. Eight bits are counted at once, as bytes of one number, over at most 255 hashes;
    longer runs are counted in pieces."""
    size = np.diff(np.append(first, len(h)))
    pieces = -(-size // 255)
    run = np.repeat(np.arange(len(first)), pieces)
    at = first[run] + 255 * (np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    begin = np.cumsum(pieces) - pieces
    split = len(run) > len(first)
    out = np.zeros(len(first), "<u8")
    parts = np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8)
    for k in range(8):
        counts = np.add.reduceat(_SPREAD[parts[:, k]], at).astype("<u8").view(np.uint8).reshape(-1, 8)
        if split:
            counts = np.add.reduceat(counts, begin, axis=0, dtype=np.int64)
        over = 2 * counts.astype(np.int64) > size[:, None]
        out |= np.packbits(over, axis=1, bitorder="little").ravel().astype("<u8") << np.uint64(8 * k)
    return out


class Lines:
    """The lines of a column that take part: text index, line number, hash and,
    if asked for, fingerprint of each. With ``whole`` also ``short``: text
    index, line number and hash of the lines that only take part as they stand."""

    def __init__(self, column, fingerprints: bool = True, whole: bool = False):
        w = self.words = Words(column, class_table(BETWEEN), lower=True)
        self.buf = w.buf.copy() if whole else w.buf
        exact = w.hashes() if whole else None
        w.buf[(w.buf >= 48) & (w.buf <= 57)] = 48
        doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
        breaks = np.flatnonzero(w.buf == 10)
        number = np.searchsorted(breaks, w.start) - np.searchsorted(breaks, w.off[:-1])[doc]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(doc))[:len(begin)]
        h = w.hashes() if fingerprints or not whole else exact
        self.hash = range_hashes(exact if whole else h, begin, end)
        ok = end - begin >= LEAST_WORDS
        if whole:
            lead = _before((w.buf & 0xC0) != 0x80)      # characters before a byte
            chars = np.concatenate(([0], np.cumsum(lead[w.end] - lead[w.start])))
            ok |= chars[end] - chars[begin] + end - begin - 1 >= LEAST_CHARS
            if fingerprints:
                self.short = _as_they_stand(column, w.start[begin[ok]])
        self.doc, self.number = doc[begin][ok], number[begin][ok]
        self.hash, self.begin, self.end = self.hash[ok], begin[ok], end[ok]
        if not fingerprints:
            return
        line = np.cumsum(new) - 1
        # each different word of a line once: one hash of line and word, the first of equal ones stays
        both = h ^ line.astype(np.uint64) * np.uint64(M1)
        order = np.argsort(both)
        both = both[order]
        once = np.zeros(len(h), bool)
        once[order[np.concatenate(([True], both[1:] != both[:-1]))[:len(h)]]] = True
        line, h = line[once], h[once]
        first = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1]))) if len(h) else line
        self.fp = majority(h, first)[ok] if len(h) else np.zeros(0, "<u8")

    def text(self, k: int) -> bytes:
        w = self.words
        return b" ".join(self.buf[a:b].tobytes() for a, b in zip(w.start[self.begin[k]:self.end[k]], w.end[self.begin[k]:self.end[k]]))


def _before(mask: np.ndarray) -> np.ndarray:
    """How many entries before each place (and in all) are set."""
    out = np.zeros(len(mask) + 1, np.int32 if len(mask) < 1 << 31 else np.int64)
    np.cumsum(mask, out=out[1:], dtype=out.dtype)
    return out


def _as_they_stand(column, but: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, line number and hash of the column's lines that are not
    blank, without those that hold the bytes ``but``."""
    w = Words(column, class_table(b"\n"))
    ink = _before(class_table(BREAKS)[w.buf])
    use = ink[w.end] > ink[w.start]
    use[np.searchsorted(w.start, but, side="right") - 1] = False
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    breaks = np.flatnonzero(w.buf == 10)
    number = np.searchsorted(breaks, w.start) - np.searchsorted(breaks, w.off[:-1])[doc]
    w.start, w.end = w.start[use], w.end[use]
    return doc[use], number[use], w.hashes(RAW)


def _occurrences(whole: bool):
    """doc_id, mark, line, key, fp of every line that takes part; fp is null
    for those that only do as they stand."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for b in slices(batch, "text", 1 << 20):
                found = Lines(b.column("text"), True, whole)
                parts = [(found.doc, found.number, found.hash, pa.array(found.fp.view(np.int64)))]
                if whole:
                    parts.append((*found.short, pa.nulls(len(found.short[0]), pa.int64())))
                for doc, number, key, fp in parts:
                    at = pa.array(doc)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(at), b.column("mark").take(at), pa.array(number.astype(np.int32)),
                         pa.array(key.view(np.int64)), fp], names=["doc_id", "mark", "line", "key", "fp"])
    return run


def block_keys(fp: np.ndarray, pair: int) -> np.ndarray:
    """The bits of two of the seven blocks of uint64 fingerprints, as one number."""
    out = np.zeros(len(fp), np.uint64)
    for block in PAIRS[pair]:
        size = np.uint64(BORDERS[block + 1] - BORDERS[block])
        out = out << size | fp >> np.uint64(BORDERS[block]) & np.uint64((1 << int(size)) - 1)
    return out


_DEALT = "bucket int, body binary"


def _deal(buckets: int):
    """Fingerprints to (pair of blocks, part of the key space), as packed arrays."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def flush(parts):
            fp = np.unique(np.concatenate(parts))
            for pair in range(len(PAIRS)):
                place = (block_keys(fp, pair) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)
                order = np.argsort(place, kind="stable")
                place, mine = place[order], fp[order]
                cuts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
                bodies = [mine[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(mine)])]
                yield pa.RecordBatch.from_arrays([pa.array((place[cuts] + np.uint64(pair * buckets)).astype(np.int32)), pa.array(bodies, pa.binary())],
                                                 names=["bucket", "body"])
        held, count = [], 0
        for b in batches:
            held.append(b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            count += len(held[-1])
            if count >= UNIT:
                yield from flush(held)
                held, count = [], 0
        if count:
            yield from flush(held)
    return run


def _compare(buckets: int, radius: int, crowd: int):
    """Bucket by bucket: links (a, b); and (fp, key, crowded) of keys with more
    than ``crowd`` fingerprints, left to tiles."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(bucket, bodies):
            pair = bucket // buckets
            fp = np.unique(np.frombuffer(b"".join(bodies), "<u8"))
            keys = block_keys(fp, pair)
            order = np.argsort(keys, kind="stable")
            keys, fp = keys[order], fp[order]
            begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            size = np.repeat(np.diff(np.append(begin, len(keys))), np.diff(np.append(begin, len(keys))))
            many = size > crowd
            use = np.flatnonzero((size > 1) & ~many)
            # a few thousand rows at a time, cut between keys
            starts = np.flatnonzero(np.concatenate(([True], keys[use][1:] != keys[use][:-1]))) if len(use) else use
            cuts = starts[np.searchsorted(starts, np.arange(0, len(use), 8192)).clip(max=max(0, len(starts) - 1))] if len(use) else use
            cuts = np.unique(np.append(cuts, len(use)))
            for a, b in zip(cuts[:-1], cuts[1:]):
                rows = use[a:b]
                mine = fp[rows]
                i, j = link(keys[rows], mine, radius, near=lambda x, y: np.bitwise_count(mine[x] ^ mine[y]) <= radius)
                yield fp[rows][i], fp[rows][j], np.zeros(len(i), bool)
            yield fp[many], keys[many] * np.uint64(len(PAIRS)) + np.uint64(pair), np.ones(int(many.sum()), bool)

        def made(bucket, bodies):
            for a, b, c in out(bucket, bodies):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(c)], names=["a", "b", "crowded"])

        bucket, bodies = None, []
        for batch in batches:
            for k, body in zip(batch.column("bucket").to_pylist(), batch.column("body").to_pylist()):
                if k != bucket and bodies:
                    yield from made(bucket, bodies)
                    bodies = []
                bucket = k
                bodies.append(body)
        if bodies:
            yield from made(bucket, bodies)
    return run


def near_fingerprints(nodes: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that connect the fingerprints ``fp`` at most ``radius`` apart."""
    if radius > 5:
        raise ValueError("two of seven blocks agree up to five differing bits")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (nodes.select("fp").mapInArrow(_deal(parts), _DEALT).repartition(parts, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(_compare(parts, radius, crowd), "a long, b long, crowded boolean"))
    found = materialise(found, "line-links")
    rest = linked_in_keys(found.where("crowded").select(F.col("a").alias("fp"), F.col("b").alias("key")), radius)
    return found.where("not crowded").select("a", "b").unionByName(rest)


def edit_similar(a: str, b: str, least: float = SIMILAR) -> bool:
    """Whether 1 - edit distance / longer length is at least ``least``."""
    longest = max(len(a), len(b))
    most = int((1 - least) * longest + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    head = 0
    end = min(len(a), len(b))
    while head < end and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < end - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    if max(len(a), len(b)) <= most:
        return True
    if not a or not b:
        return False
    # words replaced one for one bound the distance from above
    x, y = a.split(" "), b.split(" ")
    if len(x) == len(y) and sum(max(len(p), len(q)) for p, q in zip(x, y) if p != q) <= most:
        return True
    # a column of the distance table as bits of two integers: steps up and steps down
    full = (1 << len(a)) - 1
    top = 1 << len(a) - 1
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    up, down, score, left = full, 0, len(a), len(b)
    for c in b:
        eq = where.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq
        rise = down | ~(across | up) & full
        fall = up & across
        score += 1 if rise & top else -1 if fall & top else 0
        left -= 1
        if score - left > most:
            return False
        rise = (rise << 1 | 1) & full
        fall = fall << 1 & full
        eq |= down
        up = fall | ~(eq | rise) & full
        down = rise & eq
    return score <= most


def _texts_of(docs: DataFrame, keys: DataFrame, whole: bool) -> DataFrame:
    """(key, body): the normalised line of every key in ``keys``."""
    spark = docs.sparkSession
    few = keys.count() <= KNOWN
    held = spark.sparkContext.broadcast(np.sort(np.array([r["key"] for r in keys.toLocalIterator()], np.int64)).tobytes()) if few else None

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        wanted = np.frombuffer(held.value, np.int64) if held else None
        for batch in batches:
            for b in slices(batch, "text", 1 << 20):
                found = Lines(b.column("text"), False, whole)
                h, at = np.unique(found.hash.view(np.int64), return_index=True)
                if wanted is not None:
                    ok = wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h if len(wanted) else np.zeros(len(h), bool)
                    h, at = h[ok], at[ok]
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array([found.text(k) for k in at], pa.binary()).cast(pa.string())], names=["key", "body"])
    found = docs.select("text").mapInArrow(run, "key long, body string")
    if not few:
        found = found.join(keys, "key", "left_semi")
    return found.groupBy("key").agg(F.min("body").alias("body"))


def _verified(members: DataFrame, radius: int, similar: float, tile: int) -> DataFrame:
    """Links (a, b) of the keys of one candidate group within the radius and
    similar in text. ``members``: root, key, fp, body."""
    crowded = (members.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile)
               .select("root", F.ceil(F.col("n") / tile).cast("int").alias("cuts")))
    own = F.pmod(F.xxhash64("key"), F.coalesce("cuts", F.lit(1))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("cuts", F.lit(1)) - 1))
    tiles = (members.join(crowded, "root", "left").select("key", "fp", "body", "root", own.alias("x"), other.alias("y"))
             .select(F.xxhash64("root", F.least("x", "y"), F.greatest("x", "y")).alias("tile"), "key", "fp", "body"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for tile_of, key, fp, body in sorted_groups(batches, ["tile", "key", "fp", "body"], 4096):
            same = lambda i, j: np.array([edit_similar(body[x], body[y], similar) for x, y in zip(i.tolist(), j.tolist())], bool)
            bits = fp.view(np.uint64)
            i, j = link(tile_of, bits, radius, same, lambda x, y: np.bitwise_count(bits[x] ^ bits[y]) <= radius)
            yield pa.RecordBatch.from_arrays([pa.array(key[i]), pa.array(key[j])], names=["a", "b"])

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tiles.repartition(parts, "tile").sortWithinPartitions("tile").mapInArrow(run, "a long, b long")


def repeated_lines(docs: DataFrame, radius: int = RADIUS, similar: float = SIMILAR, whole: bool = False) -> DataFrame:
    """(mark, lines): the line numbers to drop from the documents of that mark.
    ``docs`` has doc_id, text and mark."""
    seen = materialise(docs.where("text is not null").select("doc_id", "text", "mark")
                       .mapInArrow(_occurrences(whole), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, mark long, line int, key long, fp long"), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "mark", "line")
    nodes = materialise(seen.groupBy("key").agg(F.min("fp").alias("fp"), F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), "line-nodes")
    long = nodes.where("fp is not null").select("key", "fp")
    near = components(near_fingerprints(long, radius)).toDF("fp", "root")
    rooted = long.join(near, "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("root")
    members = materialise(rooted.join(groups, "root"), "line-candidates")
    with_text = materialise(members.join(_texts_of(docs, members.select("key"), whole), "key"), "line-texts")
    same = components(_verified(with_text, radius, similar, TILE)).toDF("key", "top")

    grouped = materialise(nodes.join(same, "key", "left").where("n > 1 or top is not null")
                          .select("key", F.coalesce("top", "key").alias("top"), "first"), "line-groups")
    firsts = grouped.groupBy("top").agg(F.min("first").alias("stay")).select("top", F.col("stay.mark").alias("stay_mark"), F.col("stay.line").alias("stay_line"))
    stays = grouped.select("key", "top").join(firsts, "top").select("key", "stay_mark", "stay_line")
    gone = (seen.select("mark", "line", "key").join(stays, "key")
            .where("mark <> stay_mark or line <> stay_line").select("mark", "line").distinct())
    # the lines of one document
    return gone.groupBy("mark").agg(F.collect_list("line").alias("lines"))


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", dropped: str | None = None,
                        radius: int = RADIUS, similar: float = SIMILAR, whole: bool = False) -> DataFrame:
    """``docs`` with the text's repeated lines taken out; the others stay as
    they are. ``dropped`` names a column for the number of lines taken out,
    ``whole`` takes in short lines and tells digits apart (see above)."""
    mark, lines, kept = unused(docs, "line_mark", "line_numbers", "kept_text")
    marked = docs.withColumn(mark, F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")))
    plain = marked.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(mark).alias("mark"))
    gone = repeated_lines(plain, radius, similar, whole).toDF(mark, lines)
    rest = [c for c in docs.columns if c != text]
    names = [*rest, text, *([dropped] if dropped else [])]
    joined = marked.join(gone, mark, "left").select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias(kept), F.col(lines))
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest] + [f"`{text}` string"] + ([f"`{dropped}` long"] if dropped else []))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            out, count = [], []
            for value, t, numbers in zip(b.column(kept), utf8(b.column(kept)), b.column(lines).to_pylist()):
                if numbers:
                    cut = set(numbers)
                    t = b"\n".join(x for k, x in enumerate(t.split(b"\n")) if k not in cut)
                out.append(t if value.is_valid else None)
                count.append(len(numbers or ()))
            made = [*b.columns[:len(rest)], pa.array(out, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(made + ([pa.array(count, pa.int64())] if dropped else []), names=names)
    return joined.mapInArrow(run, schema).select(*[f"`{c}`" for c in docs.columns], *([dropped] if dropped else []))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document after fuzzy line deduplication."""
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(breaks + 1, F.lit(0)).cast("long").alias("n_lines"))
    out = drop_repeated_lines(docs, dropped="n_removed", whole=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
