"""Phrase collocations, counted in HAT-tries.

A task numbers the words it meets and counts phrases in one trie for each lang. Its leaves
are hash containers: (first word, packed rest) -> count, in order of a 64-bit hash, with the
phrases themselves compared. A container holds the phrases of a range of first words, at
first of all; one of over ``BURST`` entries bursts: its range is split where its entries are
halved, and one of a single first word by ranges of its second words. When a task holds
``MOST_ENTRIES``, the largest containers (whole subtrees) are given out until half is left, as
runs sorted by words; so memory is bounded and the counts stay complete. Runs are stored,
dealt by ranges of (lang, phrase), so that a common first word is split over several tasks,
and summed.

The texts are read three times: for words, for pairs of words that both reach the least
count, and for phrases of three and four whose pairs of neighbours all reach it. Which
words or pairs do is told by a bit table of fixed size (``FILTER_BITS``), the only thing
broadcast: one that shares another's bit costs needless counting, and none is missed. A
phrase with a part below the least count is below it too, so nothing is lost.

Null texts are empty, a null lang is ``und``, and repeated rows count as often as they
stand. Equal scores are ordered by count, then by phrase. Empty tables and tables without
a frequent phrase give no rows. Texts of any length are cut into chunks at spaces and
counted across the cuts. Only ``text`` and ``lang`` are read, so other columns don't clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import load, materialise

LEAST = 30                # occurrences of a candidate
LONGEST = 4               # words of a candidate
WITHIN = 80               # per cent of a phrase's occurrences that lie in one longer phrase
BEST = 2000               # phrases reported for each lang

WORD_BITS = 21
MOST_WORDS = 1 << 19      # words numbered before a task starts a new list
MOST_WORD_BYTES = 64 << 20
MOST_ENTRIES = 2_000_000  # counts that a task holds
BURST = 1 << 16
CHUNK = 4 << 20           # bytes of text cut into words at once: fewer than 2^WORD_BITS different words
FILTER_BITS = 26
RUN_ENTRIES = 1 << 19     # about as many counts are put in order at once
RUN_BYTES = 4 << 20       # of phrases in a batch given out
PARTS = 32                # first stage of the ranking

BOUNDARY = b"."           # any of the marks that end a piece
_MARKS = b".,;:!?\x0a\x0b\x0c\x0d"
_GAP = re.compile(b"[ \t" + _MARKS + b"]")
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _MARKS, b"abcdefghijklmnopqrstuvwxyz " + BOUNDARY * len(_MARKS))


class Vocabulary(dict):
    """Word -> id, with the words in order of their ids; id 0 is the boundary of pieces."""

    def __init__(self):
        super().__init__({BOUNDARY: 0})
        self.words, self.bytes = [BOUNDARY], 0

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self.words)
        self.words.append(word)
        self.bytes += len(word)
        return i


class Container:
    """Counts of phrases whose first word (or, at depth 1, second word) is at least ``low``."""

    def __init__(self, depth: int, low: int):
        import numpy as np

        none = np.zeros(0, np.int64)
        self.depth, self.low, self.held, self.new, self.waiting = depth, low, (np.zeros(0, np.uint64), none, none, none), [], 0

    def add(self, hashes, first, rest) -> None:
        import numpy as np

        self.new.append((hashes, first, rest, np.ones(len(first), np.int64)))
        self.waiting += len(first)

    def merge(self) -> int:
        """Merge what waits by hash; the number of entries."""
        import numpy as np

        if self.new:
            h, first, rest, n = (np.concatenate(c) for c in zip(self.held, *self.new))
            order = np.argsort(h, kind="stable")
            same = lambda o: (h[o][1:] == h[o][:-1], (first[o][1:] == first[o][:-1]) & (rest[o][1:] == rest[o][:-1]))
            hash_met, met = same(order)
            if (hash_met & ~met).any():      # different phrases of one hash
                order = np.lexsort((rest, first, h))
                _, met = same(order)
            starts = np.flatnonzero(np.concatenate(([True], ~met)))
            at = order[starts]
            self.held = h[at], first[at], rest[at], np.add.reduceat(n[order], starts)
            self.new, self.waiting = [], 0
        return len(self.held[0])

    def size(self) -> int:
        return len(self.held[0]) + self.waiting

    def burst(self) -> list:
        """This container, or the two that its range is split into."""
        import numpy as np

        if self.waiting < max(BURST, len(self.held[0])) or self.merge() <= BURST:
            return [self]
        depth, words = self.depth, self.held[1]
        if depth == 0 and words.min() == words.max():
            depth, self.low = 1, 0
        if depth == 1:
            words = self.held[2] >> 2 * WORD_BITS
        least = int(np.median(words)) + 1
        if least > words.max():
            least = int(words.max())
        if least <= words.min():
            return [self]
        out = []
        for low, part in ((self.low, words < least), (least, words >= least)):
            c = Container(depth, low)
            c.held = tuple(x[part] for x in self.held)
            out.append(c)
        return out


class HatTrie:
    """Counts of phrases by first word and packed rest: containers in order of first words,
    and under a first word that has outgrown one, those of its second words."""

    def __init__(self):
        self.leaves: dict = {None: [Container(0, 0)]}      # by the first word of a deeper node

    def add(self, first, rest) -> None:
        import numpy as np

        h = (first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ rest.view(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        for deeper in [f for f in self.leaves if f is not None]:
            own = first == deeper
            if own.any():
                self._into(deeper, rest[own] >> 2 * WORD_BITS, h[own], first[own], rest[own])
                h, first, rest = h[~own], first[~own], rest[~own]
        if len(first):
            self._into(None, first, h, first, rest)

    def _into(self, node, words, h, first, rest) -> None:
        import numpy as np

        leaves = self.leaves[node]
        leaf = np.searchsorted([c.low for c in leaves], words, side="right") - 1
        order = np.argsort(leaf, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(leaf[order])) + 1).tolist(), len(order)]
        out = {}
        for s, e in zip(cuts, cuts[1:]):
            at, c = order[s:e], leaves[leaf[order[s]]]
            c.add(h[at], first[at], rest[at])
            out[id(c)] = c.burst()
        kept = []
        for c in leaves:
            for x in out.get(id(c), [c]):
                if x.depth == 1 and node is None:
                    self.leaves.setdefault(int(x.held[1][0]), []).append(x)
                else:
                    kept.append(x)
        if not kept or kept[0].low > 0:
            kept.insert(0, Container(0 if node is None else 1, 0))
        self.leaves[node] = kept

    def containers(self) -> list:
        return [c for leaves in self.leaves.values() for c in leaves]


def _tokens(text: bytes):
    """The words of a text, marks among them as boundaries: their places in the list of different words."""
    import pyarrow as pa
    import pyarrow.compute as pc

    spaced = text.translate(_TABLE).replace(BOUNDARY, b" " + BOUNDARY + b" ")
    coded = pc.list_flatten(pc.split_pattern(pa.array([spaced], pa.large_binary()), " ")).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def _word_hash(word: bytes) -> int:
    import zlib

    return zlib.crc32(word)


def _bit(lang: int, parts: list, bits: int):
    """The bits of words, or of pairs of them, from the words' hashes."""
    import numpy as np

    h = np.full(len(parts[0]), lang, np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h >> np.uint64(64 - bits)


class Counter:
    """One task's counts: phrases of ``lengths`` words, of which each ``unit`` neighbours
    have their bit in ``table`` (unit 0: no table)."""

    def __init__(self, lengths: range, unit: int, table, bits: int):
        self.lengths, self.unit, self.table, self.bits = lengths, unit, table, bits
        self.reset()

    def reset(self) -> None:
        self.vocabulary, self.tries, self.hashes = Vocabulary(), {}, []

    def held(self, merged: bool = False) -> int:
        """Entries, or occurrences where they are not merged yet."""
        return sum(c.merge() if merged else c.size() for t in self.tries.values() for c in t.containers())

    def feed(self, lang: str, texts: list[bytes]) -> Iterator:
        """Count whole texts; gives the runs that this spills."""
        tail: list[bytes] = []
        text, at = BOUNDARY.join(texts), 0
        while at < len(text):
            # a cut beside a mark or space parts no word
            cut = _GAP.search(text, at + CHUNK)
            end = cut.start() if cut else len(text)
            index, words = _tokens(text[at:end])
            at = end
            v = self.vocabulary
            if len(v) + len(words) + len(tail) >= 1 << WORD_BITS or len(v) > MOST_WORDS or v.bytes > MOST_WORD_BYTES:
                yield from self.spill()
                self.reset()
            ids = self._ids(tail, index, words)
            self._chunk(lang, ids, len(tail))
            tail = [self.vocabulary.words[i] for i in ids[1 - LONGEST:]]
            if self.held() > MOST_ENTRIES and (held := self.held(merged=True)) > MOST_ENTRIES * 3 // 4:
                yield from self.spill(MOST_ENTRIES // 2, held)

    def _ids(self, tail: list[bytes], index, words: list[bytes]):
        """Ids of the words of ``tail`` and of those at ``index``; empty words go."""
        import numpy as np

        gap = words.index(b"") if b"" in words else None
        if gap is not None:
            words[gap] = BOUNDARY          # known already, so no id is drawn for it
        known = np.fromiter(map(self.vocabulary.__getitem__, words), np.int64, len(words))
        if gap is not None:
            known[gap] = -1
        ids = known[index] if len(words) else np.zeros(0, np.int64)
        return np.concatenate((np.array([self.vocabulary[w] for w in tail], np.int64), ids[ids >= 0]))

    def _chunk(self, lang: str, ids, old: int) -> None:
        """Count the phrases that end after the ``old`` first words."""
        import numpy as np

        trie = self.tries.setdefault(lang, HatTrie())
        good, span = ids != 0, max(self.unit, 1)
        if len(ids) < min(self.lengths):
            return
        if self.unit:
            words = self.vocabulary.words
            self.hashes.extend(map(_word_hash, words[len(self.hashes):]))
            h = np.array(self.hashes, np.uint64)[ids]
            inside, n = good, len(ids) - span + 1
            bit = _bit(_word_hash(lang.encode()), [h[i:i + n] for i in range(span)], self.bits)
            good = (self.table[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            for i in range(span):
                good &= inside[i:i + n]
        first, rest = [], []
        for n in self.lengths:
            starts = len(ids) - n + 1
            if starts <= 0:
                continue
            ok = np.arange(starts) + n > old
            for i in range(n - span + 1):
                ok &= good[i:i + starts]
            at = np.flatnonzero(ok)
            packed = np.zeros(len(at), np.int64)
            for i in range(1, LONGEST):
                packed = packed << WORD_BITS | (ids[at + i] if i < n else 0)
            first.append(ids[at])
            rest.append(packed)
        if not sum(map(len, first)):
            return
        trie.add(np.concatenate(first), np.concatenate(rest))

    def spill(self, keep: int = 0, held: int = 0) -> Iterator:
        """Give out the largest containers, each lang's as runs sorted by words, until
        ``keep`` of the ``held`` entries are left (0: all of them)."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        sizes = sorted(((c.size(), i, lang, c) for lang, t in self.tries.items() for i, c in enumerate(t.containers()) if c.size()),
                       key=lambda x: (-x[0], x[2], x[1]))
        if not sizes:
            return
        words = pa.array(self.vocabulary.words, pa.large_binary())
        rank = np.empty(len(words), np.int64)
        rank[pc.array_sort_indices(words).to_numpy()] = np.arange(len(words))
        out, gathered = {}, 0
        for n, _, lang, c in sizes:
            if keep and held <= keep:
                break
            held -= n
            gathered += c.merge()
            out.setdefault(lang, []).append(c.held[1:])
            c.held = tuple(x[:0] for x in c.held)
            if gathered > RUN_ENTRIES:
                yield from _written(out, words, rank)
                out, gathered = {}, 0
        yield from _written(out, words, rank)


def _written(out: dict, words, rank) -> Iterator:
    """Arrow batches of the counts gathered for each lang, in order of words."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    size = pc.binary_length(words).to_numpy()
    mask = (1 << WORD_BITS) - 1
    for lang, parts in out.items():
        first, rest, counts = (np.concatenate(c) for c in zip(*parts))
        ids = [first, *(rest >> s & mask for s in (2 * WORD_BITS, WORD_BITS, 0))]
        # absent words have id 0, which ranks before every word here
        place = [np.where(i > 0, rank[i] + 1, 0) for i in ids]
        keys = [place[2] << WORD_BITS + 1 | place[3], place[0] << WORD_BITS + 1 | place[1]]
        order = np.lexsort(keys) if ids[2].any() else np.argsort(keys[1], kind="stable")
        ids, counts = [i[order] for i in ids], counts[order]
        many = sum((i > 0).astype(np.int32) for i in ids)
        held = np.cumsum(sum(size[i] for i in ids) + 64)
        cuts = np.flatnonzero(np.diff(held // RUN_BYTES)) + 1
        for s, e in zip([0, *cuts], [*cuts, len(counts)]):
            phrases = words.take(pa.array(ids[0][s:e]))
            for i in (i for i in ids[1:] if i[s:e].any()):
                # no word, no space: null parts are skipped
                part = pa.array(i[s:e], mask=i[s:e] == 0)
                phrases = pc.binary_join_element_wise(phrases, words.take(part), pa.scalar(b" ", pa.large_binary()), null_handling="skip")
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (e - s)), phrases.cast(pa.binary()).cast(pa.string()), pa.array(many[s:e]), pa.array(counts[s:e])],
                names=["lang", "phrase", "words", "n"])


_RUN = "lang string, phrase string, words int, n long"


def _runs(docs: DataFrame, lengths: range, unit: int, table, bits: int) -> DataFrame:
    """Runs of phrase counts of (text, lang); ``table`` is the broadcast bit table for ``unit``."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counter = Counter(lengths, unit, table.value if unit else None, bits)
        waiting: dict = {}
        size = 0

        def drain():
            for lang, texts in waiting.items():
                yield from counter.feed(lang, texts)
            waiting.clear()

        for b in batches:
            texts = b.column("text").cast(pa.large_binary())
            for lang, text in zip(b.column("lang").to_pylist(), texts):
                if (text := text.as_py()) is not None:
                    waiting.setdefault(lang, []).append(text)
                    size += len(text)
                    if size > 2 * CHUNK:
                        yield from drain()
                        size = 0
        yield from drain()
        yield from counter.spill()
    return docs.mapInArrow(run, _RUN)


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """Sums over the runs, by ranges of (lang, phrase); only those of ``least`` and more."""
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (runs.repartitionByRange(parts, "lang", "phrase").groupBy("lang", "phrase")
            .agg(F.first("words").alias("words"), F.sum("n").alias("f")).where(F.col("f") >= least))


def _bit_table(phrases: DataFrame, bits: int):
    """2^bits bits, those of ``phrases`` set: at most 2^(bits - 6) numbers reach the driver."""
    import numpy as np

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            langs = b.column("lang").to_pylist()
            words = [p.encode().split(b" ") for p in b.column("phrase").to_pylist()]
            bit = [int(_bit(_word_hash(g.encode()), [np.array([_word_hash(x)], np.uint64) for x in w], bits)[0])
                   for g, w in zip(langs, words)]
            yield pa.RecordBatch.from_arrays([pa.array(bit, pa.int64())], names=["bit"])
    held = (phrases.select("lang", "phrase").mapInArrow(run, "bit long")
            .groupBy(F.shiftright("bit", 6).alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("set")).toArrow())
    table = np.zeros(1 << bits - 6, np.int64)
    if held.num_rows:
        table[held.column("at").to_numpy()] = held.column("set").to_numpy()
    return table.view(np.uint8)


def _forget(stored: DataFrame) -> None:
    """Delete a scratch table that has been summed."""
    spark = stored.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stored.inputFiles()[0]).getParent() if stored.inputFiles() else None
    if path is not None:
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _exact(c):
    return F.col(c).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, within: int = WITHIN, best: int = BEST,
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``best`` phrases of two to four words of
    each lang of ``docs`` (text, lang)."""
    spark = docs.sparkSession
    texts = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    counted, unit, totals = None, 0, None
    for lengths in (range(1, 2), range(2, 3), range(3, LONGEST + 1)):
        table = unit and spark.sparkContext.broadcast(_bit_table(counted.where(F.col("words") == unit), filter_bits))
        runs = materialise(_runs(texts, lengths, unit, table, filter_bits), "phrase-runs")
        if totals is None:
            totals = materialise(runs.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
        found = materialise(_merged(runs, least), "phrase-counts")
        counted = found if counted is None else counted.unionByName(found)
        _forget(runs)
        unit += 1
    candidates = counted.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    part = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    cuts = (candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"),
                    part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest")))
    count = lambda name, n: counted.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    # products may pass 64 bits, so they are decimals; the quotient does not
    cuts = cuts.join(count("first", "l"), ["lang", "first"]).join(count("rest", "r"), ["lang", "rest"]).select(
        "lang", "phrase", "a", "k", "l", "r",
        F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").alias("score"))
    scored = (cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("c"))
              .select("lang", "phrase", "a", "c.l", "c.r", "c.score"))

    inner = F.filter(F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.array_join(F.slice(F.col("w"), i, n), " ")))), lambda p: p.isNotNull())
    longer = (candidates.where("words > 2").select("lang", "a", F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (scored.join(longer, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * within)))

    # a lang's phrases are ranked in parts first, so the last task has PARTS * best rows
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part_of = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = kept.select("*", F.row_number().over(W.partitionBy("lang", part_of).orderBy(*order)).alias("place")).where(F.col("place") <= best)
    ranked = first.select("*", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long").alias("rank")).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of each lang of ``documents``."""
    return collocations(load(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k AS words, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 30),
x AS (SELECT c.*, unnest(range(1, words)) AS cut FROM c),
y AS (SELECT x.lang, x.phrase, x.a, x.cut, l.f AS l, r.f AS r, (2000000::HUGEINT * x.a) // (l.f + r.f) AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.w[1:x.cut], ' ')
      JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.w[x.cut + 1:], ' ')),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, a, unnest(list_transform(range(1, words - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS phrase
      FROM c, (SELECT unnest([2, 3]) AS k) WHERE k < words),
m AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY ALL),
o AS (SELECT z.*, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, z.phrase) AS rank
      FROM z LEFT JOIN m ON m.lang = z.lang AND m.phrase = z.phrase
      WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT o.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM o JOIN t ON t.lang = o.lang WHERE rank <= 2000
"""
