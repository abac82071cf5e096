"""Token ids of a corpus in a compact binary form.

Ids are replaced by their rank in the corpus's own frequency order, so frequent
ids are small numbers, and written in a byte-aligned variable-length code: a
number takes one to four bytes, and the lengths, two bits each, lie in control
bytes of their own, four numbers to a byte. Decoding is table lookup: 256
control bytes give lengths, running sums give places, and every number is one
four-byte read and a mask.

A store is a folder with
  ranks/   one row: the id of every rank, little-endian uint32
  blocks/  rows of the format below, in files by ascending doc_id; a file holds
           one range of doc_ids, its blocks in order
A block has part (file range), seq, before (ids of its part before it), doc_ids,
lens (ids of each document, little-endian int64), control, data. A block ends
after the document that brings it to ``BLOCK`` ids.

The files are written by Spark, so they may lie on any store it can write, and
a task that is run again replaces what it wrote.

Null text counts as empty; every document ends with the id ``end_id``. Null
doc_ids come first, equal doc_ids are ordered by their ids.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import count, repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import load, per_worker, slices

BLOCK = 1 << 18           # ids in a block
KEPT = 1_000_000          # words without the marks after them, of which a worker keeps the ids: about 200 MB
FIRST = "\x1c"           # before a text's first word, which has no space before it
ODD = ("\x1c", "\x1d", "\x1e", "\x1f")    # white space to Python, not to the pattern
MARKS = ".,;:!?*&$%#|"    # none begins a contraction


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of uint32 numbers."""
    n = numbers.astype("<u4")
    extra = (n > 0xFF).astype(np.uint8) + (n > 0xFFFF) + (n > 0xFFFFFF)
    codes = np.zeros(-(-len(n) // 4) * 4, np.uint8)
    codes[:len(n)] = extra
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    data = n.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) <= extra[:, None]]
    return control.tobytes(), data.tobytes()


_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], "<u4")


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    ends = np.cumsum(lengths, dtype=np.int64)
    room = np.zeros(len(data) + 4, np.uint8)
    room[:len(data)] = np.frombuffer(data, np.uint8)
    at = np.ndarray((len(data) + 1,), "<u4", room, strides=(1,))
    return at[ends - lengths] & _MASKS[lengths]


def _gather(ids: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends) of the runs ``numbers``, one after the other, out of runs that
    end at ``ends``; both ends begin with 0."""
    sizes = np.diff(ends)[numbers]
    places = np.concatenate([[0], np.cumsum(sizes)])
    return ids[np.repeat(ends[numbers] - places[:-1], sizes) + np.arange(places[-1])], places


def _laid_out(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow column of large strings without nulls."""
    _, offsets, data = column.buffers()
    return np.frombuffer(data or b"", np.uint8), np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)


class Known:
    """Ids of words: a word's number, and all ids in order of the numbers. The
    empty word has number 0 and no ids."""

    def __init__(self):
        self.numbers: dict[str, int] = {"": 0}
        self.ids = np.empty(0, "<u4")
        self.ends = np.zeros(2, np.int64)

    def find(self, words: list[str]) -> np.ndarray:
        """The numbers of ``words``, -1 where unknown."""
        return np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))

    def add(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        self.numbers.update(zip(words, count(len(self.numbers))))
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends[1:]])
        self.ids = np.concatenate([self.ids, ids])


class WordIds:
    """Ids by the tokenizers library, word by word.

    Its byte-level pattern always ends a piece between a character that is no
    white space and a space or line break, so words are encoded once, with the
    space or break before them, and kept. It also ends one between a letter and
    the marks after it, so a word with such an ending is put together from the
    word without it and the marks, and only these two are kept. A text with
    other white space at a word's border is encoded as a whole, and so is one
    that holds an added token's string, if ``added``: the library's default, by
    which such a string becomes that token. Otherwise it is ordinary text."""

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        size = self.tokenizer.get_vocab_size()
        # a character of a byte-level token stands for one byte
        self.bytes = np.array([len(self.tokenizer.id_to_token(k) or "") for k in range(size)], np.int64)
        self.known, self.older = Known(), Known()

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of ``texts``, ends beginning with 0."""
        found = [array("I", e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.frombuffer(b"".join(found), np.uint32)
        return ids, np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of words that end without white space, each with a space
        before it unless it begins with a line break: one call for their
        concatenation, cut where the tokens' bytes add up."""
        if not words:
            return self._encode([])
        ids, _ = self._encode([(" " + " ".join(words)).replace(" \n", "\n")])
        sizes = np.fromiter(map(len, map(str.encode, words)), np.int64, len(words))
        sizes += [w[0] != "\n" for w in words]
        cuts = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(sizes)) + 1
        return ids, np.concatenate([[0], cuts])

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of different ``words`` among the known ones, new words
        added. A word stands for itself with a space before it, unless it begins
        with a line break or FIRST."""
        found = self.known.find(words)
        if np.count_nonzero(found < 0) + len(self.known.numbers) > KEPT // 2:
            self.older, self.known = self.known, Known()
            found = self.known.find(words)
        new = np.flatnonzero(found < 0)
        if not len(new):
            return found
        rest = [words[k] for k in new.tolist()]
        before = self.older.find(rest)
        first = np.fromiter((w[0] == FIRST for w in rest), bool, len(rest))
        for some, ids_of in ((before >= 0, None), ((before < 0) & ~first, self._encode_words),
                             ((before < 0) & first, lambda group: self._encode([w[1:] for w in group]))):
            group = [rest[k] for k in np.flatnonzero(some).tolist()]
            found[new[some]] = len(self.known.numbers) + np.arange(len(group))
            self.known.add(group, *(ids_of(group) if ids_of else _gather(self.older.ids, self.older.ends, before[some])))
        return found

    def _words(self, words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ends, unclear) of an Arrow column of different words, ends
        beginning with 0. Where a word's border is not clear it has no ids."""
        import pyarrow as pa
        import pyarrow.compute as pc

        kind = words.type
        nothing = pa.scalar("", kind)
        heads = pc.ascii_rtrim(words, MARKS)
        last = pc.utf8_slice_codeunits(heads, -1).dictionary_encode()
        at, chars = last.indices.to_numpy(), last.dictionary.to_pylist()
        letter = np.array([c.isalpha() for c in chars], bool)[at]
        data, offsets = _laid_out(words)
        marks = np.diff(offsets) - np.diff(_laid_out(heads)[1])
        unclear = np.array([not c or c.isspace() for c in chars], bool)[at] & (marks == 0)
        marks[~letter] = 0
        heads = pc.if_else(pa.array(unclear), nothing, pc.if_else(pa.array(letter), heads, words))
        # the marks: the last bytes of the words
        places = np.concatenate([[0], np.cumsum(marks)])
        tails = data[np.repeat(offsets[1:] - places[1:], marks) + np.arange(places[-1])]
        tails = pa.Array.from_buffers(kind, len(words), [None, pa.py_buffer(places), pa.py_buffer(tails)])
        tails = pc.binary_join_element_wise(pc.if_else(pa.array(marks > 0), pa.scalar(FIRST, kind), nothing), tails, nothing)
        both = pa.concat_arrays([heads, tails]).dictionary_encode()
        numbers = self._numbers(both.dictionary.to_numpy(zero_copy_only=False).tolist())[both.indices.to_numpy()]
        ids, ends = _gather(self.known.ids, self.known.ends, numbers.reshape(2, -1).T.ravel())
        return ids, ends[::2], unclear

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of an Arrow column of texts, null as empty: all their ids
        as uint32, and where each text's ids end. The texts are cut into words
        and the words numbered by Arrow; only a column's different words are
        looked up, and ids are gathered by number."""
        import pyarrow as pa
        import pyarrow.compute as pc

        kind = pa.large_string()
        nothing = pa.scalar("", kind)
        texts = pc.fill_null(texts.cast(kind), "")
        alone = pc.match_substring_regex(texts, "|".join(map(re.escape, (*ODD, *self.added))))
        cut = pc.replace_substring(pc.if_else(alone, nothing, texts), "\n", " \n")
        broken = pc.starts_with(cut, " \n")       # begins with a line break
        cut = pc.binary_join_element_wise(pc.if_else(broken, nothing, pa.scalar(FIRST, kind)), cut, nothing)
        if pc.any(broken).as_py():
            cut = pc.if_else(broken, pc.utf8_slice_codeunits(cut, 1), cut)
        cut = pc.split_pattern(cut, " ")
        words = cut.values.dictionary_encode()
        at = words.indices.to_numpy()
        found, ends, unclear = self._words(words.dictionary)
        ids, places = _gather(found, ends, at)
        offsets = cut.offsets.to_numpy()
        ends = places[offsets[1:]]
        whole = alone.to_numpy(zero_copy_only=False)
        if unclear.any():
            seen = np.concatenate([[0], np.cumsum(unclear[at])])[offsets]
            whole = whole | (seen[1:] > seen[:-1])
        if not whole.any():
            return ids, ends
        starts = places[offsets[:-1]]
        rows = [self._encode([texts[i].as_py()])[0] if whole[i] else ids[starts[i]:ends[i]] for i in range(len(texts))]
        return np.concatenate(rows), np.cumsum([len(x) for x in rows])


def tokenise(docs: DataFrame, path: str, end_id: int, text: str = "text", doc_id: str = "doc_id", width: int = 4,
             added: bool = False) -> DataFrame:
    """doc_id, n (with the end id), ids (unsigned little-endian, ``width`` bytes)."""
    name = f"word-ids-{path}-{added}"
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        coder = per_worker(name, lambda: WordIds(path, added))
        for whole in batches:
            for b in slices(whole, "text"):
                ids, ends = coder.encode(b.column("text"))
                ids = np.insert(ids, ends, end_id).astype(f"<u{width}")
                ends = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
                data = pa.Array.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(ends * width), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(ends), pa.int64()), data.cast(pa.binary())],
                                                 names=["doc_id", "n", "ids"])
    return (docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, n long, ids binary"))


def frequency_ranks(ids: DataFrame, vocabulary: int, width: int = 4) -> np.ndarray:
    """The ids by falling count, then by number: position = rank."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            col = b.column("ids").cast(pa.large_binary())
            off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, 8 * col.offset)
            seen = np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]]
            total += np.bincount(np.frombuffer(seen.tobytes(), f"<u{width}"), minlength=vocabulary)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])
    # one row for each id of the vocabulary at most
    rows = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocabulary, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return np.lexsort((np.arange(vocabulary), -counts)).astype("<u4")


_TAIL = "lens binary, control binary, data binary"


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, text: str = "text", doc_id: str = "doc_id",
                added: bool = False) -> None:
    """Encode ``docs`` and write a store to ``path``; with ``added`` the strings
    of added tokens become these tokens, as the library has it by default."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    size = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1)
    width = 2 if size <= 1 << 16 else 4
    raw = scratch_path(spark, "llm-token-ids")
    tokenise(docs, tokenizer_path, end_id, text, doc_id, width, added).write.option("compression", "zstd").parquet(raw)
    ids = spark.read.parquet(raw)
    order = frequency_ranks(ids, size, width)
    rank = np.empty(size, "<u4")
    rank[order] = np.arange(size)
    held = spark.sparkContext.broadcast(rank.tobytes())
    spark.createDataFrame([(order.tobytes(),)], "ids binary").write.parquet(f"{path}/ranks")
    kind = ids.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, seq, before, count = TaskContext.get().partitionId(), 0, 0, 0
        ranks = np.frombuffer(held.value, "<u4")
        kept, held_ids = [], []

        def block():
            values = np.concatenate(held_ids)
            control, data = pack(ranks[values])
            ids_of = pa.chunked_array([b for b in kept]).combine_chunks()
            lens = np.array([len(x) for x in held_ids], "<i8").tobytes()
            row = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()),
                   pa.ListArray.from_arrays(pa.array([0, len(ids_of)], pa.int32()), ids_of)]
            return pa.RecordBatch.from_arrays([*row, *[pa.array([x], pa.binary()) for x in (lens, control, data)]],
                                              names=["part", "seq", "before", "doc_ids", "lens", "control", "data"])
        for b in batches:
            for i, x in enumerate(b.column("ids")):
                held_ids.append(np.frombuffer(x.as_py(), f"<u{width}"))
                kept.append(b.column("doc_id").slice(i, 1))
                count += len(held_ids[-1])
                if count >= BLOCK:
                    yield block()
                    seq, before, count = seq + 1, before + count, 0
                    kept, held_ids = [], []
        if held_ids:
            yield block()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (ids.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
     .mapInArrow(run, f"part int, seq int, before long, doc_ids array<{kind}>, {_TAIL}")
     .write.option("compression", "zstd").parquet(f"{path}/blocks"))


def read_store(spark: SparkSession, path: str, made=None, columns: str = "ids array<long>") -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and the columns
    that ``made(ids)`` gives for a document's uint32 ids (default: the ids)."""
    blocks = spark.read.parquet(f"{path}/blocks")
    ids = spark.read.parquet(f"{path}/ranks").first()["ids"]
    held = spark.sparkContext.broadcast(bytes(ids))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    # one row for each file range
    last = blocks.groupBy("part").agg(F.max(F.struct("seq", F.col("before"), F.col("lens"))).alias("m")).select("part", "m.before", "m.lens")
    base, total = {}, 0
    for r in sorted(last.collect(), key=lambda r: r["part"]):
        base[r["part"]] = total
        total += r["before"] + int(np.frombuffer(r["lens"], "<i8").sum())
    made = made or (lambda x: (x.tolist(),))
    names = [c.split(" ")[0] for c in columns.split(", ")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        table = np.frombuffer(held.value, "<u4")
        for b in batches:
            for k in range(b.num_rows):
                lens = np.frombuffer(b.column("lens")[k].as_py(), "<i8")
                ends = np.cumsum(lens)
                values = table[unpack(b.column("control")[k].as_py(), b.column("data")[k].as_py(), int(ends[-1]))]
                start = base[b.column("part")[k].as_py()] + b.column("before")[k].as_py() + ends - lens
                cols = list(zip(*[made(values[e - n:e]) for n, e in zip(lens.tolist(), ends.tolist())]))
                yield pa.RecordBatch.from_arrays([b.column("doc_ids")[k].values, pa.array(start), pa.array(lens), *[pa.array(c) for c in cols]],
                                                 names=["doc_id", "start", "n_tokens", *names])
    return blocks.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, {columns}")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents to a store and describe what it gives back."""
    import public_tokenizers

    path = scratch_path(spark, "llm-token-store")
    write_store(load(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 2, added=True)
    return read_store(spark, path, lambda x: (zlib.crc32(x.astype("<u4").tobytes()),), "ids_crc32 long")
