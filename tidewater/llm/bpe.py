"""Byte-level BPE encoding and decoding.

Tokens are bytes; mapped to Latin-1 they are strings for an Aho-Corasick
automaton, which gives the longest token starting at each byte of a piece. A
piece is then encoded from the left by trying the longest token first and, when
the next one does not fit, the next shorter prefix that is a token, stepping
back where nothing fits. Two neighbours fit if BPE would not merge across their
border; that depends on the two tokens alone and is remembered, as is every
byte position found to be a dead end, so the work is linear in the piece's
length and the result is that of the merges in rank order.

Pieces are the matches of the tokenizer's pattern. A piece that is itself a
token is that token. Encoded pieces, and the words between spaces, are kept in
tables that are emptied when they reach ``KEPT`` entries.

Null is empty; no text is cut.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, per_worker, slices, utf8

KEPT = 400_000            # entries in each table of a worker: about 100 MB; twice that for words
ODD = ("\x1c", "\x1d", "\x1e", "\x1f")    # white space to Python, not to the pattern


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Kept(dict):
    """A table filled by ``make(key)`` on first use. At ``most`` entries it
    starts anew, and takes over from the full one what is asked for again."""

    def __init__(self, make, most: int = KEPT):
        super().__init__()
        self.make, self.most, self.older = make, most // 2, {}

    def __missing__(self, key):
        value = self.older.pop(key, self)
        if value is self:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """BPE over ranks ``token -> rank``; every single byte must be a token."""

    def __init__(self, ranks: dict[bytes, int], kept: int = KEPT):
        import ahocorasick

        self.ranks = ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.token[r] = t
        self.size = [len(t) for t in self.token]
        self.decimal = [str(r).encode() for r in range(len(self.token))]
        found = ahocorasick.Automaton()
        for t, r in ranks.items():
            found.add_word(t.decode("latin-1"), (r, len(t) - 1))
        found.make_automaton()
        self.matches = found.iter
        self.shorter = Kept(self._shorter, 2 * len(ranks))
        self.halves = Kept(self._halves, 2 * len(ranks))
        self.fit = Kept(self._compatible, kept)

    def _shorter(self, rank: int) -> int | None:
        """The longest token that is a proper prefix of a token."""
        t = self.token[rank]
        return next((r for n in range(len(t) - 1, 0, -1) if (r := self.ranks.get(t[:n])) is not None), None)

    def _halves(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, or for
        a token that merges of lower rank do not reach."""
        parts = self._merged(self.token[rank], rank)
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def _merged(self, piece: bytes, below: float = float("inf")) -> list[bytes]:
        """Merges of a rank under ``below``, lowest first, leftmost first."""
        parts = [piece[k:k + 1] for k in range(len(piece))]
        while True:
            best = min(((r, k) for k in range(len(parts) - 1)
                        if (r := self.ranks.get(parts[k] + parts[k + 1])) is not None and r < below), default=None)
            if best is None:
                return parts
            k = best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Whether BPE leaves these two tokens side by side.

        Both are taken apart again, last merge first. At each state the two
        tokens at the border must not merge before the later of the merges
        already undone."""
        left, right = pair
        # a merge across the border happens if its rank is lower than that of the
        # next merge on its left, and no higher than on its right (the leftmost goes first)
        token, halves, rank = self.token, self.halves, self.ranks.get
        next_left = next_right = len(token)   # ranks that the border tokens go on to become
        while True:
            merged = rank(token[left] + token[right])
            if merged is not None and merged < next_left and merged <= next_right:
                return False
            a, b = halves[left], halves[right]
            # undo the merge that came last: the higher rank; of equals the one further right
            if a is not None and (b is None or left > right):
                next_left, left = left, a[1]
            elif b is not None:
                next_right, right = right, b[0]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, size, fit, shorter = len(piece), self.size, self.fit, self.shorter
        longest = [0] * n
        for end, (rank, back) in self.matches(piece.decode("latin-1")):
            longest[end - back] = rank        # ends grow, so the longest stays
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + size[token]
            if not dead[end] and (not out or fit[out[-1], token]):
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest[at]
                continue
            less = shorter[token]
            while less is None:
                # nothing fits here: this position is a dead end, go back
                dead[at] = 1
                if not out:
                    return self.merge(piece)
                token = out.pop()
                at -= size[token]
                less = shorter[token]
            token = less

    def merge(self, piece: bytes) -> list[int]:
        """Merges in rank order, one by one: for vocabularies with tokens that
        merges do not reach, where the walk above may find no way."""
        return [self.ranks[p] for p in self._merged(piece)]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class TextCoder:
    """Whole texts by way of pieces.

    The pattern always ends a piece between a character that is not white space
    and a space, so a text is cut at single spaces and the parts are looked up
    one by one; a text where a part is empty or ends in white space goes through
    the pattern as a whole."""

    def __init__(self, encoder: Encoder, pattern: str, shown, kept: int = KEPT):
        import regex

        self.pieces = regex.compile(pattern).findall
        self.encoder, self.shown = encoder, shown
        self.piece = Kept(lambda p: encoder.encode_piece(p.encode()), kept)
        self.word = Kept(self._word, 2 * kept)

    def _word(self, part: str):
        if not part or part == " " or part[-1].isspace():
            return None
        piece = self.piece
        return self.shown(self.encoder, [r for p in self.pieces(part) for r in piece[p]])

    def parts(self, text: str) -> list:
        """``shown`` of the ids of the text's parts, in order."""
        if not text:
            return []
        if not any(c in text for c in ODD):
            words = text.split(" ")
            found = [self.word[words[0]]] if words[0] else []
            found += map(self.word.__getitem__, map(" ".__add__, words[1:]))
            if None not in found:
                return found
        return [self.shown(self.encoder, self.piece[p]) for p in self.pieces(text)]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column ``ids`` (array<int>) in place of the text."""
    return _mapped(docs, ranks, pattern, text, [(ids, "array<int>")],
                   lambda encoder, found: found, lambda parts: ([r for p in parts for r in p],))


def decode(docs: DataFrame, ranks: dict[bytes, int], ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with the bytes of ``ids`` as a column ``text`` (binary)."""
    held = docs.sparkSession.sparkContext.broadcast({r: t for t, r in ranks.items()})
    rest = [c for c in docs.columns if c != ids]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != ids)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        token = held.value
        for b in batches:
            made = [b"".join(token[r] for r in (v.as_py() or ())) for v in b.column(len(rest))]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], pa.array(made, pa.binary())], names=[*rest, text])
    return docs.select(*[f"`{c}`" for c in rest], F.col(f"`{ids}`").alias("__ids")).mapInArrow(run, (kinds + ", " if kinds else "") + f"`{text}` binary")


def _mapped(docs: DataFrame, ranks: dict, pattern: str, text: str, made: list[tuple[str, str]], shown, whole, kept: int = KEPT) -> DataFrame:
    """The text replaced by the columns ``made`` = ``whole`` of its parts as
    ``shown``. ``kept`` bounds a worker's tables, not the results."""
    import pyarrow as pa

    held = docs.sparkSession.sparkContext.broadcast(ranks)
    name = f"bpe-{uuid.uuid4().hex}"
    rest = [c for c in docs.columns if c != text and c not in [m for m, _ in made]]
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    types = [kinds[k] for _, k in made]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in rest] + [f"`{n}` {k}" for n, k in made])
    names = [*rest, *[n for n, _ in made]]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        coder = per_worker(name, lambda: TextCoder(Encoder(held.value, kept), pattern, shown, kept))
        for given in batches:
            for b in slices(given, "__text", 2 << 20):
                rows = [whole(coder.parts(t.decode())) for t in utf8(b.column("__text"))]
                yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], names=names)
    return docs.select(*[f"`{c}`" for c in rest], F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)


def _shown(encoder: Encoder, ids: list[int]) -> tuple[int, bytes, bytes]:
    """How many ids, the ids in decimal, and the bytes they decode to."""
    decimal, token = encoder.decimal, encoder.token
    return len(ids), b" ".join([decimal[r] for r in ids]), b"".join([token[r] for r in ids])


def _digests(parts: list) -> tuple[int, str, str]:
    n, ids, text = zip(*parts) if parts else ((), (), ())
    return sum(n), hashlib.sha256(b" ".join(ids)).hexdigest(), hashlib.sha256(b"".join(text)).hexdigest()


def encode_and_check(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", kept: int = KEPT // 8) -> DataFrame:
    """ids, n_tokens and decoded_sha256 (of the bytes the ids decode to) in place of the text."""
    def shown(encoder: Encoder, found: list[int]) -> tuple[list[int], bytes]:
        return found, encoder.decode(found)

    def whole(parts: list) -> tuple[list[int], int, str]:
        made = [r for ids, _ in parts for r in ids]
        return made, len(made), hashlib.sha256(b"".join(x for _, x in parts)).hexdigest()
    return _mapped(docs, ranks, pattern, text, [("ids", "array<int>"), ("n_tokens", "long"), ("decoded_sha256", "string")], shown, whole, kept)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """n_tokens, ids_sha256, decoded_sha256 in place of the text."""
    return _mapped(docs, ranks, pattern, text, [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")],
                   _shown, _digests)


def public_ranks(path: str = "byte_bpe_50k.tiktoken") -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return read_ranks(public_tokenizers.path(path)), public_tokenizers.PATTERN


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    return round_trip(load(spark, sf_dir, "documents").select("doc_id", "text"), *public_ranks())
