"""Operators on words and tokens against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cases import ALNUM, WORD, awkward, frame, lower, prose
from tidewater.llm import bitslice, bpe, components, decontaminate, lines, simhash, substrings, token_store


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


# ---- decontamination

def windows_of(text):
    w = ALNUM.findall(lower(text))
    return [tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))] if w else []


def brute_hits(rows, items):
    where = defaultdict(set)
    for i, t in items:
        for x in windows_of(t):
            where[x].add(i)
    out = []
    for d, t in rows:
        w = ALNUM.findall(lower(t))
        hit, ids = set(), set()
        for n in {len(x) for x in where}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in where:
                    hit |= set(range(i, i + n))
                    ids |= where[tuple(w[i:i + n])]
        out.append((str(d), len(w), len(hit), sorted(str(x) for x in ids if x is not None)))
    return sorted(out)


@pytest.mark.parametrize("block", [1_000_000, 7])
def test_contamination(spark, block):
    rows = awkward()
    text = dict((i, t) for i, t in rows if t)
    long = sorted(text.values(), key=len)[-4]
    items = [(1, long[:300]), (22, "W1 w2, W3"), (3, None), (4, ""), (5, rows[25][1]), (5, rows[25][1]), (None, rows[30][1]), (6, "a b")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.find_contamination(frame(spark, rows), bench, block=block).collect()
    got = sorted((str(r.doc_id), r.found_.n_words, sum(s.b - s.a for s in r.found_.spans), list(r.found_["items"])) for r in out)
    assert got == brute_hits(rows, items)
    clean = decontaminate.drop_contaminated(frame(spark, rows), bench, block=block)
    assert clean.columns == frame(spark, rows).columns
    assert clean.count() == sum(1 for r in got if r[2] == 0)
    cut = decontaminate.remove_spans(frame(spark, rows), bench, block=block)
    assert cut.count() == len(rows)
    left = {r.doc_id: r.text for r in cut.collect() if r.doc_id is not None}
    assert left[rows[25][0]] is not None and len(left[rows[25][0]].split()) < 3


def test_contamination_of_nothing(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_contaminated(frame(spark, awkward()), bench).count() == len(awkward())
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.drop_contaminated(frame(spark, awkward()).limit(0), some).count() == 0


# ---- SimHash

def brute_fp(text):
    import xxhash
    w = WORD.findall(lower(text))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(n, linked):
    top = list(range(n))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def test_near_copies(spark):
    rows = awkward() + [(1000 + i, f"{prose(__import__('random').Random(9), 150)} tail{i}") for i in range(12)]
    fp = [brute_fp(t) for _, t in rows]
    group = classes(len(rows), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 3)
    least = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    out = simhash.group_near_copies(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in out) == \
        Counter((i, f, least.get(g)) for (i, _), f, g in zip(rows, fp, group))
    kept = simhash.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(group)) and set(x for x in ids if x is not None) == set(least.values())


def test_unrelated_documents_with_one_id_are_kept(spark):
    import random
    rnd = random.Random(21)
    apart = [prose(rnd, 80) for _ in range(8)]
    rows = [(None, t) for t in apart[:4]] + [(None, apart[0])] + [(7, apart[4]), (7, apart[5]), (7, apart[5]), (8, apart[6]), (9, apart[7])]
    kept = simhash.keep_one(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(set(rows))


def test_near_copies_of_nothing(spark):
    assert simhash.group_near_copies(frame(spark, [(1, "a")]).limit(0)).collect() == []
    assert simhash.keep_one(frame(spark, [(1, "a")]).limit(0)).collect() == []


@pytest.mark.parametrize("tile", [1024, 8])
def test_links_against_all_pairs(spark, tile):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(8):
            fps.add(int(s) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 8), replace=False)))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    from pyspark.sql import functions as F
    keyed = nodes.select("fp", F.explode(F.expr(simhash._keys("fp"))).alias("key"))
    got = {r.node: r.root for r in components.components(simhash.linked_in_keys(keyed, 3, tile)).collect()}
    want = classes(len(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    parts = defaultdict(set)
    for k, f in enumerate(signed):
        parts[got.get(f, f)].add(want[k])
    assert all(len(v) == 1 for v in parts.values()) and len(parts) == len(set(want))
    near = lines.near_fingerprints(nodes, 5, crowd=tile)
    got = {r.node: r.root for r in components.components(near).collect()}
    want = classes(len(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 5)
    parts = defaultdict(set)
    for k, f in enumerate(signed):
        parts[got.get(f, f)].add(want[k])
    assert all(len(v) == 1 for v in parts.values()) and len(parts) == len(set(want))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    a = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    b = a.copy()
    for k in range(500):
        for bit in rng.choice(64, rng.integers(0, 12), replace=False):
            b[k] ^= np.uint64(1) << np.uint64(bit)
    planes = bitslice.planes_of(np.concatenate((a, b)))
    got = bitslice.within(planes, np.arange(500), np.arange(500, 1000), radius)
    want = [(int(x) ^ int(y)).bit_count() <= radius for x, y in zip(a, b)]
    assert got.tolist() == want


def test_components_of_a_path(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 2000), (7, 7), (None, 3)]
    out = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(301)}, 1000: 1000, 2000: 1000}


# ---- token store and BPE

def texts_for_tokens():
    return awkward() + [(500 + i, t) for i, t in enumerate(["<|endoftext|> a", "  two  spaces ", "tab\t then", "it's I'll 12345 !!", "é" * 3000])]


def test_token_store(spark, tmp_root):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    rows = texts_for_tokens()
    path = P.path("byte_bpe_50k.json")
    token_store.write_store(frame(spark, rows), f"{tmp_root}/store", path, 2)
    out = sorted(token_store.read_store(spark, f"{tmp_root}/store").collect(), key=lambda r: r.start)
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    want = Counter((i, *tok.encode(t or "", add_special_tokens=False).ids, 2) for i, t in rows)
    assert Counter((r.doc_id, *r.ids) for r in out) == want
    key = [(r.doc_id is not None, r.doc_id or 0) for r in out]
    assert key == sorted(key)
    at = 0
    for r in out:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens


def test_token_store_query_has_added_tokens(spark, tmp_root, monkeypatch):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    rows = texts_for_tokens() + [(900, "a <|endoftext|> b"), (901, "x<|endoftext|><|endoftext|>\ny"), (902, "a <|endoftext b")]
    monkeypatch.setattr(token_store, "load", lambda *a: frame(spark, rows))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = [np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in rows]
    assert sum(50256 in x for x in ids) == 3
    want = Counter((i, len(x), zlib.crc32(x.tobytes())) for (i, _), x in zip(rows, ids))
    out = token_store.op5_token_store(spark, "").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == want


@pytest.mark.parametrize("top", [200, 1 << 8, 1 << 16, 1 << 24, (1 << 32) - 1])
def test_variable_length_code(top):
    rng = np.random.default_rng(top)
    for n in (0, 1, 3, 4, 5, 1000):
        x = rng.integers(0, top, n, endpoint=True).astype("<u4")
        control, data = token_store.pack(x)
        assert len(control) == -(-n // 4)
        assert token_store.unpack(control, data, n).tolist() == x.tolist()


def test_bpe(spark):
    import tiktoken
    rows = texts_for_tokens()
    ranks, pattern = bpe.public_ranks()
    lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    docs = frame(spark, rows).withColumnRenamed("found", "ids")
    out = bpe.round_trip(docs, ranks, pattern).collect()
    want = Counter((i, len(x := lib.encode_ordinary(t or "")), sha(" ".join(map(str, x))), sha(t or "")) for i, t in rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == want
    coded = bpe.encode(docs, ranks, pattern)
    back = bpe.decode(coded, ranks)
    assert Counter((r.doc_id, bytes(r.text).decode()) for r in back.collect()) == Counter((i, t or "") for i, t in rows)
    assert bpe.round_trip(docs.limit(0), ranks, pattern).collect() == []


def test_bpe_pieces_against_merging():
    import random
    ranks, _ = bpe.public_ranks()
    coder = bpe.Encoder(ranks)
    rnd = random.Random(5)
    for k in range(400):
        piece = bytes(rnd.choice(b"abeinorst thes\xc3\xa9\xff") for _ in range(rnd.randrange(1, 40)))
        assert coder.encode_piece(piece) == ([ranks[piece]] if piece in ranks else coder.merge(piece))


# ---- repeated windows

def brute_repeats(rows, length):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = {p for i in range(len(w) - length + 1) if seen[tuple(w[i:i + length])] > 1 for p in range(i, i + length)}
        out.append((d, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


@pytest.mark.parametrize("length", [35, 3, 1])
def test_repeats(spark, length):
    rows = awkward()
    out = substrings.remove_repeats(frame(spark, rows), length).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out) == brute_repeats(rows, length)


def test_repeats_across_units(spark, monkeypatch):
    monkeypatch.setattr(substrings, "UNIT", 50)
    rows = awkward(2)
    out = substrings.remove_repeats(frame(spark, rows, 1), 10).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out) == brute_repeats(rows, 10)
    assert substrings.remove_repeats(frame(spark, rows).limit(0)).collect() == []


# ---- lines

def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_similarity():
    import random
    rnd = random.Random(3)
    for _ in range(1500):
        a = "".join(rnd.choice("ab c") for _ in range(rnd.randrange(0, 40)))
        b = list(a)
        for _ in range(rnd.randrange(0, 12)):
            b.insert(rnd.randrange(len(b) + 1), rnd.choice("abcx ")) if rnd.random() < .5 or not b else b.pop(rnd.randrange(len(b)))
        b = "".join(b)
        longest = max(len(a), len(b))
        assert lines.edit_similar(a, b) == (edit(a, b) <= int(0.2 * longest + 1e-9)), (a, b)


def brute_lines(rows):
    """Rows after line deduplication, all pairs of lines compared."""
    import re
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    seen = {}
    for i, t in docs:
        for n, line in enumerate(t.split("\n")):
            w = [re.sub(r"[0-9]", "0", x) for x in ALNUM.findall(lower(line))]
            if len(w) >= 5:
                seen.setdefault(" ".join(w), []).append((i, t, n))
    keys = list(seen)
    fp = []
    for k in keys:
        import pyarrow as pa
        fp.append(int(lines.Lines(pa.array([k])).fp[0]))
    group = classes(len(keys), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 5 and lines.edit_similar(keys[a], keys[b]))
    places = defaultdict(list)
    for k, g in zip(keys, group):
        places[g] += seen[k]
    rank = {r: k for k, r in enumerate(docs)}
    gone = set()
    for p in places.values():
        p.sort(key=lambda x: (rank[x[:2]], x[2]))
        gone |= set(p[1:])
    return Counter((i, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, t, n) not in gone)) for i, t in rows)


def line_rows():
    import random
    rnd = random.Random(11)
    line = [prose(rnd, rnd.randrange(3, 60)) for _ in range(25)]
    rows = [(i, "\n".join(rnd.choice(line) if rnd.random() < .6 else prose(rnd, 30) for _ in range(rnd.randrange(1, 8)))) for i in range(60)]
    typo = lambda x: x[:len(x) // 2] + "q" + x[len(x) // 2 + 1:]
    rows += [(100 + i, typo(rnd.choice(line)) + "\n" + rnd.choice(line).upper() + "!\n\n") for i in range(30)]
    return rows + [(200, None), (201, ""), (202, "\n\n"), (203, "short line"), (204, "short line"), (None, line[0]), rows[3], (205, "a b c d e f " * 3000)]


@pytest.mark.parametrize("small", [False, True])
def test_lines(spark, monkeypatch, small):
    if small:
        for name, n in (("TILE", 2), ("KNOWN", 3), ("UNIT", 5)):
            monkeypatch.setattr(lines, name, n)
    rows = line_rows()
    docs = frame(spark, rows)
    out = lines.drop_repeated_lines(docs, dropped="n_gone")
    assert out.columns == [*docs.columns, "n_gone"]
    assert Counter((r.doc_id, r.text) for r in out.collect()) == brute_lines(rows)


def test_lines_as_they_stand_and_digits(spark):
    import random
    rnd = random.Random(17)
    long = " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(12))
    chinese = "这是一行没有空格的中文文本需要完全相同才会被删除掉吗"
    rows = [(1, "short line\n\n-----\n" + chinese), (2, "Short line\n\n-----\n" + chinese + "\nshort line"),
            (3, "2019 12 34 56 78\n2018 98 76 54 32\n" + long + " 2019"), (4, "2019 12 34 56 78\n" + long.upper() + "! 2018\n  \n  "), (5, None)]
    out = lines.drop_repeated_lines(frame(spark, rows), dropped="n_gone", whole=True).collect()
    assert {r.doc_id: (r.text, r.n_gone) for r in out} == {
        1: (rows[0][1], 0), 2: ("Short line\n", 3), 3: (rows[2][1], 0), 4: ("  \n  ", 2), 5: (None, 0)}


def test_lines_of_nothing(spark):
    assert lines.drop_repeated_lines(frame(spark, [(1, "a")]).limit(0)).collect() == []


def test_crc_query_columns():
    assert zlib.crc32(b"") == 0


def test_majority_of_long_lines():
    """Runs of one hash, of 255, 256 and many more, against bits counted one by one."""
    rng = np.random.default_rng(8)
    sizes = [1, 2, 255, 256, 3, 511, 1000, 1]
    h = rng.integers(0, 1 << 63, sum(sizes), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, sum(sizes), dtype=np.uint64)
    first = np.cumsum([0, *sizes[:-1]])
    want = [sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h[a:a + n]) > n) for a, n in zip(first, sizes)]
    assert lines.majority(h, first).tolist() == want


def test_word_ids_are_the_librarys(monkeypatch):
    """Words cut by Arrow: every text's ids are those of the library, with and without added tokens, also
    where the table of known words begins anew."""
    import pyarrow as pa
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = ["a", "word", "Wörter", "é́", "漢字", "don't", "it's?", "x,", "ok!!", ";;", "12", "3.5", "", " ", "\n", "\n\n", "\t", "\r\n", "\x1c",
              "　", "ẞx", "<|endoftext|>", "l'eau.", "|", "...", "a*b", "\U0001f600."]
    rnd = random.Random(7)
    texts = ["", None, " a", "\nx\n\ny", "  \n", "\n", "x\n", "<|endoftext|>"]
    texts += [rnd.choice([" ", "\n", ""]).join(rnd.choice(pieces) for _ in range(rnd.randint(1, 12))) for _ in range(400)]
    for added in (False, True):
        coder = token_store.WordIds(path, added)
        for kept in (40, 1_000_000):
            monkeypatch.setattr(token_store, "KEPT", kept)
            for some in (texts, texts[5:60], texts[:1], []):
                ids, ends = coder.encode(pa.array(some, pa.string()))
                starts = [0, *ends[:-1]]
                assert len(ends) == len(some)
                for t, a, b in zip(some, starts, ends):
                    assert ids[a:b].tolist() == coder.tokenizer.encode(t or "", add_special_tokens=False).ids, (t, added)


def test_word_ids_keep_words_without_their_marks(monkeypatch):
    """A word goes to the library once, whatever marks come after it, and its forms take no room in the table."""
    import pyarrow as pa
    import public_tokenizers

    class Seen:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, []

        def encode_batch_fast(self, texts, **more):
            self.texts += texts
            return self.tokenizer.encode_batch_fast(texts, **more)

    monkeypatch.setattr(token_store, "KEPT", 200)
    coder = token_store.WordIds(public_tokenizers.path("byte_bpe_50k.json"), True)
    library = coder.tokenizer
    coder.tokenizer = seen = Seen(library)
    words = [f"q{a}{b}éx" for a in "abcd" for b in "xyz"]
    for marks in ([".", ",", "!?"], ["", "***", ".;"], [":", "|", "&&"]):
        texts = [f"{marks[0]}{w} {w}{m}\n{w}{marks[0]} a{m} 3{m}" for w in words for m in marks]
        ids, ends = coder.encode(pa.array(texts))
        for t, a, b in zip(texts, [0, *ends[:-1]], ends):
            assert ids[a:b].tolist() == library.encode(t, add_special_tokens=False).ids, t
    given = "\0".join(seen.texts)
    assert [given.count(f" {w}") for w in words] == [1] * len(words)
