"""Top-k search, hard negatives and phrases against brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import types as T


def vectors(seed=3):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(-20, 400):
        c = centres[rnd.randrange(5)]
        rows.append((i, [x + rnd.gauss(0, 0.05 if i % 3 else 1) for x in c], rnd.randrange(4)))
    crowd = centres[0]
    rows += [(1000 + 10 * i, list(crowd), i % 2) for i in range(150)]           # equal vectors
    rows += [(100, centres[1], 1), (100, centres[2], 2), (200, list(crowd), 1), (200, list(crowd), 1)]   # shared ids
    rows += [(300, [0.0] * 6, 1), (500, None, 1), (600, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (None, centres[0], 1),
             (700, [math.nan] * 6, 1), (800, [math.inf] + [0.0] * 5, 1), (900, centres[3], None),
             (1100, [1.0, 2.0], 1), (1101, [2.0, 1.0], 1), (1102, [1.9, 1.0], 2), (1200, [], 1), (1201, [], 2),
             (1300, [1e300, 1.0, -1.0], 1), (1301, [1e300, -1e300, 3.0], 1), (1302, [5e15, 1.0, 7.0], 2), (1400, [-9.0, 0.25, 1e8], 2)]
    return rows


SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("label", T.IntegerType()),
                       *[T.StructField(c, T.IntegerType()) for c in ("row", "id", "vec", "key", "state", "score", "rank")]])


def table(spark, tmp_root, rows, name="embeddings"):
    import os
    import tempfile
    d = tempfile.mkdtemp(dir=tmp_root)
    spark.createDataFrame([(*r, *[7] * 7) for r in rows], SCHEMA).repartition(3).write.parquet(os.path.join(d, f"{name}.parquet"))
    return d


def code(vec, factor):
    return [math.floor(x) * factor if abs(x) >= 2 ** 53 else math.floor(x * factor) for x in vec]


def usable(rows, factor):
    return [(i, code(v, factor), lab) for i, v, lab in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]


def inner(a, b):
    return max(-(1 << 60), min(1 << 60, sum(x * y for x, y in zip(a, b))))


def brute_top(rows, k):
    rows = usable(rows, 1024)
    out = Counter()
    for qn, (q, qv, _) in enumerate(rows):
        if q % 100:
            continue
        got = sorted((-inner(qv, v), i) for n, (i, v, _) in enumerate(rows) if n != qn and len(v) == len(qv))[:k]
        out.update((q, r, i, -s) for r, (s, i) in enumerate(got, 1))
    return out


def brute_negatives(rows):
    rows = [(i, v, lab) for i, v, lab in usable(rows, 256) if lab is not None]
    rows = [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows]
    out = Counter()
    for an, (a, av, al) in enumerate(rows):
        if a % 100:
            continue
        s = sorted((-inner(av, v), i, lab == al) for n, (i, v, lab) in enumerate(rows) if n != an and len(v) == len(av))
        for ps, p, _ in [x for x in s if x[2]][:5]:
            window = [x for x in s if not x[2] and 80 * -ps <= 100 * -x[0] <= 100 * -ps][:5]
            out.update((a, p, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(window, 1))
    return out


def test_topk_brute_force(spark, tmp_root):
    from tidewater.llm.topk import op12_topk
    rows = vectors()
    got = op12_topk(spark, table(spark, tmp_root, rows))
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert Counter(map(tuple, got.collect())) == brute_top(rows, 10)
    assert op12_topk(spark, table(spark, tmp_root, [])).count() == 0


def test_topk_grid_and_rounds(spark, monkeypatch, tmp_root):
    """Many tiles and blocks, and few bins: the same rows."""
    from tidewater.llm import topk, vector_blocks
    monkeypatch.setattr(vector_blocks, "BLOCK_BYTES", 8 * 6 * 16)
    monkeypatch.setattr(vector_blocks, "QUERY_TILE", 4)
    monkeypatch.setattr(topk, "BINS", 5)
    rows = vectors(4)[:300]
    assert Counter(map(tuple, topk.op12_topk(spark, table(spark, tmp_root, rows)).collect())) == brute_top(rows, 10)


def test_hard_negatives_brute_force(spark, tmp_root):
    from tidewater.llm.negatives import op11_hard_negatives
    rows = vectors(5)
    got = op11_hard_negatives(spark, table(spark, tmp_root, rows))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows)
    assert len(want) > 30
    assert Counter(map(tuple, got.collect())) == want
    assert op11_hard_negatives(spark, table(spark, tmp_root, [])).count() == 0


def test_score_bounds_hold_and_prune():
    """No score leaves its bounds; near anchors, most far rows are left unscored."""
    import numpy as np

    from tidewater.llm import negatives as N
    from tidewater.llm import vector_blocks as V
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 32))
    v = (centres[rng.integers(0, 8, 600)] + 0.1 * rng.normal(size=(600, 32))) * rng.uniform(0.1, 3, (600, 1))
    c = V.codes(v, 256)
    refs = N._unit(V.codes(centres, 256))

    class Rows:
        codes, angle = c, N.angles_to(c, refs)
    norm = N._norms(c)
    lower, upper = N.pair_bounds(Rows.angle, norm, Rows, norm)
    s = V.products(c, c)
    assert ((lower <= s) & (s <= upper)).all()
    assert (upper < 0.8 * np.sort(s, axis=1)[:, -6][:, None]).mean() > 0.5
    low, high = N.block_bounds(Rows, norm, Rows, norm)
    assert ((low[:, None] <= s) & (s <= high[:, None])).all()


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e5, 1e12])
def test_products_are_exact(scale):
    import numpy as np

    from tidewater.llm import vector_blocks as V
    rng = np.random.default_rng(2)
    a, b = V.codes(scale * rng.normal(size=(5, 40)), 1024), V.codes(scale * rng.normal(size=(7, 40)), 1024)
    want = [[inner([int(x) for x in r], [int(y) for y in t]) for t in b] for r in a]
    assert V.products(a, b).tolist() == want


def brute_phrases(rows, least, within=80, best=2000):
    import re
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            f.update((lang, *w[i:i + n]) for n in range(1, 5) for i in range(len(w) - n + 1))
    out = []
    longer = Counter()
    for p, a in f.items():
        if a >= least:
            for n in range(2, len(p) - 1):
                for i in range(1, len(p) - n + 1):
                    longer[(p[0], *p[i:i + n])] = max(a, longer[(p[0], *p[i:i + n])])
    for p, a in f.items():
        if len(p) > 2 and a >= least and not 100 * longer[p] >= within * a:
            s, k = min((2000000 * a // (f[p[:k]] + f[(p[0], *p[k:])]), k) for k in range(2, len(p)))
            out.append((p[0], -s, -a, " ".join(p[1:]).encode(), f[p[:k]], f[(p[0], *p[k:])]))
    rank, want = Counter(), set()
    for lang, s, a, p, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= best:
            want.add((lang, rank[lang], p.decode(), -a, left, right, total[lang], -s))
    return want


def texts(seed=7):
    rnd = random.Random(seed)
    words = ["The", "the", "of", "Ünï", "漢字", "x\u00a0y", "\x1cq", "w'1", "é"] + [f"w{i}" for i in range(12)]
    gaps = [" "] * 12 + ["\t", "  ", ", ", ".", "\n", "\r\n", " ; ", "\x0b", "\x85"]
    say = lambda n: "".join(rnd.choice(words[:9] if rnd.random() < 0.6 else words) + rnd.choice(gaps) for _ in range(n))
    rows = [(say(rnd.randrange(0, 80)), rnd.choice(["en", "de", None, "und"])) for _ in range(120)]
    rows += [("new York City hall " * 40 + say(20), "en")] * 3 + [(say(4000), "de")]
    return rows + [(None, "en"), ("", None), (" \t.,", "fr"), (None, None), ("z" * 3000 + " one", "en")]


def phrase_frame(spark, rows):
    return spark.createDataFrame([(t, lang, 1, 2) for t, lang in rows], "text string, lang string, words int, n int").repartition(3)


def test_phrases_brute_force(spark):
    from tidewater.llm.phrases import collocations
    rows = texts()
    got = collocations(phrase_frame(spark, rows), least=5)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    want = brute_phrases(rows, 5)
    assert len(want) > 200
    assert set(map(tuple, got.collect())) == want
    assert collocations(phrase_frame(spark, rows).limit(0)).count() == 0


def test_phrases_with_small_memory(spark, monkeypatch):
    """Bursting, spilling, new word lists, chunks cut inside texts and a crowded bit table change nothing."""
    from tidewater.llm import phrases
    for name, value in (("BURST", 5), ("MOST_ENTRIES", 200), ("CHUNK", 500), ("MOST_WORDS", 25), ("RUN_ENTRIES", 20), ("PARTS", 3)):
        monkeypatch.setattr(phrases, name, value)
    rows = texts(8)
    got = phrases.collocations(phrase_frame(spark, rows), least=4, best=30, filter_bits=7)
    assert set(map(tuple, got.collect())) == brute_phrases(rows, 4, best=30)


def test_hat_trie_bursts():
    """Containers split by ranges of first words and, under a hot one, of second words; counts stay whole."""
    import numpy as np

    from tidewater.llm import phrases as P
    rng = np.random.default_rng(5)
    burst, P.BURST = P.BURST, 40
    try:
        trie, want = P.HatTrie(), Counter()
        for _ in range(30):
            first = np.where(rng.random(200) < 0.5, 7, rng.integers(1, 60, 200))
            second, third = rng.integers(1, 30, 200), rng.integers(0, 3, 200)
            rest = (second << 2 * P.WORD_BITS) | (third << P.WORD_BITS)
            want.update(zip(first.tolist(), rest.tolist()))
            trie.add(first, rest)
        leaves = trie.containers()
        assert 7 in trie.leaves and len(trie.leaves[7]) > 1 and len(trie.leaves[None]) > 2
        got = Counter()
        for c in leaves:
            c.merge()
            got.update({(f, r): n for f, r, n in zip(*(x.tolist() for x in c.held[1:]))})
        assert got == want and sum(len(c.held[0]) for c in leaves) == len(want)
    finally:
        P.BURST = burst
