"""Learned operators: held-out accuracy, and that awkward input is scored."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import awkward, frame, prose
from tidewater.llm import neighbours, quality, toxicity


def corpus(spark, seed=4, n=900):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        text, bad, toxic = prose(rnd, rnd.randrange(20, 150)), i % 7 == 0, i % 5 == 0
        if toxic:
            words = text.split(" ")
            for w in rnd.sample(["idiot", "scum", "moron", "slimeball", "slimeface"], 3):
                words.insert(rnd.randrange(len(words)), w)
            text = " ".join(words)
        if bad:
            text = " ".join(w + rnd.choice(["!!", "***"]) for w in text.split(" ")) if i % 2 else "again and " * 60
        rows.append((i, text))
        if i % 3:
            labels.append((i, int(not bad), int(toxic)))
    labels += [(None, 1, 1), (1, None, None), (labels[0][0], labels[0][1], labels[0][2])]
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def right(scores, truth):
    return np.mean([(scores[i] >= 0.3) == bool(t) for i, t in truth])


def test_toxicity(spark):
    rows, labels = corpus(spark)
    rows += [r for r in awkward() if r[0] is None or r[0] < 0 or r[0] > 1 << 60]
    docs = frame(spark, rows)
    model = toxicity.train(docs, labels, toxicity.held_out())
    out = toxicity.score_documents(docs.drop("score", "passages"), model, ("doc_id", "text"))
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = {r.doc_id for r in docs.where(toxicity.held_out()).select("doc_id").collect()}
    scores = {r.doc_id: r.score for r in got}
    assert right(scores, [(i, i % 5 == 0 and "again" not in t) for i, t in rows if i is not None and i in held and 0 <= i < 900]) > 0.93
    found = [r for r in got if r.doc_id == 5 or r.doc_id == 10]
    for r in found:
        for p in r.passages:
            assert any(w in r.text.encode()[p.start:p.end].decode() for w in ("idiot", "scum", "moron", "slime"))
    clean = toxicity.drop_toxic(docs, model)
    assert clean.columns == docs.columns and clean.count() == sum(r.score < 0.3 for r in got)


@pytest.mark.parametrize("seed", range(20))
def test_maximal_segments(seed):
    rnd = random.Random(seed)
    n, cost = 30, 0.5
    at = sorted(rnd.sample(range(n), rnd.randrange(1, 15)))
    w = [rnd.choice([-1.0, 0.75, 1.5, 2.25]) for _ in at]
    s = [-cost] * n
    for p, x in zip(at, w):
        s[p] = x
    run = [0.0]
    for x in s:
        run.append(run[-1] + x)
    # by definition: positive-scoring, all proper prefixes and suffixes score above 0, and no longer one is such
    good = [(a, b) for a in range(n) for b in range(a + 1, n + 1)
            if all(run[c] > run[a] for c in range(a + 1, b + 1)) and all(run[b] > run[c] for c in range(a, b))]
    want = sorted((a, b, round(run[b] - run[a], 6)) for a, b in good if not any((x, y) != (a, b) and x <= a and b <= y for x, y in good))
    got = sorted((a, b, round(x, 6)) for a, b, x in toxicity.maximal_segments(at, w, cost))
    assert got == want


def test_passages_that_repeat_words():
    import pyarrow as pa
    words = ["idiot", "scum", "moron"]
    hashes = toxicity.tokens(pa.record_batch({"t": [" ".join(words)]}), "t")[0].hashes()
    model = toxicity.Model(hashes, np.array([3.0, 3.0, 3.0]), 0.2, 1.0, 0.1, (-5.0, 1.0))
    clean, passage = "one two three four five " * 40, "idiot scum moron "
    far = "".join(w + " " + clean for w in words)      # each alone, too weak for a passage
    texts = [passage + clean, passage + clean + passage, far, far + passage + passage]
    found = [[x for x in s if x[3] <= 0] for s in model.segments(pa.record_batch({"t": texts}), "t")]
    assert [len(s) for s in found] == [1, 2, 0, 1]
    assert [texts[1].encode()[a:b].decode() for a, b, *_ in found[1]] == [passage.strip()] * 2
    assert found[3][0][0] == len(far)
    evidence = [model.evidence(s) for s in found]
    assert evidence[1] > evidence[0] > evidence[2] == 0 < evidence[3]


def test_toxicity_without_labels(spark):
    docs = frame(spark, awkward())
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, none, toxicity.held_out())
    assert toxicity.drop_toxic(docs, model).count() == docs.count()
    assert toxicity.drop_toxic(docs.limit(0), model).count() == 0
    vectors, net = quality.train(docs, none, quality.held_out())
    assert {round(r.p, 6) for r in quality.score_documents(docs, vectors, net, score="p").collect()} == {0.5}


def test_toxicity_with_one_toxic_label(spark):
    rnd = random.Random(8)
    rows = [(i, prose(rnd, 40)) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i == 3)) for i in range(60)], "doc_id long, toxic int")
    docs = frame(spark, rows)
    model = toxicity.train(docs, labels, F.lit(False))
    scores = [r.score for r in toxicity.score_documents(docs, model).collect()]
    assert np.allclose(scores, 1 / 60)
    assert toxicity.drop_toxic(docs, model).count() == 60


def test_quality(spark):
    rows, labels = corpus(spark)
    rows += [r for r in awkward() if r[0] is None or r[0] < 0 or r[0] > 1 << 60]
    docs = frame(spark, rows)
    vectors, net = quality.train(docs, labels, quality.held_out())
    out = quality.score_documents(docs, vectors, net, score="p").collect()
    assert len(out) == len(rows) and all(0 <= r.p <= 1 for r in out)
    held = {r.doc_id for r in docs.where(quality.held_out()).select("doc_id").collect()}
    scores = {r.doc_id: r.p for r in out}
    assert right(scores, [(i, i % 7 != 0) for i, _ in rows if i is not None and i in held and 0 <= i < 900]) > 0.95
    assert quality.score_documents(docs.limit(0), vectors, net).collect() == []


def test_a_repeated_labelled_id_is_one_lesson(spark, monkeypatch):
    rnd = random.Random(12)
    rows, labels = corpus(spark, n=120)
    rows += [(1, prose(rnd, 30)) for _ in range(200)] + [(1, rows[1][1])] * 20 + [(1, None)]
    docs, sizes = frame(spark, rows), []
    fit, logistic = quality.fit, toxicity.logistic
    monkeypatch.setattr(quality, "fit", lambda x, y: sizes.append(len(x)) or fit(x, y, 10))
    monkeypatch.setattr(toxicity, "logistic", lambda x, y: sizes.append(len(x)) or logistic(x, y))
    quality.train(docs, labels, F.lit(False))
    toxicity.train(docs, labels, F.lit(False))
    assert sizes == [80, 80]


def brute_nearest(rows, asked, k):
    use = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for i, v in use:
        if i % asked == 0:
            near = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, u)))), j) for j, u in use if j != i and len(u) == len(v))[:k]
            out += [(i, r + 1, j, round(s, 9)) for r, (s, j) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("dim", [1, 7, 600])
def test_nearest(spark, dim, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "QUERY_TILE", 20)
    rng = np.random.default_rng(dim)
    rows = [(i, rng.normal(0, 1, dim).round(2).tolist()) for i in range(150)]
    rows += [(200 + i, rows[i % 4][1]) for i in range(30)] + [(300, None), (310, []), (320, [0.0] * dim), (330, [float("nan")] * dim), (340, [None] * dim),
                                                            (350, [float("inf")] * dim), (None, rows[0][1]), (360, [1.0] * (dim + 1)), (370, [1e-300] * dim), (380, [1e150] * dim)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(4)
    v = neighbours.usable(df, "vec_id", "v")
    out = neighbours.nearest(v.where("id % 10 = 0"), v, 5, groups=3).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in out) == brute_nearest(rows, 10, 5)


def test_nearest_with_repeated_ids(spark):
    rows = [(100, [0.0, 1.0]), (100, [5.0, 5.0]), (100, [0.0, 1.0]), (7, [0.0, 2.0]), (7, [5.0, 4.0]), (8, [1.0, 1.0])]
    v = neighbours.numbered(neighbours.usable(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v"))
    out = neighbours.nearest(v.where("id % 100 = 0"), v, 4, groups=3).collect()
    want = []
    for n, (i, a) in enumerate(rows):
        if i == 100:
            near = sorted((math.dist(a, b), j) for m, (j, b) in enumerate(rows) if m != n)[:4]
            want += [(i, rank + 1, j, round(d, 9)) for rank, (d, j) in enumerate(near)]
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in out) == sorted(want)


def test_nearest_of_nothing(spark):
    v = neighbours.usable(spark.createDataFrame([(1, None)], "vec_id long, v array<float>"), "vec_id", "v")
    assert neighbours.nearest(v, v, 3).collect() == []
    assert F.lit(1) is not None
