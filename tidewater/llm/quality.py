"""Quality classifier over random-indexing word vectors.

Tokens are runs of letters and digits and runs of punctuation; each falls into
one of ``BUCKETS`` by hash, upper-case words into one of a few shared ones, and
words longer than ``LONG`` bytes too. Every bucket has a fixed sparse random
index vector, made from its number. A bucket's word vector is the sum of the
index vectors found within ``REACH`` tokens of it, counted over the whole
corpus on Spark and scaled to unit length: words used alike point alike.

A document is the mean of its tokens' vectors, with the mean of their squares'
root, the mean vector's length, and a few shares (different tokens, upper case,
punctuation, digits, tokens a line). A network with one hidden layer is trained
in numpy on at most ``SAMPLE`` labelled documents; a temperature fitted on a part
set aside makes its outputs probabilities.

The word vectors and the network have a fixed size, so they are broadcast.
Null, empty and wordless texts have the zero vector and get the network's
answer to it. Without labelled documents of both classes every score is the
share of label 1 among the labelled (0.5 if there are none).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise, per_worker, slices
from .training import labelled_sample, lessons, remainder
from .wordhash import Words

SAMPLE = 20_000           # labelled documents to learn from, at most
BUCKETS = 4096
DIM = 48
FILLED = 4                # entries of an index vector that are not 0
REACH = 2
LONG = 24
SHAPES = 8                # buckets kept for upper-case and for very long words
HIDDEN = 24
ROUNDS = 400

_SPACE, _WORD, _MARK = 0, 1, 2


def _classes() -> np.ndarray:
    """Byte classes: white space and controls, letters and digits, the rest of ASCII."""
    t = np.full(256, _MARK, np.uint8)
    t[:33] = _SPACE
    t[127] = _SPACE
    t[48:58] = t[65:91] = t[97:123] = t[128:] = _WORD
    return t


CLASSES = _classes()


def index_vectors() -> np.ndarray:
    """BUCKETS x DIM, FILLED entries of +1 or -1 each, the same everywhere."""
    rng = np.random.Generator(np.random.PCG64(20_240_229))
    at = rng.permuted(np.tile(np.arange(DIM), (BUCKETS, 1)), axis=1)[:, :FILLED]
    out = np.zeros((BUCKETS, DIM), np.int8)
    np.put_along_axis(out, at, rng.choice(np.array([-1, 1], np.int8), (BUCKETS, FILLED)), axis=1)
    return out


class Tokens:
    """A slice's tokens as buckets, with what the shares need."""

    def __init__(self, column):
        w = Words(column, CLASSES)
        self.first, size = w.first, w.end - w.start
        self.h = w.hashes()
        self.bucket = (self.h % np.uint64(BUCKETS - SHAPES)).astype(np.int64) + SHAPES
        lead = w.buf[w.start] if len(w.start) else np.zeros(0, np.uint8)
        final = w.buf[w.end - 1] if len(w.start) else lead
        upper = lambda x: (x >= 65) & (x <= 90)
        self.upper = upper(lead) & upper(final) & (size > 1)
        self.mark = CLASSES[lead] == _MARK
        self.digit = (lead >= 48) & (lead <= 57)
        self.bucket[self.upper] = 0
        self.bucket[size > LONG] = 1
        self.lines = np.add.reduceat(np.append(w.buf == 10, False), np.minimum(w.off[:-1], len(w.buf))) if len(w.off) > 1 else np.zeros(0)
        self.lines = np.where(np.diff(w.off) > 0, self.lines, 0)
        self.doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))


def _contexts(batches: Iterator) -> Iterator:
    """bucket, vec: sums of the index vectors near each bucket's tokens."""
    import pyarrow as pa
    index = per_worker("quality-index", index_vectors)
    total = np.zeros((BUCKETS, DIM), np.int64)
    for whole in batches:
        for b in slices(whole, "text", 1 << 20):
            t = Tokens(b.column("text"))
            n = len(t.bucket)
            if not n:
                continue
            mine = index[t.bucket]
            near = np.zeros((n, DIM), np.int16)
            for d in range(1, REACH + 1):
                if d >= n:
                    break
                same = (t.doc[d:] == t.doc[:-d])[:, None]
                near[d:] += mine[:-d] * same
                near[:-d] += mine[d:] * same
            order = np.argsort(t.bucket, kind="stable")
            ranked = t.bucket[order]
            cuts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
            total[ranked[cuts]] += np.add.reduceat(near[order], cuts, axis=0, dtype=np.int32)
    at = np.flatnonzero(total.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([total[k].astype("<i8").tobytes() for k in at], pa.binary())],
                                     names=["bucket", "vec"])


def _summed(batches: Iterator) -> Iterator:
    import pyarrow as pa
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for k, v in zip(b.column("bucket").to_pylist(), b.column("vec")):
            total[k] = total.get(k, 0) + np.frombuffer(v.as_py(), "<i8")
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.astype("<i8").tobytes() for v in total.values()], pa.binary())],
                                     names=["bucket", "vec"])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """BUCKETS x DIM float32 of unit length (0 for buckets without context)."""
    sums = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(_contexts, "bucket int, vec binary")
    # BUCKETS rows come back, whatever the corpus
    rows = sums.repartition("bucket").mapInArrow(_summed, "bucket int, vec binary").collect()
    out = np.zeros((BUCKETS, DIM))
    for r in rows:
        out[r["bucket"]] = np.frombuffer(r["vec"], "<i8")
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm == 0, 1, norm)).astype(np.float32)


FEATURES = 2 * DIM + 8


def features(column, vectors: np.ndarray) -> np.ndarray:
    """One row of FEATURES numbers for each text."""
    t = Tokens(column)
    n = np.diff(t.first).astype(float)
    out = np.zeros((len(n), FEATURES))
    some = np.flatnonzero(n > 0)
    if not len(some):
        return out
    starts = t.first[:-1][some]
    size = n[some][:, None]
    v = vectors[t.bucket]
    mean = np.add.reduceat(v, starts, axis=0, dtype=np.float64) / size
    out[some, :DIM] = mean
    out[some, DIM:2 * DIM] = np.sqrt(np.maximum(np.add.reduceat(v * v, starts, axis=0, dtype=np.float64) / size - mean ** 2, 0))
    share = lambda x: np.add.reduceat(x.astype(float), starts) / n[some]
    order = np.lexsort((t.h, t.doc))
    new = np.ones(len(order), bool)
    new[1:] = (t.h[order][1:] != t.h[order][:-1]) | (t.doc[order][1:] != t.doc[order][:-1])
    different = np.add.reduceat(new.astype(float), starts)
    out[some, 2 * DIM:] = np.column_stack((
        np.linalg.norm(mean, axis=1), different / n[some], different / np.sqrt(n[some]) / 10, share(t.upper), share(t.mark), share(t.digit),
        np.log1p(n[some]) / 10, np.log1p(n[some] / (1 + t.lines[some])) / 5))
    return out


class Network:
    """Features → HIDDEN tanh units → a logit, divided by a temperature."""

    def __init__(self, mean, scale, w1, b1, w2, b2, temperature: float):
        self.parts = [np.asarray(x, np.float64) for x in (mean, scale, w1, b1, w2, b2)]
        self.temperature = temperature

    def logits(self, x: np.ndarray) -> np.ndarray:
        mean, scale, w1, b1, w2, b2 = self.parts
        return np.tanh(((x - mean) / scale) @ w1 + b1) @ w2 + b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, seed: int = 7) -> Network:
    """Train on four fifths with Adam, keep the weights that do best on the
    rest, and fit the temperature there."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held, use = order[:len(x) // 5], order[len(x) // 5:]
    mean, scale = x[use].mean(axis=0), x[use].std(axis=0)
    scale = np.where(scale < 1e-6, 1.0, scale)
    a, b = np.clip((x[use] - mean) / scale, -8, 8), y[use].astype(float)
    w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(k) for k in w], [np.zeros_like(k) for k in w]
    best, kept = np.inf, [k.copy() for k in w]
    loss = lambda z, t: np.mean(np.logaddexp(0, z) - t * z)
    for step in range(1, rounds + 1):
        rows = rng.choice(len(a), min(len(a), 4096), replace=False)
        h = np.tanh(a[rows] @ w[0] + w[1])
        p = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -500, 500)))
        g = (p - b[rows]) / len(rows)
        back = np.outer(g, w[2]) * (1 - h * h)
        grads = [a[rows].T @ back + 1e-4 * w[0], back.sum(axis=0), h.T @ g + 1e-4 * w[2], np.array([g.sum()])]
        for k, gk in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * gk
            v[k] = 0.999 * v[k] + 0.001 * gk * gk
            w[k] = w[k] - 0.01 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        if step % 10 == 0 and len(held):
            now = loss(Network(mean, scale, *w, 1.0).logits(x[held]), y[held])
            if now < best:
                best, kept = now, [k.copy() for k in w]
    net = Network(mean, scale, *(kept if len(held) else w), 1.0)
    if len(held):
        z = net.logits(x[held])
        grid = np.geomspace(0.25, 8, 141)
        net.temperature = float(grid[np.argmin([loss(z / t, y[held]) for t in grid])])
    return net


def train(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", text: str = "text",
          doc_id: str = "doc_id", sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents, and a network from the labelled ones
    that are not ``held_out`` (an expression on doc_id)."""
    vectors = word_vectors(docs, text)
    held = docs.sparkSession.sparkContext.broadcast(vectors.tobytes())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        table = np.frombuffer(held.value, np.float32).reshape(BUCKETS, DIM)
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                x = features(b.column("text"), table).astype("<f4")
                yield pa.RecordBatch.from_arrays([b.column("sample_label"), pa.array([r.tobytes() for r in x], pa.binary())], names=["label", "x"])

    chosen = materialise(labelled_sample(labels, label, held_out, sample, doc_id), "quality-sample")
    # a row for each chosen id, so about ``sample`` at most come back
    rows = lessons(docs, chosen, text, doc_id).mapInArrow(run, "label int, x binary").orderBy("label", "x").collect()
    x = np.array([np.frombuffer(r["x"], "<f4") for r in rows], float).reshape(len(rows), FEATURES)
    y = np.array([r["label"] for r in rows], float)
    if len(set(y.tolist())) < 2:
        share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
        none = np.zeros(FEATURES)
        return vectors, Network(none, none + 1, np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), np.array([np.log(share / (1 - share))]), 1.0)
    return vectors, fit(x, y)


def score_documents(docs: DataFrame, vectors: np.ndarray, net: Network, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` without the text, with ``score``: the probability of label 1."""
    held = docs.sparkSession.sparkContext.broadcast((vectors.tobytes(), [p.tolist() for p in net.parts], net.temperature))
    name = f"quality-{uuid.uuid4().hex}"
    rest = [c for c in docs.columns if c not in (text, score)]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name in rest) + f"`{score}` double"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        table, model = per_worker(name, lambda: (np.frombuffer(held.value[0], np.float32).reshape(BUCKETS, DIM), Network(*held.value[1], held.value[2])))
        for whole in batches:
            for b in slices(whole, "__text", 1 << 20):
                yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], pa.array(model.probability(features(b.column("__text"), table)))], names=[*rest, score])
    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)


def held_out() -> Column:
    return remainder("doc_id", 5) == 0


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, load(spark, sf_dir, "labels"), held_out())
    return score_documents(docs, *model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
