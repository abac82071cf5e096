"""Toxic passages as maximum-scoring segments.

Tokens are words and beginnings of words (``PREFIXES`` bytes), which also catch
a stem with endings never seen before. A word stands for itself if it has a
weight, else for its longest beginning that has one. Learning counts it once a
document; the search scores every occurrence.

Learning. Tokens of labelled documents are counted by class, once a document.
Those that lean most to the toxic side are counted again over the whole corpus,
which gives the Dirichlet prior: a token's prior mass follows its share of the
corpus's documents. Its weight is the difference of its log-odds in the two classes under
that prior, kept if it is ``LEAST_Z`` standard errors above zero. Every other
word costs ``cost``, large enough that clean text falls on average.

Search. A document is a sequence of such scores. One pass in the manner of
Ruzzo and Tompa finds all its maximal segments: none can be made larger by
adding or cutting words. Words without weight between two weighted ones count
as one step, so the pass is linear in the weighted words.

Calibration. Under clean text the best segment of n words follows an extreme
value law, P(S >= x) = 1 - exp(-K n exp(-lambda x)). lambda solves
sum p(w) exp(lambda s(w)) = 1, with p from all words of the clean labelled
documents, and K is fitted on these documents. A segment is significant if E, its expected number of equals in a
clean text of that length, is at most ``MOST_E``. The document's evidence is the
sum of -ln(E / MOST_E) over its significant segments, up to ``MOST_EVIDENCE``, and a logistic curve
fitted on the labelled documents turns it into a probability.

Null, empty and wordless texts have no segment, and get the curve's value at
zero evidence. Without labelled documents of both classes, or without a token
that leans to the toxic one, every score is the share of toxic ones among the
labelled (0 if there are none).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import training
from .common import load, materialise, per_worker, slices
from .decontaminate import BETWEEN
from .training import labelled_sample, remainder
from .wordhash import Words, class_table

SAMPLE = 20_000           # labelled documents to learn from, at most
WEIGHTED = 20_000         # tokens that may get a weight, at most
PREFIXES = (4, 5, 6, 7, 8)
PRIOR = 0.05              # mass of the Dirichlet prior, as a share of the tokens counted
LEAST_Z = 3.0
LEAST_WEIGHT = 1.5        # log-odds below this never start a passage
COST = 0.2                # least cost of a word without weight
MOST_E = 1.0
TAIL = 0.05               # share of clean documents that K is fitted to
MOST_EVIDENCE = 20.0      # of a document: beyond this the curve is flat
TABLE_BITS = 20


def tokens(batch, column: str | int) -> tuple[Words, list[tuple[np.ndarray, np.ndarray]]]:
    """Words, and (hashes, which words) of the words and then of their
    beginnings, longest first."""
    w = Words(batch.column(column), class_table(BETWEEN), lower=True)
    return w, [(w.hashes(), np.arange(len(w.start)))] + [w.prefix_hashes(n) for n in sorted(PREFIXES, reverse=True)]


def _counted(batches: Iterator) -> Iterator:
    """h, toxic, clean: in how many documents a token is, summed for each slice."""
    import pyarrow as pa
    for whole in batches:
        for b in slices(whole, "text", 1 << 20):
            w, found = tokens(b, "text")
            label = b.column("sample_label").to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(b.num_rows), np.diff(w.first))
            for h, which in found:
                u, at = np.unique(h, return_inverse=True)
                once = np.unique(at * b.num_rows + doc[which])
                at, toxic = once // b.num_rows, label[once % b.num_rows]
                total = np.bincount(at, minlength=len(u))
                toxic = np.bincount(at, toxic, len(u)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(toxic), pa.array(total - toxic)], names=["h", "toxic", "clean"])


class _Table:
    """Weights by word hash, looked up for whole arrays."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.weights = hashes[order], weights[order]
        self.bits = np.zeros(1 << TABLE_BITS, bool)
        self.bits[self.hashes >> np.uint64(64 - TABLE_BITS)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, index into the table) of the words that are in it."""
        at = np.flatnonzero(self.bits[h >> np.uint64(64 - TABLE_BITS)])
        if not len(at):
            return at, at
        place = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        ok = self.hashes[place] == h[at]
        return at[ok], place[ok]

    def weigh(self, found: list) -> tuple[np.ndarray, np.ndarray]:
        """(words, weights) of the words that have a weight, by their first
        entry of ``found`` that has one."""
        words, weights = np.zeros(0, np.int64), np.zeros(0)
        for h, which in found:
            at, place = self.find(h)
            new = ~np.isin(which[at], words)
            words, weights = np.append(words, which[at][new]), np.append(weights, self.weights[place][new])
        order = np.argsort(words)
        return words[order], weights[order]


def maximal_segments(positions: list[int], weights: list[float], cost: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, past the last word, score) of a
    sequence with ``weights`` at ``positions`` and ``-cost`` elsewhere."""
    kept: list[tuple[float, float, int, int]] = []    # sum before, sum after, first, past last
    smaller: list[int] = []                           # for each, the nearest earlier one that starts lower
    total, last = 0.0, None
    for p, x in zip(positions, weights):
        if last is not None:
            total -= cost * (p - last - 1)
        last = p
        if x <= 0:
            total += x
            continue
        now = (total, total + x, p, p + 1)
        total += x
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= now[0]:
                j = smaller[j]
            if j < 0 or kept[j][1] >= now[1]:
                kept.append(now)
                smaller.append(j)
                break
            now = (kept[j][0], now[1], kept[j][2], now[3])
            del kept[j:], smaller[j:]
    return [(a, b, r - l) for l, r, a, b in kept]


class Model:
    """What scoring needs; small, and of a size bounded by ``WEIGHTED``."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, cost: float, lam: float, k: float, curve: tuple[float, float]):
        self.hashes, self.weights, self.cost, self.lam, self.k, self.curve = hashes, weights, cost, lam, k, curve

    def state(self) -> tuple:
        return self.hashes.tobytes(), self.weights.tobytes(), self.cost, self.lam, self.k, self.curve

    @classmethod
    def of(cls, state: tuple) -> Model:
        return cls(np.frombuffer(state[0], np.uint64), np.frombuffer(state[1]), *state[2:])

    def log_e(self, score: float, words: int) -> float:
        """ln of the expected number of clean segments as good."""
        return math.log(self.k * max(words, 1)) - self.lam * score

    def probability(self, evidence: float) -> float:
        z = self.curve[0] + self.curve[1] * evidence
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

    def segments(self, batch, column: str | int) -> Iterator[list[tuple]]:
        """For each text its maximal segments: (byte start, byte end, score, ln E)."""
        w, found = tokens(batch, column)
        if "table" not in self.__dict__:
            self.table = _Table(self.hashes, self.weights)
        at, weight = self.table.weigh(found)
        cut = np.searchsorted(at, w.first)
        for d, n in enumerate(np.diff(w.first).tolist()):
            a, b = cut[d], cut[d + 1]
            if a == b:
                yield []
                continue
            o = int(w.off[d])
            yield [(int(w.start[x]) - o, int(w.end[y - 1]) - o, s, self.log_e(s, n))
                   for x, y, s in maximal_segments(at[a:b].tolist(), weight[a:b].tolist(), self.cost)]

    @staticmethod
    def evidence(segments: list[tuple]) -> float:
        limit = math.log(MOST_E)
        return min(sum(limit - s[3] for s in segments if s[3] <= limit), MOST_EVIDENCE)


def _solve_lambda(p: np.ndarray, s: np.ndarray, cost: float) -> float:
    """The positive root of sum p exp(lambda s) + (1 - sum p) exp(-lambda cost) = 1."""
    rest = max(1 - p.sum(), 0.0)
    f = lambda x: (p * np.exp(x * s)).sum() + rest * math.exp(-x * cost) - 1
    lo, hi = 1e-6, 1e-3
    while f(hi) <= 0 and hi < 50:
        lo, hi = hi, hi * 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) <= 0 else (lo, mid)
    return lo


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Intercept and slope of a logistic curve, by Newton's method."""
    a = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + ridge * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", text: str = "text",
          doc_id: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Learn from the labelled documents that are not ``held_out`` (an
    expression on doc_id), and from the word counts of all documents."""
    chosen = materialise(labelled_sample(labels, label, held_out, sample, doc_id), "toxicity-sample")
    # a row for each chosen id, so about ``sample`` at most
    lessons = materialise(training.lessons(docs, chosen, text, doc_id), "toxicity-lessons")
    sizes = {r["sample_label"]: r["n"] for r in lessons.groupBy("sample_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    empty = np.zeros(0, np.uint64), np.zeros(0)
    share = min(max((bad + 0.0) / max(bad + good, 1), 1e-9), 1 - 1e-9)
    by_share = Model(*empty, COST, 1.0, 1.0, (math.log(share / (1 - share)), 0.0))
    if not bad or not good:
        return by_share

    counts = materialise(lessons.mapInArrow(_counted, "h long, toxic long, clean long")
                         .groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxicity-counts")
    n_toxic, n_clean = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    n_toxic, n_clean = n_toxic or 0, n_clean or 0
    # log-odds of a token, lightly smoothed, times the root of its count
    lean = F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5)) - F.lit(math.log((n_toxic + 1) / (n_clean + 1)))
    top = (counts.where(F.col("toxic") >= 3).withColumn("lean", lean * F.sqrt(F.col("toxic")))
           .where(F.col("lean") > 0).orderBy(F.col("lean").desc(), "h").limit(WEIGHTED).collect())
    if not top:
        return by_share
    hashes = np.array([r["h"] for r in top], np.int64).view(np.uint64)
    toxic, clean = (np.array([r[c] for r in top], float) for c in ("toxic", "clean"))

    # the same words over the whole corpus
    held = docs.sparkSession.sparkContext.broadcast(hashes.tobytes())

    def corpus(batches: Iterator) -> Iterator:
        import pyarrow as pa
        keys = np.frombuffer(held.value, np.uint64)
        table = _Table(keys, np.arange(len(keys), dtype=float))
        seen, rows = np.zeros(len(keys), np.int64), 0
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                w, found = tokens(b, "text")
                rows += b.num_rows
                doc = np.repeat(np.arange(b.num_rows), np.diff(w.first))
                for h, which in found:
                    at, place = table.find(h)
                    once = np.unique(table.weights[place].astype(np.int64) * b.num_rows + doc[which[at]])
                    seen += np.bincount(once // b.num_rows, minlength=len(keys))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], rows))], names=["k", "n"])

    everywhere = np.zeros(len(hashes))
    corpus_rows = 1
    for r in docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(corpus, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        if r["k"] < 0:
            corpus_rows = max(1, r["n"])
        else:
            everywhere[r["k"]] = r["n"]

    mass = PRIOR * (n_toxic + n_clean)
    prior = PRIOR * (bad + good) * (everywhere + 0.5) / corpus_rows
    odds = lambda y, n: np.log((y + prior) / np.maximum(n + mass - y - prior, 1e-9))
    weight = odds(toxic, n_toxic) - odds(clean, n_clean)
    z = weight / np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    use = (z >= LEAST_Z) & (weight >= LEAST_WEIGHT)
    hashes, weight = hashes[use], weight[use]
    # how often each is a word of clean text, every occurrence counted as in the search
    kept = docs.sparkSession.sparkContext.broadcast(hashes.tobytes())

    def occurrences(batches: Iterator) -> Iterator:
        import pyarrow as pa
        keys = np.frombuffer(kept.value, np.uint64)
        table = _Table(keys, np.arange(len(keys), dtype=float))
        seen, words = np.zeros(len(keys), np.int64), 0
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                w, found = tokens(b, "text")
                words += len(w.start)
                if len(keys):
                    seen += np.bincount(table.weigh(found)[1].astype(np.int64), minlength=len(keys))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], words))], names=["k", "n"])

    often, n_words = np.zeros(len(hashes)), 0
    for r in lessons.where("sample_label = 0").select("text").mapInArrow(occurrences, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        if r["k"] < 0:
            n_words = r["n"]
        else:
            often[r["k"]] = r["n"]
    p = (often + prior[use]) / ((1 + PRIOR) * max(n_words, 1))
    cost = max(COST, 2 * float((p * weight).sum()))
    lam = _solve_lambda(p, weight, cost) if len(weight) else 1.0
    model = Model(hashes, weight, cost, lam, 1.0, (0.0, 1.0))

    # the labelled documents once more: K from the clean ones, the curve from all
    found = _scored(lessons, model, ("sample_label",)).select("sample_label", "n_words", "best", "evidence").collect()
    at_zero = [(r["n_words"], r["best"]) for r in found if r["sample_label"] == 0 and r["n_words"]]
    # K so that TAIL of the clean documents have a best segment with E at most TAIL
    e = sorted(math.log(n) - lam * b for n, b in at_zero)
    if e:
        model.k = min(1.0, math.exp(math.log(TAIL) - e[int(TAIL * len(e))]))
    # evidence again with the fitted K: a shift of ln K, so from the segments themselves
    again = _scored(lessons, model, ("sample_label",)).select("sample_label", "evidence").collect()
    model.curve = logistic(np.array([r["evidence"] for r in again]), np.array([float(r["sample_label"]) for r in again]))
    return model


_PASSAGE = "array<struct<start:int,end:int,score:double,log_e:double>>"


def _scored(docs: DataFrame, model: Model, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """``keep`` columns, n_words, best, evidence, score, passages of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model.state())
    name = f"toxicity-{uuid.uuid4().hex}"
    # the text travels once, also where it is kept
    body = keep.index(text) if text in keep else len(keep)
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if text in keep else [F.col(f"`{text}`")]))
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep) + \
        f"n_words long, best double, evidence double, score double, passages {_PASSAGE}"
    names = [*keep, "n_words", "best", "evidence", "score", "passages"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        m = per_worker(name, lambda: Model.of(held.value))
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("log_e", pa.float64())]))
        limit = math.log(MOST_E)
        for whole in batches:
            for b in slices(whole, body, 1 << 20):
                found = list(m.segments(b, body))
                n = np.diff(Words(b.column(body), class_table(BETWEEN)).first) if "n_words" in needed else np.zeros(len(found), np.int64)
                evidence = [m.evidence(s) for s in found]
                yield pa.RecordBatch.from_arrays([
                    *[b.column(c) for c in range(len(keep))], pa.array(n, pa.int64()),
                    pa.array([max((x[2] for x in s), default=0.0) for s in found], pa.float64()), pa.array(evidence, pa.float64()),
                    pa.array([m.probability(e) for e in evidence], pa.float64()),
                    pa.array([[dict(zip(("start", "end", "score", "log_e"), x)) for x in s if x[3] <= limit] for s in found], kind)], names=names)
    needed = {"n_words"} if "sample_label" in keep else set()
    return kept.mapInArrow(run, schema)


def score_documents(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns, score (0 to 1) and the significant passages as byte
    ranges of the text with their score and ln E."""
    return _scored(docs, model, keep, text).select(*[f"`{c}`" for c in keep], "score", "passages")


def drop_toxic(docs: DataFrame, model: Model, most: float = 0.3, text: str = "text") -> DataFrame:
    """The documents scored under ``most``, unchanged."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}      # free of clashes with score, passages
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    out = score_documents(renamed, model, tuple(names.values()), names[text]).where(F.col("score") < most)
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])


def held_out() -> Column:
    return remainder("doc_id", 4) == 2


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, load(spark, sf_dir, "labels"), held_out())
    return score_documents(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
