"""Awkward documents, and brute-force versions of the operators."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    # names that the operators use for columns of their own
    *[T.StructField(c, T.IntegerType()) for c in ("found", "score", "h", "d", "row", "fp", "mark", "shard", "passages", "text_mark", "key")]])


def prose(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}{rnd.choice(['', ',', '.', 'é'])}" for _ in range(n))


def awkward(seed=1):
    """(doc_id, text) with nulls, empties, copies, very long texts, odd white space."""
    rnd = random.Random(seed)
    base = [prose(rnd, rnd.randrange(1, 200)) for _ in range(40)]
    shared = prose(rnd, 60)
    texts = [None, "", " ", "\n\n", "a", "a b", None, "\t \r\n", "x" * 5000, "word " * 6000, "\x1c\x1f\x85  ", "漢字 😀 Ünï\n" * 30]
    texts += base + base[:5] + [base[0]] * 15
    texts += [prose(rnd, 20) + " " + shared + " " + prose(rnd, 30) for _ in range(6)]
    texts += [base[1].replace("w1", "w2", 1), base[2] + " more", prose(rnd, 10) + "\n" + base[3] + "\n" + prose(rnd, 12)]
    rows = [(i * 3 - 5, t) for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], (rows[21][0], rows[22][1]), (None, base[6]), (None, None), (1 << 62, "far away"), (-(1 << 62), "far below")]
    return rows


def frame(spark, rows, parts=3):
    extra = len(SCHEMA) - 2
    return spark.createDataFrame([(*r, *[7] * extra) for r in rows], SCHEMA).repartition(parts)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
