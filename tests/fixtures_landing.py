"""Edge-case landing files from FIXTURES.md §3, written to a fresh folder."""

from __future__ import annotations

import gzip
import os

import pyarrow as pa
import pyarrow.parquet as pq

SRC = "t"
DATE = "2026-05-17"

# name -> (bytes, expected status, expected rows or None)
CASES = {
    "ok.csv": (b'id,name\n1,"x ""q"" y"\n\n2,\n', "done", 2),
    "quoted_newline.csv": (b'a,b\n"x\ny",2\n', "done", 1),
    "short.csv": (b"a,b\n1\n", "failed", None),
    "long.csv": (b"a,b\n1,2,3\n", "failed", None),
    "header_only.csv": (b"id,name\n", "failed", None),
    "dup.csv": (b"a,a\n1,2\n", "done", 1),
    "bare_quote.csv": (b'a,b\n1,x"y\n', "failed", None),
    "after_quote.csv": (b'a,b\n"x"y,2\n', "failed", None),
    "upper.CSV": (b"a\n1\n", "quarantined", None),
    "g.csv": (gzip.compress(b"a\n1\n"), "failed", None),
    "ok.jsonl": (b'{"a":1.50,"b":{"c":[1]}}\n{"a":12345678901234567890}\n', "done", 2),
    "many_per_line.json": (b'{"a":1}{"a":2}\n{"a":\n3}\n', "done", 3),
    "null_value.json": (b'null\n{"a":1}\n', "done", 2),
    "array.json": (b'[{"a":1}]\n', "failed", None),
    "trailing.jsonl": (b'{"a":1}xx}\n', "failed", None),
    "single_quotes.jsonl": (b"{'a':1}\n", "failed", None),
    "big_exponent.jsonl": (b'{"a":1e400}\n', "failed", None),
    "bad.jsonl": (b'{"a":1}\n{oops\n', "failed", None),
    "sparse.jsonl": (b'{"a":1}\n{"b":2}\n', "done", 2),
    "o k+é%.csv": (b"a\nodd\n", "done", 1),
}


def _parquet_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    pq.write_table(table, sink)
    return sink.getvalue().to_pybytes()


def parquet_cases() -> dict:
    return {
        "p1.parquet": (_parquet_bytes(pa.table({"id": pa.array([1, 2], pa.int64())})), "done", 2),
        "p2.parquet": (_parquet_bytes(pa.table({"id": pa.array(["x"]), "z": pa.array([1.5])})), "done", 1),
        "p.csv": (_parquet_bytes(pa.table({"q": pa.array(["pq under csv name"])})), "done", 1),
        "zero_rows.parquet": (_parquet_bytes(pa.table({"id": pa.array([], pa.int64())})), "failed", None),
    }


def write_cases(root: str, cases: dict, source: str = SRC, date: str = DATE) -> str:
    d = os.path.join(root, f"source={source}", f"date={date}")
    os.makedirs(d, exist_ok=True)
    for name, (body, _st, _n) in cases.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(body)
    return d
