"""Randomised differential tests of the parsers: files generated with the
standard library's csv/json writers are ingested, and every file's
processed rows must equal what was written (seeded, reproducible)."""

import csv
import io
import json
import os
import random

from pyspark.sql import functions as F

import fixtures_landing as FX
from tidewater.functions import constants as K
from tidewater.operators.ingest import IngestTables, ingest_landing, read_processed

ALPHABET = ["a", "b", "Z", "é", "ß", "0", "9", " ", ",", '"', "\n", "'", "{", "}", "\t", "-"]


def _cell(rng):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 6)))


def _rows_by_file(spark, t):
    p = read_processed(spark, t).withColumn("f", F.regexp_extract("ingest_path", r"([^/]*)$", 1))
    out = {}
    for r in p.collect():
        d = r.asDict()
        out.setdefault(d.pop("f"), []).append(d)
    return out


def test_random_csv_tables(spark, tmp_root):
    rng = random.Random(11)
    cases, expect = {}, {}
    for i in range(12):
        ncol = rng.randrange(1, 5)
        header = [f"c{i}_{j}" for j in range(ncol)]
        rows = [[_cell(rng) for _ in range(ncol)] for _ in range(rng.randrange(1, 6))]
        if ncol == 1:   # a lone empty field would be a blank line, which both readers skip
            rows = [[r[0] or "x"] for r in rows]
        buf = io.StringIO()
        w = csv.writer(buf, lineterminator="\n")
        w.writerow(header)
        w.writerows(rows)
        name = f"r{i}.csv"
        cases[name] = (buf.getvalue().encode(), K.DONE, len(rows))
        expect[name] = sorted(tuple(r) for r in rows)
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, cases)
    t = IngestTables(os.path.join(tmp_root, "state"))
    res = {r.path.rsplit("/", 1)[1]: r for r in ingest_landing(spark, land, t, batch_id=1).collect()}
    got = _rows_by_file(spark, t)
    for name, rows in expect.items():
        assert res[name].status in (K.DONE, "skipped"), (name, res[name])
        if res[name].status == "skipped":
            continue
        ncol = len(rows[0])
        cols = [f"c{name[1:-4]}_{j}" for j in range(ncol)]
        assert sorted(tuple(d[c] for c in cols) for d in got[name]) == rows, name


def _obj(rng, depth=0):
    o = {}
    for j in range(rng.randrange(0, 4)):
        k = rng.choice(["a", "b", "c", "ä", "k k"])
        kind = rng.randrange(6 if depth < 2 else 4)
        o[k] = [lambda: rng.randrange(-1000, 1000), lambda: _cell(rng), lambda: None,
                lambda: rng.choice([1.5, 0.1, -2.25, 100000.0]),
                lambda: [rng.randrange(9) for _ in range(2)], lambda: _obj(rng, depth + 1)][kind]()
    return o


def test_random_json_fast_and_slow_paths_agree(spark, tmp_root):
    rng = random.Random(5)
    cases, objs = {}, {}
    for i in range(8):
        items = [_obj(rng) for _ in range(rng.randrange(1, 5))]
        objs[i] = items
        fast = "".join(json.dumps(o, ensure_ascii=False) + "\n" for o in items)
        slow = "  ".join(json.dumps(o, ensure_ascii=False, indent=1) for o in items) + "\n"
        cases[f"f{i}.jsonl"] = (fast.encode(), K.DONE, len(items))
        cases[f"s{i}.json"] = (slow.encode(), K.DONE, len(items))
    land = os.path.join(tmp_root, "landing")
    FX.write_cases(land, cases)
    t = IngestTables(os.path.join(tmp_root, "state"))
    res = {r.path.rsplit("/", 1)[1]: r for r in ingest_landing(spark, land, t, batch_id=1).collect()}
    got = _rows_by_file(spark, t)
    data_cols = lambda d: {k: v for k, v in d.items() if not k.startswith("ingest_") and v is not None}
    for i in range(8):
        f, s = res[f"f{i}.jsonl"], res[f"s{i}.json"]
        assert f.status == K.DONE and f.n_records == len(objs[i])
        if s.status == "skipped":     # same bytes as an earlier file
            continue
        assert s.status == K.DONE and s.n_records == len(objs[i])
        a = sorted(json.dumps(data_cols(d), sort_keys=True) for d in got[f"f{i}.jsonl"])
        b = sorted(json.dumps(data_cols(d), sort_keys=True) for d in got[f"s{i}.json"])
        assert a == b, (i, a, b)
        # values equal what was written: text as is, numbers as their text,
        # nested values as compact JSON
        exp = sorted(json.dumps({k: (v if isinstance(v, str) else json.dumps(v, separators=(",", ":"),
                                                                              ensure_ascii=False))
                                 for k, v in o.items() if v is not None}, sort_keys=True)
                     for o in objs[i])
        assert a == exp, (i, a, exp)
