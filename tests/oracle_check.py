"""Local stand-in for the driver's correctness gate.

Runs queries()[name] on Spark and oracle_sql()[name] on DuckDB over the same
parquet tables, then compares column names, row counts and an
order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return h, lines


SPARK_CANON = {"byte": "int8", "short": "int16", "integer": "int32", "long": "int64", "float": "float32",
               "double": "float64", "string": "string", "boolean": "bool", "date": "date",
               "timestamp": "timestamp", "timestamp_ntz": "timestamp", "binary": "binary"}
DUCK_CANON = {"TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int32", "BIGINT": "int64",
              "HUGEINT": "int128", "FLOAT": "float32", "DOUBLE": "float64", "VARCHAR": "string",
              "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp", "BLOB": "binary"}


def spark_types(df):
    return {f.name: SPARK_CANON.get(f.dataType.typeName(), f.dataType.simpleString()) for f in df.schema.fields}


def duck_types(con, sql):
    rel = con.sql(sql)
    return {n: DUCK_CANON.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}


def check(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e)[:400])
            print(f"{name:28s} SPARK-ERROR {str(e)[:400]}")
            continue
        ts = time.time() - t0
        if name not in os_:
            results[name] = ("NO-ORACLE", len(srows))
            print(f"{name:28s} no-oracle rows={len(srows)} {ts:.1f}s")
            continue
        try:
            cur = con.execute(os_[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("DUCK-ERROR", str(e)[:400])
            print(f"{name:28s} DUCK-ERROR {str(e)[:400]}")
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        try:
            st, dt_ = spark_types(df), duck_types(con, os_[name])
            type_diff = {c: (st.get(c), dt_.get(c)) for c in st if st.get(c) != dt_.get(c)}
        except Exception as e:  # noqa: BLE001
            type_diff = {"?": str(e)[:100]}
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        ok = ok_cols and len(srows) == len(drows) and hs == hd and not type_diff
        results[name] = ("OK" if ok else "MISMATCH", len(srows), len(drows))
        print(f"{name:28s} {'OK' if ok else 'MISMATCH'} spark={len(srows)} duck={len(drows)} "
              f"cols={'ok' if ok_cols else (sorted(scols), sorted(dcols))} "
              f"types={'ok' if not type_diff else type_diff} {ts:.1f}s")
        if not ok and verbose:
            a, b = set(ls), set(ld)
            for x in sorted(a - b)[:3]:
                print("   spark only:", x[:300])
            for x in sorted(b - a)[:3]:
                print("   duck  only:", x[:300])
    return results


if __name__ == "__main__":
    args = sys.argv[1:]
    plain = "--plain" in args          # a bare session, as an outside driver would pass
    args = [a for a in args if a != "--plain"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    if plain:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.driver.memory", "8g").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from tidewater.session import build_session
        spark = build_session("local[8]", shuffle_partitions=8,
                              extra={"spark.driver.memory": "8g"})
    res = check(spark, sf, args[1:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "NO-ORACLE")]
    print("FAILED:", bad)
    spark.stop()
