"""Every registered query against its DuckDB oracle (small scale factor)."""

import os

import pytest

from conftest import SF_SMALL
import oracle_check

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data missing")


def test_all_queries_match_oracle(spark):
    res = oracle_check.check(spark, SF_SMALL, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "NO-ORACLE")}
    assert not bad, bad


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["source", "format", "status", "files"]
