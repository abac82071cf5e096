"""Registered queries against their SQL, and the pipeline's stages."""

import os
from collections import Counter

import pytest

import oracle_check
from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data missing")


def test_queries_with_sql(spark):
    from tidewater.llm.queries import ORACLES
    res = oracle_check.check(spark, SF_SMALL, sorted(ORACLES), verbose=False)
    assert all(v[0] == "OK" for v in res.values()), res


def test_stages_take_effect(spark):
    import tiktoken

    import corpus_pipeline as C
    from cases import awkward, frame
    from tidewater.llm import bpe, decontaminate, lines, simhash, toxicity
    from tidewater.llm.common import load, materialise
    docs = load(spark, SF_SMALL, "documents")
    columns = docs.columns
    for name, stage in C.STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, SF_SMALL), f"test-{name}")
        assert docs.columns == columns
        if name == "toxicity":
            model = toxicity.train(before, load(spark, SF_SMALL, "labels"), toxicity.held_out())
            ok = toxicity.score_documents(before, model).where("score < 0.3").select("doc_id")
            assert {r[0] for r in ok.collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "line_dedup":
            assert docs.count() == before.count()
            assert docs.where("n_chars <> length(text)").count() == 0
        if name == "near_duplicates":
            assert docs.count() == simhash.group_near_copies(before).select("component_id").distinct().count()
            assert simhash.group_near_copies(docs).where("doc_id <> component_id").count() == 0
        if name == "decontamination":
            bench = load(spark, SF_SMALL, "benchmark")
            assert decontaminate.drop_contaminated(docs, bench).count() == docs.count()
    out = C.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    ranks, pattern = bpe.public_ranks()
    lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    assert Counter((r.doc_id, *r.ids) for r in out) == Counter((r.doc_id, *lib.encode_ordinary(r.text)) for r in docs.collect())
    assert lines and frame and awkward


def test_stages_on_awkward_documents(spark):
    import corpus_pipeline as C
    from cases import awkward, frame
    from tidewater.llm.common import materialise
    for rows in (awkward(), []):
        docs = frame(spark, rows or [(1, "a")])
        docs = docs if rows else docs.limit(0)
        for name, stage in C.STAGES:
            columns = docs.columns
            docs = materialise(stage(spark, docs, SF_SMALL), f"test-{name}")
            if name != "bpe":
                assert docs.columns == columns
        assert docs.count() <= len(rows)
