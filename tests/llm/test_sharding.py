import zlib
from collections import defaultdict

import pytest

from cases import awkward, frame
from tidewater.llm.sharding import assign_shards, write_shards


def check(rows, out, shards):
    assert len(out) == len(rows)
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for got in by.values():
        assert sorted(r.slot for r in got) == list(range(len(got)))
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in out) == want
    return {k: sum(r.size for r in v) for k, v in by.items()}


@pytest.mark.parametrize("shards", [1, 4, 24])
def test_awkward(spark, shards):
    rows = awkward()
    check(rows, assign_shards(frame(spark, rows), shards).collect(), shards)


def test_equal_sizes_with_a_hot_text(spark):
    rows = [(i, "the same text for a third of all" if i % 3 == 0 else f"text number {i}") for i in range(6000)]
    size = check(rows, assign_shards(frame(spark, rows), 24).collect(), 24)
    assert len(size) == 24 and max(size.values()) - min(size.values()) <= 2 * 50


def test_all_keys_equal(spark):
    size = check([(5, "x")] * 50, assign_shards(frame(spark, [(5, "x")] * 50), 3).collect(), 3)
    assert sorted(size.values()) == [16 * 9, 17 * 9, 17 * 9]


def test_equal_sizes_with_repeated_rows(spark):
    """A third of all rows are one row: its copies are dealt like all others."""
    rows = [(7, "one and the same row")] * 300 + [(i, f"text {i:04}") for i in range(600)] + [(None, None)] * 30
    size = check(rows, assign_shards(frame(spark, rows), 24).collect(), 24)
    assert len(size) == 24 and max(size.values()) - min(size.values()) <= 2 * 28


def test_written_shards_of_repeated_rows(spark, tmp_root):
    rows = [(7, "same")] * 400
    write_shards(frame(spark, rows), f"{tmp_root}/out", 4)
    back = spark.read.parquet(f"{tmp_root}/out").groupBy("shard_").count().collect()
    assert sorted(r["count"] for r in back) == [100] * 4


def test_tolerance_keeps_copies_whole(spark):
    rows = [(i, f"text {i // 20}") for i in range(4000)]
    out = assign_shards(frame(spark, rows), 4, tolerance=300.0).collect()
    text = dict(rows)
    places = defaultdict(set)
    for r in out:
        places[text[r.doc_id]].add(r.shard)
    assert all(len(v) == 1 for v in places.values())


def test_empty(spark):
    assert assign_shards(frame(spark, [(1, "a")]).limit(0), 24).collect() == []


def test_written_shards(spark, tmp_root):
    rows = [(i, f"text number {i}") for i in range(500)]
    write_shards(frame(spark, rows), f"{tmp_root}/out", 5)
    back = spark.read.parquet(f"{tmp_root}/out")
    assert sorted((r.doc_id, r.text) for r in back.collect()) == rows
    assert back.select("shard_").distinct().count() == 5
