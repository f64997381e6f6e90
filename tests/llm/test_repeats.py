import random
import tracemalloc
from pathlib import Path
from types import SimpleNamespace

import brute
import numpy as np
import pyarrow as pa
import pytest

from starmill.llm import suffix_dedup
from starmill.llm.common import drop_scratch


def told(df):
    return [tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]


@pytest.mark.parametrize("batch_bytes", [1 << 30, 15_000])
def test_equals_brute_force(make, odd_rows, batch_bytes):
    assert sorted(told(suffix_dedup.repeated(make(odd_rows), batch_bytes))) == sorted(brute.repeats(odd_rows))


def test_very_common_anchors(make, odd_rows):
    assert sorted(told(suffix_dedup.repeated(make(odd_rows), most=3))) == sorted(brute.repeats(odd_rows))


def test_repeated_rows_and_null_ids(make):
    text = "the quick brown fox " * 3 + "jumps over it and goes on and on for more than a hundred bytes in all, surely"
    got = sorted(told(suffix_dedup.repeated(make([(1, text), (1, text), (None, text), (2, "short")]))), key=str)
    n = len(text)
    assert sorted((r[0], r[2]) for r in got if r[0] == 1) == [(1, 0), (1, n)]
    assert [r[2] for r in got if r[0] is None] == [n]


def test_empty_table(make):
    assert told(suffix_dedup.repeated(make([]))) == []


def test_levels_merge_like_carries(spark, make, odd_rows):
    index = suffix_dedup.SuffixIndex()
    for i in range(4):
        part = [(k, t) for k, t in odd_rows if k % 4 == i]
        index.add(make(part).selectExpr("doc_id + 1000 * %d AS _ord" % i, "text")).count()
        assert [n for n, _ in index.levels] == [[1], [2], [2, 1], [4]][i]


def test_tasks_hash_a_bounded_part_of_their_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefgh ", k=4000)) for _ in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts)], names=["_ord", "text"])
    tracemalloc.start()
    try:
        assert sum(len(b) for b in suffix_dedup._entries(iter([batch]))) > 100_000
        assert tracemalloc.get_traced_memory()[1] < 64e6
    finally:
        tracemalloc.stop()


def test_tables_are_written_by_the_tasks(make, odd_rows):
    index = suffix_dedup.SuffixIndex()
    frames = [index.scan(make(odd_rows).selectExpr("doc_id AS _ord", "text"), keep=False), index.compare()]
    for df in frames:
        assert df.count()
        # Hadoop's local file system would leave checksums, and start a process for each
        folder = Path(df._scratch.removeprefix("file:"))
        assert list(folder.glob("part-*.parquet")) and not list(folder.glob(".*.crc"))
    drop_scratch(*frames)


def test_contexts_are_sent_once_from_a_task():
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdefgh", k=300))
    batches = [pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([passage])], names=["_ord", "text"]) for i in range(5)]
    bits = SimpleNamespace(value=np.full(1 << 17, 255, np.uint8))
    got = [d for b in suffix_dedup._contexts(bits)(iter(batches)) for d in b.column("doc").to_pylist()]
    assert got and set(got) == {0}


def test_result_is_cut_before_the_caller_writes_it(make, odd_rows):
    # the caller's tasks only copy narrow rows: they read no text and run no Python
    plan = suffix_dedup.repeated(make(odd_rows))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Join" not in plan
