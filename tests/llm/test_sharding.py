import zlib
from collections import Counter

import pytest

from starmill.llm import sharding


def test_every_row_has_its_slot(make, odd_rows):
    rows = [*odd_rows, (3, "again"), (3, "one"), (None, "n"), (None, None)]
    out = sharding.place(make(rows), sharding.even(5), sharding.even(6)).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    for s in range(5):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    assert all(r["grown_shard"] in (r["shard"], 5) for r in out)
    assert len({r["shard"] for r in out if r["doc_id"] == 3}) == 1


def test_weights_and_moves(spark):
    d = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text")
    a, b = sharding.Shard(0), sharding.Shard(1, 3.0)
    out = sharding.place(d, [a, b], [a, b, sharding.Shard(2, 1.0)]).collect()
    n = Counter(r["shard"] for r in out)
    assert abs(n[1] / 20_000 - 0.75) < 0.02
    moved = [r for r in out if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {2} and abs(len(moved) / 20_000 - 0.2) < 0.02


def test_files_and_errors(make, odd_rows, tmp_path, spark):
    sharding.write_shards(make(odd_rows).select("doc_id", "text"), sharding.even(3), f"file://{tmp_path}/s", files_per_shard=2)
    assert spark.read.parquet(f"file://{tmp_path}/s").count() == len(odd_rows)
    assert sharding.place(make([]), sharding.even(2)).collect() == []
    with pytest.raises(ValueError):
        sharding.place(make([]), [])
