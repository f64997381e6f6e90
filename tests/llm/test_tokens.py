import math

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starmill.llm import packing, token_io, tokens


def test_both_engines_agree(odd_rows):
    texts = [t or "" for _, t in odd_rows] + ["a<|endoftext|>b", "é\U0001f600 你好  \n\n x's I'LL 12 345"]
    encode = tokens.encoder()
    for t, ids in zip(texts, brute.ids_of(texts), strict=True):
        assert tokens.with_end(encode(t)).tolist() == ids.tolist()


def test_files_give_back_all_ids(spark, make, odd_rows, monkeypatch, tmp_path):
    d = make(odd_rows)
    folder = f"file://{tmp_path}/ids"
    entries = token_io.write_ids(d, folder)
    monkeypatch.setattr(token_io, "BUCKET", 16)
    index, buckets = token_io.build_index(entries)
    found = {r["key"]: r for r in token_io.lookup(entries.select("key"), index, buckets).collect()}
    store, root = token_io._open(folder)
    want = brute.ids_of([t for _, t in odd_rows])
    for (i, _), ids in zip(odd_rows, want, strict=True):
        r = found[i]
        assert token_io.read_ids(store, root, r["shard"], r["first"], r["n"]).tolist() == ids.tolist()
    absent = spark.createDataFrame([(k,) for k in range(10_000, 10_200)], "key long")
    assert token_io.lookup(absent, index, buckets).count() == 0


def test_query_starts_and_checks(spark, make, odd_rows, tmp_path):
    make(odd_rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in token_io.op7(spark, str(tmp_path)).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    ids = brute.ids_of([t for _, t in odd_rows])
    starts = np.cumsum([0, *map(len, ids)])
    assert got == [(i, int(s), len(x), brute.crc(x)) for (i, _), s, x in zip(odd_rows, starts, ids, strict=False)]


def test_repeated_and_null_ids(spark, make, tmp_path):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (1, None)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(r["n_tokens"] for r in token_io.op7(spark, str(tmp_path)).collect())
    assert got == sorted(len(x) for x in brute.ids_of([t for _, t in rows]))


def test_empty_table(spark, make, tmp_path):
    make([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert token_io.op7(spark, str(tmp_path)).collect() == []
    assert packing.op5(spark, str(tmp_path)).collect() == []


@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=500))
@settings(max_examples=30, deadline=None)
def test_hash_is_perfect_and_minimal(keys):
    k = np.array(sorted(keys), np.int64)
    assert sorted(token_io.find_hash(*token_io.build_hash(k), k).tolist()) == list(range(len(k)))


@pytest.mark.parametrize("capacity", [2048, 64])
def test_pieces_fill_sequences(make, odd_rows, capacity):
    rows = [tuple(r) for r in packing.pack_documents(make(odd_rows), capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    ids = dict(zip([i for i, _ in odd_rows], brute.ids_of([t for _, t in odd_rows]), strict=True))
    by_doc, by_seq = {}, {}
    for d, p, s, n, c, q, o in rows:
        assert brute.crc(ids[d][s : s + n]) == c and 0 < n <= capacity
        by_doc.setdefault(d, []).append((p, s, n))
        by_seq.setdefault(q, []).append((o, n))
    for d, x in ids.items():
        assert [(s, n) for _, s, n in sorted(by_doc[d])] == packing.cuts(len(x), capacity)
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 200), max_size=25))
@settings(max_examples=100, deadline=None)
def test_sweep_is_best_fit_decreasing(counts):
    gaps = []
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            fit = [g for g in gaps if g >= n]
            if fit:
                gaps.remove(min(fit))
                gaps.append(min(fit) - n)
            else:
                gaps.append(40 - n)
    segments, opened = packing.sweep(counts, 40)
    used = {}
    for n, a, b, first, each, at in segments:
        for r in range(b - a):
            used.setdefault(first + r // each, []).append((at + r % each * n, n))
    assert opened == len(gaps) == len(used)
    for x in used.values():
        end = 0
        for o, n in sorted(x):
            assert o == end
            end += n
        assert end <= 40
    assert opened >= math.ceil(sum(k * v for k, v in counts.items()) / 40)


def test_sequences_hold_the_ids(make, odd_rows):
    d = make(odd_rows)
    packed = packing.pack_documents(d, 256)
    got = packing.fill(d, packed, 256).collect()
    assert sum(len(r["ids"]) for r in got) == sum(map(len, brute.ids_of([t for _, t in odd_rows])))
    assert max(len(r["ids"]) for r in got) <= 256


def test_reader_finds_single_keys(spark, make, odd_rows, tmp_path, monkeypatch):
    monkeypatch.setattr(token_io, "BUCKET", 16)
    payload, folder = f"file://{tmp_path}/ids", f"file://{tmp_path}/index"
    index, buckets = token_io.build_index(token_io.write_ids(make(odd_rows), payload))
    token_io.export_index(index, folder)
    r = token_io.Reader(folder, payload, buckets)
    asked = spark.range(200).select("id", token_io._bucket("id", buckets).alias("b")).collect()
    assert all(r.bucket(x["id"]) == x["b"] for x in asked)
    for (i, _), ids in zip(odd_rows, brute.ids_of([t for _, t in odd_rows]), strict=True):
        assert r.get(i).tolist() == ids.tolist()
    assert not any(r.get(k) is not None for k in range(10_000, 10_100))


def test_vocabulary_is_checked(tmp_path, make):
    import json

    assert tokens.id_width() == 2
    spec = tokens.specification()
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": spec["model"] | {"merges": spec["model"]["merges"][::-1]}}):
        (tmp_path / "t.json").write_text(json.dumps(spec | change))
        with pytest.raises(ValueError, match="plain byte-level"):
            tokens.encoder(str(tmp_path / "t.json"), "tiktoken")
    (tmp_path / "wide.json").write_text(json.dumps(spec | {"added_tokens": [{"id": 70_000, "content": "<x>", "special": True}]}))
    assert tokens.id_width(str(tmp_path / "wide.json")) == 4
    with pytest.raises(ValueError, match="4 bytes"):
        token_io.write_ids(make([]), "file:///tmp/none", str(tmp_path / "wide.json"), 2)
