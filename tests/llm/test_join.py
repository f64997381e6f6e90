import brute
from pyspark.sql import functions as F

from starmill.llm import ngram_join


def test_equals_brute_force(make, odd_rows):
    got = [tuple(r) for r in ngram_join.find(make(odd_rows)).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got) == sorted(brute.jaccard_components(odd_rows))


def test_chains_link(make):
    w = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join(w[:40][k:] + [f"z{k}_{j}" for j in range(k)])) for k in range(8)] + [(50 + k, " ".join(w[k : k + 40])) for k in range(15)]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.find(make(rows)).collect()}
    assert got == {i: c for i, _, c in brute.jaccard_components(rows)}


def test_filter_keeps_one_row_of_each(make):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A B c d e f"), (None, "x y"), (None, None), (3, ""), (4, "")]
    d = make(rows)
    kept = ngram_join.filter_documents(d)
    assert kept.columns == d.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, "a b c d e f"), (None, "x y"), (None, None), (3, ""), (4, "")], key=str)


def test_empty_table(make):
    assert ngram_join.find(make([])).collect() == []
    assert ngram_join.filter_documents(make([])).collect() == []


def test_family_that_no_leader_holds_together(make):
    import random

    rng = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for k in range(60):
        w = list(base)
        for _ in range(rng.choice([1, 2, 4, 6, 8])):
            w[rng.randrange(200)] = f"e{k}_{rng.randrange(1000)}"
        rows.append((k, " ".join(w[: rng.choice([200, 200, 170, 150])])))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.find(make(rows)).collect()}
    want = {i: c for i, _, c in brute.jaccard_components(rows)}
    assert got == want and 1 < len(set(want.values())) < 60


def test_filter_with_null_and_repeated_ids_over_many_partitions(spark):
    n = 20000
    word = lambda k: F.concat(F.lit("w"), F.col("id") * 7 + k)
    text = F.concat_ws(" ", *[word(k) for k in range(7)])
    wide = F.sha2(F.col("id").cast("string"), 512)
    d = spark.range(n).select(F.when(F.col("id") != 77, F.col("id") % (n - 1)).alias("doc_id"), text.alias("text"), *[F.concat(wide, F.lit(str(k))).alias(f"c{k}") for k in range(8)])
    copies = d.where("doc_id % 10 = 0").withColumn("doc_id", F.col("doc_id") + n)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        kept = [(r["doc_id"], r["text"]) for r in ngram_join.filter_documents(d.union(copies)).select("doc_id", "text").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert sorted(kept, key=str) == sorted(((r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()), key=str)


def test_fragments_of_a_group_are_joined_by_a_tree():
    import numpy as np
    import pyarrow as pa

    from starmill.llm import ngram_join

    k, sh = 40, np.sort(np.random.default_rng(1).integers(0, 1 << 63, 100).astype(np.uint64))
    digest = ngram_join.digests(np.array([0, 100]), sh, ngram_join.WIDE)[0]
    whole = lambda v, kind: pa.array([v] * k, kind)
    ids = pa.array(range(k), pa.int64())
    batch = pa.RecordBatch.from_arrays([whole(1, pa.int64()), whole(0, pa.int32()), ids, whole(100, pa.int32()), whole(0, pa.int32()), whole(True, pa.bool_()), ids, whole(digest, pa.binary())], names=["tile", "mine", "comp", "n", "level", "own", "sid", "digest"])
    assert sum(len(b) for b in ngram_join._apart(iter([batch]))) == k * (k - 1) // 2
    pairs = [tuple(r.values()) for b in ngram_join._forest(iter([batch])) for r in b.to_pylist()]
    assert len(pairs) == k - 1 and len({x for p in pairs for x in p}) == k
