import math

import brute

from starmill.llm import quality


def test_counts_equal_brute_force(spark, make, odd_rows):
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in odd_rows[:10]] + [(None, 0, 0), (3, None, None), (3, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.judge(make(odd_rows), labels).collect()}
    for i, t in odd_rows:
        r = got[i]
        want = brute.quality_counts(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want
        assert r["kept"] == (not want[-1])  # ten labels certify nothing


def test_cutoffs_are_certified(spark, make):
    text = lambda i, mark: " ".join(f"w{i}x{j}{mark}" for j in range(30))
    rows = [(i, text(i, "###" if i % 4 == 0 else "")) for i in range(6000)]
    d = make(rows)
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    out = quality.judge(d, labels).select("doc_id", "kept").collect()
    assert {r["doc_id"] for r in out if not r["kept"]} == {i for i, _ in rows if i % 4 == 0}
    kept = quality.filter_documents(d, labels)
    assert kept.columns == d.columns and kept.count() == 4500


def test_tail_is_exact(spark):
    from pyspark.sql import functions as F

    cases = [(50, 0), (400, 1), (400, 3), (1000, 2), (1000, 20)]
    df = spark.createDataFrame(cases, "n long, k long")
    for level in (0.05, 0.001):
        got = df.select("n", "k", quality._tail_at_most(F.col("n"), F.col("k"), 0.01, F.lit(level)).alias("ok")).collect()
        for r in got:
            tail = sum(math.comb(r["n"], i) * 0.01**i * 0.99 ** (r["n"] - i) for i in range(r["k"] + 1))
            assert r["ok"] == (tail <= level and r["k"] < r["n"] * 0.01)


def test_empty_tables_and_repeated_rows(spark, make):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(make([]), none).collect() == []
    d = make([(1, "a " * 30), (1, "b c " * 30), (None, None)])
    assert quality.judge(d, none).count() == 3


def test_filter_goes_by_row(spark, make):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    good = [" ".join(f"w{k}_{j}" for j in range(30)) for k in range(4)]
    rows = [(1, good[0]), (1, "too short"), (1, good[1]), (None, good[2]), (None, None), (None, good[3]), (2, "short")]
    d = make(rows)
    kept = quality.filter_documents(d, none)
    assert kept.columns == d.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, good[0]), (1, good[1]), (None, good[2]), (None, good[3])], key=str)
