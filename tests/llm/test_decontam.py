import brute
import numpy as np

from starmill.llm import decontam, fm_index

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def items_of(odd_rows):
    words = odd_rows[8][1].split(" ")
    return [(1, " ".join(words[100:130])), (2, " ".join(words[120:140]).upper()), (3, odd_rows[11][1]), (4, "two words"), (None, "one"), (5, ""), (6, None), (3, odd_rows[11][1])]


def test_equals_brute_force(spark, make, odd_rows):
    items = items_of(odd_rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1 << 20, 60):
        got = [tuple(r) for r in decontam.find(make(odd_rows), bench, limit).select(COLUMNS).collect()]
        assert sorted(got) == sorted(brute.contamination(odd_rows, items))


def test_empty_tables(spark, make, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find(make([]), none).collect() == []
    assert {r["contaminated"] for r in decontam.find(make(odd_rows), none).collect()} == {False}


def test_repeated_rows_and_filter(spark, make):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    d = make([(1, "alpha beta gamma"), (1, "alpha beta gamma"), (None, "Alpha, beta gamma!"), (2, "alpha beta"), (None, None)])
    assert sorted(r["contaminated"] for r in decontam.find(d, bench).collect()) == [False, False, True, True, True]
    kept = decontam.filter_documents(d, bench)
    assert kept.columns == d.columns and [r["doc_id"] for r in kept.collect()] == [2]


def test_index_finds_all_places():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 700):
        text = rng.integers(1, 5, n)
        index = fm_index.FMIndex(text, 5)
        for k in (1, 3):
            phrases = np.array(list(np.ndindex(*(4,) * k))) + 1
            for p, lo, hi in zip(phrases, *index.search(phrases), strict=True):
                want = [i for i in range(n - k + 1) if (text[i : i + k] == p).all()]
                assert sorted(index.locate(np.arange(lo, hi)).tolist()) == want


def test_filter_goes_by_row_where_ids_repeat(spark, make):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    d = make([(1, "alpha beta gamma"), (1, "clean words"), (1, "alpha beta gamma"), (1, None), (2, "other words"), (None, "no id")])
    kept = decontam.filter_documents(d, bench)
    assert kept.columns == d.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, "clean words"), (1, None), (2, "other words"), (None, "no id")], key=str)
