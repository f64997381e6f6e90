from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starmill.operators import load as L
from starmill.operators import profile as P
from starmill.operators import stages as S


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_coerce_and_check(spark):
    d = spark.createDataFrame([(0, "1", "yes", "x"), (1, "q", "T", "x"), (2, None, "T", "x"), (3, "3", "f", " ")], "i long, n string, b string, t string")
    out = S.check_rows(S.coerce_rows(d, {"n": "bigint", "b": "bool"}), ["n", "t"], {"n": "int", "b": "bool"})
    assert rows(out, "i", "reject_reason") == [(0, "b: not bool"), (1, "n: not int"), (2, "n: required"), (3, "t: required")]
    good, bad = S.split(out)
    assert good.count() == 0 and bad.count() == 4
    assert S.sample_rejects(S.with_order(bad), 2, 6).count() == 2
    strict = S.coerce_strings(d.select("i", "n"), {"n": "int"})
    assert rows(strict, "i", "reject_reason") == [(0, None), (1, "n: not int"), (2, "n: blank"), (3, None)]


def test_text_dates_fail_the_check(spark):
    d = spark.createDataFrame([("2018-01-01",)], "day string")
    assert S.check_rows(d, [], {"day": "date"}).first()["reject_reason"] == "day: not date"


def test_dedup(spark):
    d = spark.createDataFrame([(0, "A", "1"), (1, "B", "2"), (2, "A", "3"), (3, None, "nk"), (4, "B", "4"), (5, "C", "5"), (6, None, "nk2")], "_ord long, k string, v string")
    assert [r[0] for r in rows(S.dedup(d, ["k"]), "_ord")] == [2, 3, 4, 5, 6]
    assert [r[0] for r in rows(S.dedup(d, ["k"], "keep-first"), "_ord")] == [0, 1, 3, 5, 6]
    full = spark.createDataFrame([(0, "A", "x", ""), (1, "A", "", "y"), (2, "A", "", "")], "_ord long, k string, a string, b string")
    assert S.dedup(full, ["k"], "most-complete", ["b"]).first()["_ord"] == 1


def test_require_normalize_realign_chain(spark):
    d = spark.createDataFrame([("a", None), ("b", ""), ("c", "\xa0x ")], "a string, b string")
    out = S.chain(d, lambda x: S.require(x, ["a", "b"]), S.normalize)
    assert rows(out) == [("c", "x")]
    r = spark.createDataFrame([("1", "X", "2"), ("X", "3", "4"), ("5", "6", "7")], "a string, b string, c string")
    assert rows(S.realign(r, ["a", "b", "c"], "b", ["X"])) == [("1", "X", "2"), ("5", "6", "7"), (None, "X", "3")]


def test_record_contract(spark):
    d = spark.createDataFrame([("1", "sure", "A", "13.08.2018"), ("1.5", "never", "A", None), ("2", "perhaps", "A", None), ("2", None, "Z", None), (" ", None, "A", "x")], "n string, f string, e string, d string")
    fields = [{"name": "n", "type": "int", "required": True}, {"name": "f", "type": "bool", "truthy": ["sure"], "falsy": ["never"]}, {"name": "e", "enum": ["A"]}, {"name": "d", "type": "date"}]
    got = [r["reject_reason"] for r in S.check_records(d.coalesce(1), fields).collect()]
    assert got == [None, "n: not int", "f: not bool", "e: not in enum", "n: required"]


def test_dimension_and_lookup(spark):
    d = spark.createDataFrame([(" alice ", 1), ("bob", 2), ("alice", 3), (None, 4), (" ", 5), ("eve", 6)], "u string, n long")
    dim = L.ensure_dimension(d.where("n < 6"), "u", None)
    assert rows(dim) == [(1, "alice"), (2, "bob")]
    more = L.ensure_dimension(d, "u", dim)
    assert rows(more) == [(3, "eve")]
    assert rows(L.lookup(d, dim, "u", "id"), "n", "id") == [(1, 1), (2, 2), (3, 1)]
    assert rows(L.lookup(d, dim, "u", "id", nullable=True), "n", "id") == [(1, 1), (2, 2), (3, 1), (4, None), (5, None)]
    with pytest.raises(Exception, match="lookup miss"):
        L.lookup(d, dim, "u", "id", strict=True).collect()
    assert rows(L.needed_keys(dim, d.where("n = 2"), "u")) == [(2, "bob")]


@pytest.mark.parametrize("few", [10, 100_000])
def test_numbers_are_gapless_in_order(spark, monkeypatch, few):
    monkeypatch.setattr(L, "FEW", few)
    got = rows(L.numbered(spark.range(5000).repartition(7), "id", "n", 10))
    assert sorted(got) == [(i, i + 11) for i in range(5000)]


def test_new_facts(spark):
    d = spark.createDataFrame([(0, "a", 1), (1, "a", 2), (2, None, 3), (3, None, 4), (4, "b", 5)], "_ord long, k string, v long")
    assert [r[0] for r in rows(L.new_facts(d, ["k"]), "_ord")] == [0, 2, 3, 4]
    assert [r[0] for r in rows(L.new_facts(d, ["k"], d.where("k = 'b' or k is null")), "_ord")] == [0, 2, 3]
    assert L.project_fact(d, {"x": "k", "y": "missing"}).columns == ["x", "y", "_ord"]


T1, T2, T3 = (datetime(2026, 1, i) for i in (1, 2, 3))


def batch(spark, *values):
    return spark.createDataFrame([(i, k, h) for i, (k, h) in enumerate(values)], "_ord long, k string, row_hash string")


def test_history_matrix(spark):
    live, closed, new = L.scd2(batch(spark, ("A", "1"), ("A", "1"), ("A", "1")), ["k"], T1)
    assert (live.count(), closed.count(), new.count()) == (1, 0, 1)
    live2, closed2, new2 = L.scd2(batch(spark, ("A", "2")), ["k"], T2, live)
    assert rows(live2, "row_hash", "valid_from", "valid_to") == [("2", T2, None)]
    assert rows(closed2, "row_hash", "valid_from", "valid_to", "changed_at") == [("1", T1, T2, T2)] and new2.count() == 1
    live3, closed3, _ = L.scd2(batch(spark, ("A", "1")), ["k"], T3, live2)
    assert rows(live3, "row_hash") == [("1",)] and rows(closed3, "row_hash") == [("2",)]
    same, none, zero = L.scd2(batch(spark, ("A", "1")), ["k"], T3, live3)
    assert (same.count(), none.count(), zero.count()) == (1, 0, 0)
    other, _, _ = L.scd2(batch(spark, ("B", "1")), ["k"], T3, live3)
    assert rows(other, "k") == [("A",), ("B",)]


def test_history_chain_and_null_keys(spark):
    live, closed, new = L.scd2(batch(spark, ("A", "1"), ("A", "2"), ("A", "1"), (None, "x"), (None, "x")), ["k"], T1)
    assert rows(live, "k", "row_hash") == sorted([("A", "1"), (None, "x"), (None, "x")], key=str)
    assert rows(closed, "row_hash", "valid_from", "valid_to") == [("1", T1, T1), ("2", T1, T1)] and new.count() == 5
    again, _, _ = L.scd2(batch(spark, (None, "x")), ["k"], T2, live)
    assert again.where("k is null").count() == 3


def test_history_without_hash_keeps_surrogates(spark):
    cur = spark.createDataFrame([(7, "A", "x", T1, None, T1)], "id long, k string, v string, valid_from timestamp, valid_to timestamp, changed_at timestamp")
    staged = spark.createDataFrame([(0, "A", "y")], "_ord long, k string, v string")
    live, closed, _ = L.scd2(staged, ["k"], T2, cur, "id")
    assert rows(live, "id", "v") == [(7, "y")] and rows(closed, "id", "v") == [(7, "x")]


def test_profiles(spark):
    d = spark.range(100).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).cast("string").alias("shape"), (F.col("id") % 4).cast("string").alias("color"), F.col("id").cast("string").alias("volume"), F.lit("h").alias("row_hash"))
    p = P.uniqueness(d)
    assert [r["column_name"] for r in P.breakouts(p).collect()] == ["shape", "color"]
    assert [r["column_name"] for r in P.report(p).collect()][0] == "row_hash"
    assert P.uniqueness(d, ["id"], cap=10).first()["capped"]
    assert P.key_column(p, d.columns) == "id"
    kinds = {r["column_name"]: r["inferred_type"] for r in P.infer_types(spark.createDataFrame([("1", "yes", "13.08.2018", "1.5", "a", None)], "a string, b string, c string, d string, e string, f string")).collect()}
    assert kinds == {"a": "integer", "b": "boolean", "c": "date", "d": "float", "e": "text", "f": "text"}


def test_percentiles_and_paths(spark):
    import random

    values = [random.Random(3).randint(0, 50) for _ in range(1)] + list(range(37))
    d = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    s, r = sorted(map(float, values)), P.percentiles(d, ["g"], "v").first()
    assert [r[f"p{p}"] for p in (50, 90, 95, 99)] == [s[int(p / 100 * (len(s) - 1) + 0.5)] for p in (50, 90, 95, 99)]
    e = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (2, "a", "x"), (2, "b", "")], "r long, p string, t string")
    assert rows(P.paths(e, "r", "p", "t")) == [("a", 3, 2, 2, ["x", "y"]), ("b", 1, 1, 1, None)]


def test_set_operators(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i long, s string")
    assert rows(L.minus(a, a.where("i = 2"))) == [(1, None), (1, None)]
    assert rows(L.members(a, spark.range(2, 3), "i", "id"), "i") == [(2,)]


def test_new_facts_keep_every_null_key_of_one_order(spark):
    d = spark.createDataFrame([(5, "p", None, "a"), (5, "p", None, "b"), (5, "p", 1, "c"), (6, "p", 1, "d")], "_ord long, k string, s long, v string")
    assert [r[0] for r in rows(L.new_facts(d, ["k", "s"]), "v")] == ["a", "b", "c"]
