import base64
import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from starmill.functions import coerce as C
from starmill.functions import hashing, text, urls
from starmill.functions.emails import decode_email


def apply(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string").select("i", f(F.col("s")).alias("v")).orderBy("i").collect()
    return [r["v"] for r in rows]


def test_ints(spark):
    values = [" 42 ", "42.0", "42.5", "1e3", "+7", "", "9223372036854775808", "x", None, "-3"]
    assert apply(spark, values, lambda c: C.coerced(c, "bigint")) == [42, 42, None, None, 7, None, None, None, None, -3]


def test_bools(spark):
    values = ["T", "TRUE", "tRue", "yes", "ano", "1", "f", "0", " ", "False"]
    assert apply(spark, values, C.to_bool) == [True, True, None, None, None, True, False, False, None, False]
    assert apply(spark, values, C.loose_bool) == [True, True, True, True, True, True, False, False, None, False]
    assert apply(spark, ["Sure", "never", "yes"], lambda c: C.to_bool(c, ["sure"], ["never"])) == [True, False, None]


def test_dates(spark):
    values = ["13.08.2018", "31.02.2018", "13.08.2018 00:00", "2018-08-13", "3.8.2018", "", "13.13.2018", "32.01.2018"]
    want = [date(2018, 8, 13), date(2018, 3, 3), date(2018, 8, 13), date(2018, 8, 13), None, None, None, None]
    assert apply(spark, values, lambda c: C.coerced(c, "date")) == want
    assert apply(spark, ["08/13/2018", "2018-08-13"], lambda c: C.to_date(c, "01/02/2006")) == [date(2018, 8, 13)] * 2
    assert C.java_pattern("2006-01-02T15:04:05") == "yyyy-MM-dd'T'HH:mm:ss"
    assert apply(spark, ["2018-01-02", "02.01.2018", "13/01/2018", "01/13/2018", "x"], C.loose_date_layout) == ["2006-01-02", "02.01.2006", "02/01/2006", "01/02/2006", None]
    assert apply(spark, ["2018-01-02 03:04:05", "02.01.2018 03:04", "no"], lambda c: C.loose_timestamp(c).isNotNull()) == [True, True, False]


@pytest.mark.parametrize(("name", "kind"), [("int4", "int"), ("TIMESTAMPTZ", "timestamp"), ("bitint", "int"), ("", "text"), ("varchar", "text"), ("boolean", "bool")])
def test_kind_names(name, kind):
    assert C.normalize_kind(name) == kind


def test_texts(spark):
    assert apply(spark, ["<p>Hello</p> world <br>", "a < b", "a > b"], text.strip_html) == ["Hello world ", "a ", "a  b"]
    assert apply(spark, ["  a \t b\n\nc "], text.collapse_whitespace) == ["a b c"]
    assert apply(spark, ["x[a]y", "x[a", "[]", "[a][b]"], lambda c: text.extract_between(c, "[", "]")) == ["a", None, "", "a"]
    assert apply(spark, ["a12b34c 56", "n:42,m:7;z=99", "99999999999999999999", ""], text.extract_ints) == [[12, 34, 56], [42, 7, 99], None, []]
    assert apply(spark, ["Uryyb"], text.rot13) == ["Hello"]
    assert apply(spark, ["\xa0 a\xa0b "], text.normalize_nbsp) == ["a b"]
    assert apply(spark, [" a", "a", "a\n"], text.has_edge_space) == [True, False, True]
    assert apply(spark, ["id=7;", "none"], lambda c: text.regex_filter(c, r"id=(\d)")) == ["7", None]
    assert apply(spark, ["(1 096 ads)", "x"], text.parse_count) == [1096, None]
    assert apply(spark, ["1 000", "x"], text.parse_spaced_count) == [1000, None]


@pytest.mark.parametrize(("raw", "name"), [("PČV", "pcv"), ("Stát", "stat"), ("Číslo-smlouvy", "cislo_smlouvy"), ("  Řízení / Test  ", "rizeni_test"), ("﻿PČV", "pcv")])
def test_field_names(raw, name):
    assert text.field_name(raw) == name


def test_identifiers():
    long = "a" * 80
    cut = text.limit_identifier(long)
    assert len(cut) == 63 and cut[-10:-8] == "__" and text.limit_identifier("short") == "short"
    assert text.quote("public.a`b") == "`public`.`a``b`" and text.quote("a]b", "mssql") == "[a]]b]"


def test_row_hash(spark):
    import hashlib

    d = spark.createDataFrame([(None, " x ", date(2018, 8, 13), True)], "a long, b string, c date, d boolean")
    got = d.select(hashing.row_hash(d, ["a", "b"]).alias("h"), hashing.row_hash(d, ["c", "d"], names=False).alias("k")).first()
    assert got["h"] == "2e86c29f1c074f249f48c562e05699bf486bc033ca22ec937a96bf962feffdf6"
    assert got["k"] == hashlib.sha256("2018-08-13T00:00:00Z\x1ftrue".encode()).hexdigest()
    kept = hashing.with_row_hash(d.withColumn("h", F.lit("old")), "h", ["a"], overwrite=False).first()["h"]
    assert kept == "old"


def _order(d):
    return base64.b64encode(json.dumps(d).encode()).decode().rstrip("=")


@pytest.mark.parametrize(
    ("script", "mail"),
    [
        ("console.log('none')", ""),
        ("var a='me&#64;example.com';", "me@example.com"),
        ("var a='mailto:me@example.com';", "me@example.com"),
        (f"var a='me+NOISE@example.com'; <span class=\"email {_order({'rmv': '+NOISE'})}\">", "me@example.com"),
        (f"var a='qi@example.org'; <i class=\"emailLink {_order({'h': 'q'})}\">", "hi@example.org"),
        (f"var a='znvygb:zr@rknzcyr.pbz'; <b class=\"required {_order({'rot': 'it'})}\">", "me@example.com"),
        (f"var a='mx@example.com'; <div class=\"btn {_order({'rmv': 'x'})}\">", "mx@example.com"),
        ("var a='not an address';", ""),
    ],
)
def test_hidden_addresses(script, mail):
    assert decode_email(script) == mail


def test_paging(spark):
    rows = spark.createDataFrame([("urlA", "101"), ("urlB", None), ("urlC", "1 000"), ("urlA", "101")], "href string, count string").coalesce(1)
    got = [r["url"] for r in urls.expand_hrefs(rows).collect()]
    assert got == ["urlA", "urlA/2/", "urlA/3/", "urlA/4/", "urlB", "urlC", *[f"urlC/{i}/" for i in range(2, 41)]]
    n = spark.createDataFrame([("u", 51), ("v", 0), ("w", 26), ("x", 25)], "u string, n int")
    assert sorted(r["page_url"] for r in urls.page_urls(n, "u", "n").collect()) == ["u/2", "u/3", "w/2"]


def test_waits(spark):
    now = datetime(2026, 1, 1, tzinfo=UTC)
    assert urls.retry_after("7") == 7 and urls.retry_after("soon") is None
    assert urls.retry_after("Thu, 01 Jan 2026 00:00:30 GMT", now) == 30
    assert spark.range(5).select(urls.backoff(F.col("id") + 1, 0.5, 3.0).alias("w")).orderBy("id").toPandas().w.tolist() == [0.5, 1, 2, 3, 3]


def test_urls(spark):
    assert apply(spark, ["http://h/p?a=1&b=x#f", "http://h/p"], urls.safe_filename)[0] == "a_1_b_x"
    d = spark.createDataFrame([("http://h/a/b", " ../c "), ("http://h/", None)], "b string, h string")
    assert [r[0] for r in d.select(urls.resolve("b", "h")).collect()] == ["http://h/c", None]
