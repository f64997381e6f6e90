import json
import os

import pytest

from starmill.operators import profile
from starmill.sources import csv, html, json_files, web, xml_files


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return f"file://{tmp_path}/{name}"


def test_csv_header_and_cells(spark, tmp_path):
    p = put(tmp_path, "a.csv", "﻿First Name,Last Name,age\n Ada ,  Lovelace,  \nx\n")
    rows = [tuple(r) for r in csv.read_csv(spark, p, ["first_name", "last_name", "age", "none"]).collect()]
    assert [r[:4] for r in rows] == [("Ada", "Lovelace", None, None), ("x", None, None, None)]
    assert csv.read_csv(spark, p, fields_per_record=0).count() == 1
    assert csv.read_csv(spark, p, fields_per_record=2).count() == 0
    assert csv.read_csv(spark, p).agg(csv.skipped()).first()[0] == 1
    mapped = csv.read_csv(spark, p, ["given"], header_map={"First Name": "given"})
    assert mapped.first()["given"] == "Ada"


def test_csv_without_header_and_scrub(spark, tmp_path):
    p = put(tmp_path, "b.csv", "1,candycane,301\n2,swallow,940")
    assert [tuple(r)[:3] for r in csv.read_csv(spark, p, ["id", "shape", "volume"], header=False).collect()] == [("1", "candycane", "301"), ("2", "swallow", "940")]
    q = put(tmp_path, "c.csv", 'name,n\n"Acme "v likvidaci""",1\n')
    assert csv.read_csv(spark, q, scrub=True).first()["name"] == "Acme (v likvidaci)"


def test_header_rules():
    assert csv.resolve_header(["﻿A b", " PČV "], {"PČV": "pcv"}) == ["a_b", "pcv"]


@pytest.mark.parametrize(
    ("text", "n"),
    [('[{"a":1,"b":["x","y"]},null,{"a":2,"b":[]}]\n{"a":3,"b":["z"]}', 3), ('{"meta":{"k":1},"records":[{"a":1},{"a":2}],"other":{}}\n{"a":3}', 3), ('{"a":1,"nested":{"y":2},"flag":true}', 1), ("", 0)],
)
def test_json_shapes(text, n):
    assert len(list(json_files.records(text))) == n


@pytest.mark.parametrize("text", ["3", "null", '["x"]', '{"a":["x"]}'])
def test_json_errors(text):
    with pytest.raises(ValueError):
        list(json_files.records(text))


def test_json_rows(spark, tmp_path):
    p = put(tmp_path, "a.json", '[{"a":1.50,"b":["x","y"],"Orig":"o"},null,{"a":true,"b":[],"norm":null,"Orig":"p","c":{"d":1}}]')
    d = json_files.read_documents(spark, p, ["a", "b", "norm", "c"], {"Orig": "norm"})
    assert [tuple(r)[:4] for r in d.collect()] == [("1.50", "x,y", "o", None), ("true", "", None, '{"d": "1"}')]
    bad = put(tmp_path, "bad.json", '[{"a":1},{"a":')
    assert [r["_corrupt"] is None for r in json_files.read_documents(spark, bad, ["a"]).collect()] == [True, False]
    lines = put(tmp_path, "l.json", '{"a":1.50}\n{"a":"x","b":{"c":1}}\n')
    assert [tuple(r)[:2] for r in json_files.read_lines(spark, lines, ["a", "b"]).collect()] == [("1.50", None), ("x", '{"c":1}')]
    assert json_files.flatten({"a": {"b": 1, "c": [1]}, "d": {}}) == {"a.b": 1, "a.c": [1], "d": {}}


XML = '<Root><Rec><A>1</A><B x="y">z</B></Rec><Rec><A>2</A></Rec><Rec><A>cut'


def test_xml(spark, tmp_path):
    p = put(tmp_path, "a.xml", XML)
    c = xml_files.XmlConfig.from_json(xml_files.XmlConfig("Rec", {"a": "A", "b": "B[@x='y']"}, {"all": "A"}).to_json())
    assert [tuple(r) for r in xml_files.read_xml(spark, p, c).collect()] == [("1", "z", ["1"]), ("2", None, ["2"])]
    assert xml_files.guess_record_tag(XML) == "Rec"
    seen = profile.paths(xml_files.elements(spark, p, "Rec"), "record", "path", "text").orderBy("path").collect()
    assert [(r["path"], r["count"], r["max_per_record"], r["examples"]) for r in seen] == [("A", 2, 1, ["1", "2"]), ("B", 1, 1, ["z"])]
    assert xml_files.starter_config("Rec", [r.asDict() for r in seen]).fields == {"a": "A", "b": "B"}
    with pytest.raises(ValueError):
        xml_files.XmlConfig.from_json("{}")
    nested = "<R><X><A>1</A><A>2</A><B>k</B></X><X><B>m</B></X></R>"
    q = put(tmp_path, "n.xml", nested)
    got = xml_files.read_xml(spark, q, xml_files.XmlConfig("X", {"b": "B"}, {"a": "A"})).collect()
    assert [tuple(r) for r in got] == [("k", ["1", "2"]), ("m", [])]


PAGE = """<html><body><div class="rec"><span class="name"> Ann </span><a class="x" href=" /a#f ">A</a></div>
<div class="rec"><span class="name">Bob</span></div><div class="rec"></div>
<ul id="u"><li>A</li><li> B </li><li></li></ul><p>first<p>second<table><tr><th>Phone</th><td>123</td></tr><tr><th>Fax</th><td>9</td></tr></table></body></html>"""


@pytest.mark.parametrize(
    ("selector", "texts"),
    [("#u > li:nth-of-type(2)", ["B"]), ("p + p", ["second"]), ("tr:has(th:contains('Phone')) td", ["123"]), ("td:not(:contains(123))", ["9"]), (".rec .name, li:first-child", ["Ann", "Bob", "A"]), ("a[href*='a'].x", ["A"]), ("th ~ td", ["123", "9"]), ("[id=u] li:last-child", [""])],
)
def test_selectors(selector, texts):
    assert [t.strip() for t in html.debug(PAGE, selector)] == [t.strip() for t in texts]


def test_bad_selectors():
    for s in ("", "a >", "a:nope", "a["):
        with pytest.raises(ValueError):
            html.compile_selector(s)


def test_mappings(spark):
    m = html.MappingFile.from_json(json.dumps({"record_selector": ".rec", "mappings": [{"name": "n", "selector": ".name"}, {"name": "l", "selector": "a.x", "extract": "attr", "attr": "href", "regex": "/(a)"}]}))
    assert html.extract(PAGE, m) == [{"n": "Ann", "l": "a"}, {"n": "Bob"}]
    many = html.MappingFile([html.Mapping("i", "li", all=True)])
    assert html.extract(PAGE, many) == [{"i": ["A", "B"]}]
    d = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "id long, html string")
    assert [tuple(r) for r in html.extract_pages(d, "html", m, "id").collect()] == [(1, "Ann", "a"), (1, "Bob", None)]


def test_links_and_crawl(spark):
    page = '<a class="c d" href="/x#y">1</a><a class="c" href="http://other/z">2</a><a href="mailto:a@b">3</a><a class="c" href="/x">4</a>'
    assert html.links(page, "http://h/p", "c") == ["http://h/x"]
    assert html.links(page, "http://h/p", "", False) == ["http://h/x", "http://other/z"]
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("b", "a")], "from_url string, to_url string")
    got = html.crawl(spark.createDataFrame([("a",)], "url string"), edges, 2)
    assert sorted(tuple(r) for r in got.collect()) == [("a", 0), ("b", 1), ("c", 2)]


def test_lists_and_fetch(spark, tmp_path):
    p = put(tmp_path, "urls", "# c\n\n file:///nowhere \nb\n")
    assert [r["line"] for r in web.read_list(spark, p).collect()] == ["file:///nowhere", "b"]
    put(tmp_path, "page.html", "hello")
    assert web.first_bytes(str(tmp_path / "page.html"), 3) == b"hel"
    waits = []
    c = web.Client(retries=2)
    c.sleep = waits.append
    assert c.request("file:///nowhere")[0] == 0 and waits == [0.5, 1.0]
    urls = spark.createDataFrame([(f"file://{tmp_path}/page.html",), ("file:///nowhere",)], "url string")
    got = {r["url"]: r for r in web.download(urls, str(tmp_path / "out"), web.Client(retries=0), 2).collect()}
    ok = got[f"file://{tmp_path}/page.html"]
    assert ok["ok"] and os.path.getsize(tmp_path / "out" / ok["file"]) == 5 and not got["file:///nowhere"]["ok"]
    pages = html.read_pages(spark, f"file://{tmp_path}").collect()
    assert [tuple(r) for r in pages] == [("page.html", "hello")]


def test_requests_retry_and_send(spark, tmp_path):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen = []

    class Handler(BaseHTTPRequestHandler):
        def _answer(self):
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            seen.append((self.command, body, self.headers.get("Range")))
            busy = self.path == "/busy" and len([s for s in seen if s[0] == "GET"]) < 3
            self.send_response(503 if busy else 404 if self.path == "/none" else 200)
            if busy:
                self.send_header("Retry-After", "7")
            self.end_headers()
            self.wfile.write(b"0123456789")

        do_GET = do_POST = do_PUT = _answer

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at, waits = f"http://127.0.0.1:{server.server_port}", []
    c = web.Client(retries=3)
    c.sleep = waits.append
    assert c.get(f"{at}/busy") == (200, b"0123456789", 3) and waits == [7.0, 7.0]
    assert c.post(f"{at}/x", b"body")[0] == 200 and c.put(f"{at}/x", b"b2")[0] == 200
    assert web.first_bytes(f"{at}/x", 4) == b"0123"
    assert [s[:2] for s in seen[3:5]] == [("POST", b"body"), ("PUT", b"b2")] and seen[-1][2] == "bytes=0-3"
    got = web.download(spark.createDataFrame([(f"{at}/none",)], "url string"), str(tmp_path), web.Client(), 1).first()
    assert got["ok"] and got["status"] == 404 and got["file"] is None
    server.shutdown()


def test_citation_fields(spark):
    from pyspark.sql import functions as F

    authors = "".join(f"<Author><LastName>N{i}</LastName></Author>" for i in range(20))
    d = spark.createDataFrame([(f"<A><PMID Version='1'>7</PMID><ArticleTitle>T</ArticleTitle>{authors}</A>",)], "xml string")
    r = d.select(*xml_files.citation_fields(F.col("xml"))).first()
    assert (r["pmid"], r["title"], r["journal"], len(r["authors"])) == ("7", "T", None, 16)


def test_csv_cells_that_span_lines(spark, tmp_path):
    p = put(tmp_path, "m.csv", 'id,name\n1,"a\nb"\n2,"say ""hi"""\n3,c\n')
    assert csv.spans_lines(spark, p)
    assert [tuple(r)[:2] for r in csv.read_csv(spark, p).collect()] == [("1", "a\nb"), ("2", 'say "hi"'), ("3", "c")]
    q = put(tmp_path, "n.csv", 'id,name\n1,"Acme "v likvidaci"""\n2,"a\nb"\n')
    assert [tuple(r)[:2] for r in csv.read_csv(spark, q, scrub=True).collect()] == [("1", "Acme (v likvidaci)"), ("2", "a\nb")]
    assert not csv.spans_lines(spark, put(tmp_path, "o.csv", 'a\n"x ""y"""\n'))


def test_csv_scrub_keeps_rows_like_the_header(spark, tmp_path):
    folder = tmp_path / "two"
    folder.mkdir()
    for n in ("a", "b"):
        (folder / f"{n}.csv").write_text("id,name\n1,x\nid,name\n")
    got = sorted(tuple(r)[:2] for r in csv.read_csv(spark, f"file://{folder}", scrub=True).collect())
    assert got == [("1", "x"), ("1", "x"), ("id", "name"), ("id", "name")]


def test_csv_rows_of_another_width(spark, tmp_path):
    p = put(tmp_path, "w.csv", "a,b\nx,y,z\nok1,ok2\n")
    assert [tuple(r)[:2] for r in csv.read_csv(spark, p, fields_per_record=2).collect()] == [("ok1", "ok2")]
    with pytest.warns(UserWarning, match="2 cells, 5"):
        assert csv.read_csv(spark, p, fields_per_record=5).count() == 0
    q = put(tmp_path, "u.csv", 'h1,h2\na,b\n"bad,bad\nc,d\n')
    assert tuple(csv.read_csv(spark, q).first())[:2] == ("a", "b")


def test_json_lines_with_names_that_differ_in_case(spark, tmp_path):
    p = put(tmp_path, "case.json", '{"Id":1}\n{"id":2,"Id":3}\nbroken\n')
    assert [r["id"] for r in json_files.read_lines(spark, p, ["id"], {"Id": "id"}).collect()] == ["1", "2", None]


def test_paging_and_largest_array():
    m = html.MappingFile([html.Mapping("href", "a", "attr", "href"), html.Mapping("count", "i")], ".r")
    page = '<div class="r"><a href="/c/">x</a><i>(51)</i></div><div class="r"><a href="d"></a><i>(0)</i></div>'
    assert html.paging(page, "http://h.example/l", m) == ["http://h.example/c/", "http://h.example/c/2", "http://h.example/c/3"]
    assert html.paging("<i>(26)</i>", "http://h.example/l/", html.MappingFile([html.Mapping("count", "i")])) == ["http://h.example/l", "http://h.example/l/2"]
    assert [r["x"] for r in json_files.records('{"a":[{"x":"1"}],"b":[{"x":"2"},{"x":"3"}]}', largest=True)] == ["2", "3"]


def test_live_crawl_follows_links_once():
    site = {"http://h.example/": '<a href="/a">a</a><a href="/b">b</a>', "http://h.example/a": '<a href="/">up</a><a href="/c">c</a>'}

    class Client:
        def get(self, url):
            return (200, site[url].encode(), 1) if url in site else (404, b"", 1)

    got = list(html.crawl_live(["http://h.example/"], 2, Client()))
    assert got == [("http://h.example/", 0, 200), ("http://h.example/a", 1, 200), ("http://h.example/b", 1, 404), ("http://h.example/c", 2, 404)]


def test_csv_header_in_folders_with_numbers(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / f"part={k}").mkdir()
        put(tmp_path / f"part={k}", "a.csv", f'id,note\n{k},"a\nb"\n')
    d = csv.read_csv(spark, f"file://{tmp_path}")
    assert d.columns == ["id", "note", csv.CORRUPT]
    assert sorted(tuple(r) for r in d.collect()) == [("1", "a\nb", None), ("2", "a\nb", None)]


def test_page_lists_of_any_length(spark):
    listings = spark.createDataFrame([("http://a.example/x", '<div class="r"><a href="/1/">n</a><i>60</i></div><div class="r"><a href="/2">n</a><i>2000000000</i></div>')], "url string, html string")
    m = html.MappingFile([html.Mapping("href", "a", "attr", "href"), html.Mapping("count", "i")], ".r")
    d = html.page_lists(listings, "url", "html", m)
    # a list of all 80,000,003 URLs fits no batch
    assert [tuple(r)[1:] for r in d.limit(5).collect()] == [(0, "http://a.example/1/"), (1, "http://a.example/1/2"), (2, "http://a.example/1/3"), (3, "http://a.example/2"), (4, "http://a.example/2/2")]
    assert tuple(d.where("at = 5000").first())[1:] == (5000, "http://a.example/2/4998")


def test_xml_records_in_splits(spark, tmp_path):
    bodies = [
        "<R><X><A>1</A></X> <X/>\n<X a='b'><A>2</A></X></R>",
        "<R><X>whole</X><X>cut",
        "<X>1</X><X>last</X>",
        "<X>same</X><X>same",
        "<X>a<X>in</X>b</X><X >c</X >",
        "﻿<X>é</X>\n" * 3,
        "none",
        "</X><X>d</X>",
    ]
    for i, body in enumerate(bodies):
        put(tmp_path, f"{i}.xml", body)
    want = sorted(r for b in bodies for r in xml_files.split_records(b, "X"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        got = xml_files.read_records(spark, f"file://{tmp_path}", "X")
        assert sorted(r[0] for r in got.collect()) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    put(tmp_path, "4.xml", bodies[0])
    put(tmp_path, "3.xml", bodies[0])
    put(tmp_path, "7.xml", bodies[0])
    plan = xml_files.read_records(spark, f"file://{tmp_path}", "X")._jdf.queryExecution().toString()
    assert "binaryFile" not in plan, "files of plain records come in splits"
