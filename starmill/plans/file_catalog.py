"""Queries over files, stores, streams and documents: tables are written out in a format, and read back by its source.

Each writes into a folder of its own under the shared folder; the SQL says what the
tables themselves hold.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill import metrics
from starmill.functions import coerce as C
from starmill.functions import text
from starmill.functions.emails import email_column
from starmill.operators import profile as P
from starmill.operators import stages as S
from starmill.plans import config, ddl, engine, probe, stores
from starmill.plans.catalog import NOW, QUERIES, SQL, STAR, query, t  # noqa: F401
from starmill.sources import csv, html, json_files, web, xml_files
from starmill.streaming import loader


def folder(spark: SparkSession, name: str) -> str:
    return f"{stores.shared_dir(spark)}/files-{name}-{uuid.uuid4().hex}"


def put_lines(lines: DataFrame, path: str, parts: int | None = None) -> str:
    """Write ``lines`` (column ``value``) as text files."""
    (lines.coalesce(parts) if parts else lines).select("value").write.text(path)
    return path


def put_headed(lines: DataFrame, path: str, *heads: str) -> str:
    """Write ``heads`` and then ``lines`` (column ``value``) as one text file."""
    first = lines.sparkSession.createDataFrame([(h,) for h in heads], "value string")
    both = first.withColumn("at", F.lit(0)).union(lines.select("value", F.lit(1).alias("at")))
    both.repartition(1).sortWithinPartitions("at").select("value").write.text(path)
    return path


def put_text(spark: SparkSession, path: str, body: str) -> str:
    """Write one small file."""
    fs, p = stores.file_system(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(body, "utf-8"))
    out.close()
    return path


def get_text(spark: SparkSession, path: str) -> str:
    return spark.read.option("wholetext", "true").text(path).first()[0]


def _quoted(c) -> F.Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


# -- CSV


def _order_csv(spark, sf_dir) -> str:
    """Orders as CSV: quotes and commas in a cell, a line break in every third, a blank in every fifth."""
    o = t(spark, sf_dir, "orders")
    note = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit('a "b",\n'), "o_orderpriority")).when(F.col("o_orderkey") % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" x, "), "o_orderpriority"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), _quoted(note), F.date_format("o_orderdate", "dd.MM.yyyy"))
    path = folder(spark, "orders-csv")
    # every file has the header: a file is a partition's lines, with the header before them
    parts = o.select(line.alias("value")).withColumn("part", F.spark_partition_id())
    heads = parts.groupBy("part").agg(F.lit("﻿Order Key,Note,Day").alias("value")).withColumn("at", F.lit(0))
    both = parts.withColumn("at", F.lit(1)).unionByName(heads)
    both.repartition(4, "part").sortWithinPartitions("part", "at").select(F.concat_ws("", "value").alias("value"), "part").write.partitionBy("part").text(path)
    return path


@query("SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CASE WHEN o_orderkey % 3 = 0 THEN 'a \"b\",' || chr(10) || o_orderpriority WHEN o_orderkey % 5 = 0 THEN NULL ELSE trim(' x, ' || o_orderpriority) END AS note, strftime(o_orderdate, '%d.%m.%Y') AS day FROM orders")
def csv_quoted_line_breaks(spark, sf_dir):
    return csv.read_csv(spark, _order_csv(spark, sf_dir), ["order_key", "note", "day"]).drop(csv.CORRUPT)


@query("SELECT CAST(l_orderkey AS VARCHAR) AS key, CAST(l_linenumber AS VARCHAR) AS line, CASE WHEN l_linenumber % 4 <> 0 THEN l_returnflag END AS flag FROM lineitem")
def csv_ragged_rows(spark, sf_dir):
    """No header, semicolons; every fourth row lacks its last cell."""
    li = t(spark, sf_dir, "lineitem")
    line = F.concat_ws(";", "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 4 != 0, F.col("l_returnflag")))
    path = put_headed(li.select(line.alias("value")), folder(spark, "ragged"), "-1;-1;x")
    return csv.read_csv(spark, path, ["key", "line", "flag"], header=False, sep=";").where("key <> '-1'").drop(csv.CORRUPT)


def _wide_csv(spark, sf_dir) -> str:
    c = t(spark, sf_dir, "customer")
    line = F.concat_ws(",", "c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, "more"))
    return put_headed(c.select(line.alias("value")), folder(spark, "wide"), "id,segment")


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS segment FROM customer WHERE c_custkey % 7 <> 0")
def csv_enforced_width(spark, sf_dir):
    return csv.read_csv(spark, _wide_csv(spark, sf_dir), fields_per_record=2).drop(csv.CORRUPT)


@query("SELECT count(*) AS n, count(*) FILTER (c_custkey % 7 = 0) AS skipped FROM customer")
def csv_skipped_count(spark, sf_dir):
    return csv.read_csv(spark, _wide_csv(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n"), csv.skipped().alias("skipped"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS pcv, s_name || CASE WHEN s_suppkey % 2 = 0 THEN ' (v likvidaci)' ELSE '' END AS nazev FROM supplier UNION ALL SELECT 'PČV', 'Název'")
def csv_scrubbed(spark, sf_dir):
    """The known damage of one source's quotes, and a data row that equals the header."""
    s = t(spark, sf_dir, "supplier")
    line = F.concat(F.col("s_suppkey").cast("string"), F.lit(',"'), "s_name", F.when(F.col("s_suppkey") % 2 == 0, F.lit(' "v likvidaci""')).otherwise(""), F.lit('"'))
    line = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.col("s_suppkey").cast("string"), F.lit(',"'), "s_name", F.lit(' "v likvidaci"""'))).otherwise(line)
    path = put_headed(s.select(line.alias("value")), folder(spark, "scrub"), "PČV,Název", "PČV,Název")
    return csv.read_csv(spark, path, ["pcv", "nazev"], header_map={"PČV": "pcv", "Název": "nazev"}, scrub=True, lazy_quotes=True).drop(csv.CORRUPT)


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name || ' \"x\" y' AS name FROM part")
def csv_lazy_quotes(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    path = put_headed(p.select(F.concat(F.col("p_partkey").cast("string"), F.lit(","), "p_name", F.lit(' "x" y')).alias("value")), folder(spark, "lazy"), "id,name")
    return csv.read_csv(spark, path, lazy_quotes=True).drop(csv.CORRUPT)


@query("SELECT unnest(['first_name', 'o_c', 'pcv', 'druhý']) AS name, unnest([0, 1, 2, 3]) AS place")
def csv_header_names(spark, sf_dir):
    names = csv.resolve_header(["﻿First Name", " O C ", "PČV", "Druhý"], {"PČV": "pcv"})
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, place int")


# -- JSON


def _events_json(spark, sf_dir, kind: str) -> str:
    """Events as JSON documents, a file a day of the month: a root array, an envelope, objects after each other, or one object a line."""
    e = t(spark, sf_dir, "events")
    tags = F.when(F.col("event_id") % 4 == 0, F.array()).otherwise(F.array(F.lit("x"), F.lit(None).cast("string"), "event_type")).cast("array<string>")
    one = F.to_json(F.struct(F.col("event_id").alias("Id"), F.col("value"), tags.alias("tags"), F.struct(F.col("user_id").alias("u")).alias("by"), F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("type")))
    path = folder(spark, f"json-{kind}")
    if kind == "lines":
        return put_lines(e.select(one.alias("value")), path)
    docs = e.groupBy(F.pmod("event_id", F.lit(8)).alias("g")).agg(F.array_sort(F.collect_list(one)).alias("rows"))
    rows = F.array_join("rows", ",")
    body = {"array": F.concat(F.lit("[null,"), rows, F.lit("]")), "envelope": F.concat(F.lit('{"meta":{"a":[1]},"records":['), rows, F.lit('],"other":{}}')), "objects": F.concat(F.lit('{"Id":"first"}\n'), F.array_join("rows", "\n"))}[kind]
    docs.select(body.alias("value"), "g").repartition(8, "g").write.partitionBy("g").text(path)
    return path + "/*"


_EVENTS = "SELECT CAST(event_id AS VARCHAR) AS id, event_id % 3 = 0 AS has_type, CASE WHEN event_id % 4 = 0 THEN '' ELSE 'x,' || event_type END AS tags, CAST(CAST(user_id AS BIGINT) AS VARCHAR) AS u FROM events"


def _event_rows(df: DataFrame) -> DataFrame:
    return df.where("_corrupt IS NULL").select("id", F.col("type").isNotNull().alias("has_type"), "tags", F.get_json_object("by", "$.u").alias("u"))


def _documents(spark, sf_dir, kind: str) -> DataFrame:
    return _event_rows(json_files.read_documents(spark, _events_json(spark, sf_dir, kind), ["id", "type", "tags", "by"], {"Id": "id"}))


@query(_EVENTS)
def json_root_array(spark, sf_dir):
    return _documents(spark, sf_dir, "array")


@query(_EVENTS)
def json_envelope(spark, sf_dir):
    return _documents(spark, sf_dir, "envelope")


@query(_EVENTS)
def json_trailing_objects(spark, sf_dir):
    return _documents(spark, sf_dir, "objects").where("id <> 'first'")


@query("SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 3 = 0 THEN event_type END AS type FROM events")
def json_lines(spark, sf_dir):
    return json_files.read_lines(spark, _events_json(spark, sf_dir, "lines"), ["id", "type"], {"Id": "id"}).select("id", "type")


@query("SELECT event_id, json_extract_string(props, '$.k') AS a_k, CAST(user_id AS VARCHAR) AS a_b_u, CASE WHEN event_id % 2 = 0 THEN '[1,2]' END AS l FROM events")
def json_nested_flatten(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    doc = F.concat(F.lit('{"a":{"k":'), F.get_json_object("props", "$.k"), F.lit(',"b":{"u":'), F.col("user_id").cast("string"), F.lit("}}"), F.when(F.col("event_id") % 2 == 0, F.lit(',"l":[1,2]')).otherwise(""), F.lit("}"))
    return json_files.flat_rows(e.select("event_id", doc.alias("doc")), "doc", ["a.k", "a.b.u", "l"])


@query("SELECT 'rows' AS name, CAST(3 AS BIGINT) AS n UNION ALL SELECT 'first', 1 UNION ALL SELECT 'flat', 2")
def json_record_choice(spark, sf_dir):
    """The longest array of objects of an envelope, the first one, and the keys of a nested object."""
    doc = '{"a":[{"x":1}],"b":[{"x":1},{"x":2},{"x":3}],"c":[1,2,3,4]}'
    rows = [("rows", len(list(json_files.records(doc, largest=True)))), ("first", len(list(json_files.records(doc)))), ("flat", len(json_files.headers([json_files.flatten({"a": {"b": 1}, "c": [1]})])))]
    return spark.createDataFrame(rows, "name string, n bigint")


# -- XML


def _parts_xml(spark, sf_dir) -> str:
    """Parts as XML records, two lists and an attribute each, in a few files; the last record of each file is cut off."""
    p = t(spark, sf_dir, "part")
    one = F.concat(
        F.lit("<Item><Key>"), F.col("p_partkey").cast("string"), F.lit('</Key><Name lang="en"> '), F.xpath_string(F.lit("<a/>"), F.lit("b")), "p_name", F.lit(' </Name><Name lang="cs">'), F.col("p_size").cast("string"),
        F.lit("</Name><Tags><Tag>"), "p_brand", F.lit("</Tag><Tag>"), F.when(F.col("p_partkey") % 3 == 0, F.lit(" ")).otherwise(F.col("p_type")), F.lit("</Tag></Tags></Item>"),
    )
    docs = p.groupBy(F.pmod("p_partkey", F.lit(4)).alias("g")).agg(F.array_join(F.array_sort(F.collect_list(one)), "").alias("rows"))
    body = F.concat(F.lit('<?xml version="1.0"?><Root><Head><V>1</V></Head>'), "rows", F.lit("<Item><Key>0</Key><Na"))
    path = folder(spark, "parts-xml")
    docs.select(body.alias("value"), "g").repartition(4, "g").write.partitionBy("g").text(path)
    return path + "/*"


@query("SELECT CAST(p_partkey AS VARCHAR) AS key, trim(p_name) AS name, CAST(p_size AS VARCHAR) AS cs, p_brand || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '|' || p_type END AS tags FROM part")
def xml_fields_and_lists(spark, sf_dir):
    c = xml_files.XmlConfig.from_json(json.dumps({"record_tag": "Item", "fields": {"key": "Key", "name": "Name", "cs": "Name[@lang='cs']"}, "lists": {"tags": "Tags/Tag"}}))
    return xml_files.read_xml(spark, _parts_xml(spark, sf_dir), xml_files.XmlConfig.from_json(c.to_json())).withColumn("tags", F.array_join("tags", "|"))


@query("""
WITH c AS (SELECT count(*) AS n FROM part), e AS (SELECT unnest(['Key', 'Name', 'Tags', 'Tags/Tag']) AS path, unnest([1, 2, 1, 2]) AS k)
SELECT path, CAST(n * k AS BIGINT) AS count, n AS records_with, CAST(k AS BIGINT) AS max_per_record FROM c, e
""")
def xml_structure(spark, sf_dir):
    """What an unknown XML file holds, its record tag guessed."""
    path = _parts_xml(spark, sf_dir)
    tag = xml_files.guess_record_tag(get_text(spark, path))
    return P.paths(xml_files.elements(spark, path, tag), "record", "path", "text").select("path", "count", "records_with", "max_per_record")


@query("SELECT 'fields' AS part, 'key' AS name, 'Key' AS path UNION ALL SELECT 'fields', 'tags', 'Tags' UNION ALL SELECT 'lists', 'name', 'Name' UNION ALL SELECT 'lists', 'tags_tag', 'Tags/Tag' UNION ALL SELECT 'record', '', 'Item'")
def xml_starter_config(spark, sf_dir):
    report = [r.asDict() for r in xml_structure(spark, sf_dir).collect()]  # a row a path
    c = xml_files.starter_config("Item", report)
    rows = [("fields", k, v) for k, v in c.fields.items()] + [("lists", k, v) for k, v in c.lists.items()] + [("record", "", c.record_tag)]
    return spark.createDataFrame(rows, "part string, name string, path string")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS pmid, o_orderpriority AS title, CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(least(16, o_orderkey % 20) AS INTEGER) AS n_authors FROM orders")
def xml_citations(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    names = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), (F.col("o_orderkey") % 20).cast("int"))), lambda i: F.concat(F.lit("<Author><LastName>N"), i.cast("string"), F.lit("</LastName></Author>"))), "")
    names = F.when(F.col("o_orderkey") % 20 == 0, "").otherwise(names)
    one = F.concat(F.lit('<PubmedArticle><PMID Version="1">'), F.col("o_orderkey").cast("string"), F.lit("</PMID><ArticleTitle>"), "o_orderpriority", F.lit("</ArticleTitle><Year>"), F.year("o_orderdate").cast("string"), F.lit("</Year>"), names, F.lit("</PubmedArticle>"))
    path = put_lines(o.select(one.alias("value")), folder(spark, "citations"))
    d = xml_files.read_records(spark, path, "PubmedArticle").select(*xml_files.citation_fields(F.col("xml")))
    return d.select("pmid", "title", "year", F.size("authors").alias("n_authors"))


# -- lists, pages, HTTP


@query("SELECT DISTINCT trim(url) AS line FROM pages")
def list_file(spark, sf_dir):
    p = t(spark, sf_dir, "pages")
    extra = spark.createDataFrame([("# note",), ("   ",), ("",)], "value string")
    path = put_lines(p.select("url").distinct().select(F.concat(F.lit("  "), "url", F.lit(" ")).alias("value")).union(extra), folder(spark, "list"))
    return web.read_list(spark, path)


def _page_folder(spark, sf_dir) -> str:
    """One HTML file a page, named by its number, with three plain records added."""
    p = t(spark, sf_dir, "pages")
    path = folder(spark, "pages")
    body = F.concat(F.lit("<html><body>"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.concat(F.lit('<div class="rec"><a class="x y" href="/c/'), i.cast("string"), F.lit('">N'), F.col("page_id").cast("string"), F.lit("</a><i>("), (F.col("page_id") * i).cast("string"), F.lit(" ...)</i></div>"))), ""), F.lit("</body></html>"))
    names = p.select("page_id", body.alias("body"))

    def put(frames):
        import pandas as pd
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        for frame in frames:
            store.create_dir(root, recursive=True)
            for i, b in zip(frame["page_id"], frame["body"], strict=True):
                with store.open_output_stream(f"{root}/p{i:07d}.html") as f:
                    f.write(b.encode())
            yield pd.DataFrame({"n": [len(frame)]})

    names.mapInPandas(put, "n long").agg(F.sum("n")).collect()
    return path


_RECORDS = html.MappingFile([html.Mapping("name", "a.x"), html.Mapping("href", "a.x", "attr", "href"), html.Mapping("count", "i", regex=r"\d+")], ".rec")


@query("SELECT 'p' || lpad(CAST(page_id AS VARCHAR), 7, '0') || '.html' AS source_file, 'N' || page_id AS name, '/c/' || i AS href, CAST(page_id * i AS VARCHAR) AS count FROM pages, (SELECT unnest([1, 2, 3]) AS i) x")
def html_folder_records(spark, sf_dir):
    return html.extract_pages(html.read_pages(spark, _page_folder(spark, sf_dir)), "html", _RECORDS, "source_file")


_MANY = "SELECT page_id, 'http://h' || page_id || '.example' AS h, i, page_id * i AS n FROM pages, (SELECT unnest([1, 2, 3]) AS i) x"


@query(f"SELECT h || '/c/' || i || CASE WHEN p > 1 THEN '/' || p ELSE '' END AS page_url FROM (SELECT h, i, unnest(range(1, CAST(ceil(n / 25.0) AS BIGINT) + 1)) AS p FROM ({_MANY}) z WHERE n > 0) y")
def html_paging_records(spark, sf_dir):
    p = t(spark, sf_dir, "pages")
    one = lambda i: F.concat(F.lit(f'<div class="rec"><a class="x" href="/c/{i}">n</a><i>('), (F.col("page_id") * i).cast("string"), F.lit(" ...)</i></div>"))
    d = p.select(F.concat(F.lit("http://h"), F.col("page_id").cast("string"), F.lit(".example/x")).alias("base"), F.concat(one(1), one(2), one(3)).alias("html"))
    return html.page_lists(d, "base", "html", _RECORDS).select("page_url")


@query("SELECT rtrim(url, '/') || CASE WHEN p > 1 THEN '/' || p ELSE '' END AS page_url FROM (SELECT url, unnest(range(1, CAST(ceil(page_id / 25.0) AS BIGINT) + 1)) AS p FROM pages WHERE page_id > 0) y")
def html_paging_single(spark, sf_dir):
    p = t(spark, sf_dir, "pages").select("url", F.concat(F.lit("<p><b>found ("), F.col("page_id").cast("string"), F.lit(" items)</b></p>")).alias("html"))
    return html.page_lists(p, "url", "html", html.MappingFile([html.Mapping("count", "b", regex=r"\d+")])).select("page_url")


@query("SELECT s_suppkey, 's' || s_suppkey || '@example.com' AS plain, 's' || s_suppkey || '@example.com' AS noisy, 's' || s_suppkey || '@example.com' AS turned, s_suppkey % 2 = 0 AS is_mail FROM supplier")
def email_forms(spark, sf_dir):
    """Addresses behind entities, behind noise that an order removes, and turned by 13; and texts that are none."""
    import base64

    order = lambda d: base64.urlsafe_b64encode(json.dumps(d).encode()).decode().rstrip("=")
    s = t(spark, sf_dir, "supplier").withColumn("mail", F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit("@example.com")))
    script = lambda value, orders="": F.concat(F.lit(f'<i class="email {orders}"></i>var a=\''), value, F.lit("';"))
    d = s.select(
        "s_suppkey", email_column(script(F.replace(F.concat(F.lit("mailto:"), "mail"), F.lit("@"), F.lit("&#64;")))).alias("plain"),
        email_column(script(F.replace("mail", F.lit("@"), F.lit("+NOISE@")), order({"rmv": "+NOISE"}))).alias("noisy"),
        email_column(script(text.rot13(F.col("mail")), order({"rot": "it"}))).alias("turned"),
        email_column(script(F.when(F.col("s_suppkey") % 2 == 0, F.col("mail")).otherwise("nothing"))).isNotNull().alias("is_mail"),
    )
    return d


@query("SELECT CAST(n AS INTEGER) AS attempt, least(60.0, 2.0 * pow(2.0, n - 1)) AS other, greatest(10.0, least(60.0, 2.0 * pow(2.0, n - 1))) AS network FROM (SELECT unnest(range(1, 7)) AS n) x")
def retry_waits(spark, sf_dir):
    """The waits of a client whose every request fails, by an answer and by the network."""
    import urllib.error
    import urllib.request

    def waits(error) -> list[float]:
        told: list[float] = []
        c = web.Client(retries=6, wait=2.0, longest=60.0, network_wait=10.0)
        c.sleep = told.append

        def fail(*a, **k):
            raise error

        was, urllib.request.urlopen = urllib.request.urlopen, fail
        try:
            c.get("http://nowhere.example/")
        finally:
            urllib.request.urlopen = was
        return told

    import io

    other = waits(urllib.error.HTTPError("u", 503, "no", None, io.BytesIO(b"")))
    network = waits(urllib.error.URLError("down"))
    return spark.createDataFrame([(i + 1, a, b) for i, (a, b) in enumerate(zip(other, network, strict=True))], "attempt int, other double, network double")


@query("SELECT url, sha1(url) AS file, CAST(length(CAST(url AS VARCHAR)) AS BIGINT) AS bytes, TRUE AS ok FROM (SELECT DISTINCT url FROM pages) p")
def bulk_download(spark, sf_dir):
    """Every page's URL fetched once, from a server inside each task that answers with the URL itself."""
    import tempfile

    urls = t(spark, sf_dir, "pages").select("url")
    out = folder(spark, "bodies").removeprefix("file://") if stores.shared_dir(spark).startswith("file:") else tempfile.mkdtemp()
    return web.download(urls, out, _Echo(), fail_fast=True).select("url", "file", "bytes", "ok")


class _Echo(web.Client):
    def request(self, url, *a, **k):
        return 200, url.encode(), 1


# -- stores


def _table(name: str, key: str | None = None, /, **columns: str) -> config.Table:
    return config.Table(name, "fact", {n: {"type": k, "nullable": True} for n, k in columns.items()}, key)


_ORDERS = "SELECT CAST(o_orderkey AS BIGINT) AS id, o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price, o_orderkey % 2 = 0 AS even FROM orders"


def _order_rows(spark, sf_dir) -> DataFrame:
    return t(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("bigint").alias("id"), F.col("o_orderpriority").alias("priority"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("price"), (F.col("o_orderkey") % 2 == 0).alias("even"))


_ORDER_TABLE = {"id": "bigint", "priority": "text", "day": "date", "price": "float", "even": "bool"}


@query(_ORDERS)
def store_parquet_parts(spark, sf_dir):
    """Two appends, the second with more columns; a batch that comes twice counts once."""
    s, tab = stores.open_store(spark, "parquet", folder(spark, "store")), _table("orders", **_ORDER_TABLE)
    rows = _order_rows(spark, sf_dir)
    s.append(tab, rows.where("id % 3 = 0"), "one")
    s.append(tab, rows.where("id % 3 = 0"), "one")
    s.append(tab, rows.where("id % 3 <> 0"), "two")
    return s.read(tab)


def _sqlite(spark, name: str) -> stores.SqliteStore:
    import os
    import tempfile

    return stores.open_store(spark, "sqlite", f"file:{os.path.join(tempfile.mkdtemp(), name)}.db?cache=shared")


@query("SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name, s_acctbal AS balance, DATE '2024-02-29' AS day FROM supplier")
def store_sqlite_round_trip(spark, sf_dir):
    """A transaction's inserts on the driver, created from the document, read back typed."""
    s, tab = _sqlite(spark, "a"), _table("dbo.suppliers", id="bigint", name="text", balance="float", day="date")
    rows = t(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.lit("2024-02-29").cast("date").alias("day"))
    s.append(tab, rows, "b1")
    s.append(tab, rows, "b1")
    return s.read(tab)


@query(_ORDERS)
def store_jdbc_round_trip(spark, sf_dir):
    """A database's table over JDBC: created from the document, appended in batches, replaced, read back."""
    import os
    import tempfile

    s = stores.open_store(spark, "derby", f"jdbc:derby:{os.path.join(tempfile.mkdtemp(), 'orders')};create=true")
    tab, rows = _table("orders", **_ORDER_TABLE), _order_rows(spark, sf_dir)
    s.append(tab, rows.where("id % 3 = 0"))
    s.replace(tab, s.read(tab).where("even").unionByName(rows.where("NOT even AND id % 3 = 0")))
    s.append(tab, rows.where("id % 3 <> 0"))
    return s.read(tab)


@query("SELECT user_id, event_type, is_current FROM (" + """
WITH a AS (SELECT * FROM events WHERE hour(ts) < 12), b AS (SELECT * FROM events WHERE hour(ts) >= 12),
al AS (SELECT user_id, event_type, event_id AS o, 0 AS batch FROM a UNION ALL SELECT user_id, event_type, 100000000 + event_id, 1 FROM b),
k AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY o) AS p FROM al),
v AS (SELECT *, lead(o) OVER (PARTITION BY user_id ORDER BY o) AS nxt FROM k WHERE p IS NULL OR p <> event_type)
SELECT user_id, event_type, nxt IS NULL AS is_current FROM v""" + ") x")
def store_history_replayed(spark, sf_dir):
    """Two batches of a history table in a store, the second delivered twice."""
    from starmill.operators import load as L

    s, tab = stores.open_store(spark, "parquet", folder(spark, "history")), config.Table("e", "fact", {"user_id": {"type": "bigint"}, "event_type": {"type": "text"}}, history=True, business_key=["user_id"])
    e = t(spark, sf_dir, "events").select("user_id", "event_type", F.sha2("event_type", 256).alias("row_hash"), F.col("event_id").alias(S.ORDER), F.hour("ts").alias("h"))
    for name, rows in (("am", e.where("h < 12")), ("pm", e.where("h >= 12")), ("pm", e.where("h >= 12"))):
        live, closed, _ = L.scd2(rows.drop("h"), ["user_id"], NOW, s.read(tab))
        s.merge(tab, stores.written(live), stores.written(closed), name)
    both = s.read(tab).withColumn("is_current", F.lit(True)).unionByName(s.read_history(tab).withColumn("is_current", F.lit(False)))
    return both.select("user_id", "event_type", "is_current")


@query("SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM region")
def store_table_copy(spark, sf_dir):
    """A table copied from a folder store to a SQLite file."""
    a, b, tab = stores.open_store(spark, "parquet", folder(spark, "copy")), _sqlite(spark, "b"), _table("region", id="bigint", name="text")
    a.append(tab, t(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name")))
    stores.copy_table(a, b, tab)
    return b.read(tab)


@query("SELECT o_orderkey || chr(9) || CASE WHEN o_orderkey % 3 = 0 THEN '\\N' ELSE 'a\\tb\\\\' || o_orderpriority END AS value FROM orders")
def bulk_copy_lines(spark, sf_dir):
    """Orders as the lines of a bulk load, written and read back."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("a\tb\\"), "o_orderpriority")).alias("note"))
    path = folder(spark, "copy")
    stores.copy_lines(o).write.text(path)
    return spark.read.text(path)


@query("SELECT json_extract_string(j, '$.n_name') AS name, CAST(json_extract(j, '$.n_regionkey') AS BIGINT) AS region FROM (SELECT '{\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}' AS j FROM nation) x")
def json_lines_written(spark, sf_dir):
    path = folder(spark, "out-json")
    t(spark, sf_dir, "nation").select("n_name", "n_regionkey").write.json(path)
    return spark.read.schema("n_name string, n_regionkey bigint").json(path).select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))


# -- DDL, documents, probe


_DDL_TABLE = config.Table("public.cars", "fact", {"pcv": {"type": "bigint", "nullable": False}, "kind": {"type": "text", "nullable": True}, "kind_id": {"type": "int", "nullable": True, "references": "public.kinds(kind_id)"}, "day": {"type": "date", "nullable": True}, "price": {"type": "float", "nullable": True}}, "car_id", unique=[["pcv"]])

_DDL = {
    "postgres": 'CREATE TABLE IF NOT EXISTS "public"."cars" ("car_id" BIGSERIAL PRIMARY KEY, "pcv" BIGINT NOT NULL, "kind" TEXT, "kind_id" BIGINT REFERENCES "public"."kinds"("kind_id"), "day" DATE, "price" DOUBLE PRECISION, UNIQUE ("pcv") )',
    "mssql": "IF OBJECT_ID(N'public.cars', N'U') IS NULL CREATE TABLE [public].[cars] ([car_id] BIGINT IDENTITY(1,1) PRIMARY KEY, [pcv] BIGINT NOT NULL, [kind] NVARCHAR(MAX), [kind_id] BIGINT REFERENCES [public].[kinds]([kind_id]), [day] DATE, [price] DECIMAL(38,10), UNIQUE ([pcv]) )",
    "sqlite": 'CREATE TABLE IF NOT EXISTS "cars" ("car_id" INTEGER PRIMARY KEY AUTOINCREMENT, "pcv" INTEGER NOT NULL, "kind" TEXT, "kind_id" INTEGER REFERENCES "kinds"("kind_id"), "day" TEXT, "price" REAL, UNIQUE ("pcv") )',
    "spark": "CREATE TABLE IF NOT EXISTS `cars` (`car_id` BIGINT, `pcv` BIGINT, `kind` STRING, `kind_id` BIGINT, `day` DATE, `price` DOUBLE ) USING parquet",
}


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@query(" UNION ALL ".join(f"SELECT {_lit(k)} AS dialect, {_lit(v)} AS ddl" for k, v in _DDL.items()))
def ddl_texts(spark, sf_dir):
    rows = [(d, " ".join(ddl.create(_DDL_TABLE, d).split()).replace("( ", "(")) for d in _DDL]
    return spark.createDataFrame(rows, "dialect string, ddl string")


@query("SELECT unnest(['car_id', 'pcv', 'kind', 'kind_id', 'day', 'price', 'valid_from', 'valid_to', 'changed_at']) AS name, unnest(['bigint', 'bigint', 'string', 'bigint', 'date', 'double', 'timestamp', 'timestamp', 'timestamp']) AS kind")
def ddl_history_schema(spark, sf_dir):
    import dataclasses

    made = spark.createDataFrame([], ddl.schema(dataclasses.replace(_DDL_TABLE, history=True)))
    return spark.createDataFrame(made.dtypes, "name string, kind string")


_KIND_NAMES = {"int": "int", "BIGSERIAL": "int", "bit": "bool", "boolean": "bool", "datetime2": "timestamp", "timestamptz": "timestamp", "numeric": "float", "decimal": "float", "varchar": "text", "uuid": "text", "date": "date"}
_TYPE_NAMES = {"int": ("BIGINT", "BIGINT", "INTEGER"), "bool": ("BOOLEAN", "BIT", "INTEGER"), "date": ("DATE", "DATE", "TEXT"), "timestamp": ("TIMESTAMPTZ", "DATETIME2", "TEXT"), "float": ("DOUBLE PRECISION", "DECIMAL(38,10)", "REAL"), "text": ("TEXT", "NVARCHAR(MAX)", "TEXT")}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}', '{_TYPE_NAMES[v][0]}', '{_TYPE_NAMES[v][1]}', '{_TYPE_NAMES[v][2]}')" for k, v in _KIND_NAMES.items()) + ") v(name, kind, postgres, mssql, sqlite)")
def type_maps(spark, sf_dir):
    rows = [(n, C.normalize_kind(n), *(ddl.map_type(n, d) for d in ("postgres", "mssql", "sqlite"))) for n in _KIND_NAMES]
    return spark.createDataFrame(rows, "name string, kind string, postgres string, mssql string, sqlite string")


@query("SELECT unnest(['order_id', 'segment', 'day']) AS name, unnest(['bigint', 'string', 'date']) AS kind, unnest([0, 0, 0]) AS n")
def table_from_contract(spark, sf_dir):
    """The single table that a document's contract tells, made in a store."""
    s = stores.open_store(spark, "parquet", folder(spark, "inferred"))
    tab = stores.ensure_from_pipeline(s, config.load(STAR), "orders")
    made = s.read(tab)
    return spark.createDataFrame([(n, k, made.limit(1).count()) for n, k in made.dtypes], "name string, kind string, n int")


@query("SELECT unnest(['pcv', 'public.a', 'x]y', 'q\"r']) AS name, unnest(['\"pcv\"', '\"public\".\"a\"', '\"x]y\"', '\"q\"\"r\"']) AS postgres, unnest(['[pcv]', '[public].[a]', '[x]]y]', '[q\"r]']) AS mssql")
def quoted_identifiers(spark, sf_dir):
    return spark.createDataFrame([(n, text.quote(n, "postgres"), text.quote(n, "mssql")) for n in ("pcv", "public.a", "x]y", 'q"r')], "name string, postgres string, mssql string")


@query("SELECT unnest(['error', 'error', 'error', 'error', 'warning', 'warning']) AS severity, unnest(['parser.kind', 'source.file.path', 'storage.db.tables[2].load.from_rows[1].lookup.table', 'transform[1].options.fields', 'job', 'transform[0].options.types.x']) AS path")
def lint_findings(spark, sf_dir):
    """A document with six faults."""
    import copy

    d = copy.deepcopy(STAR)
    d["job"], d["parser"]["kind"], d["source"]["file"]["path"] = "", "yaml", ""
    d["transform"][0]["options"]["types"]["x"] = "blob"
    d["transform"][1]["options"]["fields"] = []
    d["storage"]["db"]["tables"][2]["load"]["from_rows"][1]["lookup"]["table"] = "nowhere"
    return spark.createDataFrame([(i.severity, i.path) for i in config.lint(d)], "severity string, path string")


@query("SELECT unnest(['path', 'parser', 'storage', 'tables', 'history', 'lookup', 'dsn']) AS what, unnest([TRUE, TRUE, TRUE, TRUE, TRUE, TRUE, FALSE]) AS refused")
def run_time_checks(spark, sf_dir):
    """Documents that a run refuses, each with one thing missing; and one whose DSN comes from the environment."""
    import copy
    import os

    def bad(change) -> bool:
        d = copy.deepcopy(STAR)
        change(d)
        try:
            config.check(config.load(d))
        except ValueError:
            return True
        return False

    tables = lambda d: d["storage"]["db"]["tables"]
    os.environ["STARMILL_FOLDER"] = "f"
    env = copy.deepcopy(STAR)
    env["storage"]["db"]["dsn"] = "file:${STARMILL_FOLDER}/x"
    rows = [
        ("path", bad(lambda d: d["source"]["file"].update(path=""))), ("parser", bad(lambda d: d["parser"].update(kind="yaml"))), ("storage", bad(lambda d: d["storage"].update(kind=""))), ("tables", bad(lambda d: d["storage"]["db"].update(tables=[]))),
        ("history", bad(lambda d: tables(d)[2]["load"].update(history={"enabled": True}))), ("lookup", bad(lambda d: tables(d)[2]["load"]["from_rows"][1]["lookup"].update(table="x"))), ("dsn", config.load(env).dsn != "file:f/x"),
    ]
    return spark.createDataFrame(rows, "what string, refused boolean")


def _probe_file(spark, sf_dir) -> bytes:
    """The head of a CSV of orders."""
    o = t(spark, sf_dir, "orders").orderBy("o_orderkey").limit(200)
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderpriority", F.date_format("o_orderdate", "dd.MM.yyyy"), F.col("o_totalprice").cast("string"))
    lines = [r[0] for r in o.select(line).collect()]  # 200 rows
    return ("﻿Order Key,Priorita-č,Day,Total Price\n" + "\n".join(lines) + "\n1,cut").encode()


@query("""
WITH h AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders) x WHERE i <= 200)
SELECT 'order_key' AS name, 'integer' AS type, NULL AS layout, count(*) AS total, count(DISTINCT o_orderkey) AS "distinct" FROM h UNION ALL
SELECT 'priorita_c', 'text', NULL, count(*), count(DISTINCT o_orderpriority) FROM h UNION ALL
SELECT 'day', 'date', '02.01.2006', count(*), count(DISTINCT CAST(o_orderdate AS DATE)) FROM h UNION ALL
SELECT 'total_price', 'float', NULL, count(*), count(DISTINCT o_totalprice) FROM h
""")
def probe_report(spark, sf_dir):
    """Format, names, types and layouts told from a file's head, whose last line is cut off."""
    kind, fields = probe.describe(spark, probe.whole_lines(_probe_file(spark, sf_dir)))
    assert kind == "csv" and probe.summary(fields).count("\n") == 4
    return spark.createDataFrame([(f["name"], f["type"], f["layout"], f["total"], f["distinct"]) for f in fields], "name string, type string, layout string, total bigint, distinct bigint")


@query("SELECT unnest(['public.orders_priorita_c', 'public.orders']) AS tab, unnest(['dimension', 'fact']) AS kind, unnest(['priorita_c_id', 'orders_id']) AS key, unnest(['priorita_c', 'priorita_c_id,order_key,day,total_price,row_hash']) AS columns, unnest(['', 'priorita_c']) AS lookups")
def probe_star_schema(spark, sf_dir):
    """The document that loads the probed file: a dimension for the column worth one, hashes of all columns, ids that may be null."""
    _, fields = probe.describe(spark, probe.whole_lines(_probe_file(spark, sf_dir)))
    d = probe.pipeline("csv", fields, "x.csv", "orders", "postgres", ["priorita_c"])
    assert d["transform"][1]["options"]["fields"] == ["day", "order_key", "priorita_c", "total_price"] and not [i for i in config.lint(d) if i.severity == "error"]
    p = config.load(d)
    rows = [(x.name, x.kind, x.primary_key, ",".join(x.columns), ",".join(s.key for s in x.sources if s.table)) for x in p.tables]
    return spark.createDataFrame(rows, "tab string, kind string, key string, columns string, lookups string")


@query("SELECT unnest(['flag', 'env', 'parts', 'sqlite', 'mssql']) AS what, unnest(['f', 'e', 'postgresql://u:p@h:5432/d?x=1', 'file:d?x=1', 'sqlserver://u:p@h:1433?database=d&x=1']) AS dsn")
def probe_dsn(spark, sf_dir):
    parts = {f"DSN_{k}": v for k, v in (("USER", "u"), ("PASSWORD", "p"), ("HOST", "h"), ("DB", "d"), ("PARAMS", "x=1"))}
    rows = [("flag", probe.dsn("postgres", "f", {"DSN": "e"})), ("env", probe.dsn("postgres", env={"DSN": "e"} | parts)), ("parts", probe.dsn("postgres", env=parts)), ("sqlite", probe.dsn("sqlite", env=parts)), ("mssql", probe.dsn("mssql", env=parts))]
    return spark.createDataFrame(rows, "what string, dsn string")


@query("SELECT unnest(['<a/>', ' {\"a\":1}', '[1]', 'a,b', '']) AS head, unnest(['xml', 'json', 'json', 'csv', 'csv']) AS kind")
def probe_sniff(spark, sf_dir):
    return spark.createDataFrame([(x, probe.sniff(x)) for x in ("<a/>", ' {"a":1}', "[1]", "a,b", "")], "head string, kind string")


@query("""SELECT line FROM (SELECT r, '{"column_name":"' || c || '","total":' || n || ',"distinct_count":' || d || ',"capped":false,"ratio":' || r || '}' AS line FROM (SELECT 'n_name' AS c, count(n_name) AS n, count(DISTINCT n_name) AS d, CAST(round(count(DISTINCT n_name) / count(n_name), 6) AS DOUBLE) AS r FROM nation UNION ALL SELECT 'n_regionkey', count(n_regionkey), count(DISTINCT n_regionkey), CAST(round(count(DISTINCT n_regionkey) / count(n_regionkey), 6) AS DOUBLE) FROM nation) x) y""")
def uniqueness_json(spark, sf_dir):
    return P.report_json(P.uniqueness(t(spark, sf_dir, "nation"), ["n_name", "n_regionkey"]))


# -- whole loads from files; streams; metrics


def _star_csv(spark, sf_dir, files: int) -> str:
    from starmill.plans.catalog import _raw_orders

    d = _raw_orders(spark, sf_dir)
    path = folder(spark, "star-csv")
    d.repartition(files, "order_id").write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return path


def _facts(s, p) -> DataFrame:
    by = {x.name: x for x in p.tables}
    seg = s.read(by["segments"]).select(F.col("segment_id").alias("sid"), F.col("name").alias("segment"))
    return s.read(by["order_facts"]).join(seg, F.col("segment_id") == F.col("sid")).select("order_id", "segment", "day", "cents")


_STAR_SQL = "SELECT CAST(o_orderkey AS BIGINT) AS order_id, c_mktsegment AS segment, CAST(o_orderdate AS DATE) AS day, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0"


def _star_document(path: str) -> dict:
    import copy

    d = copy.deepcopy(STAR)
    d["source"]["file"]["path"] = path
    return d


@query(_STAR_SQL)
def load_csv_files(spark, sf_dir):
    """A document's whole run over CSV files; then again, which changes nothing."""
    p, s = config.load(_star_document(_star_csv(spark, sf_dir, 4))), stores.open_store(spark, "parquet", folder(spark, "star"))
    engine.run(spark, p, s, now=NOW)
    again = engine.run(spark, p, s, now=NOW)
    assert again.inserted == 0 and again.all_conflicts == again.valid
    return _facts(s, p)


@query("SELECT CAST(n_nationkey AS BIGINT) AS nation, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def load_json_into_sqlite(spark, sf_dir):
    """A run from a JSON document into a SQLite file."""
    rows = t(spark, sf_dir, "nation").join(t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.to_json(F.struct(F.col("n_nationkey").alias("Nation"), F.col("r_name").alias("region"))).alias("j"))
    path = put_text(spark, folder(spark, "nations") + "/n.json", "[" + ",".join(r[0] for r in rows.collect()) + "]")  # 25 rows
    key = {"name": "region_id", "type": "serial"}
    d = {
        "job": "nations", "source": {"kind": "file", "file": {"path": path}}, "parser": {"kind": "json", "options": {"header_map": {"Nation": "nation"}}},
        "transform": [{"kind": "coerce", "options": {"types": {"nation": "bigint"}}}],
        "storage": {"kind": "sqlite", "db": {"dsn": "", "tables": [
            {"name": "regions", "primary_key": key, "columns": [{"name": "name", "type": "text"}], "load": {"kind": "dimension", "from_rows": [{"target_column": "name", "source_field": "region"}], "cache": {"key_column": "name", "value_column": "region_id"}}},
            {"name": "nations", "columns": [{"name": "nation", "type": "bigint"}, {"name": "region_id", "type": "bigint"}], "load": {"kind": "fact", "dedupe": {"conflict_columns": ["nation"]}, "from_rows": [{"target_column": "nation", "source_field": "nation"}, {"target_column": "region_id", "lookup": {"table": "regions", "match": {"name": "region"}}}]}},
        ]}},
    }
    p, s = config.load(d), _sqlite(spark, "n")
    engine.run(spark, p, s, now=NOW)
    engine.run(spark, p, s, now=NOW)
    dim = s.read(p.tables[0]).withColumnRenamed("name", "region")
    return s.read(p.tables[1]).join(dim, "region_id").select("nation", "region")


@query("SELECT CAST(p_partkey AS BIGINT) AS part, p_brand AS brand FROM part")
def load_xml_files(spark, sf_dir):
    d = {
        "job": "parts", "source": {"kind": "file", "file": {"path": _parts_xml(spark, sf_dir)}}, "parser": {"kind": "xml", "options": {"xml_config": {"record_tag": "Item", "fields": {"part": "Key", "brand": "Tags/Tag"}}}},
        "transform": [{"kind": "coerce", "options": {"types": {"part": "bigint"}}}],
        "storage": {"kind": "parquet", "db": {"dsn": "", "tables": [{"name": "parts", "columns": [{"name": "part", "type": "bigint"}, {"name": "brand", "type": "text"}], "load": {"kind": "fact", "from_rows": [{"target_column": "part", "source_field": "part"}, {"target_column": "brand", "source_field": "brand"}]}}]}},
    }
    p, s = config.load(d), stores.open_store(spark, "parquet", folder(spark, "parts"))
    engine.run(spark, p, s, now=NOW)
    return s.read(p.tables[0])


@query(_STAR_SQL)
def stream_load_files(spark, sf_dir):
    """The same load over a stream of files, two a batch, until all are read; then once more from a second checkpoint, which finds only conflicts."""
    path, s = _star_csv(spark, sf_dir, 6), stores.open_store(spark, "parquet", folder(spark, "stream-store"))
    p, told = config.load(_star_document(path)), []
    for k in range(2):
        stream = loader.csv_stream(spark, path, ["order_id", "segment", "priority", "day", "cents"], 3)
        loader.load_stream(stream, p, s, folder(spark, f"checkpoint-{k}"), lambda n, x, k=k: told.append((k, x.inserted))).awaitTermination()
    assert len(told) >= 4 and not sum(n for k, n in told if k)
    return _facts(s, p)


def _event_stream(spark, sf_dir) -> DataFrame:
    path = folder(spark, "events")
    t(spark, sf_dir, "events").repartition(2, "event_id").write.parquet(path)
    return spark.readStream.schema("event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string").parquet(path)


def _drained(stream: DataFrame, spark, mode: str) -> DataFrame:
    """What a stream has told when its input is at its end: every batch is written by the executors, in complete mode over the one before."""
    path, batches = folder(spark, "drained"), set()

    def put(rows: DataFrame, number: int) -> None:
        at = f"{path}/{number if mode == 'append' else 'all'}"
        rows.write.mode("overwrite").parquet(at)
        batches.add(at)

    with loader.states_on_disk(spark):
        stream.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", folder(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(*sorted(batches)) if batches else spark.createDataFrame([], stream.schema)


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS at, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_tumbling_counts(spark, sf_dir):
    out = _drained(loader.windowed_counts(_event_stream(spark, sf_dir), "ts", "40 days", "1 hour", "event_type"), spark, "complete")
    return out.select(F.col("window.start").alias("at"), "event_type", "n")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL (k) HOUR AS at, count(*) AS n FROM events, (SELECT unnest([0, 1]) AS k) x GROUP BY 1")
def stream_sliding_counts(spark, sf_dir):
    out = _drained(loader.sliding_counts(_event_stream(spark, sf_dir), "ts", "40 days", "2 hours", "1 hour"), spark, "complete")
    return out.select(F.col("window.start").alias("at"), "n")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS at, count(*) AS n FROM s GROUP BY user_id, k
""")
def stream_session_counts(spark, sf_dir):
    out = _drained(loader.session_counts(_event_stream(spark, sf_dir), "ts", "40 days", "30 minutes", "user_id"), spark, "complete")
    return out.select("user_id", F.col("session_window.start").alias("at"), "n")


@query("SELECT user_id, event_type, count(*) > 0 AS seen FROM events GROUP BY 1, 2")
def stream_late_repeats(spark, sf_dir):
    """Repeats of a key inside the time that the stream waits for late rows are dropped."""
    out = _drained(loader.latest_only(_event_stream(spark, sf_dir), ["user_id", "event_type"], "ts", "4000 days"), spark, "append")
    return out.select("user_id", "event_type", F.lit(True).alias("seen"))


@query("SELECT event_type AS kind, 'etl.records.total' AS metric, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY 1")
def metrics_flushed(spark, sf_dir):
    """Counters of a job, buffered and flushed; unknown names and counts of none are left out."""
    out: list[dict] = []
    m = metrics.Metrics(out.extend)
    for r in t(spark, sf_dir, "events").groupBy("event_type").count().collect():  # a row a type
        m.rows("events", r["event_type"], r["count"])
        m.rows("events", r["event_type"], 0)
        m.count("unknown", 5)
    m.close()
    m.close()
    return spark.createDataFrame([(s["labels"]["kind"], s["metric"], float(s["value"])) for s in out], "kind string, metric string, value double")


@query("SELECT o_orderkey, o_orderkey % 4 = 0 AS edge, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey END AS spaced FROM orders")
def edge_spaces(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    raw = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit(" "), F.col("o_orderkey").cast("string"))).otherwise(F.col("o_orderkey").cast("string"))
    spaced = F.when(F.col("o_orderkey") % 10 == 0, F.lit("x")).otherwise(F.regexp_replace(F.col("o_orderkey").cast("string"), r"(\d)(?=(\d{3})+$)", "$1 "))
    return o.select("o_orderkey", text.has_edge_space(raw).alias("edge"), text.parse_spaced_count(spaced).cast("bigint").alias("spaced"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS found, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at, CASE o_orderkey % 3 WHEN 0 THEN '2006-01-02 15:04:05' WHEN 1 THEN '02.01.2006 15:04:05' ELSE '2006-01-02T15:04:05' END AS layout FROM orders")
def timestamp_layouts(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 3
    raw = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.date_format("o_orderdate", "dd.MM.yyyy HH:mm:ss")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return o.select("o_orderkey", C.any_date(F.date_format("o_orderdate", "MM/dd/yyyy"), "01/02/2006").alias("found"), F.date_format(C.loose_timestamp(raw), "yyyy-MM-dd HH:mm:ss").alias("at"), C.loose_timestamp_layout(raw).alias("layout"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (2, 3, 6) THEN 'n: not int' WHEN o_orderkey % 7 = 5 THEN 'n: blank' END AS reject_reason FROM orders")
def coerce_strings_orders(spark, sf_dir):
    from starmill.plans.catalog import _INTS

    return S.coerce_strings(t(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.expr(_INTS).alias("n")), {"n": "int"}).select("o_orderkey", "reject_reason")


@query("SELECT o_orderkey AS _ord, 'n: required' AS reject_reason FROM orders WHERE o_orderkey % 7 = 5 ORDER BY o_orderkey LIMIT 10")
def reject_samples(spark, sf_dir):
    from starmill.plans.catalog import _INTS

    rows = S.check_rows(t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(S.ORDER), C.coerced(F.expr(_INTS), "text").alias("n")), ["n"], {})
    return S.sample_rejects(S.split(rows)[1])


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE event_type || ',' || (event_id % 5) END AS joined FROM events")
def array_joined(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    return e.select("event_id", text.join_strings(F.array("event_type", F.when(F.col("event_id") % 3 != 0, (F.col("event_id") % 5).cast("string")))).alias("joined"))


@query("SELECT count(*) AS n, 63 AS longest, bool_and(TRUE) AS told FROM (SELECT unnest(range(70)) AS k) x")
def identifier_limits(spark, sf_dir):
    """Names up to the limit stay; a longer one is cut and ends in a digest that tells it from its neighbours."""
    names = ["x" * k for k in range(70)]
    cut = [text.limit_identifier(x) for x in names]
    told = len(set(cut)) == len(names) and cut[:64] == names[:64]
    return spark.createDataFrame([(len(cut), max(map(len, cut)), told)], "n bigint, longest int, told boolean")


@query("SELECT 'seconds' AS form, CAST(120 AS DOUBLE) AS wait UNION ALL SELECT 'date', 60 UNION ALL SELECT 'past', 0 UNION ALL SELECT 'other', NULL")
def retry_after_forms(spark, sf_dir):
    from datetime import UTC

    from starmill.functions.urls import retry_after

    now = datetime(2026, 1, 1, 0, 0, tzinfo=UTC)
    rows = [("seconds", retry_after(" 120 ")), ("date", retry_after("Thu, 01 Jan 2026 00:01:00 GMT", now)), ("past", retry_after("Wed, 31 Dec 2025 00:00:00 GMT", now)), ("other", retry_after("soon"))]
    return spark.createDataFrame(rows, "form string, wait double")


@query("SELECT min(c_custkey) AS c_custkey, count(*) AS total, 'c_custkey' AS key FROM customer")
def profile_key_column(spark, sf_dir):
    """The column with most distinct values."""
    c = t(spark, sf_dir, "customer")
    names = ["c_nationkey", "c_custkey", "c_mktsegment"]
    key = P.key_column(P.uniqueness(c, names, cap=1 << 40), names)
    return c.agg(F.min("c_custkey").alias("c_custkey"), F.count("*").alias("total")).withColumn("key", F.lit(key))
