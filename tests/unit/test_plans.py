import copy
import json

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from starmill import cli, metrics
from starmill.plans import catalog, config, ddl, engine, probe, stores
from starmill.streaming import loader

SF = "/root/testdata/sf0.001"


def vehicles(path, store="parquet"):
    dim = lambda name, key, id_, field: {"name": name, "primary_key": {"name": id_, "type": "serial"}, "columns": [{"name": key, "type": "bigint" if key == "pcv" else "text", "nullable": False}], "constraints": [{"kind": "unique", "columns": [key]}], "load": {"kind": "dimension", "from_rows": [{"target_column": key, "source_field": field}], "cache": {"key_column": key, "value_column": id_}}}
    fact = {
        "name": "imports",
        "primary_key": {"name": "import_id", "type": "serial"},
        "columns": [{"name": "vehicle_id", "type": "int", "nullable": False}, {"name": "country_id", "type": "int", "nullable": False}, {"name": "import_date", "type": "date", "nullable": True}, {"name": "row_hash", "type": "text", "nullable": False}],
        "constraints": [{"kind": "unique", "columns": ["vehicle_id", "country_id"]}],
        "load": {"kind": "fact", "history": {"enabled": True, "business_key": ["vehicle_id", "country_id"]}, "from_rows": [{"target_column": "vehicle_id", "lookup": {"table": "vehicles", "match": {"pcv": "pcv"}}}, {"target_column": "country_id", "lookup": {"table": "countries", "match": {"name": "stat"}}}, {"target_column": "import_date", "source_field": "datum"}, {"target_column": "row_hash", "source_field": "row_hash"}]},
    }
    return {
        "job": "imports",
        "source": {"kind": "file", "file": {"path": path}},
        "parser": {"kind": "csv", "options": {"header_map": {"PČV": "pcv", "Stát": "stat", "Datum": "datum"}}},
        "transform": [{"kind": "coerce", "options": {"types": {"pcv": "bigint", "datum": "date"}}}, {"kind": "hash", "options": {"fields": ["pcv", "stat", "datum"], "target_field": "row_hash", "include_field_names": True}}, {"kind": "validate", "options": {"contract": {"fields": [{"name": "pcv", "type": "bigint", "required": True}, {"name": "stat", "type": "text", "required": True}]}}}],
        "storage": {"kind": store, "db": {"dsn": "", "tables": [dim("vehicles", "pcv", "vehicle_id", "pcv"), dim("countries", "name", "country_id", "stat"), fact]}},
    }


@pytest.mark.parametrize("kind", ["parquet", "sqlite"])
def test_load_twice_with_history(spark, tmp_path, kind):
    (tmp_path / "a.csv").write_text("PČV,Stát,Datum\n1,CZ,13.08.2018\n2, SK ,\nx,CZ,\n3,,\n1,CZ,13.08.2018\n")
    (tmp_path / "b.csv").write_text("PČV,Stát,Datum\n1,CZ,14.08.2018\n4,CZ,31.02.2018\n")
    store = stores.open_store(spark, kind, f"file://{tmp_path}/store" if kind == "parquet" else f"file:{tmp_path}/s.db?x=1")
    first = engine.run(spark, config.load(vehicles(f"file://{tmp_path}/a.csv", kind)), store)
    assert (first.processed, first.transform_rejected, first.validate_dropped, first.inserted) == (5, 1, 1, 2)
    again = engine.run(spark, config.load(vehicles(f"file://{tmp_path}/a.csv", kind)), store)
    assert again.inserted == 0
    p = config.load(vehicles(f"file://{tmp_path}/b.csv", kind))
    second = engine.run(spark, p, store)
    assert second.inserted == 2
    by = {t.name: t for t in p.tables}
    live = store.read(by["imports"]).select("import_id", "vehicle_id", F.col("import_date").cast("string").alias("d"))
    assert sorted((r["vehicle_id"], str(r["d"])) for r in live.collect()) == [(1, "2018-08-14"), (2, "None"), (3, "2018-03-03")]
    assert len({r["import_id"] for r in live.collect()}) == 3
    assert store.read_history(by["imports"]).where("valid_to IS NOT NULL").count() == 1
    assert store.read(by["countries"]).count() == 2


def test_strict_and_lenient(spark, tmp_path):
    d = copy.deepcopy(catalog.STAR)
    p = config.load(d)
    raw = spark.createDataFrame([("1", "A", "p", "13.08.2018", "5"), ("2", "A", " ", None, None)], "order_id string, segment string, priority string, day string, cents string")
    stats = engine.run(spark, p, stores.ParquetStore(spark, f"file://{tmp_path}/l"), raw)
    assert (stats.inserted, stats.fact_dropped) == (1, 1)
    d["transform"][2]["options"]["policy"] = "strict"
    with pytest.raises(Exception, match="lookup miss"):
        engine.run(spark, config.load(d), stores.ParquetStore(spark, f"file://{tmp_path}/s"), raw)


def test_config_checks():
    d = vehicles("x")
    config.check(config.load(d))
    assert config.load(d).input_columns() == ["datum", "pcv", "stat"]
    for path, value in ((("source", "file", "path"), ""), (("parser", "kind"), "yaml"), (("storage", "db", "tables"), [])):
        bad = copy.deepcopy(d)
        at = bad
        for k in path[:-1]:
            at = at[k]
        at[path[-1]] = value
        with pytest.raises(ValueError):
            config.check(config.load(bad))
        assert any(i.severity == "error" for i in config.lint(bad))
    assert not [i for i in config.lint(d) if i.severity == "error"]
    with pytest.raises(ValueError):
        stores.open_store(None, "nowhere", "")


def test_ddl():
    t = config.load(vehicles("x")).tables[2]
    assert "BIGSERIAL PRIMARY KEY" in ddl.create(t, "postgres") and '"import_date" DATE,' in ddl.create(t, "postgres")
    assert "NVARCHAR(MAX)" in ddl.create(t, "mssql") and "IDENTITY" in ddl.create(t, "mssql")
    assert "AUTOINCREMENT" in ddl.create(t, "sqlite") and "AUTOINCREMENT" not in ddl.create(t, "sqlite", history=True)
    assert "valid_from" in ddl.create(t, "spark", history=True)
    assert ddl.schema(t).fieldNames() == ["import_id", "vehicle_id", "country_id", "import_date", "row_hash", "valid_from", "valid_to", "changed_at"]
    assert set(ddl.from_pipeline(config.load(vehicles("x")), "t").columns) == {"pcv", "stat"}


def test_probe_then_load(spark, tmp_path):
    path = tmp_path / "candy.csv"
    path.write_text("id,Shape,volume\n" + "".join(f"{i},{'abc'[i % 3]},{i * 10}\n" for i in range(30)))
    got = probe.probe(spark, str(path), backend="parquet")
    assert [t["name"] for t in got["storage"]["db"]["tables"]] == ["candy_shape", "candy"]
    assert not [i for i in config.lint(got) if i.severity == "error"]
    got["source"]["file"]["path"] = f"file://{path}"
    assert engine.run(spark, config.load(got), stores.ParquetStore(spark, f"file://{tmp_path}/s")).inserted == 30
    report = probe.probe(spark, str(path), report=True)
    assert report[0]["name"] == "shape" and {f["type"] for f in report} == {"integer", "text"}
    (tmp_path / "c.json").write_text('[{"a":1,"b":{"c":"x"}},{"a":2,"b":{"c":"y"}}')
    assert [f["name"] for f in probe.describe(spark, (tmp_path / "c.json").read_bytes())[1]] == ["a", "b_c"]
    assert probe.describe(spark, b"<R><X><A>1</A></X><X><A>2</A></X></R>")[0] == "xml"
    assert [probe.sniff(x) for x in ("<a/>", " {", "[1]", "a,b", "")] == ["xml", "json", "json", "csv", "csv"]
    assert probe.dsn("postgres", env={"DSN_USER": "u", "DSN_PASSWORD": "p", "DSN_HOST": "h", "DSN_DB": "d"}) == "postgresql://u:p@h:5432/d"
    assert probe.dsn("sqlite", "flag", {"DSN": "env"}) == "flag" and probe.dsn("sqlite", env={"DSN": "env"}) == "env"


def test_stream_of_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    head = "order_id,segment,priority,day,cents\n"
    (folder / "1.csv").write_text(head + "1,A,p,13.08.2018,5\n2,B,p,13.08.2018,6\n")
    (folder / "2.csv").write_text(head + "2,B,p,13.08.2018,6\n3,A,q,13.08.2018,7\n")
    store, told = stores.ParquetStore(spark, f"file://{tmp_path}/store"), []
    p = config.load(catalog.STAR)
    stream = loader.csv_stream(spark, f"file://{folder}", ["order_id", "segment", "priority", "day", "cents"])
    loader.load_stream(stream, p, store, f"file://{tmp_path}/ck", lambda n, s: told.append(s.inserted)).awaitTermination(120)
    assert sorted(told) == [1, 2] and store.read(p.tables[2]).count() == 3


def test_stream_windows(spark, tmp_path):
    spark.createDataFrame([("2026-01-01 00:00:01", "a"), ("2026-01-01 00:00:02", "a"), ("2026-01-01 00:10:00", "b")], "t string, k string").selectExpr("CAST(t AS TIMESTAMP) AS t", "k").write.parquet(f"file://{tmp_path}/e")
    src = spark.readStream.schema("t timestamp, k string").parquet(f"file://{tmp_path}/e")
    for name, df, mode in (("w", loader.windowed_counts(src, "t", "1 minute", "1 minute", "k"), "complete"), ("d", loader.latest_only(src, ["k"], "t", "1 minute"), "append")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert spark.sql(f"SELECT * FROM {name}").count() == 2


def test_metrics(tmp_path):
    got, now = [], [0.0]
    m = metrics.Metrics(got.extend, 60, lambda: now[0])
    m.rows("j", "inserted", 5)
    m.rows("j", "none", 0)
    m.count("unknown", 3)
    for s in (1.0, 2.0, 9.0):
        m.step("j", "ddl", s)
    m.http("GET", 200, 0.1)
    m.batches("j", 2)
    assert not got
    now[0] = 61
    m.rows("j", "inserted", 1)
    by = {s["metric"]: s["value"] for s in got if s["labels"].get("job") == "j"}
    assert by["etl.step.total"] == 3 and by["etl.step.duration_seconds.p50"] == 2 and by["etl.step.duration_seconds.max"] == 9 and by["etl.records.total"] == 6
    assert metrics.nearest_rank([3, 1, 2], 95) == 3
    sink = metrics.json_lines(str(tmp_path / "m"))
    sink([{"a": 1}])
    assert json.loads((tmp_path / "m").read_text()) == {"a": 1}


def test_cli(spark, tmp_path, capsys):
    (tmp_path / "a.csv").write_text("PČV,Stát,Datum\n1,CZ,13.08.2018\n")
    doc = vehicles(f"file://{tmp_path}/a.csv")
    doc["storage"]["db"]["dsn"] = f"file://{tmp_path}/store"
    (tmp_path / "p.json").write_text(json.dumps(doc))
    assert cli.main(["lint", str(tmp_path / "p.json")]) == 0
    assert cli.main(["load", str(tmp_path / "p.json"), "--metrics", str(tmp_path / "m")]) == 0
    assert "inserted=1" in capsys.readouterr().out
    (tmp_path / "h.json").write_text('[{"href":"u","count":"51"}]')
    assert cli.main(["expand", str(tmp_path / "h.json")]) == 0 and capsys.readouterr().out.split() == ["u", "u/2/"]
    (tmp_path / "x.html").write_text("<p>hi</p>")
    (tmp_path / "map.json").write_text('[{"name":"p","selector":"p"}]')
    assert cli.main(["extract", str(tmp_path / "x.html"), "--mappings", str(tmp_path / "map.json")]) == 0
    assert json.loads(capsys.readouterr().out) == {"p": "hi"}
    assert cli.main(["nothing"]) == 2 and cli.main(["load", "/nowhere.json"]) == 1


def _plain(v):
    import numbers

    import pandas as pd

    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if "bool" in type(v).__name__:
        return bool(v)
    if isinstance(v, numbers.Number):
        return round(float(v), 6)
    return str(pd.Timestamp(v)) if hasattr(v, "year") else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in "region nation customer supplier part orders lineitem events documents pages labels benchmark conversations embeddings".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name not in catalog.SQL:
        assert len(got)
        return
    want = duck.execute(catalog.SQL[name]).df()
    assert sorted(got) == sorted(want)
    plain = lambda d: sorted((tuple(map(_plain, r)) for r in d[sorted(d)].itertuples(index=False, name=None)), key=str)
    assert plain(got) == plain(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_a_crash_between_writes_leaves_the_version_before(spark, tmp_path):
    p = config.load(vehicles("x"))
    t = p.tables[2]
    s = stores.ParquetStore(spark, f"file://{tmp_path}/s")
    row = lambda k: spark.createDataFrame([(k,)], "vehicle_id long")
    s.merge(t, row(1), row(9), "a")
    was = s._point
    s._point = lambda *a: (_ for _ in ()).throw(OSError("killed"))
    with pytest.raises(OSError, match="killed"):
        s.merge(t, row(2), row(8), "b")
    s._point = was
    assert [r[0] for r in s.read(t).collect()] == [1] and [r[0] for r in s.read_history(t).collect()] == [9]
    s.merge(t, row(2), row(8), "b")
    s.merge(t, row(3), row(7), "b")
    assert [r[0] for r in s.read(t).collect()] == [2] and sorted(r[0] for r in s.read_history(t).collect()) == [8, 9]
    assert s.has_batch(t, "b") and not s.has_batch(t, "c")
    number, state = s._state(t.name)
    with pytest.raises(RuntimeError, match="another writer"):
        s._point(t.name, number, state)


def test_jdbc_creates_reads_and_counts_batches(spark):
    s = stores.open_store(spark, "derby", "jdbc:derby:memory:unit;create=true")
    t = config.load(vehicles("x")).tables[0]
    assert s.read(t) is None and s.read_history(t) is None
    rows = spark.createDataFrame([(1, 5), (2, 6)], "vehicle_id long, pcv long")
    s.append(t, rows, "a")
    s.append(t, rows, "a")
    assert sorted(tuple(r) for r in s.read(t).collect()) == [(1, 5), (2, 6)]
    s.replace(t, s.read(t).where("pcv = 6"))
    assert [tuple(r) for r in s.read(t).collect()] == [(2, 6)]


def test_jdbc_urls():
    assert stores.jdbc_url("postgresql://u:p%40@h:5432/d?sslmode=disable") == ("jdbc:postgresql://h:5432/d?sslmode=disable", {"user": "u", "password": "p@", "reWriteBatchedInserts": "true"})
    assert stores.jdbc_url("sqlserver://h:1433?database=d") == ("jdbc:sqlserver://h:1433;databaseName=d", {"useBulkCopyForBatchInsert": "true"})
    with pytest.raises(ValueError):
        stores.jdbc_url("mysql://h/d")


def test_intermediates_go_after_a_run(spark, tmp_path):
    from pathlib import Path

    shared = Path(stores.shared_dir(spark).removeprefix("file://"))
    before = {p.name for p in shared.glob("written-*")}
    raw = spark.createDataFrame([("1", "A", "p", "13.08.2018", "5")], "order_id string, segment string, priority string, day string, cents string")
    engine.run(spark, config.load(catalog.STAR), stores.ParquetStore(spark, f"file://{tmp_path}/s"), raw)
    assert {p.name for p in shared.glob("written-*")} == before


def test_one_table_alone(spark, tmp_path):
    raw = spark.createDataFrame([("1", "A", "p", "13.08.2018", "5")], "order_id string, segment string, priority string, day string, cents string")
    p, s = config.load(catalog.STAR), stores.ParquetStore(spark, f"file://{tmp_path}/s")
    engine.run(spark, p, s, raw, only="segments")
    assert s.read(p.tables[0]).count() == 1 and s.read(p.tables[1]) is None and s.read(p.tables[2]) is None


def test_metrics_go_to_a_server():
    sent = []

    class Client:
        def request(self, url, method, data, headers):
            sent.append((url, method, json.loads(data), headers))
            return 202, b"", 1

    m = metrics.Metrics(metrics.http_series("http://m.example/series", {"Key": "k"}, Client(), lambda: 7.0))
    m.rows("j", "inserted", 3)
    m.close()
    assert sent == [("http://m.example/series", "POST", {"series": [{"metric": "etl.records.total", "points": [[7, 3.0]], "tags": ["job:j", "kind:inserted"]}]}, {"Content-Type": "application/json", "Key": "k"})]


def _pages_equal_sql(spark, tmp_path, name, pages):
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got, want = catalog.QUERIES[name](spark, str(tmp_path)), con.execute(catalog.SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want.fetchall())


def test_links_of_pages_that_share_a_url(spark, tmp_path):
    _pages_equal_sql(spark, tmp_path, "page_links", [(1, "http://a.example/x", '<a href="/one">1</a><a href="/two">2</a>'), (2, "http://a.example/x", '<a href="/two">2</a><a href="/three">3</a>')])


def test_records_keep_what_the_sql_does_not_decode(spark, tmp_path):
    page = "<html><head><title>a &quot;b&quot; &lt;c&gt; &amp;lt; &amp;&amp</title></head><nav><a href=\"/x\">x</a></nav><article><h1>d &#64; &middot; &am</h1></article></html>"
    _pages_equal_sql(spark, tmp_path, "html_records", [(1, "http://a.example/x", page)])


def test_what_a_stream_tells_is_not_held_by_the_driver(spark):
    got = catalog.QUERIES["stream_session_counts"](spark, SF)
    assert got.inputFiles() and got.count()


def test_an_embedded_database_is_the_drivers_alone(spark):
    s = stores.open_store(spark, "derby", "jdbc:derby:memory:odd;create=true")
    t = config.Table("Odd", "fact", {"id": {"type": "bigint"}, "v": {"type": "text"}, "b": {"type": "bool"}})
    rows = [(1, 'a "b", c\nd', True), (2, "", None), (3, None, False), (4, " x ", True), (None, "é", None)]
    s.append(t, spark.createDataFrame(rows, "id long, v string, b boolean"))
    got = s.read(t)
    assert got.inputFiles(), "executors would read what only the driver has"
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(rows, key=str)
