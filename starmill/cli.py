"""python -m starmill.cli load|lint|probe|extract|expand|fetch ..."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _spark() -> SparkSession:
    return SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()


def _load(a) -> int:
    from starmill.metrics import Metrics, http_series, json_lines
    from starmill.plans import config, engine

    with open(a.config, encoding="utf-8") as f:
        p = config.load(f.read())
    stats = engine.run(_spark(), p, only=a.table)
    if a.metrics:
        m = Metrics(http_series(a.metrics) if "://" in a.metrics else json_lines(a.metrics))
        m.run(p.job, stats)
        m.close()
    print(" ".join(f"{k}={int(v)}" for _, k, v in stats.rows(p.job) if not k.startswith("step:")))
    return 0


def _lint(a) -> int:
    from starmill.plans import config

    with open(a.config, encoding="utf-8") as f:
        issues = config.lint(json.load(f))
    for i in issues:
        print(f"{i.severity}: {i.path}: {i.message}")
    return int(any(i.severity == "error" for i in issues))


def _probe(a) -> int:
    from starmill.plans import probe

    got = probe.probe(_spark(), a.source, a.job, a.backend, a.bytes, a.breakout, a.report, a.save)
    if not a.report and a.dsn:
        got["storage"]["db"]["dsn"] = a.dsn
    print(json.dumps(got, ensure_ascii=False, indent=2))
    return 0


def _extract(a) -> int:
    from starmill.sources import html
    from starmill.sources.web import first_bytes

    if a.debug:
        print("\n".join(html.debug(first_bytes(a.source, 1 << 30).decode("utf-8", "replace"), a.debug)))
        return 0
    with open(a.mappings, encoding="utf-8") as f:
        mapping = html.MappingFile.from_json(f.read())
    if a.dir:
        rows = html.extract_pages(html.read_pages(_spark(), a.dir), "html", mapping, "source_file").orderBy("source_file").toLocalIterator()
        found = ({k: v for k, v in r.asDict().items() if v is not None} for r in rows)
    else:
        found = html.extract(first_bytes(a.source, 1 << 30).decode("utf-8", "replace"), mapping)
    for r in found:
        print(json.dumps(r, ensure_ascii=False))
    return 0


def _expand(a) -> int:
    from starmill.functions.urls import expand_hrefs

    with open(a.file, encoding="utf-8") as f:
        rows = [(r.get("href"), r.get("count")) for r in json.load(f)]
    for r in expand_hrefs(_spark().createDataFrame(rows, "href string, count string"), per_page=a.per_page).toLocalIterator():
        print(r["url"])
    return 0


def _fetch(a) -> int:
    from starmill.sources import web

    spark = _spark()
    urls = web.read_list(spark, a.list).select(F.col("line").alias("url"))
    bad = 0
    for r in web.download(urls, a.out, web.Client(retries=a.retries), a.workers).toLocalIterator():
        bad += not r["ok"]
        print(json.dumps(r.asDict()))
    return int(bad > 0)


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="starmill")
    sub = top.add_subparsers(dest="command", required=True)

    def add(name, run, *args):
        p = sub.add_parser(name)
        for flags, options in args:
            p.add_argument(*flags, **options)
        p.set_defaults(run=run)

    add("load", _load, (["config"], {}), (["--metrics"], {}), (["--table"], {}))
    add("lint", _lint, (["config"], {}))
    add("probe", _probe, (["source"], {}), (["--job"], {}), (["--backend"], {"default": "sqlite"}), (["--bytes"], {"type": int, "default": 20_000}), (["--breakout"], {"action": "append"}), (["--report"], {"action": "store_true"}), (["--save"], {}), (["--dsn"], {}))
    add("extract", _extract, (["source"], {"nargs": "?"}), (["--mappings"], {}), (["--dir"], {}), (["--debug"], {}))
    add("expand", _expand, (["file"], {}), (["--per-page"], {"type": int, "default": 25}))
    add("fetch", _fetch, (["list"], {}), (["--out"], {"required": True}), (["--workers"], {"type": int, "default": 16}), (["--retries"], {"type": int, "default": 3}))
    try:
        a = top.parse_args(argv)
    except SystemExit as e:
        return int(e.code or 0)
    try:
        return a.run(a)
    except (OSError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
