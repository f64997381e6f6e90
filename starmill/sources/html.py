"""HTML pages: a small tree, CSS selectors, field mappings, links. Standard library only."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.emails import decode_email
from starmill.functions.urls import PAGE

VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: elements that a start tag of their own kind closes
_CLOSES = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_BLOCKS = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_STOPS = {"ul", "ol", "table", "div", "select", "dl", "section", "article", "body"}


@dataclass(eq=False)
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    parent: Node | None = None
    children: list[Node | str] = field(default_factory=list)

    def elements(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]

    def walk(self) -> Iterator[Node]:
        todo = self.elements()[::-1]
        while todo:
            n = todo.pop()
            yield n
            todo += n.elements()[::-1]

    def text(self) -> str:
        out, todo = [], self.children[::-1]
        while todo:
            c = todo.pop()
            if isinstance(c, str):
                out.append(c)
            else:
                todo += c.children[::-1]
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def handle_starttag(self, tag, attrs):
        closes, n = _CLOSES.get(tag, {"p"} if tag in _BLOCKS else ()), self.at
        while closes and n.parent and n.tag not in _STOPS:
            if n.tag in closes:
                self.at = n.parent
                break
            n = n.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        n = self.at
        while n.parent and n.tag != tag:
            n = n.parent
        if n.parent:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


# -- selectors: tag, #id, .class, [attr op value], :not() :has() :contains() :nth-of-type(n) :first-child :last-child; " ", ">", "+", "~", ","

_PART = re.compile(r"""(?P<tag>\*|[\w-]+)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~|^$*]?=)\s*(?P<q>["']?)(?P<val>.*?)(?P=q)\s*)?\]|:(?P<pseudo>[\w-]+)(?P<open>\()?""")


def _argument(s: str, i: int) -> tuple[str, int]:
    depth, start = 1, i
    while i < len(s) and depth:
        depth += {"(": 1, ")": -1}.get(s[i], 0)
        i += 1
    if depth:
        raise ValueError(f"unclosed bracket in selector: {s}")
    return s[start : i - 1], i


def _compound(s: str, i: int):
    tests = []
    while i < len(s) and s[i] not in " >+~,":
        m = _PART.match(s, i)
        if not m:
            raise ValueError(f"bad selector: {s}")
        i = m.end()
        if m["tag"]:
            t = m["tag"].lower()
            tests.append(lambda n, t=t: t in ("*", n.tag))
        elif m["id"]:
            tests.append(lambda n, v=m["id"]: n.attrs.get("id") == v)
        elif m["cls"]:
            tests.append(lambda n, v=m["cls"]: v in n.attrs.get("class", "").split())
        elif m["attr"]:
            op, want, name = m["op"], m["val"], m["attr"].lower()
            by = {None: lambda v, w: True, "=": lambda v, w: v == w, "^=": lambda v, w: v.startswith(w), "$=": lambda v, w: v.endswith(w), "*=": lambda v, w: w in v, "~=": lambda v, w: w in v.split(), "|=": lambda v, w: v == w or v.startswith(w + "-")}[op]
            tests.append(lambda n, a=name, w=want, f=by: a in n.attrs and f(n.attrs[a], w))
        else:
            arg = ""
            if m["open"]:
                arg, i = _argument(s, i)
            tests.append(_pseudo(m["pseudo"], arg))
    return tests, i


def _pseudo(name: str, arg: str):
    same = lambda n: [x for x in n.parent.elements() if x.tag == n.tag] if n.parent else [n]
    if name == "not":
        inner = compile_selector(arg)
        return lambda n: not inner.matches(n)
    if name == "has":
        inner = compile_selector(arg.lstrip("> "))
        direct = arg.strip().startswith(">")
        return lambda n: any(inner.matches(x) and (not direct or x.parent is n) for x in n.walk())
    if name == "contains":
        want = arg.strip().strip("\"'")
        return lambda n: want in n.text()
    if name == "nth-of-type":
        k = int(arg)
        return lambda n: len(same(n)) >= k and same(n)[k - 1] is n
    if name == "nth-child":
        k = int(arg)
        return lambda n: n.parent and len(n.parent.elements()) >= k and n.parent.elements()[k - 1] is n
    if name in ("first-child", "last-child"):
        k = 0 if name[0] == "f" else -1
        return lambda n: bool(n.parent) and n.parent.elements()[k] is n
    if name in ("first-of-type", "last-of-type"):
        k = 0 if name[0] == "f" else -1
        return lambda n: same(n)[k] is n
    raise ValueError(f"unknown pseudo-class: {name}")


@dataclass
class Selector:
    chains: list[list[tuple[str, list]]]

    def matches(self, n: Node) -> bool:
        return any(self._chain(c, len(c) - 1, n) for c in self.chains)

    def _chain(self, chain, i, n) -> bool:
        if not n.tag or not all(t(n) for t in chain[i][1]):
            return False
        if i == 0:
            return True
        how, p = chain[i][0], n.parent
        if how == ">":
            return p is not None and self._chain(chain, i - 1, p)
        if how == " ":
            while p is not None:
                if self._chain(chain, i - 1, p):
                    return True
                p = p.parent
            return False
        before = p.elements()[: next(k for k, x in enumerate(p.elements()) if x is n)] if p else []
        return any(self._chain(chain, i - 1, x) for x in (before[-1:] if how == "+" else before))

    def select(self, root: Node) -> list[Node]:
        return [n for n in root.walk() if self.matches(n)]


_compiled: dict[str, Selector] = {}


def compile_selector(s: str) -> Selector:
    s = s.strip()
    if s in _compiled:
        return _compiled[s]
    chains, chain, how, i = [], [], "", 0
    while i < len(s):
        tests, i = _compound(s, i)
        if not tests:
            raise ValueError(f"bad selector: {s}")
        chain.append((how, tests))
        m = re.compile(r"\s*([>+~,]?)\s*").match(s, i)
        i = m.end()
        if m[1] and i >= len(s):
            raise ValueError(f"bad selector: {s}")
        if m[1] == "," or i >= len(s):
            chains.append(chain)
            chain, how = [], ""
        else:
            how = m[1] or " "
    if chain or not chains:
        raise ValueError(f"bad selector: {s}")
    _compiled[s] = Selector(chains)
    return _compiled[s]


# -- mappings


@dataclass
class Mapping:
    name: str
    selector: str
    extract: str = "text"
    attr: str = ""
    regex: str = ""
    all: bool = False


@dataclass
class MappingFile:
    mappings: list[Mapping]
    record: str = ""

    @classmethod
    def from_json(cls, text: str) -> MappingFile:
        got = json.loads(text)
        if isinstance(got, list):
            got = {"mappings": got}
        keys = Mapping.__dataclass_fields__
        return cls([Mapping(**{k: v for k, v in m.items() if k in keys}) for m in got.get("mappings", [])], got.get("record_selector") or got.get("record") or "")


def _value(n: Node, m: Mapping) -> str | None:
    v = n.attrs.get(m.attr) if m.extract == "attr" else decode_email(n.text()) if m.extract == "js_email" else n.text()
    v = v.strip() if v else ""
    if v and m.regex:
        hit = re.search(m.regex, v)
        v = "" if not hit else (hit[1] or "") if hit.re.groups else hit[0]
    return v or None


def extract_node(n: Node, mappings: list[Mapping]) -> dict:
    out = {}
    for m in mappings:
        found = [v for v in (_value(x, m) for x in compile_selector(m.selector).select(n)) if v]
        if found:
            out[m.name] = found if m.all else found[0]
    return out


def extract(html: str, mapping: MappingFile) -> list[dict]:
    """One object, or one for each record container; empty ones are left out."""
    root = parse(html)
    where = compile_selector(mapping.record).select(root) if mapping.record else [root]
    return [r for r in (extract_node(n, mapping.mappings) for n in where) if r]


def debug(html: str, selector: str) -> list[str]:
    return [n.text().strip() for n in compile_selector(selector).select(parse(html))]


def extract_pages(df: DataFrame, html: str, mapping: MappingFile, *keep: str) -> DataFrame:
    """A row per record: ``keep`` and a text column for each mapping (a JSON array for those that take all)."""
    names = [m.name for m in mapping.mappings]

    def run(frames):
        for frame in frames:
            out = []
            for i, page in enumerate(frame[html]):
                for r in extract(page, mapping) if page else ():
                    own = [json.dumps(r[n], ensure_ascii=False) if isinstance(r.get(n), list) else r.get(n) for n in names]
                    out.append([*(frame[k].iloc[i] for k in keep), *own])
            yield pd.DataFrame(out, columns=[*keep, *names])

    kept = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)
    fields = ", ".join(f"`{n}` string" for n in names)
    return df.select(*keep, html).mapInPandas(run, ", ".join(x for x in (kept, fields) if x))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, html) of a folder's HTML files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.htm*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), F.decode("content", "UTF-8").alias("html"))


def links(html: str, base: str, classes: str = "", same_host: bool = True) -> list[str]:
    """Links, in order and once each, whose class list has the token ``classes``; http(s) only, no fragment."""
    out: dict[str, None] = {}
    host = urlsplit(base).netloc
    for n in parse(html).walk():
        if n.tag != "a" or not n.attrs.get("href") or (classes and classes not in n.attrs.get("class", "").split()):
            continue
        u = urlsplit(urljoin(base, n.attrs["href"].strip()))
        if u.scheme in ("http", "https") and (not same_host or u.netloc == host):
            out[u._replace(fragment="").geturl()] = None
    return list(out)


def page_links(df: DataFrame, url: str, html: str, classes: str = "", same_host: bool = True) -> DataFrame:
    @F.pandas_udf("array<string>")
    def found(u: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([links(b or "", a or "", classes, same_host) for a, b in zip(u, h, strict=True)])

    return df.select(F.col(url).alias("from_url"), F.explode(found(url, html)).alias("to_url"))


def listings(html: str, base: str, mapping: MappingFile, size: int = PAGE) -> list[tuple[str, int]]:
    """(first page's URL, number of pages) of a listing's items: of each record's ``href`` with its ``count``; without a record selector, of the page itself with its one ``count``. Items without a count, or none, are left out."""
    out: list[tuple[str, int]] = []
    for r in extract(html, mapping) if mapping.record else extract(html, mapping)[:1]:
        digits = "".join(re.findall(r"\d+", str(r.get("count") or "")))
        href = r.get("href") if mapping.record else base.rstrip("/")
        if digits and int(digits) and href:
            out.append((urljoin(base, href) if mapping.record else href, -(-int(digits) // size)))
    return out


def paging(html: str, base: str, mapping: MappingFile, size: int = PAGE) -> list[str]:
    """The page URLs of a listing, in order."""
    return [u for first, n in listings(html, base, mapping, size) for u in (first, *(f"{first.rstrip('/')}/{p}" for p in range(2, n + 1)))]


AT_ONCE = 4096
"""Page URLs of an item that are made at a time, and slices that are sent at a time."""


def page_lists(df: DataFrame, url: str, html: str, mapping: MappingFile, size: int = PAGE) -> DataFrame:
    """(from_url, at, page_url): the page URLs of every listing, in order. Python tells slices of an item's pages, and Spark makes their URLs."""
    names = ["from_url", "first", "stem", "before", "lo", "hi"]

    def run(frames):
        for frame in frames:
            out = []
            for a, b in zip(frame[url], frame[html], strict=True):
                before = 0
                for first, n in listings(b or "", a or "", mapping, size):
                    for lo in range(0, n, AT_ONCE):
                        out.append((a, first, first.rstrip("/"), before, lo, min(n, lo + AT_ONCE)))
                        if len(out) == AT_ONCE:
                            yield pd.DataFrame(out, columns=names)
                            out = []
                    before += n
            yield pd.DataFrame(out, columns=names)

    slices = df.select(url, html).mapInPandas(run, "from_url string, first string, stem string, before long, lo long, hi long")
    pages = slices.select("*", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("k"))
    page = F.when(F.col("k") == 0, F.col("first")).otherwise(F.concat("stem", F.lit("/"), (F.col("k") + 1).cast("string")))
    return pages.select("from_url", (F.col("before") + F.col("k")).alias("at"), page.alias("page_url"))


def crawl_live(seeds: list[str], depth: int, client=None, classes: str = "", same_host: bool = True) -> Iterator[tuple[str, int, int]]:
    """(url, depth, status) of pages fetched from the seeds over their links, each once, breadth first; a site's pages come one after another, from one machine."""
    from starmill.sources.web import Client

    client = client or Client()
    seen, front = set(seeds), list(dict.fromkeys(seeds))
    for d in range(depth + 1):
        later: list[str] = []
        for url in front:
            status, body, _ = client.get(url)
            yield url, d, status
            if d < depth and 200 <= status < 300:
                for to in links(body.decode("utf-8", "replace"), url, classes, same_host):
                    if to not in seen:
                        seen.add(to)
                        later.append(to)
        front = later


def crawl(seeds: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """(url, depth) of pages within ``depth`` steps of the seeds over (from_url, to_url), each at its least depth. Every round is written."""
    from starmill.plans.stores import written

    seen = written(seeds.select("url").distinct().withColumn("depth", F.lit(0)))
    front = seen
    for d in range(1, depth + 1):
        step = front.join(edges, F.col("url") == F.col("from_url")).select(F.col("to_url").alias("url")).distinct()
        front = written(step.join(seen, "url", "left_anti").withColumn("depth", F.lit(d)))
        if not front.limit(1).count():
            break
        seen = seen.union(front)
    return seen
