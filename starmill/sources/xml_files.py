"""XML records as text columns, and what an unknown XML file holds."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class XmlConfig:
    """``fields``: name -> path, the first filled value; ``lists``: name -> path, all filled values. A path may end in [@attr='v']."""

    record_tag: str
    fields: dict[str, str] = field(default_factory=dict)
    lists: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_json(cls, text: str) -> XmlConfig:
        got = json.loads(text)
        if not got.get("record_tag"):
            raise ValueError("record_tag is mandatory")
        return cls(got["record_tag"], got.get("fields") or {}, got.get("lists") or {})

    def to_json(self) -> str:
        return json.dumps({"record_tag": self.record_tag, "fields": self.fields, "lists": self.lists}, indent=2)


def _xpath(path: str) -> str:
    """A path that matches at any depth, as an XPath of text nodes."""
    m = re.fullmatch(r"(.*?)(\[@[\w:-]+='[^']*'\])?", path.strip().strip("/"))
    return f"//{m[1]}{m[2] or ''}/text()"


def xml_field(xml: Column, path: str) -> Column:
    found = F.filter(F.transform(F.xpath(xml, F.lit(_xpath(path))), lambda x: F.btrim(x, F.lit(" \t\n\r"))), lambda x: x != "")
    return F.get(found, F.lit(0))


def xml_list(xml: Column, path: str) -> Column:
    return F.filter(F.transform(F.xpath(xml, F.lit(_xpath(path))), lambda x: F.btrim(x, F.lit(" \t\n\r"))), lambda x: x != "")


def split_records(text: str, tag: str) -> Iterator[str]:
    """The elements ``tag`` of a text, outermost ones; a truncated one at the end is left out."""
    mark = re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*?(/?)>", re.S)
    depth, start = 0, 0
    for m in mark.finditer(text):
        if m[1]:
            depth -= 1
            if depth == 0:
                yield text[start : m.end()]
            depth = max(depth, 0)
        elif m[2]:
            if depth == 0:
                yield m[0]
        else:
            if depth == 0:
                start = m.start()
            depth += 1


def _closed(text: str, tag: str) -> bool:
    """Whether no element ``tag`` is open at the end of a text, and none was closed before it was opened."""
    depth = 0
    for m in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*?(/?)>", text, re.S):
        depth += -1 if m[1] else not m[2]
        if depth < 0:
            return False
    return depth == 0


def read_records(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """The records of each file, as XML texts (column ``xml``).

    Files are cut behind the end tags and read in splits, a record at a time. A pass
    looks for files where that doesn't do: those in which an end tag leaves an element
    ``tag`` open (they nest, or end in another way) are read whole, a task a file.
    """
    end = f"</{tag}>"

    @F.pandas_udf("boolean")
    def odd(piece: pd.Series) -> pd.Series:
        return piece.map(lambda x: not _closed(bytes(x).decode("utf-8", "replace") + end, tag))

    def cut(frames):
        for frame in frames:
            yield pd.DataFrame({"xml": [r for x in frame["piece"] for r in split_records(bytes(x).decode("utf-8", "replace") + end, tag)]}, dtype=object)

    def whole(frames):
        for frame in frames:
            for raw in frame["content"]:
                found = split_records(bytes(raw).decode("utf-8", "replace"), tag)
                while some := list(islice(found, 1000)):
                    yield pd.DataFrame({"xml": some}, dtype=object)

    own = ("file_path", "file_block_start", "file_size")
    pieces = spark.read.option("lineSep", end).text(path).select(*[F.col(f"_metadata.{c}").alias(c) for c in own], F.col("value").cast("binary").alias("piece"))
    told = pieces.withColumn("at", F.monotonically_increasing_id()).withColumn("odd", odd("piece"))
    files = told.groupBy("file_path").agg(F.count_if("odd").alias("n"), F.max_by(F.struct("odd", "piece"), F.struct("file_block_start", "at")).alias("last"), (F.sum(F.octet_length("piece") + len(end)) > F.max("file_size")).alias("rest"))
    # behind a file's last end tag: what isn't a record, or the beginning of one
    loose = F.col("rest") & F.col("last.odd")
    strange = files.where((F.col("n") > loose.cast("int")) | (F.col("rest") & ~loose)).select("file_path", (F.col("n") > loose.cast("int")).alias("nests"), "last.piece").collect()
    begun = [r for r in strange if not r["nests"]]
    nests = [r["file_path"] for r in strange if r["nests"]]
    for r in begun:
        same = (F.col("file_path") == r["file_path"]) & (F.col("piece") == F.lit(r["piece"]))
        if pieces.where(same).limit(2).count() == 1:
            pieces = pieces.where(~same)
        else:  # it equals a whole record but for its end tag
            nests.append(r["file_path"])
    if not nests:
        return pieces.select("piece").mapInPandas(cut, "xml string")
    files = spark.read.format("binaryFile").load(path).where(F.col("_metadata.file_path").isin(nests))
    return pieces.where(~F.col("file_path").isin(nests)).select("piece").mapInPandas(cut, "xml string").union(files.select("content").mapInPandas(whole, "xml string"))


def read_xml(spark: SparkSession, path: str, config: XmlConfig) -> DataFrame:
    raw = read_records(spark, path, config.record_tag)
    return raw.select(*[xml_field(F.col("xml"), p).alias(n) for n, p in config.fields.items()], *[xml_list(F.col("xml"), p).alias(n) for n, p in config.lists.items()])


#: fields of one well-known citation format and where they stand (fixed values)
CITATION = {"pmid": "PMID", "title": "ArticleTitle", "journal": "Title", "year": "Year", "abstract": "AbstractText", "volume": "Volume"}
AUTHORS = 16


def citation_fields(xml: Column) -> list[Column]:
    """Seven fixed fields by plain patterns, without parsing; at most 16 authors."""
    inner = lambda tag: F.nullif(F.regexp_extract(xml, rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1), F.lit(""))
    authors = F.slice(F.regexp_extract_all(xml, F.lit(r"(?s)<LastName>(.*?)</LastName>"), F.lit(1)), 1, AUTHORS)
    return [*[inner(tag).alias(name) for name, tag in CITATION.items()], authors.alias("authors")]


# -- what a file holds


def guess_record_tag(text: str) -> str:
    """The most frequent element right under the root; the first name of equals."""
    counts, depth = Counter(), 0
    try:
        for event, e in ET.iterparse(_Reader(text), ("start", "end")):
            if event == "start":
                counts[e.tag] += depth == 1
                depth += 1
            else:
                depth -= 1
    except ET.ParseError:
        pass
    best = [k for k, n in counts.items() if n == max(counts.values()) and n]
    if not best:
        raise ValueError("no element under the root")
    return min(best)


class _Reader:
    def __init__(self, text: str):
        self.raw, self.at = text.encode(), 0

    def read(self, n: int = -1) -> bytes:
        out = self.raw[self.at : self.at + n if n >= 0 else None]
        self.at += len(out)
        return out


def walk(xml: str) -> Iterator[tuple[str, str, str]]:
    """(path, text, attributes as JSON) of every element under a record."""

    def down(e, path):
        for child in e:
            here = f"{path}/{child.tag}" if path else child.tag
            yield here, (child.text or "").strip(), json.dumps(dict(child.attrib), sort_keys=True)
            yield from down(child, here)

    try:
        yield from down(ET.fromstring(xml), "")
    except ET.ParseError:
        return


def elements(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """(record, path, text, attributes) of every element of every record; feed it to ``profile.paths``."""
    schema = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("path", "text", "attributes")]))

    @F.pandas_udf(schema)
    def parts(xml: pd.Series) -> pd.Series:
        return xml.map(lambda x: [dict(zip(("path", "text", "attributes"), e, strict=True)) for e in walk(x)])

    raw = read_records(spark, path, tag).withColumn("record", F.monotonically_increasing_id())
    return raw.select("record", F.explode(parts("xml")).alias("e")).select("record", "e.*")


def starter_config(tag: str, report: list[dict]) -> XmlConfig:
    """Fields for paths that occur at most once in a record, lists for the others."""
    name = lambda p: p.replace("/", "_").lower()
    one = {name(r["path"]): r["path"] for r in sorted(report, key=lambda r: r["path"]) if r["max_per_record"] == 1}
    many = {name(r["path"]): r["path"] for r in sorted(report, key=lambda r: r["path"]) if r["max_per_record"] > 1}
    return XmlConfig(tag, one, many)
