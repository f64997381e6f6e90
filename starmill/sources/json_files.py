"""JSON documents of any shape as text columns: a root array, an envelope with an array, one object, objects after each other.

Numbers keep their digits; arrays of scalars are joined; nested values stay JSON.
Files are read whole by one task each, as a document can't be split; a file of one
object per line should go to ``read_lines``, which Spark splits.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DECODER = json.JSONDecoder(parse_int=str, parse_float=str)


def _skip(text: str, at: int) -> int:
    while at < len(text) and text[at] in " \t\r\n,":
        at += 1
    return at


def _elements(text: str, at: int) -> Iterator[tuple[object, int]]:
    """The elements of the array that begins at ``at``, each with the place behind it; at last the array's own end."""
    at = _skip(text, at + 1)
    while text[at : at + 1] != "]":
        value, at = _DECODER.raw_decode(text, at)
        yield value, at
        at = _skip(text, at)
    yield _END, at + 1


_END = object()


def _record(value: object) -> dict:
    if not isinstance(value, dict):
        raise ValueError("a record is an object")
    return value


def _largest(value: dict) -> list | None:
    """The longest array of objects in an object; the first of equals."""
    found = [v for v in value.values() if isinstance(v, list) and v and all(isinstance(x, dict) for x in v)]
    return max(found, key=len) if found else None


def records(text: str, largest: bool = False) -> Iterator[dict]:
    """The records of a document: the elements of a root array; those of the first array in a root object (``largest``: of the longest array of objects), or the object itself without one; and all objects that follow. Nulls are none."""
    text = text.lstrip("\ufeff")
    at, first = _skip(text, 0), True
    while at < len(text):
        if first and text[at] == "[":
            for value, at in _elements(text, at):  # noqa: B007
                if value is not _END and value is not None:
                    yield _record(value)
        else:
            value, at = _DECODER.raw_decode(text, at)
            inner = None if not first else _largest(_record(value)) if largest else next((v for v in _record(value).values() if isinstance(v, list)), None)
            for r in [value] if inner is None else inner:
                if r is not None:
                    yield _record(r)
        at, first = _skip(text, at), False


def text_of(value: object, separator: str = ",") -> str | None:
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, list) and all(x is None or isinstance(x, (str, bool)) for x in value):
        return separator.join(text_of(x) for x in value if x is not None)
    return json.dumps(value, ensure_ascii=False)


def row(record: dict, columns: list[str], header_map: dict[str, str] | None = None, separator: str = ",") -> list[str | None]:
    """A column's own name wins, if it is there, over the name that maps to it."""
    back = {v: k for k, v in (header_map or {}).items()}
    return [text_of(record[c] if c in record else record.get(back.get(c, c)), separator) for c in columns]


def read_documents(spark: SparkSession, path: str, columns: list[str], header_map: dict[str, str] | None = None, separator: str = ",") -> DataFrame:
    """``columns`` as text, and ``_corrupt`` (why a document ended early; its rows before that stay)."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for raw in frame["content"]:
                out, why = [], None
                try:
                    for r in records(bytes(raw).decode("utf-8", "replace")):
                        out.append([*row(r, columns, header_map, separator), None])
                        if len(out) >= 4096:
                            yield pd.DataFrame(out, columns=[*columns, "_corrupt"], dtype=object)
                            out = []
                except ValueError as e:
                    why = str(e)
                if why is not None:
                    out.append([*[None] * len(columns), why])
                if out:
                    yield pd.DataFrame(out, columns=[*columns, "_corrupt"], dtype=object)

    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_corrupt"]])
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, schema)


def read_lines(spark: SparkSession, path: str, columns: list[str], header_map: dict[str, str] | None = None) -> DataFrame:
    """One object a line, as text columns; mapped names are read where the own name is null. Numbers keep their digits, but lose zeros at their end where two of the names differ in letter case alone."""
    back = {v: k for k, v in (header_map or {}).items()}
    schema = lambda names: T.StructType([T.StructField(n, T.StringType()) for n in names])
    names = dict.fromkeys([*columns, *[back[c] for c in columns if c in back]])
    if len({n.lower() for n in names}) == len(names):
        df = spark.read.schema(schema([*names, "_corrupt"])).option("columnNameOfCorruptRecord", "_corrupt").json(path)
        return df.select(*[F.coalesce(c, back[c]).alias(c) if c in back else F.col(c) for c in columns], "_corrupt")
    # names that differ in letter case alone can't be in one schema: the line is read twice
    own = F.from_json("value", schema([*columns, "_corrupt"]), {"columnNameOfCorruptRecord": "_corrupt"}).alias("own")
    mapped = F.from_json("value", schema(dict.fromkeys(back[c] for c in columns if c in back))).alias("mapped") if back else F.lit(None).alias("mapped")
    df = spark.read.text(path).where(F.trim("value") != "").select(own, mapped)
    return df.select(*[F.coalesce(F.col("own")[c], F.col("mapped")[back[c]]).alias(c) if c in back else F.col("own")[c].alias(c) for c in columns], F.col("own._corrupt").alias("_corrupt"))


def flatten(value: dict, prefix: str = "") -> dict:
    """Nested objects as dotted keys; arrays stay."""
    out = {}
    for k, v in value.items():
        out |= flatten(v, f"{prefix}{k}.") if isinstance(v, dict) and v else {f"{prefix}{k}": v}
    return out


def flat_rows(df: DataFrame, column: str, paths: list[str]) -> DataFrame:
    """``paths`` (dotted, as ``flatten`` names them) of a column of JSON objects as text columns, beside the others."""
    at = lambda p: F.get_json_object(column, "$." + p)
    return df.select(*[c for c in df.columns if c != column], *[at(p).alias(p.replace(".", "_")) for p in paths])


def headers(rows: list[dict]) -> list[str]:
    return sorted({k for r in rows for k in r})
