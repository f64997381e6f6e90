"""CSV files as text columns: header names resolved, cells trimmed, blanks null.

Quoted cells may hold line breaks. A pass over the lines looks for an odd number of
quotes: where no line has one, no cell spans lines and the files are read in splits;
otherwise a task reads a file as a whole.
"""

from __future__ import annotations

import csv as pycsv
import io
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.text import WIDE_BLANKS, blank_to_null

CORRUPT = "_corrupt"
#: a common damage of one source's quotes, and its repair (fixed values)
SCRUB = (' "v likvidaci""', " (v likvidaci)")


def resolve_header(cells: list[str], header_map: dict[str, str] | None = None) -> list[str]:
    """Names: a mapped cell, else lower case with underscores for spaces. Of equal names the last column has it."""
    names = []
    for i, cell in enumerate(cells):
        cell = cell.strip(WIDE_BLANKS)
        if i == 0:
            cell = cell.removeprefix("﻿")
        names.append((header_map or {}).get(cell, cell.lower().replace(" ", "_")))
    return names


def _first_cells(spark: SparkSession, path: str, sep: str, multiline: bool) -> list[str]:
    df = spark.read.option("sep", sep).option("escape", '"').option("multiLine", multiline).csv(path)
    # behind the cells are the columns that folders' names tell (k=v)
    row = df.select([c for i, c in enumerate(df.columns) if c == f"_c{i}"]).limit(1).collect()
    return [c or "" for c in row[0]] if row else []


def spans_lines(spark: SparkSession, path: str, scrub: bool = False) -> bool:
    """Whether a line has an odd number of quotes, as the first line of a broken cell has."""
    line = F.replace("value", F.lit(SCRUB[0]), F.lit(SCRUB[1])) if scrub else F.col("value")
    odd = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
    return spark.read.text(path).where(odd).limit(1).count() > 0


def _data_lines(spark: SparkSession, path: str, header: bool) -> DataFrame:
    """The lines of all files without each file's first one, if that is the header."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_line"))
    if not header:
        return lines.select("value")
    # a row for each file
    heads = lines.where("_start = 0").groupBy("_file").agg(F.min("_line").alias("_head")).withColumnRenamed("_file", "_of")
    return lines.join(heads, (F.col("_file") == F.col("_of")) & (F.col("_line") == F.col("_head")), "left_anti").select("value")


def _whole_files(spark: SparkSession, path: str, width: int, header: bool, sep: str) -> DataFrame:
    """The cells of files that are repaired and whose cells span lines: a task a file."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for raw in frame["content"]:
                text = bytes(raw).decode("utf-8", "replace").removeprefix("\ufeff").replace(*SCRUB)
                rows = pycsv.reader(io.StringIO(text, newline=""), delimiter=sep)
                if header:
                    next(rows, None)
                out = [[*(r[:width] + [None] * (width - len(r))), sep.join(r) if len(r) != width else None] for r in rows if r]
                yield pd.DataFrame(out, columns=[*[f"_c{i}" for i in range(width)], CORRUPT], dtype=object)

    schema = ", ".join([*[f"_c{i} string" for i in range(width)], f"{CORRUPT} string"])
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, schema)


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, header: bool = True, header_map: dict[str, str] | None = None, sep: str = ",", trim: bool = True, scrub: bool = False, fields_per_record: int = -1, lazy_quotes: bool = False, multiline: bool | None = None) -> DataFrame:
    """``columns`` (all of the header's, if not given) as text, and ``_corrupt`` (the raw line of a row of another width).

    Short rows get nulls. ``fields_per_record``: 0, rows of another width than the
    first are refused; n, rows of other than n cells are; -1, none is. ``scrub``
    repairs lines before they are parsed; ``lazy_quotes`` reads quotes inside plain
    cells as text. Without a header, ``columns`` name the cells in order. ``multiline``:
    whether cells span lines; None finds out.
    """
    multiline = spans_lines(spark, path, scrub) if multiline is None else multiline
    cells = _first_cells(spark, path, sep, multiline)
    names = resolve_header(cells, header_map) if header else list(columns or [f"c{i}" for i in range(len(cells))])
    width = len(names)
    fields = [T.StructField(f"_c{i}", T.StringType()) for i in range(width)]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "header": str(header).lower(), "enforceSchema": "true", "multiLine": str(multiline).lower()}
    if lazy_quotes:
        options["unescapedQuoteHandling"] = "STOP_AT_DELIMITER"
    if scrub and multiline:
        df = _whole_files(spark, path, width, header, sep)
    elif scrub:
        lines = _data_lines(spark, path, header).where("value <> ''").select(F.replace("value", F.lit(SCRUB[0]), F.lit(SCRUB[1])).alias("value"))
        df = lines.select(F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {k: v for k, v in options.items() if k not in ("header", "multiLine")}).alias("r")).select("r.*")
    else:
        df = spark.read.schema(schema).options(**options).csv(path)
    # Spark refuses queries of the corrupt column alone: it is tied to the cells
    tied = F.length(F.concat_ws("", *[f"_c{i}" for i in range(width)])) >= 0
    df = df.withColumn(CORRUPT, F.when(tied, F.col(CORRUPT)))
    if fields_per_record >= 0 and fields_per_record not in (0, width):
        warnings.warn(f"{path}: the first line has {width} cells, {fields_per_record} are asked for: no row is read", stacklevel=2)
        df = df.where(F.lit(False))
    elif fields_per_record >= 0:
        df = df.where(F.col(CORRUPT).isNull())
    last = {n: i for i, n in enumerate(names)}
    cell = lambda n: (blank_to_null(F.col(f"_c{last[n]}")) if trim else F.nullif(F.col(f"_c{last[n]}"), F.lit(""))) if n in last else F.lit(None).cast("string")
    return df.select(*[cell(n).alias(n) for n in columns or last], CORRUPT)


def skipped() -> Column:
    """The number of rows of another width, to observe or aggregate."""
    return F.count_if(F.col(CORRUPT).isNotNull())
