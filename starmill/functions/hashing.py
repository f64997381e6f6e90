"""Deterministic row fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions.text import trim

SEPARATOR = "\x1f"


def canonical(c: Column, dtype: str, edges: bool = False) -> Column:
    """A value's text for hashing: dates as midnight UTC, booleans as true/false."""
    if dtype == "date":
        return F.date_format(c, "yyyy-MM-dd'T'00:00:00'Z'")
    if dtype.startswith("timestamp"):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return trim(c) if edges and dtype == "string" else c.cast("string")


def row_hash(df: DataFrame, fields: list[str], names: bool = True, separator: str = SEPARATOR, trimmed: bool = True, null: str = "null") -> Column:
    """sha256 over the fields in order, each with its name if ``names``; null has the text ``null``."""
    types = dict(df.dtypes)
    parts = []
    for f in fields:
        text = F.coalesce(canonical(F.col(f), types[f], trimmed), F.lit(null))
        parts.append(F.concat(F.lit(f"{f}="), text) if names else text)
    return F.sha2(F.concat_ws(separator, *parts), 256)


def with_row_hash(df: DataFrame, target: str, fields: list[str], overwrite: bool = True, **options) -> DataFrame:
    """Add ``target``; a present value stays if ``overwrite`` is off."""
    value = row_hash(df, fields, **options)
    if not overwrite and target in df.columns:
        value = F.coalesce(F.nullif(F.col(target), F.lit("")), value)
    return df.withColumn(target, value)
