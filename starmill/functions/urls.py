"""URL, paging and retry arithmetic."""

from __future__ import annotations

from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE = 25


@F.pandas_udf(T.StringType())
def resolve(base: pd.Series, href: pd.Series) -> pd.Series:
    """hrefs against their base."""
    return pd.Series([None if h is None else urljoin(b or "", h.strip()) for b, h in zip(base, href, strict=True)])


def safe_filename(url: Column) -> Column:
    """The query's letters and digits joined by underscores; without a query, the sha1 of the URL."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    name = F.btrim(F.regexp_replace(query, "[^a-zA-Z0-9]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(name, F.lit("")), F.sha1(url))


def pages(count: Column, size: int = PAGE) -> Column:
    return F.ceil(count / size).cast("int")


def page_urls(df: DataFrame, url: str, count: str, size: int = PAGE) -> DataFrame:
    """A row per further page of each row: URL/2 .. URL/n."""
    n = pages(F.col(count), size)
    more = df.withColumn("page", F.explode(F.when(n >= 2, F.sequence(F.lit(2), F.greatest(n, F.lit(2))))))
    return more.withColumn("page_url", F.concat(F.rtrim(F.col(url), F.lit("/")), F.lit("/"), F.col("page").cast("string")))


def expand_hrefs(df: DataFrame, href: str = "href", count: str = "count", per_page: int = PAGE) -> DataFrame:
    """Each href and its further pages href/2/ .. href/floor(count / per_page)/, each URL once, first come first."""
    n = F.coalesce(F.floor(F.replace(F.col(count), F.lit(" "), F.lit("")).try_cast("int") / per_page).cast("int"), F.lit(0))
    base = F.rtrim(F.col(href), F.lit("/"))
    all_ = F.concat(F.array(F.struct(F.lit(1).alias("page"), F.col(href).alias("u"))), F.when(n >= 2, F.transform(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), lambda p: F.struct(p.alias("page"), F.concat(base, F.lit("/"), p.cast("string"), F.lit("/")).alias("u")))).otherwise(F.array().cast("array<struct<page:int,u:string>>")))
    out = df.withColumn("_at", F.monotonically_increasing_id()).select("_at", F.explode(all_).alias("x"))
    first = out.groupBy(F.col("x.u").alias("url")).agg(F.min(F.struct("_at", "x.page")).alias("first"))
    return first.orderBy("first").select("url")


def backoff(attempt: Column, base: float, most: float) -> Column:
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), attempt - 1))


def retry_after(value: str, now: datetime | None = None) -> float | None:
    """Seconds of a Retry-After header: a number of seconds or a date."""
    value = (value or "").strip()
    if value.isdigit():
        return float(value)
    try:
        when = parsedate_to_datetime(value)
    except (TypeError, ValueError):
        return None
    return max(0.0, (when - (now or datetime.now(UTC))).total_seconds())
