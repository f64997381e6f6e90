"""Text and identifier functions: Column -> Column where Spark can say it, else Python."""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\r"
#: all code points that count as white space when text is trimmed
WIDE_BLANKS = " \t\n\x0b\x0c\r\x85\xa0                　"


def trim(c: Column) -> Column:
    return F.btrim(c, F.lit(WIDE_BLANKS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trim(c), F.lit(""))


def strip_html(c: Column) -> Column:
    """Without <...>; an unclosed < drops the rest, a stray > goes."""
    return F.replace(F.regexp_replace(c, "<[^>]*>?", ""), F.lit(">"), F.lit(""))


def collapse_whitespace(c: Column) -> Column:
    return trim(F.regexp_replace(c, r"[ \t\n\r]+", " "))


def normalize_text(c: Column) -> Column:
    return collapse_whitespace(strip_html(c))


def extract_between(c: Column, start: str, end: str) -> Column:
    """What stands between the first ``start`` and the next ``end``; null where either is missing."""
    after = F.instr(c, start) + len(start)
    rest = F.substring(c, after, F.length(c))
    stop = F.instr(rest, end)
    return F.when((F.instr(c, start) > 0) & (stop > 0), F.substring(rest, F.lit(1), stop - 1))


def extract_ints(c: Column) -> Column:
    """All runs of digits as BIGINTs; null if one is too large."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("bigint"))
    return F.when(~F.exists(found, lambda x: x.isNull()), found)


def normalize_nbsp(c: Column) -> Column:
    return trim(F.replace(c, F.lit("\xa0"), F.lit(" ")))


def has_edge_space(c: Column) -> Column:
    return c.rlike(r"^[ \t\n\r]|[ \t\n\r]$")


def rot13(c: Column) -> Column:
    abc = "abcdefghijklmnopqrstuvwxyz"
    turned = abc[13:] + abc[:13]
    return F.translate(c, abc + abc.upper(), turned + turned.upper())


#: what counts as an address (fixed value)
ADDRESS = r"[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}"
EMAIL = rf"(?i)^{ADDRESS}$"


def looks_like_email(c: Column) -> Column:
    return c.rlike(EMAIL)


def regex_filter(c: Column, pattern: str) -> Column:
    """The first group of the first match (the match, if there is no group); null without a match."""
    group = 1 if re.compile(pattern).groups else 0
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def normalize_key(c: Column) -> Column:
    """A join key's text: trimmed, null if empty."""
    return F.nullif(trim(c.cast("string")), F.lit(""))


def parse_count(c: Column) -> Column:
    """All digits of a text joined to a number; null without digits."""
    return F.regexp_replace(c, "[^0-9]", "").try_cast("int")


def parse_spaced_count(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit("")).try_cast("int")


def join_strings(c: Column, separator: str = ",") -> Column:
    return F.array_join(F.filter(c, lambda x: x.isNotNull()), separator)


# -- identifiers


def strip_accents(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")


def field_name(s: str) -> str:
    """A lower-case identifier of letters, digits and single underscores."""
    s = strip_accents(s.replace("﻿", "").strip()).lower()
    s = re.sub(r"[\s\-./\\_]+", "_", s)
    return re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]", "", s)).strip("_")


def limit_identifier(s: str, most: int = 63) -> str:
    """At most ``most`` bytes: a cut name ends in two underscores and 8 hex digits of its sha256."""
    raw = s.encode()
    if len(raw) <= most:
        return s
    tail = "__" + hashlib.sha256(raw).hexdigest()[:8]
    return raw[: most - len(tail)].decode(errors="ignore").rstrip("_") + tail


@F.pandas_udf(T.StringType())
def _plain_letters(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFD").str.replace(r"[\u0300-\u036f]", "", regex=True)


def field_name_column(c: Column | str) -> Column:
    """``field_name`` of a column: accents go in one vectorised pass, the rest is Spark's."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.replace(c, F.lit("\ufeff"), F.lit(""))
    s = F.lower(trim(_plain_letters(s)))
    s = F.regexp_replace(F.regexp_replace(s, r"[\s\-./\\_]+", "_"), "[^a-z0-9_]", "")
    return F.btrim(F.regexp_replace(s, "_+", "_"), F.lit("_"))


def quote(name: str, dialect: str = "spark") -> str:
    """A quoted identifier; dots separate its parts."""
    left, right = {"spark": "``", "postgres": '""', "mssql": "[]", "sqlite": '""', "derby": '""'}[dialect]
    return ".".join(left + part.replace(right, right * 2) + right for part in name.split("."))
