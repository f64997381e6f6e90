"""Typed values from text, with the rules of the loader; every function gives null where a text can't be read."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.functions.text import blank_to_null, trim

#: the exact spellings that coercion reads
TRUE, FALSE = ("1", "t", "T", "TRUE", "true", "True"), ("0", "f", "F", "FALSE", "false", "False")
#: the spellings that checks accept, in any letter case
WIDE_TRUE, WIDE_FALSE = ("1", "t", "true", "yes", "y", "ano"), ("0", "f", "false", "no", "n", "ne")
DEFAULT_LAYOUT = "02.01.2006"
#: parts of reference-time layouts and their Java patterns, longest first
_LAYOUT = [("January", "MMMM"), ("2006", "yyyy"), ("Jan", "MMM"), ("Monday", "EEEE"), ("Mon", "EEE"), ("15", "HH"), ("01", "MM"), ("02", "dd"), ("03", "hh"), ("04", "mm"), ("05", "ss"), ("06", "yy"), ("PM", "a"), ("Z07:00", "XXX"), ("-0700", "xx"), ("MST", "z"), ("1", "M"), ("2", "d")]


def java_pattern(layout: str) -> str:
    """A reference-time layout (``02.01.2006 15:04``) as a Java pattern."""
    out, i = "", 0
    while i < len(layout):
        for part, java in _LAYOUT:
            if layout.startswith(part, i):
                out, i = out + java, i + len(part)
                break
        else:
            c = layout[i]
            out, i = out + (f"'{c}'" if c.isalpha() else c), i + 1
    return out


#: what the cells of a part look like; a text of another shape isn't parsed at all
_SHAPE = {"2006": r"\d{4}", "15": r"\d{2}", "01": r"\d{2}", "02": r"\d{2}", "03": r"\d{2}", "04": r"\d{2}", "05": r"\d{2}", "06": r"\d{2}", "Z07:00": r"(?:Z|[+-]\d{2}:\d{2})", "1": r"\d{1,2}", "2": r"\d{1,2}"}


def shape(layout: str) -> str:
    """A pattern that every text of a layout matches; parts without a fixed shape match anything."""
    out, i = "", 0
    while i < len(layout):
        part = next((p for p, _ in _LAYOUT if layout.startswith(p, i)), None)
        out += (_SHAPE.get(part, ".+") if part else re.escape(layout[i])).replace("/", "\\/")
        i += len(part) if part else 1
    return f"^{out}$"


def to_int(c: Column) -> Column:
    """Base-10 BIGINT; a text with a point is read if it is a whole number."""
    return _int(trim(c))


def _int(s: Column) -> Column:
    plain = F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("bigint"))
    real = F.when(s.contains("."), s.try_cast("double"))
    whole = F.when((real == F.floor(real)) & (F.abs(real) < 9.2e18), real.try_cast("bigint"))
    return F.coalesce(plain, whole)


def to_bool(c: Column, truthy: list[str] | None = None, falsy: list[str] | None = None) -> Column:
    """Exact spellings; given lists take their place and match in any letter case."""
    if truthy or falsy:
        low = F.lower(trim(c))
        return F.when(low.isin([x.lower() for x in truthy or []]), True).when(low.isin([x.lower() for x in falsy or []]), False)
    return _bool(trim(c))


def _bool(s: Column) -> Column:
    return F.when(s.isin(*TRUE), True).when(s.isin(*FALSE), False)


def loose_bool(c: Column) -> Column:
    low = F.lower(trim(c))
    return F.when(low.isin(*WIDE_TRUE), True).when(low.isin(*WIDE_FALSE), False)


def czech_date(c: Column) -> Column:
    """dd.MM.yyyy at the start of a text; days up to 31 roll over into the next month."""
    part = lambda k: F.substring(c, *((1, 2), (4, 2), (7, 4))[k - 1]).try_cast("int")
    ok = c.rlike(r"^\d{2}\.\d{2}\.\d{4}") & part(1).between(1, 31) & part(2).between(1, 12) & (part(3) > 0)
    return F.when(ok, F.date_add(F.make_date(F.when(ok, part(3)), F.when(ok, part(2)), F.lit(1)), F.coalesce(part(1), F.lit(1)) - 1))


def iso_date(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def layout_date(c: Column, layout: str) -> Column:
    return F.when(c.rlike(shape(layout)), F.try_to_date(c, java_pattern(layout)))


def layout_time(c: Column, layout: str) -> Column:
    return F.when(c.rlike(shape(layout)), F.try_to_timestamp(c, F.lit(java_pattern(layout))))


def to_date(c: Column, layout: str = DEFAULT_LAYOUT) -> Column:
    """The Czech prefix first if the layout is Czech, then the layout, ISO, and the Czech prefix last."""
    return _date(trim(c), layout)


def _date(s: Column, layout: str) -> Column:
    if layout == DEFAULT_LAYOUT:
        return F.coalesce(czech_date(s), iso_date(s))
    return F.coalesce(layout_date(s, layout), iso_date(s), czech_date(s))


LOOSE_DATES = ("2006-01-02", "02.01.2006", "02/01/2006", "01/02/2006")
LOOSE_TIMES = ("2006-01-02 15:04:05", "2006-01-02T15:04:05", "02.01.2006 15:04:05", "02.01.2006 15:04", "2006-01-02T15:04:05Z07:00")


def loose_date(c: Column) -> Column:
    return F.coalesce(*[layout_date(trim(c), x) for x in LOOSE_DATES])


def loose_date_layout(c: Column) -> Column:
    """The first layout that reads the text."""
    out = F.lit(None).cast("string")
    for x in reversed(LOOSE_DATES):
        out = F.when(layout_date(trim(c), x).isNotNull(), x).otherwise(out)
    return out


def loose_timestamp(c: Column) -> Column:
    return F.coalesce(*[layout_time(trim(c), x) for x in LOOSE_TIMES])


def loose_timestamp_layout(c: Column) -> Column:
    out = F.lit(None).cast("string")
    for x in reversed(LOOSE_TIMES):
        out = F.when(layout_time(trim(c), x).isNotNull(), x).otherwise(out)
    return out


def any_date(c: Column, layout: str | None = None, other: str = DEFAULT_LAYOUT) -> Column:
    """A field's layout, then ISO, then the common layout."""
    tried = ([layout_date(trim(c), layout)] if layout else []) + [iso_date(trim(c)), layout_date(trim(c), other)]
    return F.coalesce(*tried)


KINDS = {"int": "int", "bigint": "int", "int64": "int", "bool": "bool", "date": "date"}
SPARK_TYPE = {"int": "bigint", "bool": "boolean", "date": "date"}


def coerced(c: Column, kind: str, layout: str = DEFAULT_LAYOUT) -> Column:
    """The value of a text under a kind; unknown kinds pass the trimmed text. Blank texts are null."""
    # of a blank text none of the readers makes a value
    read = {"int": _int, "bool": _bool, "date": lambda x: _date(x, layout)}.get(KINDS.get(kind, ""))
    return read(trim(c)) if read else blank_to_null(c)


def is_int_like(c: Column, dtype: str) -> Column:
    if dtype in ("bigint", "int", "smallint", "tinyint"):
        return c.isNotNull()
    return trim(c.cast("string")).rlike(r"^[+-]?\d+$") & trim(c.cast("string")).try_cast("bigint").isNotNull()


def is_bool_like(c: Column, dtype: str) -> Column:
    return c.isNotNull() if dtype == "boolean" else F.lower(trim(c.cast("string"))).isin(*WIDE_TRUE, *WIDE_FALSE)


def is_date_like(c: Column, dtype: str) -> Column:
    """Only dates are; a text that was never coerced is not."""
    return c.isNotNull() if dtype in ("date", "timestamp") else F.lit(False)


def normalize_kind(kind: str) -> str:
    """One name for each family of type names."""
    k = kind.strip().lower()
    for name, others in (("int", "int integer int2 int4 int8 int64 bigint bitint smallint serial bigserial"), ("bool", "bool boolean bit"), ("date", "date"), ("timestamp", "timestamp timestamptz datetime datetime2"), ("float", "float float8 double real numeric decimal"), ("text", " text string varchar nvarchar char uuid")):
        if k in others.split(" "):
            return name
    return k
