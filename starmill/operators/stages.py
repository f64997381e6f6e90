"""Row stages over raw text columns: coerce, hash, check, and the optional ones.

A stage is DataFrame -> DataFrame; a stage that can refuse rows adds ``reject_reason``
(null: accepted) and ``split`` parts the two. Nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions import coerce as C
from starmill.functions.text import blank_to_null, normalize_nbsp, trim

ORDER = "_ord"


def with_order(df: DataFrame) -> DataFrame:
    """The rows' order in their source, as a column; to be added right after a scan."""
    return df.withColumn(ORDER, F.monotonically_increasing_id())


def chain(df: DataFrame, *stages) -> DataFrame:
    return reduce(lambda d, f: f(d), stages, df)


def coerce_rows(df: DataFrame, types: dict[str, str], layout: str = C.DEFAULT_LAYOUT) -> DataFrame:
    """Typed columns; a text that isn't blank and can't be read refuses the row. Columns that aren't text stay."""
    kinds = dict(df.dtypes)
    out, failed = [], []
    for name in df.columns:
        if name == "reject_reason" or kinds[name] != "string" or name.startswith("_"):
            out.append(F.col(name))
            continue
        value = C.coerced(F.col(name), types.get(name, "text"), layout)
        out.append(value.alias(name))
        if types.get(name) in C.KINDS:
            failed.append(F.when(blank_to_null(F.col(name)).isNotNull() & value.isNull(), f"{name}: not {C.KINDS[types[name]]}"))
    before = [F.col("reject_reason")] if "reject_reason" in df.columns else []
    keep = [c for c, n in zip(out, df.columns, strict=True) if n != "reject_reason"]
    return df.select(*keep, F.coalesce(*before, *failed, F.lit(None).cast("string")).alias("reject_reason"))


def coerce_strings(df: DataFrame, types: dict[str, str], layout: str = C.DEFAULT_LAYOUT) -> DataFrame:
    """As ``coerce_rows``, but a blank text of a typed column refuses the row too."""
    blank = F.coalesce(*[F.when(blank_to_null(F.col(n)).isNull(), f"{n}: blank") for n, k in types.items() if k in C.KINDS], F.lit(None).cast("string"))
    return coerce_rows(df.withColumn("reject_reason", blank), types, layout)


def coerce_records(df: DataFrame, types: dict[str, str], layout: str = C.DEFAULT_LAYOUT) -> DataFrame:
    """Values that can't be read keep their text: all columns stay strings."""
    out = []
    for n in df.columns:
        value = C.coerced(F.col(n), types[n], layout) if n in types else F.col(n)
        out.append(F.coalesce(value.cast("string"), F.col(n).cast("string")).alias(n) if n in types else F.col(n))
    return df.select(*out)


def check_rows(df: DataFrame, required: list[str], kinds: dict[str, str]) -> DataFrame:
    """Required columns in the order of their names, then kinds in column order; the first failure is the reason."""
    types = dict(df.dtypes)
    tests: list[Column] = []
    for n in sorted(required):
        empty = F.col(n).isNull() | (trim(F.col(n)) == "") if types[n] == "string" else F.col(n).isNull()
        tests.append(F.when(empty, f"{n}: required"))
    like = {"int": C.is_int_like, "bool": C.is_bool_like, "date": C.is_date_like}
    for n in df.columns:
        if kinds.get(n) in like:
            tests.append(F.when(F.col(n).isNotNull() & ~like[kinds[n]](F.col(n), types[n]), f"{n}: not {kinds[n]}"))
    before = [F.col("reject_reason")] if "reject_reason" in df.columns else []
    return df.withColumn("reject_reason", F.coalesce(*before, *tests, F.lit(None).cast("string")))


def check_records(df: DataFrame, fields: list[dict]) -> DataFrame:
    """A contract over text records: required, kind, enum, own spellings of true and false, own date layouts."""
    tests: list[Column] = []
    for f in fields:
        c = F.col(f["name"])
        s = blank_to_null(c.cast("string"))
        name, kind = f["name"], C.normalize_kind(f.get("type", ""))
        if f.get("required"):
            tests.append(F.when(s.isNull(), f"{name}: required"))
        ok = {
            "int": C.to_int(s).isNotNull(),
            "float": s.try_cast("double").isNotNull(),
            "bool": C.to_bool(s, f.get("truthy"), f.get("falsy")).isNotNull() if f.get("truthy") or f.get("falsy") else C.loose_bool(s).isNotNull(),
            "date": C.any_date(s, f.get("layout")).isNotNull(),
            "timestamp": F.coalesce(C.loose_timestamp(s), C.any_date(s, f.get("layout")).cast("timestamp")).isNotNull(),
        }.get(kind)
        if ok is not None:
            tests.append(F.when(s.isNotNull() & ~ok, f"{name}: not {kind}"))
        if f.get("enum"):
            tests.append(F.when(s.isNotNull() & ~s.isin(*f["enum"]), f"{name}: not in enum"))
    return df.withColumn("reject_reason", F.coalesce(*tests, F.lit(None).cast("string")))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where("reject_reason IS NULL").drop("reject_reason"), df.where("reject_reason IS NOT NULL")


def sample_rejects(rejects: DataFrame, n: int = 10, most: int = 1000) -> DataFrame:
    return rejects.select(F.substring("reject_reason", 1, most).alias("reject_reason"), ORDER).orderBy(ORDER).limit(n)


def require(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows whose fields are all there and not empty."""
    return df.where(reduce(lambda a, b: a & b, [F.col(f).isNotNull() & (F.col(f).cast("string") != "") for f in fields]))


def normalize(df: DataFrame) -> DataFrame:
    """Text columns with no-break spaces made plain and edges trimmed."""
    return df.select(*[normalize_nbsp(F.col(n)).alias(n) if t == "string" else F.col(n) for n, t in df.dtypes])


def dedup(df: DataFrame, keys: list[str], policy: str = "keep-last", prefer: list[str] | None = None, order: str = ORDER) -> DataFrame:
    """One row of each key: the first, the last, or the most complete (10 points for each filled field, 1 more for a preferred one; the later of equals).

    A null is a key's value; rows without any key pass. In Spark a missing key and a
    null one are the same, so that "without" means all keys null.
    """
    fields = [c for c in df.columns if c != order]
    full = lambda c: F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), 1).otherwise(0)
    score = reduce(lambda a, b: a + b, [10 * full(c) for c in fields] + [full(c) for c in prefer or [] if c in fields])
    sort = {"keep-first": [F.col(order)], "keep-last": [F.col(order).desc()], "most-complete": [score.desc(), F.col(order).desc()]}[policy]
    bare = reduce(lambda a, b: a & b, [F.col(k).isNull() for k in keys])
    # rows without a key are groups of their own, so that no task gets them all
    by = [F.col(k).cast("string") for k in keys] + [F.when(bare, F.col(order))]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*sort))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def realign(df: DataFrame, columns: list[str], anchor: str, values: list[str]) -> DataFrame:
    """Shift a row so that the first of ``values`` found in it stands in the column ``anchor``; cells that leave the row are lost, free ones null."""
    cells = F.array(*[F.col(c).cast("string") for c in columns])
    found = F.array_position(F.transform(cells, lambda x: F.coalesce(trim(x).isin(*values), F.lit(False))), F.lit(True))
    shift = F.when(found > 0, F.lit(columns.index(anchor) + 1) - found).otherwise(F.lit(0))
    moved = df.withColumn("_cells", cells).withColumn("_shift", shift)
    place = [F.get("_cells", F.lit(i) - F.col("_shift")).alias(c) for i, c in enumerate(columns)]
    return moved.select(*[c for c in df.columns if c not in columns], *place).select(*df.columns)
