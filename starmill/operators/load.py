"""Dimensions with surrogate keys, lookups, idempotent facts, and full change history.

All are joins, windows and unions over DataFrames; they return what to write and
leave writing to a store. ``broadcast`` is never asked for: the planner decides by
size, and adaptive execution splits hot keys.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions.text import normalize_key
from starmill.operators.stages import ORDER

FEW = 200_000
"""Up to so many rows are numbered by one task."""


def numbered(df: DataFrame, key: str, name: str, start: int = 0) -> DataFrame:
    """``name``: start + 1, + 2 ... in the order of ``key`` (unique), without bringing many rows to one task.

    The rows are written, cut into ranges of the key; each range is ranked by its own
    task and shifted by the rows in the ranges before it.
    """
    from starmill.plans.stores import written

    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = written(df.repartitionByRange(ranges, F.col(key)).withColumn("_block", F.spark_partition_id()))
    if cut.count() <= FEW:
        return cut.withColumn(name, (F.row_number().over(Window.orderBy(key)) + start).cast("long")).select(*df.columns, name)
    inside = cut.withColumn("_in", F.row_number().over(Window.partitionBy("_block").orderBy(key)))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range
    first = cut.groupBy("_block").count().withColumn("_first", F.coalesce(F.sum("count").over(before), F.lit(0))).select(F.col("_block").alias("_b"), "_first")
    return inside.join(first, F.col("_block") == F.col("_b")).withColumn(name, (F.col("_first") + F.col("_in") + start).cast("long")).select(*df.columns, name)


def distinct_keys(rows: DataFrame, column: str) -> DataFrame:
    """The normalised keys of a column, each once; blank ones are none."""
    return rows.select(normalize_key(F.col(column)).alias("key")).where("key IS NOT NULL").distinct()


def ensure_dimension(rows: DataFrame, column: str, existing: DataFrame | None, id_column: str = "id", key_column: str = "key") -> DataFrame:
    """(id, key) to append: keys that the dimension lacks, with ids after its largest, in key order."""
    keys = distinct_keys(rows, column)
    top = 0
    if existing is not None:
        keys = keys.join(existing.select(normalize_key(F.col(key_column)).alias("key")), "key", "left_anti")
        top = existing.agg(F.max(id_column)).first()[0] or 0
    return numbered(keys, "key", "_id", top).select(F.col("_id").alias(id_column), F.col("key").alias(key_column))


def lookup(rows: DataFrame, dimension: DataFrame, column: str, target: str, id_column: str = "id", key_column: str = "key", nullable: bool = False, strict: bool = False) -> DataFrame:
    """``target``: the id of the row's key. A blank key gives null where that is allowed; a miss, or a blank key where it isn't, drops the row, or ends the job if ``strict``."""
    dim = dimension.select(normalize_key(F.col(key_column)).alias("_key"), F.col(id_column).alias("_found")).where("_key IS NOT NULL")
    own = normalize_key(F.col(column))
    out = rows.withColumn("_own", own).join(dim, F.col("_own") == F.col("_key"), "left")
    ok = F.col("_found").isNotNull() | (F.lit(nullable) & F.col("_own").isNull())
    if strict:
        told = F.raise_error(F.concat(F.lit(f"lookup miss: {column}="), F.coalesce("_own", F.lit(""))))
        out = out.withColumn("_found", F.when(ok, F.col("_found")).otherwise(told.cast("long")))
    else:
        out = out.where(ok)
    return out.withColumn(target, F.col("_found")).drop("_own", "_key", "_found")


def needed_keys(dimension: DataFrame, rows: DataFrame, column: str, key_column: str = "key") -> DataFrame:
    """The dimension's rows whose key occurs in ``rows``."""
    keys = distinct_keys(rows, column).withColumnRenamed("key", "_need")
    return dimension.join(keys, normalize_key(F.col(key_column)) == F.col("_need"), "left_semi")


def project_fact(rows: DataFrame, columns: dict[str, str | None]) -> DataFrame:
    """target -> source; a source that isn't there gives null."""
    out = [F.col(s).alias(t) if s in rows.columns else F.lit(None).cast("string").alias(t) for t, s in columns.items()]
    keep = [ORDER] if ORDER in rows.columns else []
    return rows.select(*out, *keep)


def new_facts(rows: DataFrame, keys: list[str], existing: DataFrame | None = None, order: str = ORDER) -> DataFrame:
    """Rows to append: the first of each conflict key that the table lacks. A null in a key conflicts with nothing."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    loose = F.when(~whole, F.col(order))  # spreads such rows; all of them stay, even those of one order
    rank = F.row_number().over(Window.partitionBy(*keys, loose).orderBy(order))
    first = rows.withColumn("_rank", rank).where((F.col("_rank") == 1) | ~whole).drop("_rank")
    return first if existing is None else first.join(existing.select(*keys), keys, "left_anti").select(*rows.columns)


def minus(a: DataFrame, b: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows of ``a`` that ``b`` lacks; nulls equal nulls; repeated rows of ``a`` stay."""
    on = [a[c].eqNullSafe(b[c]) for c in columns or a.columns]
    return a.join(b, on, "left_anti")


def members(rows: DataFrame, ids: DataFrame, column: str, id_column: str) -> DataFrame:
    """Rows whose column is in a set of ids."""
    return rows.join(ids.select(F.col(id_column).alias("_member")), F.col(column) == F.col("_member"), "left_semi")


META = ("valid_from", "valid_to", "changed_at")


def _changed(hash_column: str | None, columns: list[str], window) -> Column:
    if hash_column:
        return ~F.col(hash_column).eqNullSafe(F.lag(hash_column).over(window))
    row = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})
    return ~row.eqNullSafe(F.lag(row).over(window))


def scd2(staged: DataFrame, keys: list[str], now: datetime | Column, current: DataFrame | None = None, surrogate: str | None = None, order: str = ORDER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(current, closed, affected) after merging ``staged``, in its order, into ``current``.

    A first row of a key is inserted, an equal one does nothing, a changed one closes
    the version before it. Versions of one batch that follow each other are closed at
    the batch's time too. Equality is by ``row_hash``, or by all columns without one.
    A null in a key never matches: such rows are always inserted. The surrogate key
    of a replaced version stays.
    """
    now = now if isinstance(now, Column) else F.lit(now)
    columns = [c for c in staged.columns if c != order]
    new = staged.select(*columns, F.col(order).cast("long").alias(order), now.cast("timestamp").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"), now.cast("timestamp").alias("changed_at"), F.lit(True).alias("_staged"))
    if surrogate and surrogate not in columns:
        new = new.withColumn(surrogate, F.lit(None).cast("long"))
    if current is not None:
        old = current.withColumn(order, F.lit(-1).cast("long")).withColumn("_staged", F.lit(False))
        new = new.unionByName(old, allowMissingColumns=True)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # rows with a null in the key are groups of their own
    new = new.withColumn("_alone", F.when(~whole, F.monotonically_increasing_id()))
    alone = F.col("_alone")
    w = Window.partitionBy(*keys, alone).orderBy(order)
    kept = new.withColumn("_keep", (F.row_number().over(w) == 1) | _changed("row_hash" if "row_hash" in columns else None, columns, w)).where("_keep")
    last = F.lead(F.lit(1)).over(w).isNull()
    kept = kept.withColumn("_last", last)
    if surrogate:
        kept = kept.withColumn(surrogate, F.coalesce(surrogate, F.max(surrogate).over(Window.partitionBy(*keys, alone))))
    drop = ["_keep", "_last", "_alone", order]
    live = kept.where("_last").drop(*drop, "_staged")
    closed = kept.where("NOT _last").withColumn("valid_to", now.cast("timestamp")).withColumn("changed_at", now.cast("timestamp")).drop(*drop, "_staged")
    affected = kept.where("_staged").drop(*drop, "_staged")
    return live, closed, affected
