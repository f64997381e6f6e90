"""Column profiles: totals, distinct values, types, layouts, percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions import coerce as C
from starmill.functions.text import blank_to_null

CAP = 10_000


def uniqueness(df: DataFrame, columns: list[str] | None = None, cap: int = CAP, exact: bool = True) -> DataFrame:
    """(column_name, total, distinct_count, capped, ratio): filled cells and distinct values, in one pass. ``exact`` off: a sketch."""
    names = columns or df.columns
    count = F.count_distinct if exact else F.approx_count_distinct
    text = lambda c: blank_to_null(F.col(c).cast("string"))
    one = df.agg(*[F.count(text(c)).alias(f"t_{i}") for i, c in enumerate(names)], *[count(text(c)).alias(f"d_{i}") for i, c in enumerate(names)])
    parts = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"t_{i}").alias("total"), F.col(f"d_{i}").alias("d")) for i, c in enumerate(names)])
    out = one.select(F.explode(parts).alias("x")).select("x.column_name", "x.total", F.least("x.d", F.lit(cap).cast("long")).alias("distinct_count"), (F.col("x.d") > cap).alias("capped"))
    return out.withColumn("ratio", F.when(F.col("total") > 0, F.round(F.col("distinct_count") / F.col("total"), 6)).otherwise(F.lit(0.0)))


def report(profile: DataFrame) -> DataFrame:
    return profile.orderBy("ratio", "column_name")


def report_json(profile: DataFrame) -> DataFrame:
    """The report as one JSON object a column (column ``line``), least unique first."""
    return report(profile).select(F.to_json(F.struct("column_name", "total", "distinct_count", "capped", "ratio")).alias("line"))


def breakouts(profile: DataFrame, most: int = 5, ratio: float = 0.9, skip: tuple[str, ...] = ("row_hash",)) -> DataFrame:
    """The columns worth a dimension: the lowest ratios of distinct values."""
    return profile.where((F.col("distinct_count") > 0) & (F.col("ratio") <= ratio) & ~F.col("column_name").isin(*skip)).orderBy("ratio", "column_name").limit(most)


def key_column(profile: DataFrame, columns: list[str]) -> str:
    """The column with most distinct values; the first of equals."""
    at = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(-i))])
    return profile.agg(F.max_by("column_name", F.struct("distinct_count", F.element_at(at, F.col("column_name"))))).first()[0]


TYPES = ("integer", "boolean", "date", "timestamp", "float")


def infer_types(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, inferred_type): the first type that reads all filled cells; text if none, or without any."""
    names = columns or df.columns
    # a row a cell, so that the tests are compiled once, whatever the number of columns
    cells = df.select(F.posexplode(F.array(*[F.col(c).cast("string") for c in names])).alias("at", "raw")).select("at", blank_to_null(F.col("raw")).alias("s"))
    s = F.col("s")
    reads = {"integer": s.rlike(r"^[+-]?\d+$") & s.try_cast("bigint").isNotNull(), "boolean": C.loose_bool(s).isNotNull(), "date": C.loose_date(s).isNotNull(), "timestamp": C.loose_timestamp(s).isNotNull(), "float": s.try_cast("double").isNotNull()}
    one = cells.groupBy("at").agg(F.count("s").alias("n"), *[F.bool_and(s.isNull() | F.coalesce(reads[t], F.lit(False))).alias(t) for t in TYPES])
    kind = F.coalesce(*[F.when((F.col("n") > 0) & F.col(t), t) for t in TYPES], F.lit("text"))
    # a row a column; of an empty table, none comes
    told = df.sparkSession.createDataFrame([(i, n) for i, n in enumerate(names)], "place int, column_name string")
    return told.join(one.select("at", kind.alias("kind")), F.col("place") == F.col("at"), "left").orderBy("place").select("column_name", F.coalesce("kind", F.lit("text")).alias("inferred_type"))


def majority_layout(df: DataFrame, column: str) -> DataFrame:
    """(layout, n) of the layout that reads most cells; the earlier name of equals."""
    return df.select(C.loose_date_layout(F.col(column).cast("string")).alias("layout")).where("layout IS NOT NULL").groupBy("layout").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "layout").limit(1)


PERCENTS = (50, 90, 95, 99)


def percentiles(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Nearest-rank p50, p90, p95, p99, max and count of a value by group: the row at place int(p (n - 1) + 0.5).

    Counts of distinct values are cut into ranges of (group, value); a table of the
    ranges' sums gives each what is before it, so that no task gets a whole group.
    """
    from starmill.plans.stores import written

    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("_n"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = written(counts.repartitionByRange(ranges, *groups, value).withColumn("_block", F.spark_partition_id()))
    # a row for each range and group in it
    sums = cut.groupBy(*groups, "_block").agg(F.sum("_n").alias("_sum"))
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).withColumn("_all", F.sum("_sum").over(Window.partitionBy(*groups)))
    sums = sums.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_block").alias("_b"), "_before", "_all")
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)] + [F.col("_block") == F.col("_b")]
    inside = Window.partitionBy(*groups, "_block").orderBy(value)
    run = cut.withColumn("_in", F.sum("_n").over(inside)).join(sums, same).withColumn("_to", F.col("_before") + F.col("_in"))
    place = lambda p: F.floor(F.lit(p / 100) * (F.col("_all") - 1) + 0.5)
    return run.groupBy(*groups).agg(*[F.min(F.when(F.col("_to") > place(p), F.col(value))).alias(f"p{p}") for p in PERCENTS], F.max(value).alias("max"), F.sum("_n").alias("count"))


def totals(df: DataFrame, labels: list[str], value: str) -> DataFrame:
    """Counter sums by label; counts that aren't positive are left out."""
    return df.where(F.col(value) > 0).groupBy(*labels).agg(F.sum(value).alias("total"))


def paths(df: DataFrame, record: str, path: str, text: str, examples: int = 3) -> DataFrame:
    """Per path: occurrences, records that have it, most in a record, and up to three examples."""
    per = df.groupBy(path, record).agg(F.count("*").alias("_n"))
    shape = per.groupBy(path).agg(F.sum("_n").alias("count"), F.count("*").alias("records_with"), F.max("_n").alias("max_per_record"))
    # the least distinct values, by rank: no list of all of them is built
    least = df.where(F.col(text) != "").select(path, text).distinct().withColumn("_r", F.row_number().over(Window.partitionBy(path).orderBy(text))).where(F.col("_r") <= examples)
    shown = least.groupBy(path).agg(F.array_sort(F.collect_list(text)).alias("examples"))
    return shape.join(shown, path, "left")
