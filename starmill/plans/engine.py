"""A pipeline's run: read, coerce, hash, check; then dimensions, then facts, into a store."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmill.functions.hashing import SEPARATOR, with_row_hash
from starmill.operators import load as L
from starmill.operators import stages as S
from starmill.plans import config as cfg
from starmill.plans import ddl
from starmill.plans.stores import ParquetStore, TableStore, open_store, temporary, written
from starmill.sources import csv, json_files, xml_files


@dataclass
class RunStats:
    processed: int = 0
    parse_errors: int = 0
    transform_rejected: int = 0
    validate_dropped: int = 0
    fact_dropped: int = 0
    all_conflicts: int = 0
    inserted: int = 0
    steps: dict[str, float] = field(default_factory=dict)

    @property
    def valid(self) -> int:
        return self.processed - self.transform_rejected - self.validate_dropped

    def rows(self, job: str) -> list[tuple[str, str, float]]:
        """(job, kind, value) for the table of metrics."""
        own = asdict(self)
        steps = own.pop("steps")
        return [(job, k, float(v)) for k, v in own.items()] + [(job, f"step:{k}", v) for k, v in steps.items()]


def _read_csv(spark, p: cfg.Pipeline, columns: list[str]) -> DataFrame:
    o = p.parser_options
    return csv.read_csv(spark, p.source["file"]["path"], columns, o.get("has_header", True), o.get("header_map"), o.get("comma", ","), o.get("trim_space", True), bool(o.get("stream_scrub_likvidaci")), int(o.get("fields_per_record", -1)), bool(o.get("lazy_quotes")))


def _read_json(spark, p: cfg.Pipeline, columns: list[str]) -> DataFrame:
    o = p.parser_options
    return json_files.read_documents(spark, p.source["file"]["path"], columns, o.get("header_map"), o.get("array_join", ","))


def _read_xml(spark, p: cfg.Pipeline, columns: list[str]) -> DataFrame:
    o = p.parser_options.get("xml_config") or p.parser_options
    c = xml_files.XmlConfig(o["record_tag"], o.get("fields") or {}, o.get("lists") or {})
    df = xml_files.read_xml(spark, p.source["file"]["path"], c)
    joined = [F.array_join(n, ",").alias(n) if n in c.lists else F.col(n) for n in df.columns]
    df = df.select(*joined)
    return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in columns], F.lit(None).cast("string").alias("_corrupt"))


READERS: dict[str, Callable[[SparkSession, cfg.Pipeline, list[str]], DataFrame]] = {"csv": _read_csv, "json": _read_json, "xml": _read_xml}


def staged(raw: DataFrame, p: cfg.Pipeline) -> DataFrame:
    """Raw text rows -> typed rows with ``reject_reason`` and ``reject_stage``; always coerce, hash, check in that order."""
    rows = S.coerce_rows(S.with_order(raw), p.types, p.layout)
    rows = rows.withColumn("reject_stage", F.when(F.col("reject_reason").isNotNull(), "transform"))
    h = p.first("hash")
    if h and h.get("fields"):
        rows = with_row_hash(rows, h["target_field"], h["fields"], names=h.get("include_field_names", False), separator=h.get("separator") or SEPARATOR, trimmed=h.get("trim_space", True))
    if p.contract:
        from starmill.functions.coerce import KINDS

        own = [f for f in p.contract if f["name"] in rows.columns]
        rows = S.check_rows(rows, [f["name"] for f in own if f.get("required")], {f["name"]: f["type"] for f in own if f.get("type") in KINDS.values()})
    return rows.withColumn("reject_stage", F.coalesce("reject_stage", F.when(F.col("reject_reason").isNotNull(), "validate")))


def validated(raw: DataFrame, p: cfg.Pipeline, stats: RunStats) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows). The rows are computed once: written, and read by both passes."""
    seen = Observation("rows")
    rows = staged(raw, p).observe(seen, F.count(F.lit(1)).alias("processed"), F.count_if(F.col("_corrupt").isNotNull()).alias("corrupt"), F.count_if(F.col("reject_stage") == "transform").alias("transform"), F.count_if(F.col("reject_stage") == "validate").alias("validate"))
    rows = written(rows)
    got = seen.get
    stats.processed, stats.parse_errors, stats.transform_rejected, stats.validate_dropped = got["processed"], got["corrupt"], got["transform"], got["validate"]
    return rows.where("reject_reason IS NULL").drop("reject_reason", "reject_stage", "_corrupt"), rows.where("reject_reason IS NOT NULL")


def load_dimensions(valid: DataFrame, p: cfg.Pipeline, store: TableStore, only: str | None = None) -> None:
    for t in sorted((t for t in p.tables if t.kind == "dimension" and only in (None, t.name)), key=lambda t: t.name):
        had = store.read(t)
        new = L.ensure_dimension(valid, t.sources[0].field, had, t.cache_value, t.cache_key)
        kind = ddl.schema(t)[t.cache_key].dataType if t.cache_key in t.columns else None
        new = new.withColumn(t.cache_key, F.col(t.cache_key).cast(kind)) if kind else new
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in ddl.schema(t) if f.name not in new.columns]
        store.append(t, new.select("*", *rest))


def fact_rows(valid: DataFrame, t: cfg.Table, p: cfg.Pipeline, store: TableStore) -> DataFrame:
    """The fact's rows in source order: ids looked up, other columns projected; rows without their ids are gone."""
    by = {x.name: x for x in p.tables}
    rows, columns = valid, {}
    for s in t.sources:
        if s.table:
            dim = by[s.table]
            rows = L.lookup(rows, store.read(dim), s.key, f"_id_{s.target}", dim.cache_value, dim.cache_key, t.nullable(s.target), p.strict)
            columns[s.target] = f"_id_{s.target}"
        else:
            columns[s.target] = s.field
    return L.project_fact(rows, columns)


def load_fact(valid: DataFrame, t: cfg.Table, p: cfg.Pipeline, store: TableStore, stats: RunStats, now: datetime, batch: str | None = None) -> None:
    """One fact's rows into its table; a ``batch`` that is in it already is left out whole."""
    if batch is not None and store.has_batch(t, batch):
        return
    seen, kept = Observation(f"rows-{t.name}"), Observation(f"new-{t.name}")
    rows = fact_rows(valid, t, p, store).observe(seen, F.count(F.lit(1)).alias("n"))
    had = store.read(t)
    # a table may have columns that no source fills; the history's are filled by the merge
    wanted = [f for f in ddl.schema(t) if f.name in rows.columns]
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted], *[c for c in rows.columns if c not in {f.name for f in wanted}])
    if t.history:
        rows = written(rows)
        stats.fact_dropped += stats.valid - seen.get["n"]
        live, closed, affected = L.scd2(rows, t.business_key, now, had, t.primary_key)
        live, closed, n = written(live), written(closed), affected.count()
        if t.primary_key:
            live = _with_key(live, t.primary_key)
        store.merge(t, live, closed, batch)
        stats.inserted += n
        return
    if t.conflict:
        rows = L.new_facts(rows, t.conflict, had)
    new = rows.observe(kept, F.count(F.lit(1)).alias("n"))
    if t.primary_key and t.primary_key not in new.columns:
        top = (had.agg(F.max(t.primary_key)).first()[0] or 0) if had is not None else 0
        new = L.numbered(written(new), S.ORDER, t.primary_key, top)
    elif not isinstance(store, ParquetStore):
        new = written(new)  # those stores may read their input more than once
    store.append(t, new.drop(S.ORDER), batch)
    n = kept.get["n"]
    stats.fact_dropped += stats.valid - seen.get["n"]
    stats.all_conflicts += seen.get["n"] - n
    stats.inserted += n


def _with_key(live: DataFrame, key: str) -> DataFrame:
    top = live.agg(F.max(key)).first()[0] or 0
    fresh = live.where(F.col(key).isNull()).drop(key).withColumn("_at", F.monotonically_increasing_id())
    return live.where(F.col(key).isNotNull()).unionByName(L.numbered(fresh, "_at", key, top).drop("_at"))


def run(spark: SparkSession, p: cfg.Pipeline, store: TableStore | None = None, raw: DataFrame | None = None, now: datetime | None = None, batch: str | None = None, only: str | None = None) -> RunStats:
    """Both passes of a pipeline over its source (or ``raw``). ``batch``: a name under which each fact takes these rows at most once; ``only``: the one table to load."""
    if raw is None:
        cfg.check(p)
        raw = READERS[p.parser](spark, p, p.input_columns())
    if "_corrupt" not in raw.columns:
        raw = raw.withColumn("_corrupt", F.lit(None).cast("string"))
    store = store or open_store(spark, p.storage, p.dsn)
    stats, now = RunStats(), now or datetime.now(UTC).replace(tzinfo=None)
    at = time.time()
    with temporary(spark):
        valid, _ = validated(raw, p, stats)
        stats.steps["read"], at = time.time() - at, time.time()
        load_dimensions(valid, p, store, only)
        stats.steps["pass1_ensure_dims"], at = time.time() - at, time.time()
        for t in sorted((t for t in p.tables if t.kind == "fact" and only in (None, t.name)), key=lambda t: t.name):
            load_fact(valid, t, p, store, stats, now, batch)
        stats.steps["pass2_load_facts"] = time.time() - at
    return stats
