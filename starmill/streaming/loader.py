"""The same load over files that keep arriving: micro-batches through the batch engine."""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starmill.plans import config as cfg
from starmill.plans import engine
from starmill.plans.stores import TableStore


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def states_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB instead of the executors' heap; a provider that is set stays."""
    had = spark.conf.get(_PROVIDER, None)
    if had is None or had.endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if had is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, had)


def load_stream(stream: DataFrame, p: cfg.Pipeline, store: TableStore, checkpoint: str, told: Callable[[int, engine.RunStats], None] | None = None) -> StreamingQuery:
    """Run the pipeline on each micro-batch of raw text rows, until what is there has been read. A batch that runs again changes nothing: each fact takes it once, by its name, and dimensions append only new keys."""
    # a batch's number means something together with its checkpoint alone
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def one(batch: DataFrame, number: int) -> None:
        stats = engine.run(batch.sparkSession, p, store, batch, batch=f"{name}-{number}")
        if told:
            told(number, stats)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def csv_stream(spark: SparkSession, folder: str, columns: list[str], files_per_batch: int = 1, sep: str = ",") -> DataFrame:
    """New CSV files of a folder as text columns, with headers."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.readStream.schema(schema).option("header", "true").option("escape", '"').option("sep", sep).option("maxFilesPerTrigger", files_per_batch).csv(folder)


def latest_only(stream: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """Repeats of a key within ``late`` of each other are dropped; state older than that is, too."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, late: str, width: str, *by: str) -> DataFrame:
    """Counts by event-time window; rows later than ``late`` are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *by).agg(F.count("*").alias("n"))


def sliding_counts(stream: DataFrame, time: str, late: str, width: str, step: str, *by: str) -> DataFrame:
    """Counts by event-time windows that begin every ``step``."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width, step), *by).agg(F.count("*").alias("n"))


def session_counts(stream: DataFrame, time: str, late: str, gap: str, *by: str) -> DataFrame:
    """Counts by sessions: rows of a key with less than ``gap`` between them."""
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap), *by).agg(F.count("*").alias("n"))
