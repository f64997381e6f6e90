"""Helpers shared by the operators of this subpackage.

Everything that must outlive a stage goes to ``spark.checkpoint.dir``, the one
folder that driver and executors share; nothing relies on machine-local files.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.plans.stores import shared_dir

# --------------------------------------------------------------------------
# scratch tables


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/starmill-{name}-{uuid.uuid4().hex}"


def spill(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop_scratch(*frames: DataFrame) -> None:
    """Delete written tables that no later plan reads."""
    for df in frames:
        path = getattr(df, "_scratch", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def drop_path(spark: SparkSession, *paths: str) -> None:
    """Delete folders of the shared folder."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def open_folder(folder: str):
    """(file system, path) of a folder's URI, for tasks that write files of their own."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


@contextlib.contextmanager
def rows_per_batch(spark: SparkSession, most: int) -> Iterator[None]:
    """Actions inside send tasks' Python at most so many rows at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def tidy(run):
    """``run`` over a task's batches; at its end, free memory goes back to the system: the worker stays for the next stage."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return tidied


def free_shuffles(spark: SparkSession) -> None:
    """Let the context cleaner drop shuffle files of finished jobs."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------------
# groups of sorted rows, in a task


def sorted_groups(batches: Iterator[pa.RecordBatch], names: list[str], most: int) -> Iterator[tuple[dict[str, np.ndarray], bool]]:
    """Columns of batches sorted by the first of ``names``, cut so that no group is split (True); a group that is met in several batches and has over ``most`` rows comes in slices of about that size (False)."""
    held, rows, big, current = [], 0, False, None
    join = lambda parts: {n: np.concatenate([p[n] for p in parts]) for n in names} if len(parts) > 1 else parts[0]
    for batch in batches:
        got = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        key, at = got[names[0]], 0
        while at < len(key):
            if current is not None and key[at] != current:
                if held:
                    yield join(held), not big
                held, rows, big, current = [], 0, False, None
            if current is None:
                last = int(np.searchsorted(key, key[-1], "left"))
                if last > at:
                    yield {n: x[at:last] for n, x in got.items()}, True
                    at = last
                current = key[-1]
            end = int(np.searchsorted(key, current, "right"))
            held.append({n: x[at:end] for n, x in got.items()})
            rows, at = rows + end - at, end
            if rows > most:
                yield join(held), False
                held, rows, big = [], 0, True
    if held:
        yield join(held), not big


# --------------------------------------------------------------------------
# order keys and ranks


def ordered_documents(docs: DataFrame, *extra: str) -> tuple[DataFrame, DataFrame | None]:
    """``_ord`` (unique, ascending with doc_id), doc_id, text and ``extra`` of ``docs``; and the table to drop, if one was written.

    doc_id itself is the key while it is a whole number, unique and never null. Otherwise rows are
    ranged by doc_id (null last) and then text, and a row's place gives its key, so
    that repeated rows are separate documents in a fixed order.
    """
    slim = docs.select("doc_id", "text", *extra)
    odd = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1)
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType) and not odd.take(1):
        return slim.withColumn("_ord", F.col("doc_id").cast("long")), None
    placed = slim.sort(F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first(), *extra)
    kept = spill(placed.withColumn("_ord", F.monotonically_increasing_id()), "ordered")
    return kept, kept


def distributed_rank(df: DataFrame, groups: list[str], order: list[Column], spread: Column, name: str) -> DataFrame:
    """Add ``name``: a rank from 0, gapless in each group, that no task computes for a whole group.

    Rows are dealt by (group, block of ``spread``); a table of the blocks' counts
    gives each block the number of rows in the blocks before it.
    """
    blocks = partitions(df.sparkSession)
    cut = df.withColumn("_block", F.pmod(F.xxhash64(spread), F.lit(blocks)).cast("int"))
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = cut.groupBy(*groups, "_block").agg(F.count("*").alias("_n")).withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    first = first.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_block").alias("_b"), "_first")
    inside = Window.partitionBy(*groups, "_block").orderBy(*order)
    ranked = cut.withColumn("_in", F.row_number().over(inside) - 1)
    match = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)] + [F.col("_block") == F.col("_b")]
    out = ranked.join(first, match, "left")
    return out.select(*df.columns, (F.col("_first") + F.col("_in")).cast("long").alias(name))


# --------------------------------------------------------------------------
# a bounded set of hashes that tasks can test against


def hash_bits(df: DataFrame, col: str, bits: int) -> np.ndarray:
    """A bit set of 2**bits positions, holding the low bits of ``col`` (long) of every row; 2**bits / 8 bytes whatever the rows."""
    low = df.select(F.col(col).bitwiseAND(F.lit((1 << bits) - 1)).alias("p")).distinct()
    low = low.select(F.shiftright("p", 15).cast("int").alias("block"), F.col("p").bitwiseAND(F.lit(32767)).cast("int").alias("at"))

    def fold(pdf):
        import pandas as pd

        b = np.zeros(32768, np.uint8)
        b[pdf["at"].to_numpy()] = 1
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "bits": [np.packbits(b, bitorder="little").tobytes()]})

    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in low.groupBy("block").applyInPandas(fold, "block int, bits binary").toLocalIterator():
        out[r["block"] * 4096 : r["block"] * 4096 + 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def in_bits(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    p = h.astype(np.uint64) & np.uint64(len(bits) * 8 - 1)
    return (bits[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 != 0


# --------------------------------------------------------------------------
# connected components


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the least node reachable. Label passing with pointer jumps; every round is written, and a round that moves no label, which only ever fall, is the last."""
    both = spill(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = spill(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("n")).agg(F.min("component").alias("m"))
        step = labels.join(near, F.col("node") == F.col("n"), "left").select("node", "component", F.least("component", "m").alias("c"))
        up = labels.select(F.col("node").alias("u"), F.col("component").alias("top"))
        step = step.join(up, F.col("c") == F.col("u"), "left").select("node", F.least("c", "top").alias("component"), (F.least("c", "top") < F.col("component")).alias("moved"))
        new = spill(step, "labels")
        drop_scratch(labels)
        labels = new
        if not labels.where("moved").limit(1).count():
            break
    drop_scratch(both)
    out = labels.select("node", "component")
    out._scratch = labels._scratch
    return out


# --------------------------------------------------------------------------
# byte kernels: whole chunks of texts at once, in numpy

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_U = np.uint64


def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)


BYTE = _table(20240611)
LOWER = np.arange(256)
LOWER[65:91] += 32
BYTE_LOWER = BYTE[LOWER]

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses modulo 2**64, up to n."""
    if n >= len(_powers.get("up", ())):
        size = max(n + 1, 1 << 16)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            a = np.full(size, _U(base), dtype=np.uint64)
            a[0] = 1
            _powers[key] = np.cumprod(a, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads all bits."""
    h = h ^ (h >> _U(32))
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


def prefix_hash(data: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """H with H[e] - H[s] the sum of byte[data[i]] * base**i for s <= i < e."""
    up, _ = powers(len(data) + 1)
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(byte[data] * up[: len(data)], dtype=np.uint64, out=out[1:])
    return out


def span_hash(h: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hash of the bytes s..e of each span, whatever their place."""
    _, down = powers(len(h))
    return mix((h[e] - h[s]) * down[s])


def chunks(col: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts, of about ``limit`` bytes; null texts are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if not n:
        return
    wide = pa.types.is_large_string(col.type)
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32, n + 1, col.offset * (8 if wide else 4)).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, end, raw[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def words(data: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of maximal runs of bytes with ``inside``; no run crosses a text's border."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    w = inside[data]
    start = w.copy()
    start[1:] &= ~w[:-1]
    border = offs[1:-1]
    border = border[border < len(data)]
    start[border] = w[border]
    s = np.flatnonzero(start)
    last = w.copy()
    last[:-1] &= ~w[1:]
    back = border[border > 0] - 1
    last[back] = w[back]
    e = np.flatnonzero(last) + 1
    return s, e, np.searchsorted(offs, s, "right") - 1


SPACE = np.ones(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
"""True for the bytes of words cut at white space."""

ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
"""True for ASCII letters, digits and all bytes beyond ASCII."""
