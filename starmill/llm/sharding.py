"""Rendezvous hashing over weighted shards, in DataFrame expressions only.

Every shard draws a number for a key from their common hash; with u uniform in
(0, 1) and a shard's weight w, the draw is -ln(u) / w, and the least draw takes
the record. A shard is chosen with probability w / sum of weights, by the key and
the shards alone, so a new shard takes records only into itself and a removed
one gives up only its own.

Defined results: a null key is a key like any other, all its rows share a shard;
repeated keys share a shard; null texts have 0 bytes and the crc32 of nothing;
slots follow (key, crc32, size), so that rows equal in all three may swap places;
extra columns are ignored by ``place`` and kept by ``write_shards``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import distributed_rank, table

ROW_BYTES = 16


@dataclass(frozen=True)
class Shard:
    number: int
    weight: float = 1.0


def even(n: int) -> list[Shard]:
    return [Shard(i) for i in range(n)]


def draw(key: Column, shard: Shard) -> Column:
    """The shard's draw for ``key``; 53 bits of the hash make u, never 0 or 1."""
    bits = F.shiftrightunsigned(F.xxhash64(F.coalesce(key.cast("string"), F.lit("\x00null")), F.lit(shard.number)), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / shard.weight


def shard_of(key: Column, shards: list[Shard]) -> Column:
    """The number of the shard that takes ``key``; equal draws take the lower number."""
    if not shards or any(s.weight <= 0 for s in shards):
        raise ValueError("shards need positive weights, and there must be one")
    draws = [F.struct(draw(key, s).alias("draw"), F.lit(s.number).alias("shard")) for s in shards]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def place(docs: DataFrame, shards: list[Shard], grown: list[Shard] | None = None, key: str = "doc_id") -> DataFrame:
    """Key, size, text_crc32, shard, slot in the shard, and the shard after growing to ``grown``; a row per row of ``docs``."""
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = docs.select(
        F.col(key),
        (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        shard_of(F.col(key), shards).alias("shard"),
        (shard_of(F.col(key), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    return distributed_rank(rows, ["shard"], [F.col(key).asc_nulls_last(), F.col("text_crc32"), F.col("size")], F.col(key), "slot")


def write_shards(docs: DataFrame, shards: list[Shard], path: str, key: str = "doc_id", files_per_shard: int = 1) -> None:
    """Parquet folders shard=N with the rows of each shard; a large shard has several files."""
    cut = docs.withColumn("shard", shard_of(F.col(key), shards)).withColumn("_file", F.pmod(F.xxhash64(key), F.lit(files_per_shard)))
    dealt = cut.repartition(len(shards) * files_per_shard, "shard", "_file").sortWithinPartitions("shard", key)
    dealt.drop("_file").write.partitionBy("shard").parquet(path)


def op6(spark, sf_dir: str) -> DataFrame:
    out = place(table(spark, sf_dir, "documents"), even(40), even(41))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
