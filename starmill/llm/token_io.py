"""Token ids in raw payload files, found by a minimal perfect hash index.

Format: ``ids-NNNNN.bin`` holds the ids of one range of documents in ascending key
order, each document's ids and then the end id, with nothing between; a 16-byte
head gives the magic, the width of an id (2 bytes where the vocabulary allows it,
else 4) and zeros. Files are written under a name of their own and renamed, so
that a task that runs again after a lost executor replaces its file whole.

Index: keys are dealt by hash into buckets of about ``BUCKET`` keys; each bucket
is one row with a minimal perfect hash of its keys (levels of bits, a key takes
the first level where it is alone; its number is the count of ones before it) and,
by that number, a 32-bit fingerprint, file, first id and number of ids. A key that isn't
there is told by its fingerprint, but for one in 2**32. ``lookup`` joins many keys with
the rows; ``Reader`` reads single keys from the same index in files, a constant number
of short reads each, without Spark.

Defined results: null and empty texts have the end id alone; keys are doc_ids, or,
where those repeat or are null, the rows' places in the order (doc_id, null last;
text), so that each row keeps its own entry; very long texts are encoded whole; an empty table
gives no files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import mix, open_folder, ordered_documents, partitions, scratch, spill, table
from starmill.llm.tokens import encoder, id_width, with_end

MAGIC = b"STARMIDS"
HEAD = 16
BUCKET = 65536
GAMMA = 2.0


# -- files


_open = open_folder


def _write(folder: str, path: str | None, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, shard = encoder(path), TaskContext.get().partitionId()
        store, root = _open(folder)
        out, at, name = None, 0, f"{root}/ids-{shard:05d}.bin"
        temp = f"{name}.{uuid.uuid4().hex}"
        for batch in batches:
            if not len(batch):
                continue
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(temp)
                out.write(struct.pack("<8sII", MAGIC, width, 0))
            lengths = np.empty(len(batch), np.int64)
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = with_end(encode(text or ""))
                lengths[i] = len(ids)
                out.write(ids.astype(f"<u{width}").tobytes())
            first = at + np.cumsum(lengths) - lengths
            at += int(lengths.sum())
            yield pa.RecordBatch.from_arrays([batch.column("_ord"), batch.column("doc_id"), pa.array(np.full(len(batch), shard, np.int32)), pa.array(first), pa.array(lengths)], names=["key", "doc_id", "shard", "first", "n"])
        if out is not None:
            out.close()
            store.move(temp, name)

    return run


def write_ids(docs: DataFrame, folder: str, path: str | None = None, width: int | None = None, shards: int | None = None) -> DataFrame:
    """Write the files; returns a written table (key, doc_id, shard, first, n). ``width``: bytes an id; None takes what the vocabulary needs."""
    need = id_width(path)
    if width is not None and width not in (need, 4):
        raise ValueError(f"ids of this vocabulary need {need} bytes")
    width = width or need
    slim, _ = ordered_documents(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ranged = slim.select("_ord", "doc_id", "text").repartitionByRange(shards or partitions(docs.sparkSession), "_ord").sortWithinPartitions("_ord")
    return spill(ranged.mapInArrow(_write(folder, path, width), f"key long, doc_id {id_type}, shard int, first long, n long"), "ids")


# -- the index


def build_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes of the levels, all bits packed) of a minimal perfect hash of distinct 64-bit keys."""
    sizes, bits, left = [], [], keys.astype(np.uint64)
    while len(left):
        m = max(64, -(-int(GAMMA * len(left)) // 64) * 64)
        at = (mix(left ^ np.uint64(0x9E3779B97F4A7C15 * (len(sizes) + 1) & (1 << 64) - 1)) % np.uint64(m)).astype(np.int64)
        n = np.bincount(at, minlength=m)
        sizes.append(m)
        bits.append(n == 1)
        left = left[n[at] != 1]
        if len(sizes) > 200:
            raise ValueError("keys repeat")
    return np.array(sizes, np.int64), np.packbits(np.concatenate(bits) if bits else np.zeros(0, bool), bitorder="little")


def ranks(packed: np.ndarray) -> np.ndarray:
    """The number of ones before each 64-bit word of ``packed``."""
    ones = np.bitwise_count(packed.view("<u8")).astype(np.uint32)
    return np.cumsum(ones, dtype=np.uint32) - ones


def place_of(keys: np.ndarray, level: int, m: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) % np.uint64(m)).astype(np.int64)


def find_hash(sizes: np.ndarray, packed: np.ndarray, keys: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """Each key's number from 0; -1 where no level has it. A key costs a word of bits a level, and one rank."""
    if not len(packed):
        return np.full(len(keys), -1, np.int64)
    words = packed.view("<u8")
    before = ranks(packed) if before is None else before
    out = np.full(len(keys), -1, np.int64)
    open_, base = np.arange(len(keys)), 0
    for level, m in enumerate(sizes):
        if not len(open_):
            break
        at = base + place_of(keys[open_], level, int(m))
        word, bit = words[at >> 6], (at & 63).astype(np.uint64)
        hit = (word >> bit) & np.uint64(1) != 0
        low = word & ((np.uint64(1) << bit) - np.uint64(1))
        out[open_[hit]] = (before[at >> 6] + np.bitwise_count(low))[hit]
        open_, base = open_[~hit], base + int(m)
    return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.astype(np.uint64) * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(32)).astype(np.uint32)


def _bucket(col: str, buckets: int):
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    keys = pdf["key"].to_numpy(np.int64)
    sizes, bits = build_hash(keys)
    at = find_hash(sizes, bits, keys)
    order = np.empty(len(keys), np.int64)
    order[at] = np.arange(len(keys))
    pick = lambda x, t: x[order].astype(t).tobytes()
    return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "sizes": [sizes.tobytes()], "bits": [bits.tobytes()], "ranks": [ranks(bits).tobytes()], "prints": [pick(fingerprint(keys), "<u4")], "shards": [pick(pdf["shard"].to_numpy(), "<i4")], "firsts": [pick(pdf["first"].to_numpy(), "<i8")], "lengths": [pick(pdf["n"].to_numpy(), "<i8")]})


INDEX = "bucket int, sizes binary, bits binary, ranks binary, prints binary, shards binary, firsts binary, lengths binary"


def build_index(entries: DataFrame) -> tuple[DataFrame, int]:
    """The index of (key, shard, first, n), a row per bucket, written; and the number of buckets. Buckets are even, as keys are distinct and dealt by hash."""
    buckets = max(1, -(-entries.count() // BUCKET))
    rows = entries.select("key", "shard", "first", "n", _bucket("key", buckets).alias("bucket"))
    return spill(rows.groupBy("bucket").applyInPandas(_build, INDEX), "mph"), buckets


def lookup(keys: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """(key, shard, first, n) of the keys (column ``key``, long) that the index has."""

    def find(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"key": np.zeros(0, np.int64), "shard": np.zeros(0, np.int32), "first": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
        r, k = held.iloc[0], asked["key"].to_numpy(np.int64)
        at = find_hash(np.frombuffer(r["sizes"], np.int64), np.frombuffer(r["bits"], np.uint8), k, np.frombuffer(r["ranks"], np.uint32))
        ok = at >= 0
        ok[ok] = np.frombuffer(r["prints"], "<u4")[at[ok]] == fingerprint(k[ok])
        at = at[ok]
        return pd.DataFrame({"key": k[ok], "shard": np.frombuffer(r["shards"], "<i4")[at], "first": np.frombuffer(r["firsts"], "<i8")[at], "n": np.frombuffer(r["lengths"], "<i8")[at]})

    asked = keys.select("key", _bucket("key", buckets).alias("bucket")).groupBy("bucket")
    return asked.cogroup(index.groupBy("bucket")).applyInPandas(find, "key long, shard int, first long, n long")


# -- the index as files, read by key


def export_index(index: DataFrame, folder: str) -> None:
    """A file for each bucket: the lengths of its parts, then the parts as they are in the row."""
    parts = ("sizes", "bits", "ranks", "prints", "shards", "firsts", "lengths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for r in batch.to_pylist():
                name = f"{root}/index-{r['bucket']:08d}.bin"
                temp = f"{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(temp) as out:
                    out.write(struct.pack("<7q", *(len(r[p]) for p in parts)) + b"".join(bytes(r[p]) for p in parts))
                store.move(temp, name)
            yield batch.select(["bucket"])

    index.mapInArrow(run, "bucket int").agg(F.count("*")).collect()  # one row


class Reader:
    """Ids by key: a word of bits for each level of the hash, one rank, one fingerprint, one entry, and the ids themselves are read; the number of reads doesn't grow with the files."""

    def __init__(self, index: str, payload: str, buckets: int):
        self.store, self.root = open_folder(index)
        self.payload, self.ids = open_folder(payload)
        self.buckets = buckets

    def bucket(self, key: int) -> int:
        import xxhash

        h = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)  # as Spark's xxhash64
        return (h - (1 << 64) if h >> 63 else h) % self.buckets

    def entry(self, key: int) -> tuple[int, int, int] | None:
        """(shard, first id, number of ids) of a key; None if it isn't there."""
        name = f"{self.root}/index-{self.bucket(key):08d}.bin"
        if not self.store.get_file_info(name).is_file:
            return None
        with self.store.open_input_file(name) as f:
            lengths = struct.unpack("<7q", f.read_at(56, 0))
            start = np.concatenate([[56], 56 + np.cumsum(lengths)]).tolist()
            one, base = np.array([key], np.int64), 0
            for level, m in enumerate(np.frombuffer(f.read_at(lengths[0], start[0]), "<i8").tolist()):
                at = base + int(place_of(one, level, m)[0])
                word = int.from_bytes(f.read_at(8, start[1] + (at >> 6) * 8), "little")
                if word >> (at & 63) & 1:
                    rank = int.from_bytes(f.read_at(4, start[2] + (at >> 6) * 4), "little")
                    i = rank + (word & ((1 << (at & 63)) - 1)).bit_count()
                    if f.read_at(4, start[3] + 4 * i) != fingerprint(one).astype("<u4").tobytes():
                        return None
                    whole = lambda p, w: int.from_bytes(f.read_at(w, start[p] + w * i), "little")  # noqa: B023, E731
                    return whole(4, 4), whole(5, 8), whole(6, 8)
                base += m
        return None

    def get(self, key: int) -> np.ndarray | None:
        """A document's ids, end id included."""
        found = self.entry(key)
        return None if found is None else read_ids(self.payload, self.ids, *found)


def read_ids(store, root: str, shard: int, first: int, n: int) -> np.ndarray:
    """One document's ids, end id included."""
    with store.open_input_file(f"{root}/ids-{shard:05d}.bin") as f:
        return _ids(f, first, n)


def _ids(f, first: int, n: int, width: int | None = None) -> np.ndarray:
    if width is None:
        magic, width, _ = struct.unpack("<8sII", f.read_at(HEAD, 0))
        if magic != MAGIC:
            raise ValueError("not a file of ids")
    raw = f.read_at(n * width, HEAD + first * width)
    if len(raw) != n * width:
        raise ValueError("the file ends too early")
    return np.frombuffer(raw, f"<u{width}")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        held, f = -1, None
        for batch in batches:
            shard, first, n = (batch.column(c).to_numpy() for c in ("shard", "first", "n"))
            crc = np.empty(len(batch), np.int64)
            for i in range(len(batch)):
                if shard[i] != held:
                    if f is not None:
                        f.close()
                    held, f = int(shard[i]), store.open_input_file(f"{root}/ids-{int(shard[i]):05d}.bin")
                crc[i] = zlib.crc32(_ids(f, int(first[i]), int(n[i])).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("shard"), batch.column("first"), batch.column("n"), pa.array(crc)], names=["key", "shard", "first", "n", "ids_crc32"])
        if f is not None:
            f.close()

    return run


def op7(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "payload")
    entries = write_ids(docs, folder)
    index, buckets = build_index(entries)
    found = lookup(entries.select("key"), index, buckets)
    # in file order, a task per range of files: reads go forward through each file
    dealt = found.repartitionByRange(partitions(spark), "shard", "first").sortWithinPartitions("shard", "first")
    read = dealt.mapInArrow(_read(folder), "key long, shard int, first long, n long, ids_crc32 long")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each file
    starts = entries.groupBy("shard").agg(F.sum("n").alias("total")).select(F.col("shard").alias("s"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    names = entries.select(F.col("key").alias("k"), "doc_id")
    out = read.join(starts, F.col("shard") == F.col("s"))
    if dict(entries.dtypes)["doc_id"] == "bigint" and not entries.where("doc_id IS NULL OR doc_id <> key").limit(1).count():
        return out.select(F.col("key").alias("doc_id"), (F.col("base") + F.col("first")).alias("start"), F.col("n").alias("n_tokens"), "ids_crc32")
    return out.join(names, F.col("key") == F.col("k")).select("doc_id", (F.col("base") + F.col("first")).alias("start"), F.col("n").alias("n_tokens"), "ids_crc32")
