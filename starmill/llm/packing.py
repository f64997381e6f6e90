"""Best-fit packing of token pieces into sequences, in bulk-synchronous sweeps.

Documents are encoded once where they lie; pieces and gaps are then range-sorted
by length. All pieces of one length are a run, and so are sequences with one gap:
their numbers are at most the capacity, whatever the corpus. A superstep takes
the next run of pieces, longest first; a successor sweep over the gaps, smallest
sufficient gap first, matches it to runs of sequences; ranks settle who gets which
sequence (the r-th piece of a length takes the r-th place offered to it); the gaps
are updated, and the next superstep begins. The outcome is that of best fit
decreasing over single pieces. The sweeps state for each length which ranks go to
which sequences; the ranks themselves are counted on the executors by blocks, and
every piece finds its place by a join, so that no task and no driver ever holds
the pieces.

Defined results: null and empty texts are one piece, the end id alone; a document
longer than the capacity is cut into full pieces, of which the first may be
shorter; repeated rows are packed one by one; repeated or null doc_ids are kept as
they are; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import distributed_rank, ordered_documents, spill, table
from starmill.llm.tokens import encoder, with_end

CAPACITY = 2048
BROADCAST_ROWS = 200_000


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the rest comes first."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _encode(capacity: int, path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            out: list[tuple] = []
            row: list[int] = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = with_end(encode(text or ""))
                for k, (s, n) in enumerate(cuts(len(ids), capacity)):
                    out.append((k, s, n, zlib.crc32(ids[s : s + n].tobytes())))
                    row.append(i)
            cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_ord").take(at), batch.column("doc_id").take(at), pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                names=["_ord", "doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """_ord, doc_id, piece, start, length and ids_crc32 of every piece; written once."""
    slim, _ = ordered_documents(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    done = slim.mapInArrow(_encode(capacity, path), f"_ord long, doc_id {id_type}, piece int, start long, length long, ids_crc32 long")
    return spill(done, "pieces")


def sweep(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best fit of runs. (length, first rank, end rank, first sequence, pieces in each, offset of the first) of every match, and the number of sequences."""
    gaps: list[int] = []  # the gaps that some sequence has, in order
    runs: dict[int, list[tuple[int, int, int]]] = {}  # gap -> (first sequence, end sequence, used)
    out, opened = [], 0

    def leave(first: int, end: int, used: int) -> None:
        gap = capacity - used
        if end > first and gap:
            if gap not in runs:
                runs[gap] = []
                insort(gaps, gap)
            runs[gap].append((first, end, used))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        later: list[tuple[int, int, int]] = []  # filled as far as this length goes

        def put(first: int, end: int, used: int, each: int) -> None:
            nonlocal rank, left
            n = (end - first) * each
            out.append((length, rank, rank + n, first, each, used))  # noqa: B023
            rank, left = rank + n, left - n
            later.append((first, end, used + each * length))  # noqa: B023

        while left:
            k = bisect_left(gaps, length)
            if k == len(gaps):
                each = capacity // length
                full = left // each
                if full:
                    put(opened, opened + full, 0, each)
                    opened += full
                if left:
                    put(opened, opened + 1, 0, left)
                    opened += 1
                break
            gap = gaps[k]
            first, end, used = runs[gap].pop()
            if not runs[gap]:
                del runs[gap]
                gaps.pop(k)
            each = gap // length
            full = min(end - first, left // each)
            if full:
                put(first, first + full, used, each)
            if left and first + full < end:
                put(first + full, first + full + 1, used, left)
                full += 1
            leave(first + full, end, used)
        for x in later:
            leave(*x)
    return out, opened


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (see ``pieces``) with sequence_id and offset."""
    spark = cut.sparkSession
    runs = cut.groupBy("length").count()
    counts = {r["length"]: r["count"] for r in runs.collect()}  # at most ``capacity`` rows
    if any(n > capacity for n in counts):
        raise ValueError("a piece is longer than the capacity")
    segments, _ = sweep(counts, capacity)
    names = ["_length", "_from", "_to", "_seq", "_each", "_used"]
    cols = np.array(segments, np.int64).reshape(-1, 6)
    plan = spark.createDataFrame(pa.table({n: cols[:, i] for i, n in enumerate(names)}))
    ranked = distributed_rank(cut, ["length"], [F.col("_ord"), F.col("piece")], F.struct("_ord", "piece"), "_rank")
    # the matches are few, as the runs are; their number is checked all the same
    side = F.broadcast(plan) if len(segments) <= BROADCAST_ROWS else plan
    met = ranked.join(side, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    nth = F.col("_rank") - F.col("_from")
    return met.select(*cut.columns, (F.col("_seq") + F.floor(nth / F.col("_each"))).cast("long").alias("sequence_id"), (F.col("_used") + nth % F.col("_each") * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    return pack(pieces(docs, capacity, path), capacity).drop("_ord")


def fill(docs: DataFrame, packed: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """sequence_id and ids of every sequence: the pieces' ids, joined in order. ``packed``: of the same documents, with unique doc_ids."""
    held = docs.select("doc_id", "text").join(packed.groupBy(F.col("doc_id").alias("_d")).agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("p")), F.col("doc_id") == F.col("_d"))

    def run(batches):
        encode = encoder(path)
        for batch in batches:
            seq, off, ids = [], [], []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("p").to_pylist(), strict=True):
                own = with_end(encode(text or ""))
                for x in parts:
                    seq.append(x["sequence_id"])
                    off.append(x["offset"])
                    ids.append(own[x["start"] : x["start"] + x["length"]].astype(np.int64).tolist())
            yield pa.RecordBatch.from_pydict({"sequence_id": pa.array(seq, pa.int64()), "offset": pa.array(off, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32()))})

    parts = held.select("text", "p").mapInArrow(run, "sequence_id long, offset long, ids array<int>")
    # a sequence has at most ``capacity`` ids, so that the lists are bounded
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))


def op5(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
