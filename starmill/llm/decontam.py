"""Benchmark decontamination with an FM-index per training shard.

Words are runs of ASCII letters (lower-cased), digits and bytes beyond ASCII; a
window is 13 words of a benchmark item, or all of a shorter one. A task takes its
documents in shards, cuts each shard's word sequence down to the stretches that a
window could lie in (runs of benchmark words at least as long as the shortest
window; nothing else can match), builds an FM-index over them, searches all
windows backward at once, locates their occurrences by sampled places, and merges
the hit words of each document to spans.

The benchmark goes to the executors in blocks of at most ``BLOCK_BYTES`` of text
(and one item at least), a job over the shards for each block, which writes the rows
that it hits; the next block is read when that is done. So a large benchmark costs
passes, not memory. A benchmark of one block needs no second pass and no shuffle.

Defined results: null and empty texts have no words and are clean; an item without
words has no window; a null item_id is written "null"; rows of one item_id count as one item; repeated documents are judged one by one; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ALNUM, BYTE_LOWER, chunks, drop_scratch, ordered_documents, prefix_hash, span_hash, spill, table, words

WINDOW = 13
BLOCK_BYTES = 8 << 20
SHARD_WORDS = 1 << 21
"""Words kept in an FM-index; a shard ends with the document that reaches it."""

STATE = "spans array<struct<s:int,e:int>>, items array<string>"


class Benchmark:
    """The windows of one block of items, as ranks of word hashes."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        texts = pa.array([t or "" for _, t in items], pa.string())
        runs: list[tuple[str, np.ndarray]] = []
        for lo, hi, data, offs in chunks(texts):
            s, e, t = words(data, offs, ALNUM)
            h = span_hash(prefix_hash(data, BYTE_LOWER), s, e)
            cut = np.searchsorted(t, np.arange(hi - lo + 1))
            runs += [(items[lo + i][0], h[cut[i] : cut[i + 1]]) for i in range(hi - lo)]
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *[h for _, h in runs]]))
        owners: dict[bytes, set[str]] = {}
        for name, h in runs:
            ids = np.searchsorted(self.vocabulary, h).astype(np.int64) + 2
            for i in range(max(1, len(ids) - window + 1)) if len(ids) else ():
                owners.setdefault(ids[i : i + window].tobytes(), set()).add(name)
        self.by_length: dict[int, np.ndarray] = {}
        self.owners: dict[int, list[list[str]]] = {}
        for key in sorted(owners):
            self.owners.setdefault(len(key) // 8, []).append(sorted(owners[key]))
        for n in self.owners:
            self.by_length[n] = np.array([np.frombuffer(k, np.int64) for k in sorted(owners) if len(k) // 8 == n]).reshape(-1, n)
        self.shortest = min(self.by_length, default=0)


def _kept(ids: np.ndarray, doc: np.ndarray, shortest: int) -> np.ndarray:
    """Places of the words in runs of benchmark words, inside one document, of at least ``shortest``."""
    ok = ids > 0
    new = np.ones(len(ids), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (ok[1:] != ok[:-1])
    run = np.cumsum(new) - 1
    return np.flatnonzero(ok & (np.bincount(run)[run] >= shortest)) if len(ids) else np.zeros(0, np.int64)


def _hits(bench: Benchmark, ids: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, str]]]:
    """Spans (document, first word, end word) of the hits in one shard, unmerged, and (document, item)."""
    from starmill.llm.fm_index import FMIndex

    apart = np.ones(len(ids), bool)
    apart[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)
    at = np.arange(len(ids)) + np.cumsum(apart)  # symbol 1 stands before each run
    text = np.ones(len(ids) + int(apart.sum()), np.int64)
    text[at] = ids
    source = np.full(len(text), -1, np.int64)
    source[at] = np.arange(len(ids))
    index = FMIndex(text, len(bench.vocabulary) + 2)
    d, s, e, pairs = [], [], [], set()
    for n, windows in bench.by_length.items():
        lo, hi = index.search(windows)
        count = hi - lo
        which = np.repeat(np.arange(len(windows)), count)
        if not len(which):
            continue
        rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        w = source[index.locate(rows)]
        d.append(doc[w])
        s.append(place[w])
        e.append(place[w] + n)
        for a, b in set(zip(doc[w].tolist(), which.tolist(), strict=True)):
            pairs.update((a, name) for name in bench.owners[n][b])
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(d), join(s), join(e), sorted(pairs)


def merge_spans(s: np.ndarray, e: np.ndarray) -> list[tuple[int, int]]:
    """Spans that touch or overlap become one."""
    out: list[list[int]] = []
    for a, b in sorted(zip(s.tolist(), e.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _scan(bench: Benchmark, batches: Iterator[pa.RecordBatch], told) -> Iterator[pa.RecordBatch]:
    """One pass: ``told`` makes the rows of each batch from (batch, words of each row, spans and items by row)."""
    held: list[tuple[pa.RecordBatch, np.ndarray]] = []
    ids, docs, places, base, size = [], [], [], 0, 0
    total = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal held, ids, docs, places, base, size
        d, s, e, pairs = (np.zeros(0, np.int64),) * 3 + ([],) if not size else _hits(bench, np.concatenate(ids), np.concatenate(docs), np.concatenate(places))
        found: dict[int, tuple[list, list]] = {}
        if len(d):
            order = np.argsort(d, kind="stable")
            d, s, e = d[order], s[order], e[order]
            heads = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
            for a, b in zip(heads, [*heads[1:], len(d)], strict=True):
                found[int(d[a])] = (merge_spans(s[a:b], e[a:b]), [])
            for i, name in pairs:
                found[i][1].append(name)
        first = 0
        for batch, n_words in held:
            yield told(batch, n_words, {i - first: x for i, x in found.items() if first <= i < first + len(batch)})
            first += len(batch)
        held, ids, docs, places, base, size = [], [], [], [], 0, 0

    for batch in batches:
        counts = np.zeros(len(batch), np.int64)
        for lo, hi, data, offs in chunks(batch.column("text")):
            s, e, t = words(data, offs, ALNUM)
            counts[lo:hi] = np.bincount(t, minlength=hi - lo)
            if not bench.shortest or not len(s):
                continue
            h = span_hash(prefix_hash(data, BYTE_LOWER), s, e)
            at = np.minimum(np.searchsorted(bench.vocabulary, h), len(bench.vocabulary) - 1)
            sym = np.where(bench.vocabulary[at] == h, at + 2, 0)
            keep = _kept(sym, t, bench.shortest)
            begin = np.searchsorted(t, t[keep], "left")
            ids.append(sym[keep])
            docs.append(t[keep] + base + lo)
            places.append(keep - begin)
            size += len(keep)
        held.append((batch, counts))
        base += len(batch)
        total += batch.nbytes
        if size >= SHARD_WORDS or total >= 64 << 20:
            yield from flush()
            total = 0
    if held:
        yield from flush()


def _hit_rows(batch: pa.RecordBatch, n_words: np.ndarray, found: dict[int, tuple[list, list]]) -> pa.RecordBatch:
    """The rows with hits alone: _ord, spans and items."""
    rows = sorted(found)
    spans = [[{"s": a, "e": b} for a, b in found[i][0]] for i in rows]
    return pa.RecordBatch.from_arrays([batch.column("_ord").take(pa.array(rows, pa.int64())), pa.array(spans, SPANS), pa.array([sorted(found[i][1]) for i in rows], pa.list_(pa.string()))], names=["_ord", "spans", "items"])


SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
NOTHING = hashlib.sha256(b"").hexdigest()


def _judged(batch: pa.RecordBatch, n_words: np.ndarray, found: dict[int, tuple[list, list]]) -> pa.RecordBatch:
    """The result's rows; those without hits share their empty values."""
    n = len(batch)
    hit, count, sha, spans, items = np.zeros(n, np.int64), np.zeros(n, np.int64), [NOTHING] * n, [[]] * n, [[]] * n
    for i, (runs, names) in found.items():
        names = sorted(names)
        hit[i], count[i], sha[i] = sum(b - a for a, b in runs), len(names), hashlib.sha256(",".join(names).encode()).hexdigest()
        spans[i], items[i] = [{"s": a, "e": b} for a, b in runs], names
    bad = (hit > 0) & (20 * hit >= n_words)
    return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_words": pa.array(n_words), "n_hit": pa.array(hit), "n_items": pa.array(count), "items_sha256": pa.array(sha, pa.string()), "contaminated": pa.array(bad), "spans": pa.array(spans, SPANS), "items": pa.array(items, pa.list_(pa.string()))})


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with what all passes found in them (lists of their spans, unmerged, and items)."""
    for batch in batches:
        counts = np.zeros(len(batch), np.int64)
        for lo, hi, data, offs in chunks(batch.column("text")):
            counts[lo:hi] = np.bincount(words(data, offs, ALNUM)[2], minlength=hi - lo)
        found = {}
        for i in np.flatnonzero(batch.column("spans").is_valid().to_numpy(zero_copy_only=False)).tolist():
            own = batch.column("spans")[i].as_py()
            found[i] = (merge_spans(np.array([x["s"] for x in own]), np.array([x["e"] for x in own])), list(set(batch.column("items")[i].as_py())))
        yield _judged(batch, counts, found)


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of at most ``limit`` bytes of text (and one item at least), streamed through the driver one partition at a time."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    held, size = [], 0
    for r in rows.toLocalIterator():
        if held and size + len(r["text"]) > limit:
            yield held
            held, size = [], 0
        held.append((r["item"], r["text"]))
        size += len(r["text"].encode())
    yield held


def find(docs: DataFrame, benchmark: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (of word numbers) and items, a row per row of ``docs``."""
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, {STATE}"
    rest = blocks(benchmark, limit)
    first = next(rest)
    second = next(rest, None)
    if second is None:
        return docs.select("doc_id", "text").mapInArrow(_task(spark.sparkContext.broadcast(first), _judged), schema)
    slim, _ = ordered_documents(docs)
    found = []
    # a job for each block: at any time one block is on the driver's and the tasks' hands
    for items in itertools.chain([first, second], rest):
        block = spark.sparkContext.broadcast(items)
        found.append(spill(slim.select("_ord", "text").mapInArrow(_task(block, _hit_rows), f"_ord long, {STATE}"), "hits"))
        block.destroy()
    rows = functools.reduce(DataFrame.union, found)
    # as many spans as the row's words at most, for each block
    rows = spill(rows.groupBy(F.col("_ord").alias("_hit")).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")), "hits")
    drop_scratch(*found)
    return slim.join(rows, F.col("_ord") == F.col("_hit"), "left").select("doc_id", "text", "spans", "items").mapInArrow(_totals, schema)


def _task(block, told):
    return lambda batches: _scan(Benchmark(block.value), batches, told)


def filter_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, all columns; each row by its own verdict, but rows without a doc_id go or stay together."""
    slim, _ = ordered_documents(docs, *[c for c in docs.columns if c not in ("doc_id", "text")])
    key = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.col("_ord"))
    bad = find(slim.select(key.alias("doc_id"), "text"), benchmark).where("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    return slim.withColumn("_key", key).join(bad, F.col("_key") == F.col("_bad"), "left_anti").select(*docs.columns)


def op9(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans", "items")
