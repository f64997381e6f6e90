"""Removal of repeated byte strings by a logarithmic family of sampled suffix arrays.

A string of ``LENGTH`` bytes that also starts earlier is removed. Suffixes are
sampled by content: of the ``GRAM``-byte strings inside a window of LENGTH bytes,
the one with the least hash (the first of equal ones) is the window's anchor. Equal
windows have equal anchors at equal distance, wherever they stand, so that only
suffixes at anchors need be sorted and compared. Consecutive windows with one anchor
are an entry: (the anchor's bytes, hash of all bytes its windows cover, document,
first window, number of windows). A sampled suffix array is the entries in the order
of the anchors' bytes; suffixes that share all GRAM of them, in that of the hash.

New documents come in batches. A batch's suffixes are dealt to parts by a hash of
their first GRAM bytes and sorted in each part. A task merge-scans its part with the
same part of every level, which lies sorted in a file and is streamed, never
shuffled: an entry equal to an earlier one is a match over its whole width; an anchor
met with different bytes around it is a place where long matches may begin or end,
and its windows are compared one by one, from the texts of the few anchors concerned.
In the same pass the batch's own entries that no level has become a level, each once
(its first owner); levels of equal size merge, part by part, as carries do, so that
there are about log2(batches) levels.

Matching is exact for whole texts up to equality of 64-bit hashes of windows and
covered bytes; "earlier" is by document order, then place. An entry that equals one
which its task has sent before is told as a match at once and not sent to the
anchor's part, so that copies of a text bring a row for each task, not for each copy.
No anchor is held in memory whole: above ``MOST`` entries, its windows are dealt by
their own hash.

The shared folder must be one that both Spark and pyarrow can open. Levels and
intermediate tables are written by the tasks' Python: no row goes back to the
executor's JVM for it, which would buffer it and, in a local folder, start two
processes a file (``chmod``) that count with the JVM's memory until they run. Files
are written under a name of their own and renamed, so that a task that runs again
after a lost executor replaces its file whole.

Defined results: null and empty texts have no bytes and the hash of nothing; texts
under LENGTH bytes lose nothing; very long texts are read whole, one at a time;
documents are ordered by doc_id (null last), rows with one doc_id by text, so that a
repeated row is a later document; extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starmill.llm.common import BYTE, chunks, drop_path, drop_scratch, free_shuffles, hash_bits, in_bits, mix, open_folder, ordered_documents, partitions, powers, prefix_hash, scratch, sorted_groups, table, tidy

LENGTH = 100
GRAM = 40
MOST = 20_000
BATCHES = 4
"""Batches that ``repeated`` cuts a table into, whatever its size."""
CHUNK = 1 << 19
"""Bytes of text that a task hashes at once; it needs about 60 times that, rows sent included."""
SENT = 1 << 22
"""Entries that a task remembers to have sent; the rest go to their parts as well."""
_U = np.uint64
_PLACE = (1 << 31) - 1
"""Bits of a place in a chunk; a text has fewer bytes."""
_BYTES = f"S{GRAM}"
ENTRY = "part int, v binary, u long, doc long, at int, n int"


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, by doubling."""
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[: len(h) - size], h[size:])
        size *= 2
    rest = width - size
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def entries(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text number, first window, number of windows, place of the anchor, its hash, hash of the bytes covered) of a chunk of texts."""
    z = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return z, z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    h = prefix_hash(data, BYTE)
    _, down = powers(len(h))
    grams = mix((h[GRAM:] - h[:-GRAM]) * down[: len(h) - GRAM])
    # the least hash of a window and, of equal ones, the first: its top bits and its place in one word
    place = (grams & ~_U(_PLACE)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_least(place, LENGTH - GRAM + 1) & _U(_PLACE)).astype(np.int64)  # one for each window
    begin, end = offs[:-1], offs[1:] - LENGTH + 1
    ok = end > begin
    edge = np.zeros(len(anchor) + 1, np.int32)
    edge[begin[ok]] = 1
    np.add.at(edge, end[ok], -1)
    inside = np.cumsum(edge[:-1]) > 0
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    new[begin[ok]] = True
    s = np.flatnonzero(new)
    e = np.append(s[1:], len(anchor))
    keep = inside[s]
    s, e = s[keep], e[keep]
    text = np.searchsorted(offs, s, "right") - 1
    over = e - 1 + LENGTH
    whole = mix((h[over] - h[s]) * down[s] + (e - s).astype(np.uint64))
    return text, s, e - s, anchor[s], grams[anchor[s]], whole


def gram_hash(v: np.ndarray) -> np.ndarray:
    """The anchors' hashes, as ``entries`` gives them, from their bytes."""
    raw = np.ascontiguousarray(v).view(np.uint8).reshape(len(v), GRAM)
    up, _ = powers(GRAM)
    return mix((BYTE[raw] * up[:GRAM]).sum(axis=1, dtype=np.uint64)).view(np.int64)


class _Sent:
    """Keys that a task has sent, each with the document that sent it: sorted runs that merge geometrically."""

    def __init__(self, most: int = SENT):
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.most = most

    def earlier(self, key: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """For each key (ascending), whether an earlier document has sent it; the others are noted."""
        had = np.zeros(len(key), bool)
        for keys, docs in self.runs:
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            had |= (keys[at] == key) & (docs[at] < doc)
        if not had.all():
            self.runs.append((key[~had], doc[~had]))
        while len(self.runs) > 1 and len(self.runs[-2][0]) <= 2 * len(self.runs[-1][0]):
            (k2, d2), (k1, d1) = self.runs.pop(), self.runs.pop()
            keys, docs = np.concatenate([k1, k2]), np.concatenate([d1, d2])
            order = np.lexsort((docs, keys))
            keys, docs = keys[order], docs[order]
            first = np.ones(len(keys), bool)
            first[1:] = keys[1:] != keys[:-1]
            self.runs.append((keys[first], docs[first]))
        while sum(len(k) for k, _ in self.runs) > self.most:
            self.runs.pop(0)
        return had


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of a task's texts. One that equals an earlier one which the task has sent is a known match: it has no bytes and goes to any part."""
    sent = _Sent()
    for batch in batches:
        docs = batch.column("_ord").to_numpy()
        for lo, _, data, offs in chunks(batch.column("text"), CHUNK):
            t, s, n, p, v, u = entries(data, offs)
            d, at = docs[lo + t], s - offs[t]
            key = mix(u + v * _U(3))
            order = np.lexsort((at, d, key))
            t, s, n, p, v, u, d, at, key = (x[order] for x in (t, s, n, p, v, u, d, at, key))
            known = np.zeros(len(s), bool)
            known[1:] = key[1:] == key[:-1]
            known[~known] = sent.earlier(key[~known], d[~known])
            part = (np.where(known, mix(d.astype(np.uint64)), v) >> _U(33)).astype(np.int32)
            for a in range(0, len(s), 1 << 18):
                own = slice(a, a + (1 << 18))
                k = ~known[own]
                cut = np.lib.stride_tricks.sliding_window_view(data, GRAM)[p[own][k]]
                ends = np.concatenate([[0], np.cumsum(k * GRAM)]).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), len(k), [pa.py_buffer(np.packbits(k, bitorder="little").tobytes()), pa.py_buffer(ends), pa.py_buffer(cut.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(part[own]), raw, pa.array(u[own].view(np.int64)), pa.array(d[own]), pa.array(at[own].astype(np.int32)), pa.array(n[own].astype(np.int32))], names=["part", "v", "u", "doc", "at", "n"])


# -- levels: sorted files, one for each part

COLUMNS = ("v", "u", "doc", "at", "n", "old")
LEVEL = pa.schema([("v", pa.binary(GRAM)), ("u", pa.int64()), ("doc", pa.int64()), ("at", pa.int32())])


def _file(root: str, part: int) -> str:
    return f"{root}/part-{part:05d}.parquet"


def _level(folder: str, part: int) -> Iterator[dict[str, np.ndarray]]:
    """A level's entries of a part, in order, in slices."""
    import pyarrow.parquet as pq

    store, root = open_folder(folder)
    if not store.get_file_info(_file(root, part)).is_file:
        return
    with store.open_input_file(_file(root, part)) as f:
        for b in pq.ParquetFile(f).iter_batches(1 << 16):
            k = len(b)
            col = b.column("v")
            v = np.frombuffer(col.buffers()[1], _BYTES, k, col.offset * GRAM)
            yield {"v": v, "u": b.column("u").to_numpy(), "doc": b.column("doc").to_numpy(), "at": b.column("at").to_numpy(), "n": np.zeros(k, np.int32), "old": np.ones(k, bool)}


class _Writer:
    """Writes a task's file of a folder; the file has its name only when it is whole."""

    def __init__(self, folder: str, part: int, schema: pa.Schema = LEVEL, dictionary: bool = False):
        self.store, root = open_folder(folder)
        self.root, self.name, self.schema, self.dictionary, self.out = root, _file(root, part), schema, dictionary, None

    def add(self, g: dict[str, np.ndarray], pick: np.ndarray) -> None:
        k = int(pick.sum())
        if k:
            v = pa.Array.from_buffers(pa.binary(GRAM), k, [None, pa.py_buffer(g["v"][pick].tobytes())])
            self.write(pa.Table.from_arrays([v, *[pa.array(g[c][pick]) for c in ("u", "doc", "at")]], schema=LEVEL))

    def write(self, rows: pa.Table) -> None:
        import pyarrow.parquet as pq

        if self.out is None:
            self.store.create_dir(self.root, recursive=True)
            self.temp = f"{self.root}/_{uuid.uuid4().hex}"
            self.sink = self.store.open_output_stream(self.temp)
            self.out = pq.ParquetWriter(self.sink, self.schema, compression="zstd", use_dictionary=self.dictionary)
        self.out.write_table(rows)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.sink.close()
            self.store.move(self.temp, self.name)


def _store(run, folder: str, schema: pa.Schema):
    """``run`` over a task's batches, its rows written to the task's file of ``folder``; gives their number."""

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, held, rows, total = _Writer(folder, TaskContext.get().partitionId(), schema, True), [], 0, 0
        for batch in run(batches):
            if len(batch):
                held.append(batch)
                rows, total = rows + len(batch), total + len(batch)
            if rows >= 1 << 16:
                out.write(pa.Table.from_batches(held).cast(schema))
                held, rows = [], 0
        if held:
            out.write(pa.Table.from_batches(held).cast(schema))
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], names=["n"])

    return stored


def _written(df: DataFrame, run, columns: str, name: str) -> DataFrame:
    """``df.mapInArrow(run, columns)``, written to the shared folder by the tasks and read back."""
    spark = df.sparkSession
    folder, schema = scratch(spark, name), T.StructType.fromDDL(columns)
    store, root = open_folder(folder)
    store.create_dir(root, recursive=True)  # a table without rows has no file
    df.mapInArrow(tidy(_store(run, folder, to_arrow_schema(schema))), "n long").write.format("noop").mode("overwrite").save()
    out = spark.read.schema(schema).parquet(folder)
    out._scratch = folder
    return out


def _merged(streams: list[Iterator[dict[str, np.ndarray]]]) -> Iterator[dict[str, np.ndarray]]:
    """Streams of entries in the order (v, u, doc, at) as one in that order; each is held a slice at a time."""
    live = [[s, next(s, None)] for s in streams]
    live = [x for x in live if x[1] is not None]
    while live:
        if len(live) == 1:
            yield live[0][1]
            yield from live[0][0]
            return
        # up to the least of the last keys, nothing can follow
        last = min(live, key=lambda x: (bytes(x[1]["v"][-1]), int(x[1]["u"][-1])))[1]
        v, u = last["v"][-1], last["u"][-1]
        taken = []
        for x in live:
            g = x[1]
            lo, hi = np.searchsorted(g["v"], v, "left"), np.searchsorted(g["v"], v, "right")
            cut = int(lo + np.searchsorted(g["u"][lo:hi], u, "right"))
            if cut:
                taken.append({c: g[c][:cut] for c in COLUMNS})
                x[1] = {c: g[c][cut:] for c in COLUMNS} if cut < len(g["u"]) else next(x[0], None)
        live = [x for x in live if x[1] is not None]
        g = {c: np.concatenate([t[c] for t in taken]) for c in COLUMNS} if len(taken) > 1 else taken[0]
        if len(taken) > 1:
            order = np.lexsort((g["at"], g["doc"], g["u"], g["v"]))
            g = {c: x[order] for c, x in g.items()}
        yield g


SCAN = "kind string, h long, doc long, at int, n int"


def _scan(levels: list[str], target: str | None):
    """The merge scan of a part: ``match`` for each entry equal to an earlier one; ``meet`` for the hash of each anchor met with different bytes. First owners of the batch become the part's file of the level ``target``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, known = TaskContext.get().partitionId(), []

        def fresh() -> Iterator[dict[str, np.ndarray]]:
            for batch in batches:
                col = batch.column("v")
                g = {c: batch.column(c).to_numpy() for c in ("u", "doc", "at", "n")}
                if col.null_count:
                    none = col.is_null().to_numpy(zero_copy_only=False)
                    known.append(_rows(g, none))
                    g = {c: x[~none] for c, x in g.items()}
                    col = col.drop_null()
                if len(col):
                    g["v"] = np.frombuffer(col.cast(pa.binary(GRAM)).buffers()[1], _BYTES, len(col))
                    yield g | {"old": np.zeros(len(col), bool)}

        out = _Writer(target, part) if target else None
        had: tuple | None = None  # the last (v, u) of what came before
        held: dict | None = None  # the last anchor so far: (v, whether new entries came, the first u, whether several)
        for g in _merged([fresh(), *[_level(x, part) for x in levels]]):
            yield from known
            known.clear()
            v, u, old = g["v"], g["u"], g["old"]
            same = np.zeros(len(v), bool)
            same[1:] = (v[1:] == v[:-1]) & (u[1:] == u[:-1])
            same[0] = had is not None and bool(had[0][0] == v[0]) and had[1] == u[0]
            had = (v[-1:], u[-1])
            yield _rows(g, same & ~old)
            if out:
                out.add(g, ~same & ~old)
            # anchors with several surroundings, and something new among them
            start = np.ones(len(v), bool)
            start[1:] = v[1:] != v[:-1]
            run_of = np.cumsum(start) - 1
            several = np.zeros(int(run_of[-1]) + 1, bool)
            np.logical_or.at(several, run_of[1:], (u[1:] != u[:-1]) & (v[1:] == v[:-1]))
            new = np.zeros(len(several), bool)
            np.logical_or.at(new, run_of, ~old)
            heads = v[start]
            if held is not None and bool(held["v"][0] == heads[0]):
                several[0] |= held["several"] or held["u"] != u[0]
                new[0] |= held["new"]
            elif held is not None and held["several"] and held["new"]:
                yield _meet(held["v"])
            held = {"v": heads[-1:], "several": bool(several[-1]), "new": bool(new[-1]), "u": u[-1]}
            yield _meet(heads[:-1][several[:-1] & new[:-1]])
        yield from known
        if held is not None and held["several"] and held["new"]:
            yield _meet(held["v"])
        if out:
            out.close()

    return run


def _rows(g: dict, pick: np.ndarray) -> pa.RecordBatch:
    k = int(pick.sum())
    return pa.RecordBatch.from_arrays([pa.array(["match"] * k, pa.string()), pa.nulls(k, pa.int64()), *[pa.array(g[c][pick]) for c in ("doc", "at", "n")]], names=["kind", "h", "doc", "at", "n"])


def _meet(v: np.ndarray) -> pa.RecordBatch:
    k = len(v)
    none = [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(["meet"] * k, pa.string()), pa.array(gram_hash(v)), *none], names=["kind", "h", "doc", "at", "n"])


def _merge_parts(a: str, b: str, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("id").to_pylist():
                out = _Writer(into, part)
                for g in _merged([_level(a, part), _level(b, part)]):
                    out.add(g, np.ones(len(g["u"]), bool))
                out.close()
            yield pa.RecordBatch.from_arrays([batch.column("id")], names=["id"])

    return run


# -- windows of the anchors that met

def _contexts(bits):
    """The bytes under the entries whose anchors met; a task leaves out those that it has sent for an earlier document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, sent = bits.value, _Sent()
        for batch in batches:
            docs = batch.column("_ord").to_numpy()
            for lo, _, data, offs in chunks(batch.column("text"), CHUNK):
                t, s, n, _, v, u = entries(data, offs)
                k = np.flatnonzero(in_bits(wanted, v))
                d = docs[lo + t[k]]
                key = mix(u[k] + v[k] * _U(3))
                order = np.lexsort((s[k] - offs[t[k]], d, key))
                k, d, key = k[order], d[order], key[order]
                first = np.ones(len(k), bool)
                first[1:] = key[1:] != key[:-1]
                k, d, key = k[first], d[first], key[first]
                new = ~sent.earlier(key, d)
                k, d = k[new], d[new]
                raw = data.tobytes()
                cut = [raw[a : a + LENGTH - 1 + b] for a, b in zip(s[k].tolist(), n[k].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(v[k].view(np.int64)), pa.array(u[k].view(np.int64)), pa.array(d), pa.array((s[k] - offs[t[k]]).astype(np.int32)), pa.array(cut, pa.binary())], names=["v", "u", "doc", "at", "bytes"])

    return run


def _window_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(entry number, hash) of every window of the entries' bytes."""
    data = np.frombuffer(b"".join(raw), np.uint8)
    size = np.array([len(x) for x in raw])
    base = np.cumsum(size) - size
    h = prefix_hash(data, BYTE)
    _, down = powers(len(h))
    n = size - LENGTH + 1
    which = np.repeat(np.arange(len(raw)), n)
    at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(base, n)
    return which, mix((h[at + LENGTH] - h[at]) * down[at])


WINDOWS = "w long, doc long, at int, n int, done boolean"


def _compare(most: int):
    return lambda batches: _compared(batches, most)


def _compared(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The windows that also start earlier, anchor by anchor; of anchors with over ``most`` entries, which come in slices, all windows, to be dealt by hash (done = false)."""
    for g, whole in sorted_groups(batches, ["v", "u", "doc", "at", "bytes"], most):
        v, u = g["v"], g["u"]
        first = np.ones(len(v), bool)
        first[1:] = (v[1:] != v[:-1]) | (u[1:] != u[:-1])  # of each distinct entry, its first owner
        g = {c: x[first] for c, x in g.items()}
        v = g["v"]
        start = np.ones(len(v), bool)
        start[1:] = v[1:] != v[:-1]
        run = np.cumsum(start) - 1
        size = np.bincount(run)[run] if whole else np.full(len(v), most + 1)
        for many in (False, True):
            pick = np.flatnonzero((size > 1) & ((size > most) == many))
            # windows that are dealt anew need no whole anchors: in slices
            slices = [pick[a : a + MOST] for a in range(0, len(pick), MOST)] if many else [pick] * bool(len(pick))
            for part in slices:
                which, w = _window_hashes(list(g["bytes"][part]))
                key = w + mix(v[part][which].view(np.uint64))
                doc, at = g["doc"][part][which], g["at"][part][which].astype(np.int64)
                head = np.ones(len(which), bool)
                head[1:] = which[1:] != which[:-1]
                at = at + np.arange(len(which)) - np.flatnonzero(head)[np.cumsum(head) - 1]
                n = np.ones(len(key), np.int32)
                if not many:
                    order = np.lexsort((at, doc, key))
                    again = np.zeros(len(order), bool)
                    again[1:] = key[order][1:] == key[order][:-1]
                    doc, at = doc[order][again], at[order][again]
                    order = np.lexsort((at, doc))
                    doc, at = doc[order], at[order]
                    head = np.ones(len(doc), bool)
                    head[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)
                    k = np.flatnonzero(head)
                    n = np.diff(np.append(k, len(doc))).astype(np.int32)
                    doc, at, key = doc[k], at[k], np.zeros(len(k), np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc), pa.array(at.astype(np.int32)), pa.array(n), pa.array(np.full(len(key), not many))], names=["w", "doc", "at", "n", "done"])


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of windows in the order (hash, document, place), all but the first of each hash."""
    last = None
    for batch in batches:
        w = batch.column("w").to_numpy()
        if len(w):
            again = np.zeros(len(w), bool)
            again[1:] = w[1:] == w[:-1]
            again[0] = last == w[0]
            last = w[-1]
            yield batch.select(["doc", "at", "n"]).filter(pa.array(again))


@dataclass
class SuffixIndex:
    """The family of levels. ``levels`` are folders of sorted files, with their sizes in batches; ``documents`` has (_ord, text) of all batches so far."""

    levels: list[tuple[int, str]] = field(default_factory=list)
    documents: DataFrame | None = None
    most: int = MOST
    met: list[DataFrame] = field(default_factory=list)
    top: int | None = None

    def add(self, batch: DataFrame, keep: bool = True) -> DataFrame:
        """Windows of ``batch`` (_ord, text; all later than earlier batches) that also start earlier: (doc, at, n). ``keep``: the batch becomes a level."""
        before = self.top
        found = self.scan(batch, keep)
        self.top = batch.agg(F.max("_ord")).first()[0]
        out = found.where("kind = 'match'").select("doc", "at", "n")
        more = self.compare()
        if more is None:
            return out
        return out.union(more if before is None else more.where(F.col("doc") > before))

    def scan(self, batch: DataFrame, keep: bool = True) -> DataFrame:
        """The merge scan's rows, written; anchors that met wait for ``compare``."""
        spark = batch.sparkSession
        new = batch.select("_ord", "text").mapInArrow(tidy(_entries), ENTRY)
        dealt = new.repartition(partitions(spark), "part").sortWithinPartitions("v", "u", "doc", "at")
        target = scratch(spark, "level") if keep else None
        found = _written(dealt, _scan([x for _, x in self.levels], target), SCAN, "scan")
        free_shuffles(spark)
        self.met.append(found.where("kind = 'meet'").select(F.col("h").alias("v")))
        self.documents = batch.select("_ord", "text") if self.documents is None else self.documents.union(batch.select("_ord", "text"))
        if target:
            self._insert(spark, target)
        return found

    def compare(self) -> DataFrame | None:
        """The windows at the anchors that met since the last call, over all documents, that also start earlier; written. None without any."""
        spark, met = self.documents.sparkSession, self.met[0]
        for x in self.met[1:]:
            met = met.union(x)
        self.met = []
        count = met.count()
        if not count:
            return None
        bits = spark.sparkContext.broadcast(hash_bits(met, "v", min(29, max(20, (16 * count + 1).bit_length()))))
        near = self.documents.mapInArrow(tidy(_contexts(bits)), "v long, u long, doc long, at int, bytes binary")
        near = near.repartition(partitions(spark), "v").sortWithinPartitions("v", "u", "doc", "at")
        windows = _written(near, _compare(self.most), WINDOWS, "windows")
        free_shuffles(spark)
        wide = windows.where("NOT done").repartition(partitions(spark), "w").sortWithinPartitions("w", "doc", "at")
        out = windows.where("done").select("doc", "at", "n").union(wide.mapInArrow(_later, "doc long, at int, n int"))
        out._scratch = windows._scratch
        return out

    def _insert(self, spark, level: str) -> None:
        """The batch becomes a level; levels of equal size merge, as carries do."""
        size = 1
        while self.levels and self.levels[-1][0] == size:
            _, other = self.levels.pop()
            merged = scratch(spark, "level")
            parts = max(_parts(other), _parts(level))
            if parts:
                spark.range(0, parts, 1, parts).mapInArrow(tidy(_merge_parts(other, level, merged)), "id long").agg(F.count("*")).collect()  # one row
            drop_path(spark, other, level)
            level, size = merged, size * 2
        self.levels.append((size, level))

    def drop(self, spark) -> None:
        drop_path(spark, *[x for _, x in self.levels])
        self.levels = []


def _parts(folder: str) -> int:
    """The number of a level's parts."""
    from pyarrow import fs

    store, root = open_folder(folder)
    names = [f.base_name for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True))]
    return max((int(n[5:10]) + 1 for n in names if n.endswith(".parquet")), default=0)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends")}
        ats, ns = batch.column("ats"), batch.column("ns")
        for text, a, n in zip(batch.column("text"), ats, ns, strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            s, e = _spans(a.values.to_numpy() if a.is_valid else None, n.values.to_numpy() if n.is_valid else None)
            kept, at = hashlib.sha256(), 0
            for x, y in zip(s.tolist(), e.tolist(), strict=True):
                kept.update(raw[at:x])
                at = y
            kept.update(raw[at:])
            for k, x in zip(out, (len(raw), int((e - s).sum()), len(s), kept.hexdigest(), s.tolist(), e.tolist()), strict=True):
                out[k].append(x)
        yield pa.RecordBatch.from_arrays([ids, pa.array(out["n_bytes"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["n_spans"], pa.int64()), pa.array(out["kept_sha256"], pa.string()), pa.array(out["starts"], pa.list_(pa.int64())), pa.array(out["ends"], pa.list_(pa.int64()))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"])


def _spans(at: np.ndarray | None, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes under windows at..at + n - 1."""
    if at is None or not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(at, kind="stable")
    s = at[order].astype(np.int64)
    e = np.maximum.accumulate(s + n[order] - 1 + LENGTH)
    head = np.ones(len(s), bool)
    head[1:] = s[1:] > e[:-1]
    k = np.flatnonzero(head)
    return s[k], e[np.append(k[1:], len(s)) - 1]


def repeated(docs: DataFrame, batch_bytes: int | None = None, most: int = MOST) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed runs (starts, ends) of every row of ``docs``.

    Batches are ranges of the document order: BATCHES, or as many as ``batch_bytes``
    of text each make.
    """
    spark = docs.sparkSession
    slim, placed = ordered_documents(docs)
    count = BATCHES
    if batch_bytes is not None:
        count = max(1, -(-(slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // batch_bytes))
    marks = [] if count == 1 else slim.where("text IS NOT NULL").agg(F.percentile_approx("_ord", [i / count for i in range(1, count)], 10000)).first()[0]
    marks = sorted(set(marks or []))
    index, found = SuffixIndex(most=most), []
    for i, (lo, hi) in enumerate(zip([None, *marks], [*marks, None], strict=True)):
        part = slim
        if lo is not None:
            part = part.where(F.col("_ord") > lo)
        if hi is not None:
            part = part.where(F.col("_ord") <= hi)
        found.append(index.scan(part, keep=i < len(marks)))
    index.drop(spark)
    index.documents = slim  # the same rows, read once
    more = index.compare()
    runs = found[0].where("kind = 'match'").select("doc", "at", "n")
    for x in found[1:]:
        runs = runs.union(x.where("kind = 'match'").select("doc", "at", "n"))
    if more is not None:
        runs = runs.union(more)
    spans = runs.groupBy("doc").agg(F.collect_list(F.struct("at", "n")).alias("r"))
    spans = _written(spans.select("doc", F.col("r.at").alias("ats"), F.col("r.n").alias("ns")), iter, "doc long, ats array<int>, ns array<int>", "spans")
    drop_scratch(*found, *([more] if more is not None else []))
    free_shuffles(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    joined = slim.join(spans, F.col("_ord") == F.col("doc"), "left").select("doc_id", "text", "ats", "ns")
    out = _written(joined, _cut, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>", "removed")
    drop_scratch(spans, *([placed] if placed is not None else []))
    return out


def op1(spark, sf_dir: str) -> DataFrame:
    return repeated(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
