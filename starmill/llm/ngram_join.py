"""N-gram Jaccard join by the levels of a prefix tree over globally ordered shingle sets.

A document's set has its distinct 5-word shingles; equal sets are one class. The
global order of shingles puts rare ones first: by a count sketch over all
documents (a table of 2**SKETCH_BITS counts, of fixed size), then by hash. A set in
that order is a path; two sets of Jaccard similarity 0.8 have their first common
shingle in the first n - ceil(0.8 n) + 1 levels of both. The tree isn't linked in
memory: its upper levels are dealt by shingle, a row for each set and level, and
those that two different sets reach are kept. Where a pair's first common shingle is
at levels p and q, its overlap is at most 1 + min(n - p - 1, m - q - 1): what remains
of the shorter path. Pairs below the overlap that they need are pruned before
any set is looked at, and so are pairs whose sizes differ too much: the node of a shingle
is parted by size, a set being in its own part and in the next.

Sets that meet are compared in two rounds, each exact on whole sets:
1. every set with the ``LEADERS`` of its part of the node (those least by a hash of
   their names), which are found by partial ranks and joined in salted pieces, so that
   no task holds a node; links give components;
2. sets of one part that are still in different components. The largest component of
   a part and the rest are cut into blocks of about ``TILE`` sets; a task compares the
   sets of two blocks, never two of the largest component. A pair that shares a
   component needs no comparing, so a group of thousands of copies costs a few stars.
   Two sweeps: of each two blocks, first only pairs that join components without a
   circle (fewer than there are sets) are checked on whole sets; then all that are
   still apart.
Nothing is capped: what the first round leaves apart, the second compares. Before
whole sets are sent, bit digests (a quarter byte a shingle; one in the second
round, inside the block) bound a pair's overlap from above, and pairs that can't
reach the threshold go.

Defined results: null, empty and wordless texts have no shingles, link with
nothing and are components of their own; texts of under five words are one
shingle; rows of one text are linked; very long texts are read whole; a similarity of
just the threshold links; a null doc_id is never a component's id unless the component
has no other; repeated doc_ids are separate documents; extra columns are ignored; an
empty table gives no rows. Shingles and sets are told by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import BYTE_LOWER, SPACE, chunks, components, drop_scratch, free_shuffles, hash_bits, in_bits, mix, ordered_documents, partitions, prefix_hash, rows_per_batch, sorted_groups, span_hash, spill, table, tidy, words

N = 5
PERCENT = 80
SKETCH_BITS = 24
BLOCK_BITS = 14
LEADERS = 6
SMALLEST = 4
"""Sets of fewer shingles can reach the threshold with an equal set alone."""
SALTS = 16
"""Pieces in which a node's sets are joined with its leaders."""
TILE = 1024
"""Sets in a block that are compared with those of another."""
WIDE = 8
"""Bits of a digest for each shingle, where sets that stayed apart are compared."""
_U = np.uint64


def shingle_sets(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, cuts, hashes): row r's set is hashes[cuts[r - first] : cuts[r - first + 1]], ascending."""
    for lo, hi, data, offs in chunks(col, 1 << 20):
        s, e, t = words(data, offs, SPACE)
        h = span_hash(prefix_hash(data, BYTE_LOWER), s, e)
        n = len(h)
        per = np.bincount(t, minlength=hi - lo)
        sh, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if n >= N:
            sh = np.zeros(n - N + 1, np.uint64)
            for j in range(N):
                sh = mix(sh * _U(3) + h[j : n - N + 1 + j])
            inside = t[: n - N + 1] == t[N - 1 :]
            sh, owner = sh[inside], t[: n - N + 1][inside]
        for r in np.flatnonzero((per > 0) & (per < N)):
            x = np.array([_U(per[r])])
            for w in h[np.searchsorted(t, r) :][: per[r]]:
                x = mix(x * _U(5) + w)
            sh, owner = np.append(sh, x), np.append(owner, r)
        order = np.lexsort((sh, owner))
        sh, owner = sh[order], owner[order]
        new = np.ones(len(sh), bool)
        new[1:] = (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])
        sh, owner = sh[new], owner[new]
        yield lo, hi, np.searchsorted(owner, np.arange(hi - lo + 1)), sh


def set_ids(cuts: np.ndarray, sh: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set, from its members and size; 0 for the empty one."""
    total = np.concatenate([[_U(0)], np.cumsum(mix(sh ^ _U(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)])
    size = np.diff(cuts)
    return np.where(size > 0, mix(total[cuts[1:]] - total[cuts[:-1]] + size.astype(np.uint64) * _U(0x9E3779B97F4A7C15)), _U(0)).view(np.int64)


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - -(-PERCENT * n // 100) + 1


def digests(cuts: np.ndarray, sh: np.ndarray, per: int = 2) -> list[bytes]:
    """For each set, bits at its hashes modulo a power of two of at least ``per`` times its size."""
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        m = max(64, 1 << (per * (b - a) - 1).bit_length()) if b > a else 64
        bits = np.zeros(m, np.uint8)
        bits[(sh[a:b] & _U(m - 1)).astype(np.int64)] = 1
        out.append(np.packbits(bits, bitorder="little").tobytes())
    return out


def may_match(nx: int, ny: int, x: bytes, y: bytes) -> bool:
    """Whether two sets can be similar enough, by their sizes and digests."""
    p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(p) != len(q):  # the wider one folds onto the other
        if len(p) > len(q):
            p = p[: len(p) // 2] | p[len(p) // 2 :]
        else:
            q = q[: len(q) // 2] | q[len(q) // 2 :]
    both = min(nx - int(np.bitwise_count(p & ~q).sum()), ny - int(np.bitwise_count(q & ~p).sum()))
    return (100 + PERCENT) * both >= PERCENT * (nx + ny)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's set size and name; and, once a task, the counts of its shingles by bucket."""
    wide = np.zeros(1 << SKETCH_BITS, np.uint16)
    names = ["at", "doc_id", "n", "sid", "digest", "block", "counts"]
    for batch in batches:
        size, sid, digest = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64), []
        for lo, hi, cuts, sh in shingle_sets(batch.column("text")):
            size[lo:hi], sid[lo:hi] = np.diff(cuts), set_ids(cuts, sh)
            digest += digests(cuts, sh)
            b, c = np.unique((sh >> _U(64 - SKETCH_BITS)).astype(np.int64), return_counts=True)
            wide[b] = np.minimum(wide[b].astype(np.int64) + c, 65535)
        yield pa.RecordBatch.from_arrays([batch.column("_ord"), batch.column("doc_id"), pa.array(size), pa.array(sid), pa.array(digest, pa.binary()), pa.nulls(len(batch), pa.int32()), pa.nulls(len(batch), pa.binary())], names=names)
    rows = wide.reshape(-1, 1 << BLOCK_BITS)
    full = np.flatnonzero(rows.any(axis=1))
    if len(full):
        id_type = batch.column("doc_id").type
        z = pa.nulls(len(full), pa.int64())
        yield pa.RecordBatch.from_arrays([z, pa.nulls(len(full), id_type), z, z, pa.nulls(len(full), pa.binary()), pa.array(full.astype(np.int32)), pa.array([zlib.compress(rows[b].tobytes(), 1) for b in full], pa.binary())], names=names)


def _levels(total: np.ndarray) -> np.ndarray:
    """Counts as one byte: exact below 128, then by eighths of powers of two."""
    big = 128 + 8 * (np.log2(np.maximum(total, 128)) - 7)
    return np.where(total < 128, total, np.minimum(255, big)).astype(np.uint8)


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1 << BLOCK_BITS, np.int64)
    for raw in pdf["counts"]:
        total += np.frombuffer(zlib.decompress(raw), np.uint16)
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "levels": [_levels(total).tobytes()]})


def sketch(profile: DataFrame) -> np.ndarray:
    """The level of every bucket, over all documents; 2**SKETCH_BITS bytes, whatever the corpus."""
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    rows = profile.where("block IS NOT NULL").select("block", "counts").groupBy("block").applyInPandas(_summed, "block int, levels binary")
    for r in rows.toLocalIterator():
        out[r["block"] << BLOCK_BITS : (r["block"] + 1) << BLOCK_BITS] = np.frombuffer(r["levels"], np.uint8)
    return out


def _upper_nodes(levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = levels.value, set()
        for batch in batches:
            for _, _, cuts, sh in shingle_sets(batch.column("text")):
                sid = set_ids(cuts, sh)
                size = np.diff(cuts)
                fresh = np.zeros(len(sid), bool)
                for i in np.flatnonzero(size >= SMALLEST):
                    if sid[i] not in seen:
                        seen.add(sid[i])
                        fresh[i] = True
                row = np.repeat(np.arange(len(size)), size)
                rank = level[(sh >> _U(64 - SKETCH_BITS)).astype(np.int64)]
                keep = fresh[row]
                row, rank, tok = row[keep], rank[keep], sh[keep]
                order = np.lexsort((tok, rank, row))
                row, tok = row[order], tok[order]
                first = np.searchsorted(row, np.arange(len(size)))
                at = np.arange(len(row)) - first[row]
                upper = at < prefix_length(size)[row]
                row, tok, at = row[upper], tok[upper], at[upper]
                yield pa.RecordBatch.from_arrays([pa.array(tok.view(np.int64)), pa.array(sid[row]), pa.array(size[row].astype(np.int32)), pa.array(at.astype(np.int32))], names=["tok", "sid", "n", "level"])

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of nodes where two different sets meet, each set once in a part: in that of its own size (``own``), and in that of sets up to 1.25 times as large. ``node`` tells the part; ``hot``, that it has over ``TILE`` sets."""
    for g, whole in sorted_groups(batches, ["tok", "sid", "n", "level"], SLICE):
        new = np.ones(len(g["tok"]), bool)
        new[1:] = (g["tok"][1:] != g["tok"][:-1]) | (g["sid"][1:] != g["sid"][:-1])
        tok, sid, n, level = (g[c][new] for c in ("tok", "sid", "n", "level"))
        band = np.floor(np.log(n) / np.log(100 / PERCENT) + 1e-9).astype(np.uint64)
        node = mix(np.concatenate([tok, tok]).view(np.uint64) + mix(np.concatenate([band, band + _U(1)]) + _U(7)))
        own = np.repeat([True, False], len(tok))
        order = np.argsort(node, kind="stable")
        start = np.ones(len(order), bool)
        start[1:] = node[order][1:] != node[order][:-1]
        run = np.empty(len(order), np.int64)
        run[order] = np.cumsum(start) - 1
        size = np.bincount(run)
        # of a node that comes in slices, nothing is known but that it is large
        keep = (size > 1)[run] & (np.bincount(run, own) > 0)[run] if whole else np.ones(len(run), bool)
        hot = (size > TILE)[run] | (not whole)
        two = lambda x: np.concatenate([x, x])[keep]  # noqa: B023, E731
        yield pa.RecordBatch.from_arrays([pa.array(node[keep].view(np.int64)), pa.array(own[keep]), pa.array(two(sid)), pa.array(two(n)), pa.array(two(level)), pa.array(hot[keep])], names=["node", "own", "sid", "n", "level", "hot"])


SLICE = 1 << 17
"""Rows of one node that are held at a time."""
PARTED = "node long, own boolean, sid long, n int, level int, hot boolean"


def _salts(column: str = "hot") -> F.Column:
    return F.when(F.col(column), SALTS).otherwise(1)


def _may_pair(x: str, y: str) -> F.Column:
    """Sizes and levels of two sets of a part allow a match whose first common shingle is the node's."""
    c = lambda t, n: F.col(f"{t}.{n}").cast("long")
    sizes = (c(x, "n") * PERCENT <= c(y, "n") * 100) & (c(y, "n") * PERCENT <= c(x, "n") * 100)
    rest = 1 + F.least(c(x, "n") - c(x, "level") - 1, c(y, "n") - c(y, "level") - 1)
    return sizes & ((100 + PERCENT) * rest >= PERCENT * (c(x, "n") + c(y, "n"))) & (F.col(f"{x}.own") | F.col(f"{y}.own"))


def _stars(parted: DataFrame) -> DataFrame:
    """Each set with the leaders of its part of the node, where a match is possible: (a, b), once each."""
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("sid"), "sid"))
    lead = parted.withColumn("r", rank).where(F.col("r") <= LEADERS).drop("r")
    lead = lead.withColumn("salt", F.explode(F.sequence(F.lit(0), _salts() - 1)))
    each = parted.withColumn("salt", F.pmod(F.xxhash64("sid"), _salts()).cast("int"))
    met = each.alias("x").join(lead.alias("y"), ["node", "salt"]).where((F.col("x.sid") != F.col("y.sid")) & _may_pair("x", "y"))
    return met.select(F.least("x.sid", "y.sid").alias("a"), F.greatest("x.sid", "y.sid").alias("b")).distinct()


def _tiles(labelled: DataFrame) -> DataFrame:
    """The sets of parts that several components share, a row for each pair of blocks that a set belongs to: (tile, mine, sid, n, level, own, comp)."""
    one = labelled.groupBy("node", "hot", "comp").agg(F.count("*").alias("c"), F.max("own").alias("own"))
    node = one.groupBy("node", "hot").agg(F.sum("c").alias("all"), F.max(F.struct("c", "comp")).alias("top"), F.count("*").alias("comps"), F.max("own").alias("own"))
    # a part that no set has as its own is covered by the part before it
    node = node.where((F.col("comps") > 1) & (F.col("all") > LEADERS) & F.col("own")).select("node", F.explode(F.sequence(F.lit(0), _salts() - 1)).alias("salt"), F.col("top.comp").alias("top"), F.ceil(F.col("top.c") / TILE).cast("int").alias("large"), F.ceil((F.col("all") - F.col("top.c")) / TILE).cast("int").alias("small"))
    d = labelled.withColumn("salt", F.pmod(F.xxhash64("sid"), _salts()).cast("int")).join(node, ["node", "salt"])
    block = F.pmod(F.xxhash64("sid", F.lit(1)), F.when(F.col("comp") == F.col("top"), F.col("large")).otherwise(F.col("small"))).cast("int")
    d = d.withColumn("mine", F.when(F.col("comp") == F.col("top"), -1 - block).otherwise(block))
    to_small = F.sequence(F.lit(0), F.col("small") - 1)
    to_large = F.transform(F.sequence(F.lit(1), F.col("large")), lambda k: -k)
    d = d.withColumn("other", F.explode(F.when(F.col("mine") < 0, to_small).otherwise(F.concat(to_large, to_small))))
    tile = F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other"))
    return d.select(tile.alias("tile"), "mine", "sid", "n", "level", "own", "comp")


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _folded(digest: np.ndarray, words: int) -> np.ndarray:
    """Digests as rows of ``words`` words: wider ones folded; only those of that width or twice it can be."""
    out = np.empty((len(digest), words), np.uint64)
    for i, x in enumerate(digest):
        w = np.frombuffer(x, np.uint64)
        out[i] = w if len(w) == words else w[:words] | w[words:]
    return out


def _top(up: dict[int, int], x: int) -> int:
    while (y := up.get(x, x)) != x:
        up[x] = up.get(y, y)
        x = y
    return x


def _apart(batches: Iterator[pa.RecordBatch], forest: bool = False) -> Iterator[pa.RecordBatch]:
    """Pairs of two blocks (of one, if a tile has no other) whose sets are in different components, and may match by size, level and digest. ``forest``: only pairs, the closest first, that join a tile's components without a circle."""
    for g, _ in sorted_groups(batches, ["tile", "mine", "comp", "n", "level", "own", "sid", "digest"], 1 << 62):
        order = np.lexsort((g["n"], g["tile"]))
        tile, mine, comp, n, level, own, sid, digest = (g[c][order] for c in ("tile", "mine", "comp", "n", "level", "own", "sid", "digest"))
        n, level = n.astype(np.int64), level.astype(np.int64)
        heads = np.append(np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])), len(tile))
        mixed = np.minimum.reduceat(comp, heads[:-1]) != np.maximum.reduceat(comp, heads[:-1])
        alone = np.minimum.reduceat(mine, heads[:-1]) == np.maximum.reduceat(mine, heads[:-1])
        for k in np.flatnonzero(mixed):
            x, y = heads[k], heads[k + 1]
            # by size: a set's possible partners are the next ones, up to 1.25 times as large
            width = np.array([len(d) // 8 for d in digest[x:y]])
            upto = x + np.searchsorted(n[x:y], n[x:y] * 100 // PERCENT, "right")
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            rows = {w: (np.flatnonzero((width == w) | (width == 2 * w)) + x, _folded(digest[x:y][(width == w) | (width == 2 * w)], w)) for w in np.unique(width).tolist()}
            for i in range(x, y - 1):
                who, bits = rows[int(width[i - x])]
                lo, hi = np.searchsorted(who, i + 1), np.searchsorted(who, upto[i - x])
                who, bits = who[lo:hi], bits[lo:hi]
                rest = 1 + np.minimum(n[i] - level[i] - 1, n[who] - level[who] - 1)
                other = (comp[who] != comp[i]) & (own[who] | own[i]) & ((100 + PERCENT) * rest >= PERCENT * (n[i] + n[who]))
                if not alone[k]:
                    other &= mine[who] != mine[i]
                if not other.any():
                    continue
                who, bits = who[other], bits[other]
                bit = np.frombuffer(digest[i], np.uint64)
                a = n[i] - np.bitwise_count(bit & ~bits).sum(axis=1, dtype=np.int64)
                b = n[who] - np.bitwise_count(bits & ~bit).sum(axis=1, dtype=np.int64)
                both = np.minimum(a, b)
                near = (100 + PERCENT) * both >= PERCENT * (n[i] + n[who])
                if forest:
                    found.append((np.full(int(near.sum()), i), who[near], (both[near] / (n[i] + n[who[near]])).astype(np.float32)))
                    continue
                if near.any():
                    yield _edges(np.full(int(near.sum()), sid[i]), sid[who[near]])
            if found:
                a, b, close = (np.concatenate(c) for c in zip(*found, strict=True))
                kept, up, left = [], {}, len(np.unique(comp[x:y])) - 1
                for k2 in np.argsort(-close, kind="stable"):
                    p, q = _top(up, int(comp[a[k2]])), _top(up, int(comp[b[k2]]))
                    if p != q:
                        up[p], left = q, left - 1
                        kept.append(k2)
                        if not left:
                            break
                yield _edges(sid[a[kept]], sid[b[kept]])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _apart(batches, True)


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = (batch.column(c).to_pylist() for c in ("nx", "ny", "dx", "dy"))
        keep = [may_match(*r) for r in zip(*cols, strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _sets(bits, per: int = 0):
    """The whole sets whose names are among ``bits``; with their digests, if ``per`` is given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = bits.value, set()
        for batch in batches:
            for _, _, cuts, sh in shingle_sets(batch.column("text")):
                sid = set_ids(cuts, sh)
                rows = [i for i in np.flatnonzero((np.diff(cuts) > 0) & in_bits(wanted, sid)) if sid[i] not in seen]
                seen.update(sid[i] for i in rows)
                told = [pa.array(sid[rows]), pa.array([sh[cuts[i] : cuts[i + 1]].tobytes() for i in rows], pa.binary())]
                if per:
                    told.append(pa.array([digests(cuts[i : i + 2], sh, per)[0] for i in rows], pa.binary()))
                yield pa.RecordBatch.from_arrays(told, names=["sid", "members", "digest"][: len(told)])

    return run


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(p) + len(q) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _fetched(texts: DataFrame, ends: DataFrame, count: int, per: int = 0) -> DataFrame:
    """(sid, members) of the sets named in ``ends`` (``count`` rows), and of few others that the hash bits let through; with ``per``, their digests too."""
    bits = texts.sparkSession.sparkContext.broadcast(hash_bits(ends, "sid", min(29, max(20, (16 * count + 1).bit_length()))))
    schema = "sid long, members binary" + (", digest binary" if per else "")
    # copies of a set come once from each task
    return texts.mapInArrow(tidy(_sets(bits, per)), schema).groupBy("sid").agg(*[F.first(c).alias(c) for c in ("members", "digest")[: 2 if per else 1]])


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of ``pairs`` whose whole sets, among ``sets``, are similar enough."""
    x = sets.select(F.col("sid").alias("xs"), F.col("members").alias("x"))
    y = sets.select(F.col("sid").alias("ys"), F.col("members").alias("y"))
    both = pairs.join(y, F.col("b") == F.col("ys")).join(x, F.col("a") == F.col("xs"))
    return spill(both.select("a", "b", "x", "y").mapInArrow(_linked, "a long, b long"), "links")


def _verified(texts: DataFrame, marks: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs of ``pairs`` whose whole sets are similar enough; ``marks`` has each set's size and digest."""
    x = marks.select(F.col("sid").alias("a"), F.col("n").alias("nx"), F.col("digest").alias("dx"))
    y = marks.select(F.col("sid").alias("b"), F.col("n").alias("ny"), F.col("digest").alias("dy"))
    near = pairs.join(y, "b").join(x, "a").select("a", "b", "nx", "ny", "dx", "dy")
    edges = spill(near.mapInArrow(_plausible, "a long, b long"), "near")
    ends = edges.select(F.col("a").alias("sid")).union(edges.select("b"))
    count = ends.count()
    if not count:
        return edges
    sets = spill(_fetched(texts, ends, count), "sets")
    out = _checked(edges, sets)
    drop_scratch(sets, edges)
    return out


def _named(rows: DataFrame, comp: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``rows``, and the component of each set."""
    named = comp.select(F.col("node").alias("named"), "component")
    return rows.join(named, F.col("sid") == F.col("named"), "left").select(*columns, F.coalesce("component", "sid").alias("comp"))


def classes(slim: DataFrame) -> DataFrame:
    """_ord, doc_id, n_shingles, sid and comp (the name of a set in the same component) of every row of ``slim`` (numbered by ``ordered_documents``), written."""
    spark = slim.sparkSession
    texts = slim.select("text")
    id_type = slim.schema["doc_id"].dataType.simpleString()
    profile = spill(slim.select("_ord", "doc_id", "text").mapInArrow(tidy(_profile), f"at long, doc_id {id_type}, n long, sid long, digest binary, block int, counts binary"), "profile")
    marks = profile.where("n > 0").groupBy("sid").agg(F.first("n").alias("n"), F.first("digest").alias("digest"))
    levels = spark.sparkContext.broadcast(sketch(profile))
    upper = texts.mapInArrow(tidy(_upper_nodes(levels)), "tok long, sid long, n int, level int")
    dealt = upper.repartition(partitions(spark), "tok").sortWithinPartitions("tok", "sid")
    parted = spill(dealt.mapInArrow(tidy(_met), PARTED), "parted")
    free_shuffles(spark)
    stars = spill(_stars(parted), "stars")
    free_shuffles(spark)
    links = _verified(texts, marks, stars)
    comp = components(links)
    free_shuffles(spark)
    labelled = _named(parted, comp, "node", "hot", "own", "sid", "n", "level")
    left = spill(_tiles(labelled), "open")
    count = left.count()
    if count:
        wide = spill(_fetched(texts, left.select("sid"), count, WIDE), "wide")
        free_shuffles(spark)

        def candidates(rows: DataFrame, find, name: str) -> DataFrame:
            dealt = rows.join(wide.select("sid", "digest"), "sid").select("tile", "mine", "comp", "n", "level", "own", "sid", "digest").repartition(partitions(spark), "tile").sortWithinPartitions("tile")
            with rows_per_batch(spark, 1000):  # a digest has one or two bytes a word of its text
                return spill(dealt.mapInArrow(find, "a long, b long").distinct(), name)

        # first a few pairs, that join most of what belongs together; where there is none, there are no others
        few = candidates(left, _forest, "forest")
        if few.limit(1).count():
            more = _checked(few.join(stars, ["a", "b"], "left_anti"), wide)
            if more.limit(1).count():
                comp = components(links.union(more))
            again = _named(left, comp, "tile", "mine", "sid", "n", "level", "own")
            rest = candidates(again, _apart, "apart")
            last = _checked(rest.join(stars.union(few), ["a", "b"], "left_anti"), wide)
            if last.limit(1).count():
                comp = components(links.union(more).union(last))
            drop_scratch(rest, more, last)
        drop_scratch(wide, few)
    out = profile.where("block IS NULL").join(comp, F.col("sid") == F.col("node"), "left")
    out = spill(out.select(F.col("at").alias("_ord"), "doc_id", F.col("n").alias("n_shingles"), "sid", F.coalesce("component", "sid").alias("comp")), "classes")
    drop_scratch(profile, parted, stars, left, links)
    free_shuffles(spark)
    return out


def find(docs: DataFrame) -> DataFrame:
    """_ord, doc_id, n_shingles, component_id and first (the _ord of the component's first row) of every row of ``docs``."""
    return _firsts(ordered_documents(docs)[0])


def _firsts(slim: DataFrame) -> DataFrame:
    rows = classes(slim)
    least = rows.where("n_shingles > 0").groupBy(F.col("comp").alias("_c")).agg(F.min("doc_id").alias("_id"), F.min("_ord").alias("_first"))
    out = rows.join(least, (F.col("n_shingles") > 0) & (F.col("comp") == F.col("_c")), "left")
    return out.select("_ord", "doc_id", "n_shingles", F.coalesce("_id", "doc_id").alias("component_id"), F.coalesce("_first", "_ord").alias("first"))


def filter_documents(docs: DataFrame) -> DataFrame:
    """One row of each component, that of the least doc_id; all columns."""
    # numbered once: a second sort may cut its ranges elsewhere and number rows otherwise
    slim, _ = ordered_documents(docs, *[c for c in docs.columns if c not in ("doc_id", "text")])
    kept = _firsts(slim).where("_ord = first").select(F.col("_ord").alias("_kept"))
    return slim.join(kept, F.col("_ord") == F.col("_kept"), "left_semi").select(*docs.columns)


def op3(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
