"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Fitting, from labelled rows only, at most ``Limits.examples`` of each class (those
least by a hash of their doc_id) and all their words: idf comes from all documents,
and each word's phi (its correlation with the label, without sign) from the examples. A vector has the weight (1 + ln tf) * idf * phi for each of the words, so that none
is left out, and those that tell the classes apart decide. Words that no example has
could add to no similarity, have no phi, and count for nothing.

Scoring: the examples are held in an inverted index, its longest lists as a matrix.
A batch of texts is scored against all examples at once; no list or example is
skipped, so that the k nearest are exact. They vote with their
similarity to the power ``SHARP``, clean examples counting for the rows they stand
for; votes are calibrated by isotonic regression over the examples themselves, each
scored without itself. Evidence: the nearest examples with similarity and label.

Defined results: null and empty texts have the zero vector, which equals only that
of an example without words; a text that is like no example at all has the share of
toxic rows as its score; without any labelled row of either class, all scores are the
share of toxic rows (0.5 without labels); a doc_id labelled more than once is toxic
if any label says so; labels with null fields count for nothing; repeated rows get
equal scores; a null doc_id is not held out; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ALNUM, BYTE_LOWER, chunks, prefix_hash, span_hash, table, words

SHARP = 4.0
BATCH = 64
COMMON = 16
"""A term is common if more than one of so many examples has it."""


@dataclass(frozen=True)
class Limits:
    examples: int = 5_000
    nearest: int = 25
    threshold: float = 0.7


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def _terms(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, words of each row, row of each word, hash of each word)."""
    for lo, hi, data, offs in chunks(pc.utf8_lower(col)):
        s, e, t = words(data, offs, ALNUM)
        h = span_hash(prefix_hash(data, BYTE_LOWER), s, e) if len(s) else np.zeros(0, np.uint64)
        yield lo, hi, np.bincount(t, minlength=hi - lo), t, h


def _label_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that have a term, per task."""
    for batch in batches:
        y = batch.column("toxic").to_numpy()
        for lo, _, _, t, h in _terms(batch.column("text")):
            order = np.lexsort((h, t))
            t, h = t[order], h[order]
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
            u, at = np.unique(h[new], return_inverse=True)
            toxic = np.bincount(at, weights=y[lo + t[new]], minlength=len(u)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(toxic), pa.array(np.bincount(at, minlength=len(u)).astype(np.int64) - toxic)], names=["term", "a", "c"])


def _sparse(col: pa.Array, terms: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, row, term number, tf) of the chosen terms (sorted hashes)."""
    for lo, hi, _, t, h in _terms(col):
        row = term = tf = np.zeros(0, np.int64)
        if len(terms) and len(h):
            at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
            hit = terms[at] == h
            key, tf = np.unique(t[hit] * len(terms) + at[hit], return_counts=True)
            row, term = key // len(terms), key % len(terms)
        yield lo, hi, row, term, tf


def _document_counts(terms):
    """Documents that have each chosen term, and all, per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = terms.value
        df, total = np.zeros(len(chosen), np.int64), 0
        for batch in batches:
            for lo, hi, _, term, _ in _sparse(batch.column("text"), chosen):
                df += np.bincount(term, minlength=len(chosen))
                total += hi - lo
        has = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(np.append(-1, has)), "df": pa.array(np.append(total, df[has]))})

    return run


def vectors(count: int, row: np.ndarray, term: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ``count`` rows, 1 for each zero vector (0 for others); and the normalised weight of each (row, term)."""
    w = (1 + np.log(np.maximum(tf, 1))) * idf[term]
    norm = np.sqrt(np.bincount(row, weights=w**2, minlength=count))
    zero = norm == 0
    return zero.astype(float), w / np.where(zero, 1, norm)[row]


class Index:
    """The examples by term; terms that many examples have are held as rows of a matrix too."""

    def __init__(self, ids: np.ndarray, toxic: np.ndarray, count: np.ndarray, rest: np.ndarray, row: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: int):
        self.ids, self.toxic, self.count, self.rest = ids, toxic, count, rest
        order = np.lexsort((row, term))
        self.row, self.weight = row[order].astype(np.int32), weight[order]
        self.start = np.searchsorted(term[order], np.arange(terms + 1))
        self._common: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_common": None}

    def _matrix(self) -> tuple[np.ndarray, np.ndarray]:
        """The matrix row of each term (-1: none), and the matrix; its last row is of the zero vectors."""
        if self._common is None:
            common = np.flatnonzero(COMMON * np.diff(self.start) > len(self.ids))
            at = np.full(len(self.start) - 1, -1)
            at[common] = np.arange(len(common))
            dense = np.zeros((len(common) + 1, len(self.ids)))
            for i, t in enumerate(common):
                r = slice(self.start[t], self.start[t + 1])
                dense[i, self.row[r]] = self.weight[r]
            dense[-1] = self.rest
            self._common = at, dense
        return self._common

    def similarities(self, base: np.ndarray, cut: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of texts (text i has the terms cut[i] : cut[i + 1]) with all examples."""
        at, dense = self._matrix()
        n, who = len(self.ids), np.repeat(np.arange(len(base)), np.diff(cut))
        q = np.zeros((len(base), len(dense)))
        q[:, -1] = base
        held = at[term] >= 0
        q[who[held], at[term[held]]] = weight[held]
        out = q @ dense
        t, who, weight = term[~held], who[~held], weight[~held]
        size = self.start[t + 1] - self.start[t]
        if size.sum():
            post = np.repeat(self.start[t] - np.cumsum(size) + size, size) + np.arange(size.sum())
            out += np.bincount(np.repeat(who, size) * n + self.row[post], np.repeat(weight, size) * self.weight[post], len(base) * n).reshape(out.shape)
        # equal vectors in different batches differ in the last bits
        return np.round(out, 12)

    def nearest_of(self, base: np.ndarray, cut: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int, without: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The k nearest examples of each text, exactly, nearest first; ties by place."""
        for lo in range(0, len(base), BATCH):
            hi = min(lo + BATCH, len(base))
            part = slice(cut[lo], cut[hi])
            sims = self.similarities(base[lo:hi], cut[lo : hi + 1] - cut[lo], term[part], weight[part])
            for i, sim in enumerate(sims, lo):
                if without is not None and without[i] >= 0 and self.count[without[i]] <= 1:
                    sim[without[i]] = -np.inf
                who = np.flatnonzero(sim >= np.partition(sim, -k)[-k]) if len(sim) > k else np.arange(len(sim))
                who = who[np.lexsort((who, -sim[who]))][:k]
                who = who[sim[who] > -np.inf]
                yield who, sim[who]

    def nearest(self, base: float, term: np.ndarray, weight: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples of one text."""
        return next(self.nearest_of(np.array([base]), np.array([0, len(term)]), term, weight, k, np.array([without])))


@dataclass
class Model:
    terms: np.ndarray
    idf: np.ndarray
    index: Index | None
    prior: float
    clean_weight: float
    limits: Limits
    steps: np.ndarray | None = None
    levels: np.ndarray | None = None

    def vote(self, who: np.ndarray, sim: np.ndarray, without: int = -1) -> float:
        x = self.index
        n = x.count[who] - (who == without)
        w = np.maximum(sim, 0) ** SHARP * n * np.where(x.toxic[who] == 1, 1.0, self.clean_weight)
        total = w.sum()
        # one vote's worth of the prior
        return float((w[x.toxic[who] == 1].sum() + self.prior) / (total + 1))

    def calibrate(self) -> None:
        """Isotonic regression of the label on the vote, over the examples, each without itself."""
        x = self.index
        term = np.repeat(np.arange(len(self.terms)), np.diff(x.start))
        order = np.lexsort((term, x.row))
        cut, own = np.searchsorted(x.row[order], np.arange(len(x.ids) + 1)), np.arange(len(x.ids))
        near = x.nearest_of(x.rest, cut, term[order], x.weight[order], self.limits.nearest, own)
        votes = np.array([self.vote(who, sim, i) for i, (who, sim) in enumerate(near)])
        weight = x.count * np.where(x.toxic == 1, 1.0, self.clean_weight)
        order = np.argsort(votes, kind="stable")
        level: list[list[float]] = []
        for v, y, w in zip(votes[order], x.toxic[order], weight[order], strict=True):
            level.append([float(y) * w, w, v])
            while len(level) > 1 and level[-2][0] * level[-1][1] >= level[-1][0] * level[-2][1]:
                s, n, v2 = level.pop()
                level[-1] = [level[-1][0] + s, level[-1][1] + n, v2]
        self.steps = np.array([v for _, _, v in level])
        self.levels = np.array([(s + self.prior) / (n + 1) for s, n, _ in level])

    def score(self, vote: float) -> float:
        """The calibrated score; within a step, the vote itself decides, so that order is kept."""
        at = min(int(np.searchsorted(self.steps, vote)), len(self.steps) - 1)
        return float(min(1.0, max(0.0, 0.99 * self.levels[at] + 0.01 * vote)))


def fit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> Model:
    """A model from labelled rows (doc_id, toxic) that are not held out; counts over all of ``docs``."""
    spark = docs.sparkSession
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(~held_out(F.col("doc_id")))
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}  # a row per class
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    prior = n1 / (n0 + n1) if n0 + n1 else 0.5
    if not n1 or not n0:
        return Model(np.zeros(0, np.uint64), np.zeros(0), None, prior, 1.0, limits)
    # at most 2 * limits.examples rows of two numbers
    pick = [marks.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limits.examples) for y in (0, 1)]
    chosen = pick[0].union(pick[1]).select(F.col("doc_id").alias("_id"), "toxic")
    train = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("long").alias("toxic"))
    m1, m0 = min(n1, limits.examples), min(n0, limits.examples)
    a, c = F.col("a").cast("double"), F.col("c").cast("double")
    n = float(m1 + m0)
    chi = n * F.pow(a * (m0 - c) - c * (m1 - a), F.lit(2.0)) / (float(m1) * float(m0) * (a + c) * F.greatest(F.lit(n) - a - c, F.lit(1.0)))
    counts = train.mapInArrow(_label_counts, "term long, a long, c long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("c").alias("c"))
    # as many rows as the examples have words
    best = counts.withColumn("chi", chi).select("term", "chi").toArrow()
    terms, chi = best["term"].to_numpy().view(np.uint64), best["chi"].to_numpy()
    order = np.argsort(terms)
    terms, phi = terms[order], np.sqrt(chi[order] / n)
    known = spark.sparkContext.broadcast(terms)
    df = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_document_counts(known), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    at, had = df["term"].to_numpy(), df["df"].to_numpy()
    total, got = had[at < 0].sum(), np.zeros(len(terms))
    got[at[at >= 0]] = had[at >= 0]
    idf = (np.log((1 + total) / (1 + got)) + 1) * phi
    model = Model(terms, idf, None, prior, (n0 / m0) / (n1 / m1), limits)
    model.index = _index(train, model)
    model.calibrate()
    return model


def _index(train: DataFrame, model: Model) -> Index:
    """Examples with equal vectors and labels are one, with their number."""
    known = train.sparkSession.sparkContext.broadcast(model.terms)

    def run(batches):
        for batch in batches:
            for lo, hi, row, term, tf in _sparse(batch.column("text"), known.value):
                cut = pa.array(np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo).cast(pa.int64()), batch.column("toxic").slice(lo, hi - lo), pa.ListArray.from_arrays(cut, pa.array(term.astype(np.int64))), pa.ListArray.from_arrays(cut, pa.array(tf.astype(np.int64)))], names=["id", "toxic", "term", "tf"])

    # bounded by the number of examples and their words
    rows = train.mapInArrow(run, "id long, toxic long, term array<long>, tf array<long>").groupBy("toxic", "term", "tf").agg(F.min("id").alias("id"), F.count("*").alias("n")).orderBy("id").toArrow().combine_chunks()
    size = pc.list_value_length(rows["term"]).to_numpy()
    row = np.repeat(np.arange(len(size)), size)
    term, tf = (pc.list_flatten(rows[c]).to_numpy() for c in ("term", "tf"))
    rest, weight = vectors(len(size), row, term, tf, model.idf)
    return Index(rows["id"].to_numpy(), rows["toxic"].to_numpy(), rows["n"].to_numpy(), rest, row, term, weight, len(model.terms))


def _score(model, evidence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        seen: dict[bytes, tuple[float, list]] = {}
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))
        for batch in batches:
            scores, told = np.full(len(batch), m.prior), [[]] * len(batch)
            for lo, hi, row, term, tf in _sparse(batch.column("text"), m.terms) if m.index else ():
                base, weight = vectors(hi - lo, row, term, tf, m.idf)
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                if len(seen) >= 4096:
                    seen.clear()
                keys = [base[i].tobytes() + term[cut[i] : cut[i + 1]].tobytes() + weight[cut[i] : cut[i + 1]].tobytes() for i in range(hi - lo)]
                new = np.array([i for key, i in {key: i for i, key in enumerate(keys)}.items() if key not in seen], np.int64)
                size = np.diff(cut)[new]
                ends = np.append(0, np.cumsum(size))
                at = np.repeat(cut[new] - ends[:-1], size) + np.arange(ends[-1])
                for i, (who, sim) in zip(new.tolist(), m.index.nearest_of(base[new], ends, term[at], weight[at], m.limits.nearest), strict=True):
                    near = [{"doc_id": int(m.index.ids[j]), "similarity": float(s), "toxic": int(m.index.toxic[j])} for j, s in zip(who[:evidence], sim[:evidence], strict=True)]
                    seen[keys[i]] = m.score(m.vote(who, sim)) if sim.any() else m.prior, near
                for i, key in enumerate(keys):
                    scores[lo + i], told[lo + i] = seen[key]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= m.limits.threshold).astype(np.int32)), pa.array(told, kind)], names=["doc_id", "held_out", "score", "predicted", "evidence"])

    return run


def score(docs: DataFrame, model: Model, evidence: int = 3) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every row of ``docs``."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(_score(known, evidence), f"doc_id {id_type}, held_out boolean, score double, predicted int, evidence array<struct<doc_id:bigint,similarity:double,toxic:int>>")


def op2(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
