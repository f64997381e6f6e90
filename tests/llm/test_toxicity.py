import random
import zlib

import numpy as np
import pytest

from starmill.llm import toxicity


@pytest.fixture(scope="module")
def world():
    rng = random.Random(2)
    plain, bad = [f"w{i}" for i in range(800)], ["vile", "scum", "rotten", "hateful"]
    rows, marks = [], []
    for i in range(900):
        t = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        y = int(i % 5 == 0)
        for _ in range(rng.randint(3, 6) * y):
            t[rng.randrange(len(t))] = rng.choice(bad)
        rows.append((i, " ".join(t)))
        marks.append((i, 1, y))
    return rows, marks


def test_separates_held_out_rows(spark, make, world):
    rows, marks = world
    d = make([*rows, (5000, None), (5001, ""), (0, rows[0][1])])
    labels = spark.createDataFrame([*marks, (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    out = toxicity.score(d, toxicity.fit(d, labels)).collect()
    assert len(out) == len(rows) + 3
    truth = {i: y for i, _, y in marks}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    empty = [r["score"] for r in out if r["doc_id"] in (5000, 5001)]
    assert empty[0] == empty[1] < 0.3
    assert all(len(r["evidence"]) == 3 for r in held)


def test_nearest_are_exact(spark, make, world):
    rows, marks = world
    d = make(rows)
    m = toxicity.fit(d, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    x = m.index
    dense = np.zeros((len(x.ids), len(m.terms) + 1))
    for t in range(len(m.terms)):
        dense[x.row[x.start[t] : x.start[t + 1]], t] = x.weight[x.start[t] : x.start[t + 1]]
    dense[:, -1] = x.rest
    assert np.allclose((dense**2).sum(axis=1), 1)
    for i in range(len(x.ids)):
        t = np.flatnonzero(dense[i, :-1])
        _, sim = x.nearest(dense[i, -1], t, dense[i, t], 25)
        assert np.allclose(sim, np.sort(dense @ dense[i])[::-1][: len(sim)])


def test_without_labels_or_rows(spark, make):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score(make([(1, "a")]), toxicity.fit(make([(1, "a")]), none)).collect()} == {0.5}
    assert toxicity.score(make([]), toxicity.fit(make([]), none)).collect() == []


def test_all_words_of_the_examples_are_indexed(spark, make):
    rng = random.Random(4)
    plain, bad = [f"w{i}" for i in range(50)], [f"bad{i}" for i in range(300)]
    rows = [(i, " ".join([rng.choice(plain) for _ in range(20)] + (rng.sample(bad, 60) if i % 2 else []))) for i in range(900)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    assert len(toxicity.fit(make(rows), labels).terms) == 350
