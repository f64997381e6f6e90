import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, parts=3):
    """Documents of (doc_id, text), with extra columns whose names clash with the operators' own."""
    full = [(i, t, "en" if i is None or i % 3 else None, "src0", len(t or "")) for i, t in rows]
    d = spark.createDataFrame(full, SCHEMA).selectExpr("*", "1 AS score", "2 AS shard", "3 AS piece", "4 AS entities", "'x' AS component", "5 AS n_words")
    return d.repartition(parts) if rows else d


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows, parts=3: frame(spark, rows, parts)


@pytest.fixture(scope="session")
def odd_rows():
    """Unique ids; nulls, empty, very long, equal and nearly equal texts."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = text(120), text(40)
    rows = [None, "", "   \n\t ", "one", "two words", base, base, base.upper(), text(9000), "x" * 5000, "ab " * 300, passage]
    for _ in range(25):
        w = base.split(" ")
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append(" ".join(w))
    rows += [f"{text(rng.randint(5, 80))}\n{passage}\n{text(rng.randint(5, 80))}" for _ in range(12)]
    rows += [text(rng.randint(1, 60)) for _ in range(20)]
    return list(enumerate(rows))
