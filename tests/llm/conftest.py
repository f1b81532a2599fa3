import os
import random
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT]

# Columns that clash with names used inside the operators.
CLASH = ["key", "node", "row", "id", "n", "spans", "repeats", "features", "label", "level", "size"]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) pairs, in several partitions, with extra columns that hold nulls."""

    def make(rows, clash=True):
        schema = "doc_id long, text string" + "".join(f", {c} string" for c in CLASH if clash)
        data = [(d, t, *[None] * len(CLASH) * clash) for d, t in rows]
        return spark.createDataFrame(data, schema).repartition(3)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Texts of invented words: copies, near copies, common passages, one very long text, empty and null texts."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(600)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for d in range(160):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 8, 12, 40, 120, 300]))]
        if d % 5 == 0:
            at = rng.randint(0, len(text))
            text[at:at] = passage
        if d % 4 == 1 and rows:
            text = (rows[rng.randrange(len(rows))][1] or "").split()
            for _ in range(rng.randint(0, max(1, len(text) // 40))):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(words)
        if d % 11 == 0:
            text = [w.upper() for w in text]
        rows.append((d, rng.choice([" ", "\n", "  "]).join(text)))
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "a"), (204, "A"), (205, " ".join(rng.choice(words) for _ in range(9000)))]
    rows += [(None, "no id here"), (None, None), (7, rows[7][1]), (206, "x" * 5000), (207, "é ß 漢字 ☃   end")]
    return rows
