"""Toxicity: held-out quality on planted words, calibration, odd tables."""

import math
import random
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from tidelog.llm import toxicity as T
from tidelog.llm.toxicity import score_toxicity


def planted(n=900):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(800)]
    bad = ["vileword", "nastything", "wretch"]
    rows, labels = [], []
    for d in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        toxic = int(rng.random() < 0.2)
        for _ in range(3 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(bad) + rng.choice(["", "!", "s", "***"]))
        rows.append((d, " ".join(text)))
        labels.append((d, toxic if rng.random() > 0.02 else 1 - toxic))
    return rows, labels


def test_held_out_rows(spark, frame):
    rows, labels = planted()
    odd = [(None, None), (5000, ""), (5001, None), (5002, "漢字"), (3, rows[3][1])]
    known = spark.createDataFrame([*labels, (None, 1), (1, None), (2, labels[2][1])], "doc_id long, toxic int")
    training = F.coalesce(F.col("doc_id") % 4 != 2, F.lit(False))
    got = score_toxicity(frame(rows + odd), known, training).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    truth = [("vile" in t or "nasty" in t or "wretch" in t, score[d]) for d, t in rows if d % 4 == 2]
    bad, good = [s for y, s in truth if y], [s for y, s in truth if not y]
    assert sum(s >= 0.3 for s in bad) >= 0.9 * len(bad) and sum(s >= 0.3 for s in good) <= 0.05 * len(good)


def test_without_labels_or_rows(spark, frame):
    rows, labels = planted(40)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in score_toxicity(frame(rows), none, F.lit(True)).collect()} == {0.0}
    clean = spark.createDataFrame([(d, 0) for d, _ in labels], "doc_id long, toxic int")
    assert {r["score"] for r in score_toxicity(frame(rows), clean, F.lit(True)).collect()} == {0.0}
    assert score_toxicity(frame([]), none, F.lit(True)).count() == 0


def test_term_counts_are_those_of_plain_python():
    rng = random.Random(2)
    words = ["ab", "abc", "abcd", "abcdefgh", "abcdefghij", "xyzxyz", "q"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 9))), rng.randint(0, 1), rng.randint(0, 1)) for _ in range(300)]
    batch = pa.record_batch([pa.array(list(c)) for c in zip(*rows)], ["text", "toxic", "half"])
    got = Counter()
    for made in T._term_counts([batch]):
        for row in made.to_pylist():
            got[tuple(row[c] for c in T.COUNTS)] += 1
    want = {}
    for text, bad, half in rows:
        own = text.split()
        for term in {("", w) for w in own} | {(n, w[:n]) for w in own for n in T.BEGINNINGS if len(w) > n}:
            want.setdefault(term, [0, 0, 0, 0])[2 * half + 1 - bad] += 1
    assert got == Counter(map(tuple, want.values()))


def test_a_lexicon_of_other_texts(spark):
    terms = spark.createDataFrame([(5, 40, 0, 0, 0), (9, 6, 1, 9, 1), (2, 0, 0, 30, 2), (7, 9, 90, 9, 90)], "term long, toxic0 long, clean0 long, toxic1 long, clean1 long")
    sizes = {"toxic0": 50, "clean0": 500, "toxic1": 50, "clean1": 500}
    assert [T._lexicon(terms, sizes, halves)[0].tolist() for halves in ((0,), (1,), (0, 1))] == [[5, 9], [2, 9], [2, 5, 9]]
    weight = T._lexicon(terms, sizes, (0, 1))[1][2]
    assert abs(weight - math.log(15.5 / 101 / (2.5 / 1001))) < 1e-12
