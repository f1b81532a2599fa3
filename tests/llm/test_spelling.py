"""Near words against all pairs tried in plain Python, forms and roots, the registered query, odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidelog.llm import spelling as S
from tidelog.llm.queries import op11_spelling_variants


def apart(a, b):
    """Whether one edit turns a into b, by trying all of them."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(counts):
    rows = {}
    for w, n in counts.items():
        near = [v for v in counts if apart(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 5 * n else None
        rows[w] = [n, len(near), form, form and counts[form]]
    for w in rows:
        root = w
        while rows[root][2]:
            root = rows[root][2]
        rows[w].append(root)
    return {w: tuple(r) for w, r in rows.items()}


def variants(seed, letters, size):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(size // 2)}
    for w in sorted(words)[: size // 2]:
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]}
    words -= {""}
    return {w: 5 ** rng.randint(1, 6) for w in sorted(words)}


def test_one_letter_apart():
    words = sorted(variants(1, "abé", 200)) + ["x" * 300, "x" * 299, "x" * 298 + "yx"]
    flat, at = S.letters(pa.array(words))
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    assert S.one_letter_apart(flat, at, a, b).tolist() == [apart(words[i], words[j]) for i, j in zip(a, b)]


@pytest.mark.parametrize("seed, letters, shard_words", [(2, "ab", 40), (3, "abcdefghijéüà", 30), (4, "esardto", 7), (5, "abcdefghij", 10_000)])
def test_variants(spark, seed, letters, shard_words):
    counts = variants(seed, letters, 400)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = S.group_variants(words, shard_words=shard_words).collect()
    assert len(got) == len(counts)
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got} == grouped(counts)


def test_the_query(spark, frame, tmp_path):
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abcdé") for _ in range(rng.randint(5, 8))) for _ in range(150)})
    words += [w[:-1] + "x" for w in words[:40]]
    rows = [(d, rng.choice([" ", "-", "\n", "1"]).join(rng.choice(words[: rng.choice([5, 190])]).upper() if rng.random() < 0.3 else rng.choice(words) for _ in range(60))) for d in range(120)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (500, None), (501, ""), (502, "ÉÉÉaaa " * 9), (503, "é" * 4000 + " 漢字漢字漢字漢字 " * 9)]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = op11_spelling_variants(spark, str(tmp_path)).collect()
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got} == grouped(counts)
    assert len(got) == len(counts) > 100


def test_odd_rows(spark, frame, corpus, tmp_path):
    assert S.vocabulary(frame(corpus), least_count=1).where("length(word) < 6").count() == 0
    assert S.group_variants(S.vocabulary(frame([]))).count() == 0
    one = S.group_variants(spark.createDataFrame([("abcdef", 9)], "word string, n long")).first()
    assert (one["n_near"], one["form"], one["form_n"], one["root"]) == (0, None, None, "abcdef")
