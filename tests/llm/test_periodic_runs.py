"""Runs against every period tried in plain Python, the registered query, odd rows."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import periodic_runs as R
from tidelog.llm.queries import op13_periodic_runs


def runs_by_trying(words, least=24):
    found = []
    for q in range(1, len(words) // 3 + 1):
        k = 0
        while k < len(words) - q:
            j = k
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j - k + q >= max(least, 3 * q) and j > k:
                part = words[k : j + q]
                if not any(part[p:] == part[: len(part) - p] for p in range(1, q)):
                    found.append((k, j - k + q, q))
            k = max(j, k + 1)
    return sorted(found)


def texts(rng, kinds, size):
    words = []
    while len(words) < size:
        if rng.random() < 0.5:
            part = [rng.randrange(kinds) for _ in range(rng.randint(1, 12))]
            words += (part * 8)[: rng.randint(1, len(part) * 8)]
        else:
            words += [rng.randrange(60) for _ in range(rng.randint(1, 20))]
    return words


@pytest.mark.parametrize("seed", range(40))
def test_the_automaton_finds_all_runs(seed):
    rng = random.Random(seed)
    for least in (3, 6, 24):
        words = texts(rng, rng.choice([1, 2, 3, 6]), rng.choice([5, 50, 200]))
        assert list(R.runs_of(words, least)) == runs_by_trying(words, least)


@pytest.mark.parametrize("seed", range(40))
def test_what_is_left_out_holds_no_run(seed):
    words = texts(random.Random(100 + seed), 4, 400)
    assert R.find([b"%d" % w for w in words]) == runs_by_trying(words)


@given(st.lists(st.integers(0, 1), max_size=60))
@settings(max_examples=200, deadline=None)
def test_two_words(words):
    assert list(R.runs_of(words, 3)) == runs_by_trying(words, 3)


def test_long_runs_take_few_steps():
    part = list(range(700))
    assert list(R.runs_of(part * 9)) == [(0, 6300, 700)]
    assert list(R.runs_of([5] * 30_000)) == [(0, 30_000, 1)]


def test_the_run_with_most_periods():
    assert R.longest([]) is None
    assert R.longest([(0, 30, 10), (5, 24, 8), (9, 24, 7), (50, 48, 14)]) == (9, 24, 7)


def described(doc, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_by_trying(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
    best = max(runs, key=lambda r: (r[1] * 10**12 // r[2], -r[0], -r[2]), default=None)
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc, len(runs), *(best or [None] * 3), best and 1000 * best[1] // best[2], sha(lines.encode()), sha(b" ".join(kept)))


def test_the_query(spark, tmp_path, frame, corpus):
    rng = random.Random(9)
    rows = [(d, t[:3000] if t else t) for d, t in corpus]
    rows += [(1000 + i, " \n".join(f"w{w}" for w in texts(rng, 3, 150))) for i in range(60)]
    rows += [(rows[-1][0], rows[-1][1]), (None, "a " * 40), (2000, "  x" * 30)]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op13_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(repr(described(d, t)) for d, t in rows)


def test_odd_rows(frame):
    assert R.find_runs(frame([])).count() == 0
    row = R.find_runs(frame([(1, None)])).first()
    assert (row["runs"], row["best"], row["collapsed"]) == ([], None, "")
    row = R.find_runs(frame([(1, "x " * 50_000 + "y")])).first()
    assert row["runs"] == [row["best"]] and row["collapsed"] == "x y"
