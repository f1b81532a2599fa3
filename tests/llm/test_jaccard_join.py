"""The join against all pairs, in plain Python."""

import random
import re

import pytest

import corpus_pipeline
from tidelog.llm.components import components
from tidelog.llm.jaccard_join import PrefixTree, Union, jaccard_components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*[words[i:] for i in range(size)]))


def expected(rows, size, percent):
    rows = [(d, grams(t, size)) for d, t in rows]
    union = Union(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                union.join(i, j)
    least = {}
    for i, (d, s) in enumerate(rows):
        if d is not None and s:
            least[union.find(i)] = min(d, least.get(union.find(i), d))
    return sorted(((d, len(s), least.get(union.find(i), d) if s else d) for i, (d, s) in enumerate(rows)), key=str)


def answer(df, **options):
    return sorted((tuple(r) for r in jaccard_components(df, **options).collect()), key=str)


@pytest.mark.parametrize("size,percent,chunk", [(3, 90, 600_000), (5, 80, 600_000), (3, 80, 300)])
def test_against_all_pairs(frame, corpus, size, percent, chunk):
    got = answer(frame(corpus), size=size, percent=percent, chunk_grams=chunk)
    assert got == expected(corpus, size, percent)


def test_hot_group_of_near_copies_in_small_chunks(frame):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(120):
        text = list(base)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((d, " ".join(text)))
    assert answer(frame(rows), size=3, percent=80, chunk_grams=500) == expected(rows, 3, 80)


def test_empty_table(frame):
    assert answer(frame([])) == []


def test_tree_finds_the_same_links_as_all_pairs():
    rng = random.Random(2)
    sets = [sorted(rng.sample(range(40), rng.randint(1, 20))) for _ in range(60)]
    sets += [sorted({*s[:-1], 41}) for s in sets[:20]]
    tree = PrefixTree(70, Union(len(sets)))
    for i, own in enumerate(sets):
        linked = {j for j in range(i) if 100 * len({*own} & {*sets[j]}) >= 70 * len({*own} | {*sets[j]})}
        assert set(tree.links(None, own)) == linked
        tree.add(i, own)


def test_components_of_a_path_a_star_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (None, 3)]
    found = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(20)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_rows_without_an_id_link_and_only_the_first_of_linked_rows_stays(spark, frame, tmp_path):
    rng = random.Random(6)
    text = lambda n=60: [f"w{rng.randrange(5000)}" for _ in range(n)]
    base, other, apart = text(), text(), text()
    near, far = base[:-1] + ["y"], base[1:-1] + ["y"]
    rows = [(5, base), (None, near), (6, base[1:] + ["z"]), (9, other), (9, apart), (9, far), (None, other), (None, apart)]
    rows = [(d, " ".join(t)) for d, t in rows]
    assert answer(frame(rows), size=5, percent=80) == expected(rows, 5, 80)
    docs = frame(rows)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.dtypes == docs.dtypes
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([rows[0], rows[3], rows[4]])
    # The benchmark's texts go from rows with a null id too, and other texts of that id stay.
    spark.createDataFrame([(1, rows[3][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.benchmark_leaks(spark, docs, str(tmp_path)).collect()
    assert sorted(r["text"] for r in clean) == sorted(t for _, t in rows if t != rows[3][1])
