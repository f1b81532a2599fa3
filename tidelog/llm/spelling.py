"""Spelling variants in a vocabulary, by a trie of letter counts.

A word's vector counts its letters by group. One inserted, deleted or replaced letter changes a vector by one more in a
group, one less in a group, or both. Vectors are levels of a trie: the word's length, then the counts of one group after
the other. A search goes down depth first and may spend one count too many and one too few; the words of the leaves
it reaches are compared letter by letter.

The trie is dealt to shards by its first levels. A word is searched for in its own shard and in those of the vectors that
one letter away may lead to; of two near words, the one that stands first by (first levels, word) goes to the shard of the
other, so each pair is found once. A shard gives counts and the best near word per word, never pairs.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.words import mix
from tidelog.session import materialize

LEAST_LENGTH = 6
LEAST_COUNT = 5

# A form is so many times as frequent as its variant.
RATIO = 5

# Groups of letters: a letter's group is its code point modulo GROUPS.
GROUPS = 16

# Words that one shard is to hold of its own.
SHARD_WORDS = 10_000

# Words of a leaf that are compared without going further down, and pairs that are compared at once.
LEAF = 12
PAIRS = 1 << 20

# Distinct words that a task counts before it hands them on.
HELD = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


# --- counting ---


def _flush(counts: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def _count(batches, edit, least: int):
    counts: Counter[str] = Counter()
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if not text:
                continue
            runs = Counter(_RUN.findall(text.encode().translate(_LOWER).decode()))
            if edit is not None:
                runs = edit(doc, runs)
            for word, n in runs.items():
                if len(word) >= least:
                    counts[word] += n
            if len(counts) > HELD:
                yield _flush(counts)
                counts.clear()
    yield _flush(counts)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit=None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the runs of letters of all texts in small letters (A-Z only), with their occurrences.

    Letters are A-Z, a-z and U+00C0 to U+00FF. ``edit`` may turn the counted runs of a document into others, given its
    id. Null and empty texts have none. Repeated rows count each time. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(partial(_count, edit=edit, least=least_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- dealing ---


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in a row (those of Latin-1, as 8 bits), and where each word begins."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    at = np.cumsum([0] + [len(w) for w in raw])
    return np.frombuffer(b"".join(raw), np.uint8), at


def vectors(flat: np.ndarray, at: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Length and letter counts by group, one row a word."""
    size = np.diff(at)
    cells = np.repeat(np.arange(len(size)), size) * groups + flat % groups
    counts = np.bincount(cells, minlength=len(size) * groups).reshape(len(size), groups)
    return np.concatenate([size[:, None], counts], axis=1)


def reached(top: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The first levels that a word may be sent to: its own, and those after them that are one letter away.

    Each entry has the levels and whether they can be: a letter that is taken away must be there.
    """
    every = np.ones(len(top), bool)
    made = [(top, every)]
    groups = range(1, top.shape[1])

    def moved(length: int, more: int | None, less: int | None):
        new = top.copy()
        new[:, 0] += length
        if more is not None:
            new[:, more] += 1
        if less is not None:
            new[:, less] -= 1
        made.append((new, every if less is None else top[:, less] > 0))

    moved(1, None, None)
    for g in groups:
        moved(1, g, None)  # an inserted letter
        moved(0, g, None)  # a replaced one, for one of no first group
        for other in range(g + 1, top.shape[1]):
            moved(0, g, other)
    return made


def shard_of(top: np.ndarray, shards: int) -> np.ndarray:
    key = np.zeros(len(top), np.uint64)
    for level in top.T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + level.astype(np.uint64) + np.uint64(1))
    return (key % np.uint64(shards)).astype(np.int64)


def _deal(batches, depth: int, shards: int):
    for batch in batches:
        if not batch.num_rows:
            continue
        top = vectors(*letters(batch.column(0)))[:, : depth + 1]
        sent = np.stack([np.where(can, shard_of(to, shards), -1) for to, can in reached(top)], axis=1)
        home = sent[:, 0].copy()
        order = np.sort(sent, axis=1)
        fresh = np.ones(order.shape, bool)
        fresh[:, 1:] = order[:, 1:] != order[:, :-1]
        row, column = np.nonzero(fresh & (order >= 0))
        shard = order[row, column]
        taken = batch.take(pa.array(row))
        yield pa.RecordBatch.from_arrays([pa.array(shard), taken.column(0), taken.column(1), pa.array(shard == home[row])], names=["shard", "word", "n", "home"])


# --- searching ---


def _candidates(own: np.ndarray, asked: np.ndarray):
    """Pairs of blocks of rows of ``asked`` and ``own`` (both vectors, ``own`` sorted) that may be one letter apart."""
    waiting = [(0, len(own), 0, np.arange(len(asked)), np.zeros(len(asked), np.int8), np.zeros(len(asked), np.int8))]
    while waiting:
        low, high, level, alive, surplus, deficit = waiting.pop()
        if not len(alive) or high <= low:
            continue
        if high - low <= LEAF or level == own.shape[1]:
            yield low, high, level, alive, surplus, deficit
            continue
        column = own[low:high, level]
        edges = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1], [True]])) + low
        wanted = asked[alive, level]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            change = wanted - own[a, level]
            if level == 0:  # the length follows from the counts: it only has to be near
                keep = np.abs(change) <= 1
                waiting.append((a, b, 1, alive[keep], surplus[keep], deficit[keep]))
            else:
                more, less = surplus + np.maximum(change, 0), deficit + np.maximum(-change, 0)
                keep = (more <= 1) & (less <= 1)
                waiting.append((a, b, level + 1, alive[keep], more[keep].astype(np.int8), less[keep].astype(np.int8)))


def _leaf_pairs(own: np.ndarray, asked: np.ndarray):
    """Row numbers in ``asked`` and ``own`` of words whose vectors are within the budget, block by block."""
    for low, high, level, alive, surplus, deficit in _candidates(own, asked):
        step = max(1, PAIRS // ((high - low) * max(1, own.shape[1] - level)))
        for at in range(0, len(alive), step):
            part = alive[at : at + step]
            change = asked[part, None, level:] - own[None, low:high, level:]
            if level == 0:
                change = change[:, :, 1:]
            more = surplus[at : at + step, None] + np.maximum(change, 0).sum(axis=2)
            less = deficit[at : at + step, None] + np.maximum(-change, 0).sum(axis=2)
            i, j = np.nonzero((more <= 1) & (less <= 1))
            if len(i):
                yield part[i], low + j


def one_letter_apart(flat: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words ``a`` and ``b`` (row numbers) differ by exactly one inserted, deleted or replaced letter.

    They share a beginning; what follows the first letter that differs must be the same.
    """
    swap = np.diff(at)[a] > np.diff(at)[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)  # a is the shorter one
    size, longer = at[a + 1] - at[a], at[b + 1] - at[b]
    shared = np.zeros(len(a), np.int64)
    going = np.flatnonzero(size > 0)
    while len(going):
        place = shared[going]
        going = going[flat[at[a[going]] + place] == flat[at[b[going]] + place]]
        shared[going] += 1
        going = going[shared[going] < size[going]]
    good = (longer - size == 1) | ((longer == size) & (shared < size))
    rest = np.where(longer == size, size - shared - 1, size - shared)
    going = np.flatnonzero(good & (rest > 0))
    step = 1
    while len(going):
        same = flat[at[a[going] + 1] - step] == flat[at[b[going] + 1] - step]
        good[going[~same]] = False
        going = going[same]
        step += 1
        going = going[rest[going] >= step]
    return good


_NEAR = "word string, n_near long, best_n long, best string"


def _search(table: pa.Table, depth: int) -> pa.Table:
    """Per word of a shard: the number of its near words found here, and the most frequent of them."""
    word = table.column("word").combine_chunks()
    order = np.argsort(np.array(word.to_pylist(), dtype=object), kind="stable")
    table = table.take(pa.array(order))
    word, n = table.column("word").combine_chunks(), table.column("n").to_numpy()
    home = table.column("home").to_numpy(zero_copy_only=False)
    flat, at = letters(word)
    vector = vectors(flat, at)
    # Rows stand by word; rank puts the first levels before it.
    rank = np.empty(len(n), np.int64)
    rank[np.lexsort([np.arange(len(n)), *vector[:, : depth + 1].T[::-1]])] = np.arange(len(n))
    own = np.flatnonzero(home)
    own = own[np.lexsort(vector[own].T[::-1])]
    one, two = [], []
    for i, j in _leaf_pairs(vector[own], vector):
        j = own[j]
        first = rank[i] < rank[j]
        i, j = i[first], j[first]
        near = one_letter_apart(flat, at, i, j)
        one.append(i[near])
        two.append(j[near])
    a = np.concatenate([*one, *two, np.zeros(0, np.int64)])
    b = np.concatenate([*two, *one, np.zeros(0, np.int64)])
    by = np.lexsort([b, -n[b], a])
    a, b = a[by], b[by]
    head = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])[: len(a)])
    counts = np.diff(np.append(head, len(a)))
    best = b[head]
    columns = [word.take(pa.array(a[head])), pa.array(counts, pa.int64()), pa.array(n[best]), word.take(pa.array(best))]
    return pa.Table.from_arrays(columns, names=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, n_near, best_n, best`` for the words of ``word, n`` that have near words: their number, and the most
    frequent of them (of equal ones the first in the order of code points). Words are distinct."""
    total = words.count()
    shards = max(1, math.ceil(total / shard_words))
    # A group's counts tell about four kinds of words apart; lengths another four.
    depth = min(GROUPS, max(0, math.ceil(math.log(shards, 4))))
    sent = words.mapInArrow(partial(_deal, depth=depth, shards=shards), "shard long, word string, n long, home boolean")
    search = partial(_search, depth=depth)
    found = sent.repartition(shards, "shard").groupBy("shard").applyInArrow(lambda table: search(table), _NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.word").alias("best"))


def group_variants(words: DataFrame, ratio: int = RATIO, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word of ``word, n``.

    Two words are near if one inserted, deleted or replaced letter turns one into the other. A word's form is its most
    frequent near word, if that is ``ratio`` times as frequent or more; its root is where its forms end. ``words`` is
    read several times: write it before. No words give no rows.
    """
    near = near_words(words, shard_words)
    is_form = F.col("best_n") >= ratio * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")
    )
    joined = materialize(joined, "forms")
    # Each form is ratio times as frequent, which bounds the steps to a root; every round doubles those gone.
    most = joined.agg(F.max("n")).first()[0] or 1
    steps = math.ceil(math.log(max(most, 2), ratio)) + 1
    roots = joined.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(steps)))):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialize(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return joined.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
