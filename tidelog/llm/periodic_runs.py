"""Runs of repeating words in texts, by a suffix automaton with link-cut access.

A run is a stretch of words with smallest period q (words q apart are equal) of some least length and at least three
periods that no neighbouring word extends. Words are appended to a suffix automaton one by one. Its suffix links form a
tree whose paths from the root are kept as splay trees, one for each segment of states that last occurred at the same
place. Appending word i recolours the path of its prefix: a segment that last ended at e holds the longest words that end
at e and i, and where their length is twice the distance i - e or more, the two copies make a square with period i - e
that ends at i. All squares of a run have the same start and period, so the last of them ends it.

Words that no run can hold are left out before: in a run of 24 words or more, most stretches of eight words recur, not
farther off than the run allows. That test looks at whole texts with numpy; the automaton takes the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.words import mix, small

# A run has this many words at least, and PERIODS periods.
LEAST_WORDS = 24
PERIODS = 3

# Words that must recur together for a place to be looked at.
GRAM = 8

# Times that places are left out; what then remains is looked at, whether or not a run can hold it.
ROUNDS = 8

Run = tuple[int, int, int]


class SuffixAutomaton:
    """States of the words read so far, and their last ends; state 1 is the empty word, 0 stands for none."""

    def __init__(self):
        self.size = [0, 0]  # length of a state's longest word
        self.link = [0, 0]
        self.follow: list[dict[int, int]] = [{}, {}]
        # Splay trees over the segments of the link tree, in order of depth; ``above`` of a tree's root is the state
        # to which its topmost state links. ``end`` holds at the root and counts for all of the segment.
        self.left, self.right, self.above, self.end = [0, 0], [0, 0], [0, 0], [0, -1]
        self.whole = 1
        self.read = 0

    def _state(self, size: int, follow: dict[int, int], link: int, end: int) -> int:
        self.size.append(size)
        self.follow.append(follow)
        self.link.append(link)
        for links in (self.left, self.right, self.above):
            links.append(0)
        self.end.append(end)
        return len(self.size) - 1

    def _turn(self, x: int, up: int) -> None:
        """One rotation of ``x`` over ``up``."""
        left, right, above = self.left, self.right, self.above
        top = above[up]
        if left[up] == x:
            inner = left[up] = right[x]
            right[x] = up
        else:
            inner = right[up] = left[x]
            left[x] = up
        if inner:
            above[inner] = up
        above[up] = x
        above[x] = top
        if left[top] == up:
            left[top] = x
        elif right[top] == up:
            right[top] = x
        else:
            self.end[x] = self.end[up]

    def _splay(self, x: int) -> None:
        left, right, above, turn = self.left, self.right, self.above, self._turn
        while True:
            up = above[x]
            if not up or (left[up] != x and right[up] != x):
                return
            top = above[up]
            if top and (left[top] == up or right[top] == up):
                turn(up if (left[top] == up) == (left[up] == x) else x, top if (left[top] == up) == (left[up] == x) else up)
            turn(x, above[x])

    def _clone(self, state: int, size: int) -> int:
        """A state for the shorter words of ``state``, between it and its link; it last ended where that did."""
        self._splay(state)
        copy = self._state(size, self.follow[state].copy(), self.link[state], -1)
        below = self.left[state]
        self.left[copy], self.above[copy] = below, state
        if below:
            self.above[below] = copy
        self.left[state] = copy
        self.link[state] = copy
        return copy

    def append(self, word: int) -> list[tuple[int, int]]:
        """Reads a word; gives place and length of the longest words that ended at that place last and end here."""
        size, link, follow = self.size, self.link, self.follow
        here, p = self.read, self.whole
        self.read += 1
        new = self._state(size[p] + 1, {}, 0, here)
        while p and word not in follow[p]:
            follow[p][word] = new
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = follow[p][word]
            if size[q] != size[p] + 1:
                copy = self._clone(q, size[p] + 1)
                while p and follow[p].get(word) == q:
                    follow[p][word] = copy
                    p = link[p]
                q = copy
            link[new] = q
        self.above[new] = link[new]
        self.whole = new
        return self._access(new, here)

    def _access(self, new: int, here: int) -> list[tuple[int, int]]:
        right, above, end, size = self.right, self.above, self.end, self.size
        found, below, x = [], new, above[new]
        while x:
            self._splay(x)
            if end[x] >= 0:
                found.append((end[x], size[x]))
            deeper = right[x]
            if deeper:  # a segment of its own from now on; it keeps its place
                end[deeper] = end[x]
            right[x] = below
            below = x
            x = above[x]
        end[below] = here
        return found


def runs_of(words: list[int], least: int = LEAST_WORDS) -> Iterator[Run]:
    """Start, length and period of all runs of a list of words, by start and period."""
    automaton, last = SuffixAutomaton(), {}
    for i, word in enumerate(words):
        for end, size in automaton.append(word):
            period = i - end
            if size >= (PERIODS - 1) * period:
                last[end - size + 1, period] = i
    for (start, period), end in sorted(last.items()):
        if end - start + 1 >= least:
            yield start, end - start + 1, period


def windows(keys: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """Stretches of words that hold all runs whole, with the words next to them.

    In a run of length n and period q, n >= 3 q, the grams from its second period on recur q back or less: these are
    m = n - q - 7 places in a row, so q <= (m + 7) / 2. Places that recur too far off for their row are left out, and
    rows that get too short by that.
    """
    if len(keys) < least:
        return []
    gram = mix(keys.astype(np.uint64))
    step = 1
    while step < GRAM:  # keys of 2, 4, 8 words
        gram = mix(gram[:-step] * np.uint64(0x9E3779B97F4A7C15) + gram[step:])
        step *= 2
    order = np.argsort(gram, kind="stable")
    same = gram[order[1:]] == gram[order[:-1]]
    back = np.full(len(gram), len(gram) + least, np.int64)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    shortest = least - least // PERIODS - (GRAM - 1)
    marked = back <= len(keys) // PERIODS
    for _ in range(ROUNDS):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
        first, after = edges[::2], edges[1::2]
        size = after - first
        row = np.repeat(np.arange(len(size)), size)
        places = np.flatnonzero(marked)
        good = (size[row] >= shortest) & (back[places] <= (size[row] + GRAM - 1) // 2)
        if good.all():
            break
        marked[places[~good]] = False
    merged: list[tuple[int, int]] = []
    reach = (size + GRAM - 1) // 2
    for a, b in zip(np.maximum(first - reach - 1, 0).tolist(), np.minimum(after + GRAM, len(keys)).tolist()):
        while merged and a <= merged[-1][1]:
            begin, end = merged.pop()
            a, b = min(a, begin), max(b, end)
        merged.append((a, b))
    return merged


def find(words: list[bytes], least: int = LEAST_WORDS) -> list[Run]:
    """All runs of a text's words, by start and period."""
    known: dict[bytes, int] = {}
    ids = [known.setdefault(word, len(known)) for word in words]
    keys = np.array(ids, np.int64)
    return [(a + start, length, period) for a, b in windows(keys, least) for start, length, period in runs_of(ids[a:b], least)]


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that some run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]


def longest(runs: list[Run]) -> Run | None:
    """The run with the most periods, exactly; of equal ones the first, then that with the smaller period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


_SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, best struct<start:long,length:long,period:long>, collapsed string"
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])


def _rows(batches, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None):
    named = lambda run: run and dict(zip(("start", "length", "period"), run))
    for batch in small(batches):
        runs, best, left = [], [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = text.as_buffer()
            words = raw.to_pybytes().split() if raw is not None else []
            if rewrite is not None:
                words = rewrite(doc, words)
            found = find(words)
            runs.append([named(run) for run in found])
            best.append(named(longest(found)))
            left.append(b" ".join(collapse(words, found)).decode())
        columns = [batch.column(0), pa.array(runs, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(left, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "best", "collapsed"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite=None) -> DataFrame:
    """``doc_id, runs, best, collapsed``: the runs of every text, the one with most periods, the text without repeats.

    Words are runs of bytes other than the white space of ASCII, numbered from 0. ``rewrite`` may change the words
    of a row first, given its id. A null or empty text has no words, no runs, null for ``best``, and collapses to the
    empty text. Repeated rows and null ids are rows like others. Other columns are not looked at. A task holds one
    text's automaton at a time: about 1 KB for each word that repeats.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_rows, rewrite=rewrite), _SCHEMA)
