"""Brown class-based bigram model: classes by exchange, scores from class transitions and word emissions.

Classes are found in two steps. First the most frequent words are items of their own and the other words are items by
the hash of their first byte and last two bytes; items are moved between classes while that raises the likelihood of the
class bigrams. Then each of the other training words, however many there are, gets the class that its own neighbours in
all training texts make likeliest, and the transitions are counted again between the classes of words.

All counts come from all training texts. Their number of rows is that of the words; what is sent to every task is
bounded: items, classes, and the counts and classes of at most ``SENT_WORDS`` words. Those of rarer words meet their
occurrences in a join.

The probability of a word is P(class | class before) * P(item | class) * P(word | item), where the words of a class that
are no frequent ones are one item. Transitions are smoothed with the class frequencies, items and words with a constant.
Only words that are in no training text have the class of their hash, where they share the constant of one word.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.words import Words, blocks, give_back, signed, small, unsigned, words_of
from tidelog.session import materialize

HEAD_WORDS = 1_500
TAIL_ITEMS = 500
CLASSES = 64
ROUNDS = 10
SENT_WORDS = 400_000
ADD = 0.1
PRIOR = 20.0

# How much likelier (log10) its neighbours must be for a word to leave the class of its hash.
STAY = 1.0

# The end of a text is a token of its own: item 0, class 0. It also stands before the first word.
END_KEY = 0

_A = np.uint64(0x9E3779B97F4A7C15)


def tail_item(words: Words, tails: int) -> np.ndarray:
    """Item of each word if it is no frequent one, from 0."""
    first = words.data[words.start].astype(np.uint64)
    last = words.data[words.end - 1].astype(np.uint64)
    before = words.data[np.maximum(words.end - 2, words.start)].astype(np.uint64)
    return (((first << np.uint64(16) | before << np.uint64(8) | last) * _A) >> np.uint64(40)).astype(np.int64) % tails


def _count(batches, tails: int):
    for batch in batches:
        found = {}
        for row, last, offsets, raw in blocks(batch.column(0)):
            words = words_of(offsets, raw)
            key, at, n = np.unique(words.key, return_index=True, return_counts=True)
            found.setdefault("key", []).append(np.append(signed(key), END_KEY))
            found.setdefault("item", []).append(np.append(tail_item(words, tails)[at], 0))
            found.setdefault("n", []).append(np.append(n, last - row))
        if found:
            key, item, n = (np.concatenate(found[c]) for c in ("key", "item", "n"))
            names, at, which = np.unique(key, return_index=True, return_inverse=True)
            total = np.bincount(which, n).astype(np.int64)
            yield pa.record_batch([pa.array(names), pa.array(item[at], pa.int32()), pa.array(total)], ["key", "tail", "n"])
        del found
        give_back()


class Items:
    """Item of each word: 0 is the end, then the frequent words by key, then the hashed ones."""

    def __init__(self, head: np.ndarray, tails: int):
        self.head, self.tails = np.sort(head), tails
        self.size = 1 + len(head) + tails

    def of(self, words: Words) -> np.ndarray:
        tail = 1 + len(self.head) + tail_item(words, self.tails)
        if not len(self.head):
            return tail
        at = np.minimum(np.searchsorted(self.head, words.key), len(self.head) - 1)
        return np.where(self.head[at] == words.key, 1 + at, tail)


def _sequence(items: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items of a block with the end item before and after each text, and the places of the latter."""
    size = np.diff(first)
    ends = np.cumsum(size + 1)
    line = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int64)
    doc = np.repeat(np.arange(len(size)), size)
    line[1 + np.arange(len(items)) + doc] = items
    return line, ends


def _pairs(batches, items: Items):
    """Neighbours of each item on either side and their counts, packed."""
    total = np.zeros((items.size, items.size), np.int32)
    for batch in batches:
        for _, _, offsets, raw in blocks(batch.column(0)):
            words = words_of(offsets, raw)
            line, _ = _sequence(items.of(words), words.first)
            pair, n = np.unique(line[:-1] * items.size + line[1:], return_counts=True)
            total.ravel()[pair] += n.astype(np.int32)
        give_back()
    for side, matrix in (("next", total), ("before", total.T)):
        names, packs = [], []
        for item in range(items.size):
            other = np.flatnonzero(matrix[item])
            if len(other):
                names.append(item)
                packs.append(np.stack([other.astype(np.int32), matrix[item][other]]).tobytes())
        yield pa.record_batch(
            [pa.array(names, pa.int32()), pa.array([side] * len(names)), pa.array(packs, pa.binary())],
            ["item", "side", "pack"],
        )


def _merge(table: pa.Table, size: int) -> pa.Table:
    """Counts of one item's neighbours over all tasks."""
    found = {"next": np.zeros(size, np.int64), "before": np.zeros(size, np.int64)}
    for side, pack in zip(table.column("side").to_pylist(), table.column("pack")):
        other, n = np.frombuffer(pack.as_py(), np.int32).reshape(2, -1)
        found[side][other] += n
    item = pa.array([table.column("item")[0].as_py()], pa.int32())
    return pa.table({"item": item, **{side: pa.array([x.tolist()], pa.list_(pa.int64())) for side, x in found.items()}})


def _by_class(batch: pa.RecordBatch, name: str, classes: np.ndarray, count: int) -> np.ndarray:
    """Counts of the neighbours' classes, a row for each item of a batch."""
    flat = batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    found = np.zeros((batch.num_rows, count), np.int64)
    for one in range(count):
        found[:, one] = flat[:, classes == one].sum(1)
    return found


def _transitions(batches, classes: np.ndarray, count: int):
    total = np.zeros((count, count), np.int64)
    for batch in batches:
        np.add.at(total, classes[batch.column("item").to_numpy()], _by_class(batch, "next", classes, count))
    a, b = np.nonzero(total)
    yield pa.record_batch([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(total[a, b])], ["a", "b", "n"])


def _entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _best_moves(batches, classes: np.ndarray, matrix: np.ndarray):
    """The class to which each item had best go if the others stay, and what that gains."""
    count = len(matrix)
    for batch in batches:
        items, to, by = batch.column("item").to_numpy(), [], []
        after, before = _by_class(batch, "next", classes, count), _by_class(batch, "before", classes, count)
        for row, item in enumerate(items.tolist()):
            own = int(classes[item])
            itself = int(batch.column("next")[row][item].as_py())
            right, left = after[row].copy(), before[row].copy()
            right[own] -= itself
            left[own] -= itself
            m = matrix.astype(np.float64)
            m[own, :] -= right
            m[:, own] -= left
            m[own, own] -= itself
            rows, columns = m.sum(1), m.sum(0)
            # Change of the likelihood if it joins class b: row b and column b grow.
            row_gain = _entropy(m + right[None, :]) - _entropy(m)
            column_gain = _entropy(m + left[:, None]) - _entropy(m)
            corner = np.diag(m)
            gain = row_gain.sum(1) - np.diag(row_gain) + column_gain.sum(0) - np.diag(column_gain)
            gain += _entropy(corner + right + left + itself) - _entropy(corner)
            gain -= _entropy(rows + right.sum() + itself) - _entropy(rows)
            gain -= _entropy(columns + left.sum() + itself) - _entropy(columns)
            gain[0] = -np.inf  # the end stays alone
            best = int(gain.argmax()) if item else own
            to.append(best)
            by.append(float(gain[best] - gain[own]) if best != own else 0.0)
        yield pa.record_batch(
            [pa.array(items, pa.int32()), pa.array(to, pa.int32()), pa.array(by, pa.float64())], ["item", "class", "gain"]
        )


def _likelihood(matrix: np.ndarray) -> float:
    return float(_entropy(matrix).sum() - _entropy(matrix.sum(0)).sum() - _entropy(matrix.sum(1)).sum())


def exchange(neighbours: DataFrame, uses: np.ndarray, count: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each item, and the class transitions; the best of all rounds.

    Moves are judged as if each were made alone, so a round makes only the better half of them and few into one class.
    Tasks work on the items' neighbours; the driver gets one number per item and the class transitions.
    """

    def transitions(classes):
        made = np.zeros((count, count), np.int64)
        counted = neighbours.mapInArrow(partial(_transitions, classes=classes, count=count), "a int, b int, n long")
        for r in counted.groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
            made[r["a"], r["b"]] = r["n"]
        return made

    classes = np.zeros(len(uses), np.int64)
    classes[1 + np.argsort(-uses[1:], kind="stable")] = 1 + np.arange(len(uses) - 1) % (count - 1)
    best = (classes, transitions(classes))
    matrix = best[1]
    for _ in range(rounds):
        move = partial(_best_moves, classes=classes, matrix=matrix)
        found = neighbours.mapInArrow(move, "item int, class int, gain double").where("gain > 1e-6").collect()
        if not found:
            break
        classes, into = classes.copy(), np.zeros(count, np.int64)
        for r in sorted(found, key=lambda r: (-r["gain"], r["item"]))[: len(found) // 2 + 1]:
            if into[r["class"]] * 2 * count < len(uses):
                into[r["class"]] += 1
                classes[r["item"]] = r["class"]
        matrix = transitions(classes)
        if _likelihood(matrix) > _likelihood(best[1]):
            best = (classes, matrix)
    return best


def steps(matrix: np.ndarray) -> np.ndarray:
    """Logarithms of the class transitions."""
    freq = matrix.sum(0) + 1.0
    shown = matrix + PRIOR * (freq / freq.sum())[None, :]
    return np.log10(shown / shown.sum(1, keepdims=True))


# A neighbour's class, with ``count`` added for those that follow, and how often it is there.
_SIDE = np.dtype([("code", "<u4"), ("n", "<u4")])


def _contexts(batches, items: Items, classes: np.ndarray, count: int):
    """For each word that is no frequent one: the classes of its neighbours and their counts, packed."""
    head = 1 + len(items.head)
    for batch in small(batches):
        keys, codes, totals, kinds = [], [], [], {}
        for _, _, offsets, raw in blocks(batch.column(0)):
            words = words_of(offsets, raw)
            item = items.of(words)
            line, _ = _sequence(item, words.first)
            line = classes[line]
            rest = np.flatnonzero(item >= head)
            if not len(rest):
                continue
            at = 1 + rest + words.doc[rest]
            names, first, which = np.unique(words.key[rest], return_index=True, return_inverse=True)
            code = np.concatenate([which * 2 * count + line[at - 1], which * 2 * count + count + line[at + 1]])
            found, n = np.unique(code, return_counts=True)
            keys.append(names[found // (2 * count)])
            codes.append(found % (2 * count))
            totals.append(n)
            kinds.setdefault("key", []).append(names)
            kinds.setdefault("tail", []).append(item[rest][first] - head)
        if not keys:
            continue
        key, code, n = (np.concatenate(x) for x in (keys, codes, totals))
        names, which = np.unique(key, return_inverse=True)
        order = np.argsort(which, kind="stable")
        packed = np.empty(len(order), _SIDE)
        packed["code"], packed["n"] = code[order], n[order]
        ends = np.append(0, np.cumsum(np.bincount(which, minlength=len(names)))) * _SIDE.itemsize
        known, first = np.unique(np.concatenate(kinds["key"]), return_index=True)
        tail = np.concatenate(kinds["tail"])[first]  # the same names in the same order
        pack = pa.Array.from_buffers(
            pa.binary(), len(names), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(packed.tobytes())]
        )
        yield pa.record_batch([pa.array(signed(known)), pa.array(tail, pa.int32()), pack], ["key", "tail", "pack"])


def _named(batches, step: np.ndarray, mass: np.ndarray, tails: np.ndarray):
    """Class of each word from its packs, which come one after the other: that under which its neighbours are likeliest.

    The first class is that of the ends and takes no word. ``tails`` are the classes of the hashed items.
    """
    count = len(step)
    # Rows are the neighbours' codes: a class before the word, or after it.
    evidence = np.concatenate([step, step.T])

    def judged(key, tail, sides):
        likely = sides @ evidence - sides[:, :count].sum(1)[:, None] * np.log10(mass)[None, :]
        likely[np.arange(len(key)), tails[tail]] += STAY
        likely[:, 0] = -np.inf
        return pa.record_batch([pa.array(key), pa.array(likely.argmax(1), pa.int32())], ["key", "class"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, tail = batch.column("key").to_numpy(), batch.column("tail").to_numpy()
        at = np.frombuffer(batch.column("pack").buffers()[1], np.int32)[batch.column("pack").offset :][: batch.num_rows + 1]
        packed = np.frombuffer(batch.column("pack").buffers()[2], np.uint8)[at[0] : at[-1]].view(_SIDE)
        new = np.append(True, key[1:] != key[:-1])
        word = np.cumsum(new) - 1
        which = np.repeat(word, np.diff(at) // _SIDE.itemsize)
        sides = np.bincount(which * 2 * count + packed["code"], packed["n"], (word[-1] + 1) * 2 * count).reshape(-1, 2 * count)
        key, tail = key[new], tail[new]
        if held is not None:
            if held[0][0] == key[0]:
                sides[0] += held[2][0]
            else:
                yield judged(*held)
        if len(key) > 1:
            yield judged(key[:-1], tail[:-1], sides[:-1])
        held = key[-1:], tail[-1:], sides[-1:].copy()  # the next batch may go on with it
    if held is not None:
        yield judged(*held)


def name_words(learn: DataFrame, items: Items, uses: np.ndarray, classes: np.ndarray, matrix: np.ndarray) -> DataFrame:
    """``key, class`` of every word that is no frequent one, by its neighbours in all texts of ``learn``."""
    count = len(matrix)
    schema = "key long, tail int, pack binary"
    packs = learn.mapInArrow(partial(_contexts, items=items, classes=classes, count=count), schema)
    mass = np.bincount(classes, uses + ADD, count) + ADD
    named = partial(_named, step=steps(matrix), mass=mass, tails=classes[1 + len(items.head) :])
    return packs.repartition("key").sortWithinPartitions("key").mapInArrow(named, "key long, class int")


class Scorer:
    """What a task needs to score texts; its size does not depend on the corpus."""

    def __init__(self, items, classes, matrix, uses, tail_words, tokens, kinds, known, counts):
        self.items, self.classes, self.known, self.counts = items, classes, known, counts
        self.base_norm = np.log10(tokens + ADD * (kinds + 1))
        self.step = steps(matrix)
        in_class = np.bincount(classes, uses + ADD, len(matrix))
        self.emit = np.log10((uses + ADD) / in_class[classes])
        head = 1 + len(items.head)
        # For the hashed items: logarithm of what all counts of their words, smoothed, add up to.
        self.tail_norm = np.zeros(items.size)
        self.tail_norm[head:] = np.log10(np.maximum(uses[head:] + ADD * (tail_words + 1), ADD))
        self.ends = int(uses[0])


_FOUND = ["row", "id", "training", "n_tokens", "n_known", "base", "score", "line", "key", "at", "tail", "class"]


def _score(batches, scorer: Scorer, items: Items, hashed: np.ndarray, named: np.ndarray):
    """Sums for each row from what is known here with the classes of its tokens, and the words that are not known here.

    ``hashed`` are the classes of ``items``, ``named`` those of the words that the scorer knows. A word that is not known
    here has the class of its hash until it meets its own.
    """
    head = 1 + len(items.head)
    wide = np.min_scalar_type(len(scorer.step) - 1)
    for batch in small(batches):
        rows, training = batch.column(0).to_numpy(), batch.column(3)
        for row, last, offsets, raw in blocks(batch.column(2)):
            words = words_of(offsets, raw)
            docs = last - row
            item = items.of(words)
            at = np.minimum(np.searchsorted(scorer.known, words.key), max(len(scorer.known) - 1, 0))
            sure = scorer.known[at] == words.key if len(scorer.known) else np.zeros(len(item), bool)
            c = np.where(sure, scorer.counts[at], 0) if len(scorer.known) else np.zeros(len(item))
            tail = item >= head
            own = hashed[item]
            if len(scorer.known):
                own = np.where(tail & sure, named[at], own)
            place = np.where(tail, head - 1 + own, item)
            smooth = np.log10(c + ADD)
            word_base = np.where(sure, smooth - scorer.base_norm, 0.0)
            word_score = np.where(tail, np.where(sure, scorer.emit[place] + smooth - scorer.tail_norm[place], 0.0), scorer.emit[place])
            size = np.diff(words.first) + 1
            ends = np.cumsum(size)
            line = np.zeros(int(ends[-1]), wide)
            line[np.arange(len(own)) + words.doc] = own
            end_base = np.log10(scorer.ends + ADD) - scorer.base_norm
            base = np.bincount(words.doc, word_base, docs) + end_base
            score = np.bincount(words.doc, word_score, docs) + scorer.emit[0]
            known = np.bincount(words.doc, sure, docs).astype(np.int64) + (scorer.ends > 0)
            packed = [part.tobytes() for part in np.split(line, ends[:-1])]
            one = [rows[row:last], batch.column(1).slice(row, docs), training.slice(row, docs), size, known, base, score, pa.array(packed, pa.binary())]
            nulls = [pa.nulls(docs, kind) for kind in (pa.int64(), pa.int32(), pa.bool_(), pa.int32())]
            yield pa.record_batch([*map(pa.array, one[:1]), *one[1:3], *map(pa.array, one[3:7]), one[7], *nulls], _FOUND)
            rest = np.flatnonzero(~sure)
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
            more = [pa.nulls(len(rest), kind) for kind in kinds]
            place_in = rest + words.doc[rest] - (ends - size)[words.doc[rest]]
            met = [pa.array(signed(words.key[rest])), pa.array(place_in, pa.int32()), pa.array(tail[rest]), pa.array(own[rest], pa.int32())]
            yield pa.record_batch([pa.array(rows[row:last][words.doc[rest]]), *more, *met], _FOUND)


def _filled(batches, wide):
    """Classes of the tokens with those of the words that met theirs."""
    for batch in batches:
        lines = []
        for line, put in zip(batch.column("line"), batch.column("put")):
            line = np.frombuffer(line.as_py(), wide)
            if put.is_valid and len(put.values):
                line = line.copy()
                line[put.values.field("at").to_numpy()] = put.values.field("class").to_numpy()
            lines.append(line.tobytes())
        names = [c for c in batch.schema.names if c not in ("line", "put")]
        yield pa.record_batch([*(batch.column(c) for c in names), pa.array(lines, pa.binary())], [*names, "line"])


def _line(batch: pa.RecordBatch, wide) -> tuple[np.ndarray, np.ndarray]:
    """Classes of a batch's tokens after that of an end, and the row of each token."""
    tokens = np.frombuffer(b"".join(batch.column("line").to_pylist()), wide).astype(np.int64)
    return np.append(0, tokens), np.repeat(np.arange(batch.num_rows), batch.column("n_tokens").to_numpy())


def _followed(batches, count: int, wide):
    total = np.zeros((count, count), np.int64)
    for batch in batches:
        line, _ = _line(batch, wide)
        total += np.bincount(line[:-1] * count + line[1:], minlength=count * count).reshape(count, count)
    a, b = np.nonzero(total)
    yield pa.record_batch([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(total[a, b])], ["a", "b", "n"])


def _stepped(batches, step: np.ndarray, wide):
    for batch in batches:
        line, row = _line(batch, wide)
        walked = np.bincount(row, step[line[:-1], line[1:]], batch.num_rows)
        score = pa.array(batch.column("score").to_numpy() + walked)
        names = ["id", "n_tokens", "n_known", "base"]
        yield pa.record_batch([*(batch.column(c) for c in names), score], [*names, "score"])


def _threshold(counts: DataFrame, most: int) -> int:
    """Smallest count so that at most ``most`` words (about, by steps of an eighth of a power of 2) have it or more."""
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    total, least = 0, None
    for r in steps:
        total += r["count"]
        if total > most:
            return int(np.ceil(2 ** ((r["step"] + 1) / 8) - 1e-9)) if least is not None else 1 << 62
        least = r["step"]
    return 1


def score_texts(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    head_words: int = HEAD_WORDS,
    tail_items: int = TAIL_ITEMS,
    classes: int = CLASSES,
    rounds: int = ROUNDS,
    sent_words: int = SENT_WORDS,
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    The model learns from the rows for which ``training`` is true. Words are in small letters (A-Z); each text has
    one token more, its end. ``base_score`` is that of a unigram model with 0.1 added. Null texts count as empty and are
    their end alone. Repeated rows and null ids are rows like others. Without training rows every word is unknown.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), training.alias("training")
    )
    learn = rows.where("training").select("text")
    counted = learn.mapInArrow(partial(_count, tails=tail_items), "key long, tail int, n long")
    counts = materialize(counted.groupBy("key").agg(F.first("tail").alias("tail"), F.sum("n").alias("n")), "words")
    whole = counts.agg(F.sum("n"), F.count("*")).first()
    tokens, kinds = int(whole[0] or 0), int(whole[1])
    words = counts.where(F.col("key") != END_KEY)
    top = words.orderBy(F.desc("n"), "key").limit(head_words).collect()
    items = Items(unsigned(np.array([r["key"] for r in top], np.int64)), tail_items)
    uses = np.zeros(items.size, np.int64)
    ends = counts.where(F.col("key") == END_KEY).first()
    uses[0] = ends["n"] if ends else 0
    for r in top:
        uses[1 + np.searchsorted(items.head, unsigned(np.array([r["key"]]))[0])] = r["n"]
        uses[1 + len(top) + r["tail"]] -= r["n"]
    for r in words.groupBy("tail").agg(F.sum("n").alias("n")).collect():
        uses[1 + len(top) + r["tail"]] += r["n"]

    packed = learn.mapInArrow(partial(_pairs, items=items), "item int, side string, pack binary")
    schema = "item int, next array<long>, before array<long>"
    merge = partial(_merge, size=items.size)
    neighbours = materialize(packed.groupBy("item").applyInArrow(lambda t: merge(t), schema), "neighbours")
    named, matrix = exchange(neighbours, uses, classes, rounds)

    own = materialize(name_words(learn, items, uses, named, matrix), "named")
    words = materialize(words.join(own, "key", "left").select("key", "n", F.coalesce("class", F.lit(0)).alias("class")), "classes")

    # Items of the scorer: the end, the frequent words, and for each class but the first its other words.
    head = 1 + len(top)
    placed = Items(items.head, classes - 1)
    put, n_words = np.zeros(classes, np.int64), np.bincount(named[head:], minlength=classes)
    for r in words.where("class > 0").groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        put[r["class"]] = r["n"]
        n_words[r["class"]] += r["words"]
    least = _threshold(words, sent_words)
    sent = words.where(F.col("n") >= least).toArrow()
    known, n, of_known = unsigned(sent.column("key").to_numpy()), sent.column("n").to_numpy(), sent.column("class").to_numpy()
    order = np.argsort(known)
    # Each hashed item keeps one share for its unseen words; ``Scorer`` adds one share itself.
    scorer = Scorer(
        placed, np.append(named[:head], np.arange(1, classes)), matrix, np.append(uses[:head], put[1:]),
        np.maximum(n_words[1:] - 1, 0), tokens, kinds, known[order], n[order],
    )
    score = partial(_score, scorer=scorer, items=items, hashed=named, named=of_known[order])
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "id", "text", F.coalesce("training", F.lit(False)).alias("training"))
    schema = "row long, id long, training boolean, n_tokens long, n_known long, base double, score double, line binary, "
    found = materialize(numbered.mapInArrow(score, schema + "key long, at int, tail boolean, class int"), "scores")
    rare = found.where("key is not null").select("row", "key", "at", "tail", "class")
    seen = words.where(F.col("n") < least).select("key", "n", F.col("class").alias("own"))
    met = rare.join(seen, "key", "left").withColumn("class", F.coalesce("own", "class"))
    log = F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADD))
    by_class = scorer.emit[head:] - scorer.tail_norm[head:]
    added = met.groupBy("row").agg(
        F.count("n").alias("more_known"),
        F.sum(log - F.lit(float(scorer.base_norm))).alias("more_base"),
        F.sum(F.when(F.col("tail"), log + F.element_at(F.lit(by_class.tolist()), F.col("class"))).otherwise(0.0)).alias("more_score"),
        F.collect_list(F.when(F.col("tail"), F.struct("at", "class"))).alias("put"),
    )
    one = found.where("key is null").drop("key", "at", "tail", "class").join(added, "row", "left")
    zero = {"more_known": 0, "more_base": 0.0, "more_score": 0.0}
    summed = one.fillna(zero).select(
        "id", "training", "n_tokens", (F.col("n_known") + F.col("more_known")).alias("n_known"),
        (F.col("base") + F.col("more_base")).alias("base"), (F.col("score") + F.col("more_score")).alias("score"), "line", "put",
    )
    wide = np.min_scalar_type(classes - 1)
    schema = "id long, training boolean, n_tokens long, n_known long, base double, score double, line binary"
    whole = materialize(summed.mapInArrow(partial(_filled, wide=wide), schema), "lines")

    counted = whole.where("training").select("line", "n_tokens").mapInArrow(partial(_followed, count=classes, wide=wide), "a int, b int, n long")
    matrix = np.zeros((classes, classes), np.int64)
    for r in counted.groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        matrix[r["a"], r["b"]] = r["n"]
    walked = whole.mapInArrow(partial(_stepped, step=steps(matrix), wide=wide), "id long, n_tokens long, n_known long, base double, score double")
    return walked.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
