"""Languages of texts and of their parts: scripts narrow the candidates, Viterbi labels the words.

A model is learned from labelled rows: counts of letter n-grams (1 to 4, with word bounds) and whole words for each
language, in a table of fixed size, and the scripts in which each language is written. A word (a run of letters) is
scored by each language in whose script it is. Viterbi then finds the labels of a text's words that add up to the most,
where a change of language costs ``SWITCH``; equal labels in a row are a span.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.words import in_parts, small

UNKNOWN = "und"

# Cost of a change of language, in natural logarithms.
SWITCH = 8.0

# Labelled documents of a language that the model is fitted on (about; chosen by hash over all), and cells of its
# count table. They bound the model of a language; all labelled languages are known.
SAMPLE_DOCS = 4_000
CELLS = 1 << 15

# At least this part of a language's letters makes a script one of its own.
SCRIPT_SHARE = 0.01

# First code point of each range of letters and its script. Fixed values.
SCRIPTS = [
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "thaana"), (0x07C0, "nko"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "cherokee"), (0x1780, "khmer"), (0x1800, "mongolian"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x2E80, "han"), (0x3040, "hiragana"), (0x30A0, "katakana"), (0x3100, "other"), (0x3130, "hangul"),
    (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB50, "arabic"),
    (0xFE00, "other"), (0x20000, "han"),
]

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xD6E8FEB86659FD93)


class Reader:
    """Cuts texts into words of small letters, as code points, and counts their n-grams in cells."""

    def __init__(self):
        self.letter = np.fromiter((chr(p).isalpha() for p in range(0x40000)), bool, 0x40000)
        names = sorted({name for _, name in SCRIPTS} | {"other"})
        starts = [p for p, _ in SCRIPTS]
        self.script_names = names
        self.script = np.empty(0x40000, np.int8)
        bounds = [0, *starts, 0x40000]
        for a, b in zip(bounds, bounds[1:]):
            at = bisect_right(starts, a) - 1
            self.script[a:b] = names.index(SCRIPTS[at][1] if at >= 0 else "latin")

    def words(self, texts: list[str | None]):
        """Distinct words of the texts (padded with 0 and put together), which one each word is, and its document."""
        small = [(t or "").lower() for t in texts]
        points = np.frombuffer("\n".join(small).encode("utf-32-le", "replace"), np.uint32)
        points = np.where(points < 0x40000, points, 0)
        letter = self.letter[points]
        edge = np.diff(np.concatenate([[0], letter.astype(np.int8), [0]]))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        ends = np.cumsum([len(t) + 1 for t in small])
        doc = np.searchsorted(ends, start, "right")
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), doc, np.zeros(0, np.int64)
        size = end - start
        own = points[letter].astype(np.uint64)
        first = np.cumsum(size) - size
        place = np.arange(len(own)) - np.repeat(first, size)
        power = np.cumprod(np.full(int(size.max()), _A, np.uint64))
        key = np.add.reduceat((own + _B) * (own | np.uint64(1)) * power[place], first) + size.astype(np.uint64)
        _, which, word = np.unique(key, return_index=True, return_inverse=True)
        length = size[which]
        # The distinct words one after the other, each between zeros.
        begin = np.cumsum(length + 1) - length
        flat = np.zeros(int(begin[-1] + length[-1]) + 1, np.int64)
        inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        flat[np.repeat(begin, length) + inside] = points[np.repeat(start[which], length) + inside]
        return flat, begin, word, doc, length

    def cells(self, flat: np.ndarray, begin: np.ndarray, length: np.ndarray):
        """Cells of the n-grams of the distinct words, and the word that each is of."""
        value = flat.astype(np.uint64)
        of = np.full(len(flat), -1)
        of[np.repeat(begin, length) + np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)] = (
            np.repeat(np.arange(len(begin)), length)
        )
        found, words = [], []
        for size in (1, 2, 3, 4):
            if len(flat) < size:
                continue
            total = np.full(len(flat) - size + 1, size, np.uint64)
            for i in range(size):
                total = (total + value[i : len(flat) - size + 1 + i]) * _A
                total ^= total >> np.uint64(29)
            # The inner letters must be of one word; a single zero at either end marks its bound.
            inner = of[1 : len(flat) - size + 2] if size > 1 else of
            good = inner >= 0
            for i in range(2, size - 1):
                good &= of[i : len(flat) - size + 1 + i] >= 0
            if size == 2:
                left = of[: len(flat) - 1]
                inner = np.where(inner >= 0, inner, left)
                good = inner >= 0
            found.append(((total * _B) >> np.uint64(40))[good])
            words.append(inner[good])
        power = np.cumprod(np.full(max(1, int(length.max(initial=1))), _A, np.uint64))
        at = np.repeat(begin, length)
        inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        if len(begin):
            whole = np.add.reduceat(value[at + inside] * power[inside], np.cumsum(length) - length)
            found.append((whole * _B) >> np.uint64(40))
            words.append(np.arange(len(begin)))
        cell = np.concatenate(found) if found else np.zeros(0, np.uint64)
        owner = np.concatenate(words) if words else np.zeros(0, np.int64)
        return (cell % np.uint64(CELLS)).astype(np.int64), owner


def _slices(column: pa.Array, most: int = 1 << 19):
    """Runs of rows with about ``most`` characters of text."""
    texts, size, row = [], 0, 0
    for i, text in enumerate(column):
        texts.append(text.as_py())
        size += len(texts[-1] or "")
        if size >= most:
            yield row, texts
            texts, size, row = [], 0, i + 1
    if texts:
        yield row, texts


def _count(batches, languages: list[str]):
    """Counts by language and cell, and of letters by language and script (as cells from ``CELLS`` on)."""
    reader = Reader()
    number = {name: i for i, name in enumerate(languages)}
    scripts = len(reader.script_names)
    total: dict[int, np.ndarray] = {}  # of the languages met since the last rows

    def rows():
        for one, counts in total.items():
            cell = np.flatnonzero(counts)
            columns = [pa.array(np.full(len(cell), one), pa.int32()), pa.array(cell, pa.int32()), pa.array(counts[cell], pa.int64())]
            yield pa.record_batch(columns, ["lang", "cell", "n"])
        total.clear()

    for batch in small(batches):
        names = batch.column(0).to_pylist()
        for row, texts in _slices(batch.column(1)):
            flat, begin, word, doc, length = reader.words(texts)
            if not len(begin):
                continue
            lang = np.array([number[names[row + d]] for d in range(len(texts))])[doc]
            cell, owner = reader.cells(flat, begin, length)
            script = reader.script[flat[begin]]
            for one in np.unique(lang):
                uses = np.bincount(word[lang == one], minlength=len(begin))
                counts = total.setdefault(int(one), np.zeros(CELLS + scripts, np.int64))
                counts[:CELLS] += np.bincount(cell, uses[owner], CELLS).astype(np.int64)
                counts[CELLS:] += np.bincount(script, uses * length, scripts).astype(np.int64)
                if len(total) >= 64:
                    yield from rows()
    yield from rows()


class Model:
    """Log probabilities of the cells by language, and which language uses which script."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        grams, letters = counts[:, :CELLS].astype(np.float64), counts[:, CELLS:].astype(np.float64)
        smooth = 0.5
        self.score = np.log((grams + smooth) / (grams.sum(1, keepdims=True) + smooth * CELLS)).T.astype(np.float32).copy()
        self.uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(1, keepdims=True), 1)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Fits a model on a sample of the rows whose language is not null; None if there are none.

    The sample has about ``sample_docs`` rows of each language (all, if it has fewer), chosen by a hash of the text.
    """
    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not sizes:
        return None
    languages = sorted(r["lang"] for r in sizes)
    part = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], int((1 << 30) * min(1.0, sample_docs / r["count"])))])
    chosen = rows.where(F.expr("pmod(xxhash64(text), 1073741824)") < F.element_at(part, F.col("lang")))
    counted = chosen.select("lang", "text").mapInArrow(partial(_count, languages=languages), "lang int, cell int, n long")
    cells = CELLS + len({name for _, name in SCRIPTS})
    counts = np.zeros((len(languages), cells), np.int64)
    for r in counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow().to_batches():
        counts[r.column(0).to_numpy(), r.column(1).to_numpy()] = r.column(2).to_numpy()
    return Model(languages, counts)


def viterbi(score: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Best label of each word; ``first`` has the bounds of the texts. All texts advance one word at a time together."""
    words, states = score.shape
    label = np.zeros(words, np.int64)
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    live = int(np.count_nonzero(size))
    if not live or states == 1:
        return label
    start, size = first[:-1][order], size[order]
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")  # texts with at least so many words
    best = score[start[:live]].astype(np.float64)
    source = np.zeros(words, np.int64)  # where a change at this word comes from
    stays = np.ones((words, states), bool)
    finish = np.zeros(len(size), np.int64)
    for t in range(1, int(size[0])):
        n = int(active[t])
        if n < len(best):
            finish[n : len(best)] = best[n:].argmax(1)
            best = best[:n]
        at = start[:n] + t
        top = best.argmax(1)
        reach = best[np.arange(n), top] - switch
        source[at] = top
        stays[at] = best >= reach[:, None]
        best = np.maximum(best, reach[:, None]) + score[at]
    finish[: len(best)] = best.argmax(1)
    now = finish
    for t in range(int(size[0]) - 1, -1, -1):
        n = int(active[t])
        at = start[:n] + t
        label[at] = now[:n]
        if t:
            now[:n] = np.where(stays[at, now[:n]], now[:n], source[at])
    return label


@in_parts
def _label(batches, model, switch: float):
    reader = Reader()
    languages = np.array([*model.languages, UNKNOWN], object)
    states = len(model.languages)
    for batch in small(batches):
        names, scores, known, spans = [], [], [], []
        column = batch.column(1)
        # Scores are a number a word and language, so more languages take fewer texts at a time.
        for _, texts in _slices(column, (1 << 19) * 16 // max(16, states)):
            flat, begin, word, doc, length = reader.words(texts)
            docs = len(texts)
            if not len(begin):
                names += [UNKNOWN] * docs
                scores += [0.0] * docs
                known += [0.0] * docs
                spans += [[]] * docs
                continue
            cell, owner = reader.cells(flat, begin, length)
            order = np.argsort(owner, kind="stable")
            bounds = np.searchsorted(owner[order], np.arange(len(begin)))
            score = np.add.reduceat(model.score[cell[order]], bounds)
            # A word is scored by the languages written in its script; if there are none, by all of them.
            uses = model.uses[:, reader.script[flat[begin]]].T
            uses |= ~uses.any(1, keepdims=True)
            score = np.where(uses, score, score.min(1, keepdims=True) - 20)
            first = np.searchsorted(doc, np.arange(docs + 1))
            each = score[word]
            each -= each.max(1, keepdims=True)
            label = viterbi(each, first, switch)
            weight = length[word]
            by = np.bincount(doc * states + label, weight, docs * states).reshape(docs, states)
            main = np.where(by.sum(1) > 0, by.argmax(1), states)
            share = by.max(1) / np.maximum(by.sum(1), 1)
            # How sure the main language is of the words that it got.
            own = label == main[doc]
            total = np.stack([np.bincount(doc[own], each[own, s], docs) for s in range(states)], 1)
            total = np.exp(np.maximum(total - total.max(1, keepdims=True), -700))
            sure = total[np.arange(docs), np.minimum(main, states - 1)] / total.sum(1)
            names += languages[main].tolist()
            scores += np.where(main < states, share * sure, 0.0).tolist()
            turn = np.ones(len(label), bool)
            turn[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(turn)
            many = np.diff(np.append(at, len(label)))
            # The part of the letters in spans, each by how sure its language is there.
            span = np.add.reduceat(each, at, axis=0).astype(np.float64)
            odds = np.exp(np.maximum(span - span.max(1, keepdims=True), -700))
            sure = odds[np.arange(len(at)), label[at]] / odds.sum(1) * np.add.reduceat(weight, at)
            known += (np.bincount(doc[at], sure, docs) / np.maximum(by.sum(1), 1)).tolist()
            found = [[] for _ in range(docs)]
            for d, a, n, s in zip(doc[at].tolist(), at.tolist(), many.tolist(), label[at].tolist()):
                found[d].append({"start_word": a - int(first[d]), "n_words": n, "lang": model.languages[s]})
            spans += found
        kind = pa.list_(pa.struct([("start_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())]))
        columns = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(known, pa.float64()), pa.array(spans, kind)]
        yield pa.record_batch(columns, ["row", "lang_pred", "score", "known", "spans"])


def identify(
    docs: DataFrame, model: Model | None, switch: float = SWITCH, text_col: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """``row, lang_pred, score, known, spans`` for every row, which ``row`` holds as a struct of the columns ``carry``.

    Without ``carry`` it holds all of them, the text too, which then comes back from the workers.

    ``spans`` are runs of words (runs of letters, counted from 0) with one language. ``lang_pred`` has the most letters
    (of equal ones the first by name); ``score`` is its part of the letters times its probability among the languages
    for them; ``known`` is the part of the letters in spans of any language, by their probability. Null texts, texts without letters and any text without a model are ``und`` with score 0 and no spans.
    Repeated rows and null ids are rows like others, and columns of any name pass in ``row``.
    """
    rows = docs.select(F.struct(*(carry or ["*"])).alias("row"), F.col(text_col).cast("string").alias("text"))
    spans = "array<struct<start_word: long, n_words: long, lang: string>>"
    if model is None:
        none = [F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("known"), F.expr(f"cast(array() as {spans})").alias("spans")]
        return rows.select("row", *none)
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(f"lang_pred string, score double, known double, spans {spans}")])
    return rows.mapInArrow(partial(_label, model=model, switch=switch), schema)


def held_out(id_col: str, of: int = 4, remainder: int = 2) -> Column:
    """Whether a row is kept from training, by its id."""
    return F.crc32(F.col(id_col).cast("string")) % of == remainder
