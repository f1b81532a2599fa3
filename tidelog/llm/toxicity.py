"""Toxicity scores: gradient-boosted trees over dense features of whole texts, with isotonic calibration.

Words and beginnings of words that are much more frequent in toxic texts form a lexicon; their counts are those of all
labelled texts. The trees are fitted on one part of a labelled sample and calibrated on another. Both see features by a
lexicon of the other half of the labelled texts, so no text helps to explain its own label; all texts that are scored
have features by the lexicon of both halves.
Features: densities and weights of lexicon words, how near they are to a second person, capitals, punctuation, and words
that are obfuscated by signs, digits or repeated letters.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.words import blocks, cores, mix, signed, small, small_letters, unsigned, word_keys, words_of
from tidelog.session import materialize

# Labelled rows that the model is fitted on (about; chosen by hash over all), and entries of its lexicon.
SAMPLE_ROWS = 16_000
LEXICON = 3_000
LEAST_TOXIC = 4

# Bytes at the beginning of a word that may be an entry, besides whole words.
BEGINNINGS = (3, 4, 5, 6, 8)

# Words within which a second person counts as near.
NEAR = 5

TREES, DEPTH, STEP = 30, 4, 0.2

# Words for a second person in several languages. Fixed values.
SECOND = (
    "you your yours yourself yourselves u ur du dich dir dein deine deiner deinen ihr euch euer eure tu te toi ton ta tes "
    "vous votre vos tú ti tuyo usted ustedes vosotros vuestro você vocês seu sua voi tuo tua jij jou jouw"
).split()

FEATURES = (
    "lexicon_words", "lexicon_weight", "lexicon_most", "lexicon_kinds", "lexicon_count", "near_second", "second",
    "capital_letters", "capital_words", "marks", "calls", "signs_inside", "digits_inside", "repeats", "length",
)

# Texts of a half by their label.
COUNTS = ("toxic0", "clean0", "toxic1", "clean1")

_PREFIX = np.uint64(0xD6E8FEB86659FD93)


def _keys_of(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return np.sort(words_of(np.array([0, len(raw)]), raw).key)


_SECOND_KEYS = _keys_of(SECOND)


def _terms(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Keys of the words, then of each length of beginning, with the words that are long enough for it."""
    yield np.arange(len(start)), word_keys(data, start, end)
    for size in BEGINNINGS:
        longer = np.flatnonzero(end - start > size)
        yield longer, mix(word_keys(data, start[longer], start[longer] + size) ^ _PREFIX)


def _term_counts(batches):
    """Toxic and clean texts of each half that have each term."""
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False) > 0
        half = batch.column(2).to_numpy(zero_copy_only=False)
        for row, _, offsets, raw in blocks(batch.column(0)):
            start, end, doc = cores(raw, words_of(offsets, raw, keys=False))
            data, found = small_letters(raw), []
            for of, key in _terms(data, start, end):
                place = np.stack([key, doc[of].astype(np.uint64)], axis=1)
                order = np.lexsort((place[:, 1], place[:, 0]))
                place = place[order]
                new = np.ones(len(place), bool)
                new[1:] = (place[1:] != place[:-1]).any(1)
                found.append(place[new])
            found = np.concatenate(found)
            names, which = np.unique(found[:, 0], return_inverse=True)
            of = row + found[:, 1].astype(np.int64)
            made = [
                np.bincount(which, (half[of] == h) & (toxic[of] == bad), len(names)).astype(np.int64)
                for h in (0, 1) for bad in (True, False)
            ]
            yield pa.record_batch([pa.array(signed(names)), *map(pa.array, made)], ["term", *COUNTS])


def _holds(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def _block_features(offsets, raw, lexicon: np.ndarray, weights: np.ndarray) -> np.ndarray:
    docs = len(offsets) - 1
    words = words_of(offsets, raw, keys=False)
    start, end, doc = cores(raw, words)
    data = small_letters(raw)
    weight, entry, second = np.zeros(len(start)), np.full(len(start), -1), np.zeros(len(start), bool)
    for turn, (of, key) in enumerate(_terms(data, start, end)):
        if not turn:
            second = _holds(_SECOND_KEYS, key)[1]
        at, known = _holds(lexicon, key)
        gain = np.where(known, weights[at] if len(weights) else 0.0, 0.0)
        more = gain > weight[of]
        weight[of[more]], entry[of[more]] = gain[more], at[more]
    hit = entry >= 0
    place = np.arange(len(start))
    last = np.maximum.accumulate(np.where(second, place, -(1 << 40))) if len(place) else place
    coming = np.minimum.accumulate(np.where(second, place, 1 << 40)[::-1])[::-1] if len(place) else place
    near = hit & ((place - last <= NEAR) & (doc[np.maximum(last, 0)] == doc) | (coming - place <= NEAR) & (doc[np.minimum(coming, len(doc) - 1)] == doc)) if len(place) else hit

    def per_doc(values, of=doc):
        return np.bincount(of, values, docs)

    first = np.searchsorted(words.doc, np.arange(docs + 1))
    many = np.maximum(np.diff(first), 1).astype(float)
    kinds = np.zeros(docs)
    if hit.any():
        pairs = np.unique(doc[hit] * (len(lexicon) + 1) + entry[hit])
        kinds = np.bincount(pairs // (len(lexicon) + 1), minlength=docs).astype(float)
    most = np.zeros(docs)
    np.maximum.at(most, doc, weight)

    def between(flags, a, b):
        total = np.cumsum(np.concatenate([[0], flags]))
        return total[b] - total[a]

    def rate(flags):
        return between(flags, offsets[:-1], offsets[1:]) / np.maximum(np.diff(offsets), 1)

    capital = data != raw
    upper, lower = (raw >= 65) & (raw <= 90), (raw >= 97) & (raw <= 122)
    digit = (raw >= 48) & (raw <= 57)
    mark = (raw > 32) & (raw < 127) & ~upper & ~lower & ~digit
    letters = between(upper | lower, offsets[:-1], offsets[1:])
    same = np.zeros(len(raw), bool)
    if len(raw) > 2:
        same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & lower[2:]
    inside = between(mark, start, end) > 0
    mixed = (between(digit, start, end) > 0) & (between(upper | lower, start, end) > 0)
    shout = (between(capital, start, end) > 1) & (between(lower, start, end) == 0)
    columns = {
        "lexicon_words": per_doc(hit) / many,
        "lexicon_weight": per_doc(weight) / many,
        "lexicon_most": most,
        "lexicon_kinds": kinds,
        "lexicon_count": per_doc(hit),
        "near_second": per_doc(near) / np.maximum(per_doc(hit), 1),
        "second": per_doc(second) / many,
        "capital_letters": between(upper, offsets[:-1], offsets[1:]) / np.maximum(letters, 1),
        "capital_words": per_doc(shout) / many,
        "marks": rate(mark),
        "calls": rate((raw == 33) | (raw == 63)),
        "signs_inside": per_doc(inside) / many,
        "digits_inside": per_doc(mixed) / many,
        "repeats": per_doc(between(same, start, end) > 0) / many,
        "length": np.log1p(np.diff(first)),
    }
    return np.stack([columns[name] for name in FEATURES], 1)


def _features(batches, lexicon: np.ndarray, weights: np.ndarray):
    """The features of each text, after its other columns."""
    for batch in small(batches):
        parts = [_block_features(at, raw, lexicon, weights) for _, _, at, raw in blocks(batch.column("text"))]
        made = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
        flat = pa.FixedSizeListArray.from_arrays(pa.array(made.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
        kept = [batch.column(name) for name in batch.schema.names if name != "text"]
        yield pa.record_batch([*kept, flat], [*(n for n in batch.schema.names if n != "text"), "features"])


def _with_features(rows: DataFrame, lexicon, weights) -> DataFrame:
    kept = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "text")
    made = rows.mapInArrow(partial(_features, lexicon=lexicon, weights=weights), f"{kept}, features array<double>")
    return made.withColumn("features", array_to_vector("features"))


def _lexicon(terms: DataFrame, sizes: dict[str, int], halves: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and weights of the ``LEXICON`` strongest terms by the texts of some halves."""

    def total(label: str) -> Column:
        return sum((F.col(f"{label}{h}") for h in halves), F.lit(0))

    texts = {label: sum(sizes[f"{label}{h}"] for h in halves) for label in ("toxic", "clean")}
    odds = F.log((F.col("toxic") + 0.5) / F.lit(texts["toxic"] + 1.0) / ((F.col("clean") + 0.5) / F.lit(texts["clean"] + 1.0)))
    counted = terms.select("term", total("toxic").alias("toxic"), total("clean").alias("clean"))
    strong = counted.where(F.col("toxic") >= LEAST_TOXIC).withColumn("weight", odds).where("weight > 2")
    chosen = strong.orderBy((F.col("weight") * F.log1p("toxic")).desc(), "term").limit(LEXICON).select("term", "weight").collect()
    keys = unsigned(np.array([r["term"] for r in chosen], np.int64))
    order = np.argsort(keys)
    return keys[order], np.array([r["weight"] for r in chosen], np.float64)[order]


def _by_halves(sample: DataFrame, lexicons) -> DataFrame:
    """Rows with the features by the lexicon of the half that they are not in."""
    parts = [_with_features(sample.where(F.col("half") == h).select("label", "text"), *lexicons[1 - h]) for h in (0, 1)]
    return parts[0].unionByName(parts[1])


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``doc_id, score`` (0 to 1) for every row of ``docs``.

    Labels are taken for the documents for which ``training`` (an expression over ``docs``) is true; of several labels
    of an id the largest holds, and null labels are none. Null and empty texts have features of 0. If a part or half of the
    labelled texts has no toxic or no clean row, all scores are the toxic share, or 0 without rows. Repeated rows and null ids are
    rows like others. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), training.alias("training"))
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    one = known.where("toxic is not null and id is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    number = F.expr("pmod(xxhash64(id, 11), 10)")
    # Labels grow with the documents, so both sides are dealt by id at every size.
    taught = rows.where("training").select("id", "text").join(one.hint("merge"), "id").select(
        "id", "text", F.col("toxic").cast("double").alias("label"), F.floor(number / 5).cast("int").alias("half"),
        number.isin(3, 4, 8, 9).alias("check"),
    )
    split = [F.count_if((F.col("half") == h) & (F.col("label") == bad)).alias(f"{n}{h}") for h in (0, 1) for n, bad in (("toxic", 1), ("clean", 0))]
    sizes = taught.agg(*split).first().asDict()
    every, bad = sum(sizes.values()), sizes["toxic0"] + sizes["toxic1"]
    plain = rows.select("id", "text")
    whole = plain.select(F.col("id").alias("doc_id"), F.lit(float(bad / every) if every else 0.0).alias("score"))
    if not all(sizes.values()):
        return whole
    counted = taught.select("text", F.col("label").alias("toxic"), "half").mapInArrow(_term_counts, "term long, " + ", ".join(f"{c} long" for c in COUNTS))
    terms = counted.groupBy("term").agg(*[F.sum(c).alias(c) for c in COUNTS])
    terms = materialize(terms.where(F.col("toxic0") + F.col("toxic1") >= LEAST_TOXIC), "terms")
    lexicons = [_lexicon(terms, sizes, (h,)) for h in (0, 1)]
    lexicon, weights = _lexicon(terms, sizes, (0, 1))

    share = int((1 << 30) * min(1.0, sample_rows / every))
    sample = materialize(taught.where(F.expr(f"pmod(xxhash64(id, 7), 1073741824) < {share}")).select("text", "label", "half", "check"), "labelled")
    fitted = materialize(_by_halves(sample.where("not check"), lexicons), "fitted")
    checked = materialize(_by_halves(sample.where("check"), lexicons), "checked")
    if any(part.select("label").distinct().count() < 2 for part in (fitted, checked)):
        return whole
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, subsamplingRate=0.8, seed=7, minInstancesPerNode=5)
    model = trees.fit(fitted)
    raw = vector_to_array("probability")[1].alias("raw")
    level = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="level").fit(model.transform(checked).select("label", raw))
    guessed = level.transform(model.transform(_with_features(plain, lexicon, weights)).select("id", raw))
    # The trees' own probability only orders what has one calibrated level.
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("level") * 0.999 + F.col("raw") * 0.001))
    return guessed.select(F.col("id").alias("doc_id"), score.alias("score"))
