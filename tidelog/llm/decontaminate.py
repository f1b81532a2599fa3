"""Benchmark questions in documents, also re-parameterised ones, by windows of a typed template.

Numbers, names and units become placeholders of their type, the other words stay (lower case, without punctuation at
their ends). Windows of the template are joined by hash. The windows of a document and an item that agree are chained
in the order of both, so words put in or left out part an alignment no more than its distance changes by the length of
the item. Each value of the item stands for one value of the document: where its places disagree, that of most places
holds and windows with another are left out, or all its windows if none has most. An alignment that holds enough of the
item's windows is a leak.

* number: begins with a digit, after a sign or currency if any;
* unit: a word of ``UNITS`` right after a number;
* name: a capital and small letters; names in a row are one. What opens a text, line or sentence can be a name or not, so
  texts are taken both ways: such words as literal, and as names.

A window of less than half literal words is joined by its words as they are. Items shorter than a window are one window of their own length.
"""

from __future__ import annotations

from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.words import BLOCK_BYTES, blocks, cores, in_parts, mix, signed, small, small_letters, word_keys, words_of
from tidelog.session import materialize

WINDOW = 8
LEAST_SHARE = 0.4

# Bits of the filter on document windows. Its size is fixed; a larger benchmark lets more windows through to the join.
FILTER_BITS = 1 << 22

# Units that make a placeholder after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yards mile miles mg g kg ton tons tonnes oz lb lbs pound pounds ml cl l "
    "liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week "
    "weeks month months year years percent degree degrees dollar dollars cent cents euro euros mph kmh watt watts volt "
    "volts amp amps hz khz mhz ghz kb mb gb tb meter meters metre metres kilometer kilometers kilometre kilometres "
    "centimeter centimeters centimetre centimetres millimeter millimeters millimetre millimetres gram grams kilogram "
    "kilograms milligram milligrams ounce ounces milliliter milliliters millilitre millilitres millisecond milliseconds "
    "kilowatt kilowatts"
).split()

_LITERAL, NUMBER, NAME, UNIT = range(4)
_A = np.uint64(0xA24BAED4963EE407)


def _keys_of(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return words_of(np.array([0, len(raw)]), raw).key


_UNIT_KEYS = np.sort(_keys_of(UNITS))


def template(offsets: np.ndarray, raw: np.ndarray, opening: bool = False):
    """Words of a block as template keys, kinds and own keys, with the bounds of their cores; words of punctuation are left out.

    ``opening`` takes capital words that open a sentence as names.
    """
    words = words_of(offsets, raw, keys=False)
    size = len(raw)
    if not len(words.start):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    start, end, doc = cores(raw, words)
    data = small_letters(raw)
    key = word_keys(data, start, end)
    changed = data != raw
    wide = raw >= 0xC2
    capital = changed[start] | wide[start] & changed[np.minimum(start + 1, size - 1)]
    digit = (raw[start] >= 48) & (raw[start] <= 57)
    # What ends a sentence before a word: a mark right after the word before, a new line, or nothing before it.
    marks = np.cumsum(np.concatenate([[0], np.isin(raw, np.frombuffer(b".!?:\n", np.uint8))]))
    opens = np.ones(len(start), bool)
    opens[1:] = (doc[1:] != doc[:-1]) | (marks[start[1:]] > marks[end[:-1]])
    # Words of capitals are no names: the second letter of a name is a small one.
    second = np.minimum(start + 1 + wide[start], size - 1)
    lowered = (end > second) & ~changed[second] & ~(wide[second] & changed[np.minimum(second + 1, size - 1)])
    kind = np.where(digit, NUMBER, np.where(capital & lowered & (opening | ~opens), NAME, _LITERAL))
    after = np.zeros(len(start), bool)
    after[1:] = digit[:-1] & (doc[1:] == doc[:-1])
    found = np.searchsorted(_UNIT_KEYS, key)
    unit = after & (_UNIT_KEYS[np.minimum(found, len(_UNIT_KEYS) - 1)] == key)
    kind = np.where(unit & (kind == _LITERAL), UNIT, kind)
    # Names with nothing but white space between them are one.
    white = np.cumsum(np.concatenate([[0], np.isin(raw, np.frombuffer(b" \t\n\v\f\r", np.uint8))]))
    lead = np.ones(len(start), bool)
    follows = (kind[1:] == NAME) & (kind[:-1] == NAME) & ~opens[1:]
    lead[1:] = ~(follows & (white[start[1:]] - white[end[:-1]] == start[1:] - end[:-1]))
    head = np.flatnonzero(lead)
    own = np.add.reduceat(mix(key + np.arange(len(key), dtype=np.uint64) - np.repeat(head, np.diff(np.append(head, len(key)))).astype(np.uint64)), head) if len(head) else key
    end = end[np.append(head[1:], len(start)) - 1] if len(head) else end
    key, kind, start, doc = key[head], kind[head], start[head], doc[head]
    first = np.searchsorted(doc, np.arange(len(offsets)))
    return np.where(kind == _LITERAL, key, kind.astype(np.uint64)), kind, own, start, end, first


def windows(key: np.ndarray, kind: np.ndarray, own: np.ndarray, first: np.ndarray, size: int):
    """First words and keys of the windows of ``size`` words, and which have too few literal words and go by their own."""
    if len(key) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(doc[size - 1 :] == doc[: len(doc) - size + 1])
    literal = np.cumsum(np.concatenate([[0], kind == _LITERAL]))
    dense = 2 * (literal[at + size] - literal[at]) < size
    total = np.where(dense, np.uint64(size + (1 << 20)), np.uint64(size))
    power = np.cumprod(np.full(size, _A, np.uint64))
    typed, plain = mix(key), mix(own)
    for i in range(size):
        total += np.where(dense, plain[at + i], typed[at + i]) * power[i]
    return at, mix(total), dense


def _slots(raw, kind, start, end, at: int, size: int) -> list[str]:
    """Place in the window, type and value of each placeholder of a window."""
    held = [i for i in range(at, at + size) if kind[i] != _LITERAL]
    return [f"{i - at}:{kind[i]}:{raw[start[i] : end[i]].tobytes().decode(errors='replace').lower()}" for i in held]


def _way(keys: np.ndarray, opening: bool) -> np.ndarray:
    """Keys of the two ways to take a text never meet."""
    return (keys << np.uint64(1)) | np.uint64(opening)


_FOUND = "id long, digest long, key long, place int, size int, dense boolean, typed int, total int, slots array<string>"


def _batch(rows) -> pa.RecordBatch:
    ids, digests, keys, places, sizes, dense, typed, totals, slots = zip(*rows) if rows else ((),) * 9
    return pa.record_batch(
        [
            *(pa.array(x, pa.int64()) for x in (ids, digests, keys)),
            *(pa.array(x, pa.int32()) for x in (places, sizes)),
            pa.array(dense, pa.bool_()),
            *(pa.array(x, pa.int32()) for x in (typed, totals)),
            pa.array(slots, pa.list_(pa.string())),
        ],
        ["id", "digest", "key", "place", "size", "dense", "typed", "total", "slots"],
    )


def _item_windows(batches, size: int):
    """All windows of each item, with the number of its windows and that of typed ones."""
    for batch in batches:
        ids, rows = batch.column(0).to_pylist(), []
        for row, last, offsets, raw in blocks(batch.column(1)):
            for opening in (False, True):
                key, kind, plain, start, end, first = template(offsets, raw, opening)
                for d in range(last - row):
                    a, b = int(first[d]), int(first[d + 1])
                    own = min(size, b - a)
                    if not own:
                        continue
                    at, keys, dense = windows(key[a:b], kind[a:b], plain[a:b], np.array([0, b - a]), own)
                    typed = int(len(at) - dense.sum())
                    for place, value, thick in zip(at.tolist(), signed(_way(keys, opening)).tolist(), dense.tolist()):
                        slots = _slots(raw, kind, start, end, a + place, own)
                        rows.append((ids[row + d], 0, value, place, own, thick, typed, len(at), slots))
        yield _batch(rows)


@in_parts
def _document_windows(batches, sizes: list[int], bits: bytes):
    """Windows of documents that pass the filter."""
    bitmap = np.frombuffer(bits, np.uint8)
    for batch in small(batches):
        ids, digests = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for row, _, offsets, raw in blocks(batch.column(1), BLOCK_BYTES // 2):
            rows = []
            for opening in (False, True):
                key, kind, plain, start, end, first = template(offsets, raw, opening)
                for size in sizes:
                    at, keys, dense = windows(key, kind, plain, first, size)
                    keys = _way(keys, opening)
                    bit = (keys % np.uint64(FILTER_BITS)).astype(np.int64)
                    some = np.flatnonzero((bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                    doc = np.searchsorted(first, at[some], "right") - 1
                    for place, value, thick, d in zip(at[some].tolist(), signed(keys[some]).tolist(), dense[some].tolist(), doc.tolist()):
                        slots = _slots(raw, kind, start, end, place, size)
                        rows.append((ids[row + d], digests[row + d], value, place - int(first[d]), size, thick, 0, 0, slots))
            if rows:
                yield _batch(rows)


def chain(place: np.ndarray, at: np.ndarray, reach: int) -> np.ndarray:
    """Matches of the best chain: both places go up, the distance changes by ``reach`` at most, and seldom."""
    order = np.lexsort((at, place))
    place, at = place[order].astype(np.int64), at[order].astype(np.int64)
    shift = place - at
    span = int(at.max()) + reach
    score, back = np.ones(len(at)), np.full(len(at), -1)
    low = np.searchsorted(place, place - span)
    for i in range(1, len(at)):
        a = int(low[i])
        part = slice(a, i)
        move = np.abs(shift[part] - shift[i])
        able = (place[part] < place[i]) & (at[part] < at[i]) & (move <= reach)
        gain = np.where(able, score[part] - 0.5 * (move > 0), -1.0)
        if len(gain) and gain.max() > 0:
            best = int(gain.argmax())
            score[i], back[i] = gain[best] + 1, a + best
    found, i = [], int(score.argmax())
    while i >= 0:
        found.append(order[i])
        i = int(back[i])
    return np.array(found)


def _consistent(matches: list) -> tuple[list, bool]:
    """The matches of which all slots hold the value that stands for the item's, and whether no value differs at all."""
    partners: dict[str, set] = {}
    same = True
    for m in matches:
        for a, b in zip(m["slots"], m["own"]):
            (where, value), other = a.split(":", 1), b.split(":", 1)[1]
            partners.setdefault(value, set()).add((m["at"] + int(where), other))
            same &= value == other
    stands = {}
    for value, seen in partners.items():
        other, times = Counter(b for _, b in sorted(seen)).most_common(1)[0]
        stands[value] = other if 2 * times > len(seen) else None
    fits = lambda m: all(stands[a.split(":", 1)[1]] == b.split(":", 1)[1] for a, b in zip(m["slots"], m["own"]))
    return [m for m in matches if fits(m)], same


def _judge(batches, least_share: float):
    """The best alignment of each document and item, if it has enough windows."""
    names = ["id", "item", "share", "n_windows", "same_slots"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.bool_()]
    for batch in batches:
        rows = []
        for line in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
            by_shift: dict[int, list] = {}
            for m in line["matches"]:
                by_shift.setdefault(m["place"] - m["at"], []).append(m)
            tried = list(by_shift.values())
            if len(tried) > 1:
                place, at = (np.array([m[c] for m in line["matches"]]) for c in ("place", "at"))
                tried.append([line["matches"][i] for i in chain(place, at, line["total"] + line["size"])])
            made = []
            for matches in tried:
                kept, same = _consistent(matches)
                typed = sum(not m["dense"] for m in kept)
                share = max(len(kept) / line["total"], typed / max(line["typed"], 1))
                made.append((share, len(kept), same))
            if max(made)[0] >= least_share:
                rows.append((line["id"], line["item"], *max(made)))
        columns = zip(*rows) if rows else ((),) * 5
        yield pa.record_batch([pa.array(x, kind) for x, kind in zip(columns, kinds)], names)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    least_share: float = LEAST_SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, share, n_windows, same_slots`` for each leak, one row for a document and an item.

    ``share`` is the part of the item's windows in the best consistent alignment (of all, or of the typed ones, whichever
    is more), ``n_windows`` their number, and ``same_slots`` tells a copy from a re-parameterised question. Items with equal text are all reported. Null and
    empty texts have no windows, on either side. Repeated rows of a document or an item count once. Rows with a null
    or repeated id are judged text by text and reported under it once. Other columns are not looked at.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    items = items.where("text is not null").withColumn("item", F.xxhash64("text"))
    one = items.groupBy("text").agg(F.min("item").alias("item")).select("item", "text")
    made = materialize(one.mapInArrow(partial(_item_windows, size=window), _FOUND), "items")
    # Both are bounded: sizes by the window, bits by the size of the filter.
    sizes = sorted(r[0] for r in made.select("size").distinct().collect())
    bit = F.expr(f"pmod(key, {FILTER_BITS})").cast("int")
    bitmap = np.zeros(FILTER_BITS // 8, np.uint8)
    some = np.array([r[0] for r in made.select(bit).distinct().toLocalIterator()], np.int64)
    np.bitwise_or.at(bitmap, some >> 3, (1 << (some & 7)).astype(np.uint8))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("digest"))
    seek = partial(_document_windows, sizes=sizes, bits=bitmap.tobytes())
    met = rows.mapInArrow(seek, _FOUND).select("id", "digest", "key", "place", "size", F.col("slots").alias("own"))
    item = made.select(F.col("id").alias("item"), "key", F.col("place").alias("at"), "size", "dense", "typed", "total", "slots")
    pairs = met.join(item, ["key", "size"]).withColumn("way", F.expr("key & 1"))
    aligned = pairs.groupBy("id", "digest", "item", "way").agg(
        F.collect_set(F.struct("place", "at", "dense", "own", "slots")).alias("matches"),
        F.count_distinct("at").alias("n"),
        *(F.max(c).alias(c) for c in ("size", "typed", "total")),
    )
    # No alignment has more windows than all of them.
    enough = F.col("n") >= least_share * F.when(F.col("typed") > 0, F.col("typed")).otherwise(F.col("total"))
    judge = partial(_judge, least_share=least_share)
    columns = "id long, item long, share double, n_windows long, same_slots boolean"
    good = aligned.where(enough).select("id", "item", "size", "typed", "total", "matches").mapInArrow(judge, columns)
    best = good.groupBy("id", "item").agg(F.max(F.struct("share", "n_windows", "same_slots")).alias("b"))
    named = items.select("item", F.col("id").alias("item_id")).distinct()
    leaks = best.join(named, "item").groupBy(F.col("id").alias("doc_id"), "item_id").agg(F.max("b").alias("b"))
    return leaks.select("doc_id", "item_id", "b.*")
