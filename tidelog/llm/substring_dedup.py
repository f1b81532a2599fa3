"""Passages that repeat, found by content-defined chunks.

A gear hash rolls over the words of a text (shift by one bit, add the word's key); a chunk ends where two bits of it
are zero. Those bits depend on the last four words only, so an insertion moves the bounds near it and no others. The
digest of a chunk and of the one before it is its key: equal keys are equal passages of about eight words. Of each
key the first place (by id, row, then position) stays; a passage is reported where repeated chunks in a row reach
``min_words`` words. Rows are told apart by a number that they get once, so repeated and null ids are rows like others. With that at 16, a passage of more than 50 words is missed less than once in a hundred times,
as chunk bounds inside it are random but the same in every copy.

A task sends each key once for a batch, with its first place there, so a passage that a third of the documents share
costs a few rows per task.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.words import blocks, give_back, in_parts, mix, small, words_of
from tidelog.session import materialize

# Repeated words in a row that make a passage, and the longest chunk.
MIN_WORDS = 16
MOST_WORDS = 64

# Text for one bucket of keys.
BUCKET_BYTES = 32 << 20

# Rows that a task gives at once.
ROWS = 1 << 15

_A = np.uint64(0xA24BAED4963EE407)
# Rows with one id are in the order of a digest of their texts, and equal ones in that of their numbers.
_PLACE = np.dtype([("key", "<u8"), ("doc", "<i8"), ("digest", "<i4"), ("at", "<i8"), ("chunk", "<i4")])


def chunk_starts(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Word positions at which chunks begin; the start of every text is one."""
    rolled = np.zeros(len(key), np.uint64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.arange(len(key)) - first[:-1][doc]
    for back in range(4):
        inside = np.flatnonzero(place >= back)
        rolled[inside] += key[inside - back] << np.uint64(back)
    begins = np.zeros(len(key), bool)
    begins[1:] = (rolled[:-1] >> np.uint64(2)) & np.uint64(3) == 0
    begins[first[:-1][np.diff(first) > 0]] = True
    start = np.flatnonzero(begins)
    if len(start):
        run = np.arange(len(key)) - np.repeat(start, np.diff(np.append(start, len(key))))
        begins |= run % MOST_WORDS == 0
    return np.flatnonzero(begins)


def chunk_keys(key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Key of each chunk together with the one before it."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = np.diff(np.append(start, len(key)))
    run = np.arange(len(key)) - np.repeat(start, size)
    power = np.cumprod(np.full(MOST_WORDS, _A, np.uint64))
    digest = mix(np.add.reduceat(key * power[run], start) + size.astype(np.uint64))
    both = digest.copy()
    both[1:] += digest[:-1] * _A
    return mix(both)


def _first(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first place of each key, the other places, and the document of the first for each of those."""
    places = places[np.lexsort([places[c] for c in ("chunk", "at", "digest", "doc", "key")])]
    new = np.ones(len(places), bool)
    new[1:] = places["key"][1:] != places["key"][:-1]
    begin = np.flatnonzero(new)
    lead = np.repeat(places[begin], np.diff(np.append(begin, len(places))))
    return places[begin], places[~new], lead["doc"][~new]


def _rows(bucket, places=None, packs=None, seen=None) -> pa.RecordBatch:
    at = pa.nulls(len(bucket), pa.int64()) if places is None else pa.array(places["at"])
    chunk = pa.nulls(len(bucket), pa.int32()) if places is None else pa.array(places["chunk"])
    seen = pa.nulls(len(bucket), pa.int64()) if seen is None else pa.array(seen)
    packs = pa.nulls(len(bucket), pa.binary()) if packs is None else pa.array(packs, pa.binary())
    names = ["bucket", "at", "chunk", "seen_in", "packs"]
    return pa.record_batch([pa.array(bucket, pa.int32()), at, chunk, seen, packs], names)


@in_parts
def _cut(batches, buckets: int):
    for batch in small(batches):
        names = {"doc": "key", "digest": "digest", "at": "at"}
        known = {c: batch.column(name).to_numpy(zero_copy_only=False) for c, name in names.items()}
        found = []
        for row, end, offsets, raw in blocks(batch.column("text")):
            words = words_of(offsets, raw)
            start = chunk_starts(words.key, words.first)
            keys = chunk_keys(words.key, start)
            doc = words.doc[start] if len(start) else np.zeros(0, np.int64)
            chunk = np.arange(len(start)) - np.searchsorted(doc, doc)
            some = chunk > 0  # the first chunk of a text has none before it
            places = np.empty(int(some.sum()), _PLACE)
            places["key"], places["chunk"] = keys[some], chunk[some]
            for c, values in known.items():
                places[c] = values[row:end][doc[some]]
            found.append(places)
        if not sum(map(len, found)):
            continue
        first, others, seen = _first(np.concatenate(found))
        yield _rows(others["key"] % np.uint64(buckets), others, seen=seen)
        bucket = (first["key"] % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        names, begin = np.unique(bucket[order], return_index=True)
        yield _rows(names, packs=[part.tobytes() for part in np.split(first[order], begin[1:])])


@in_parts
def _compare(batches):
    def flush():
        _, others, seen = _first(np.frombuffer(b"".join(held), _PLACE))
        for row in range(0, len(others), ROWS):
            few = others[row : row + ROWS]
            yield _rows(np.zeros(len(few), np.int32), few, seen=seen[row : row + ROWS]).drop_columns(["bucket", "packs"])

    held, now = [], None
    for batch in batches:
        packed = batch.column("packs").is_valid()
        yield batch.filter(pc.invert(packed)).drop_columns(["bucket", "packs"])
        packs = batch.filter(packed)
        for bucket, pack in zip(packs.column("bucket").to_pylist(), packs.column("packs")):
            if bucket != now and held:
                yield from flush()
                held = []
                give_back()
            now = bucket
            held.append(pack.as_py())
        del packs, packed
    if held:
        yield from flush()
        held = []
    give_back()


@in_parts
def _passages(batches, min_words: int, at: int | None = None):
    """The repeated runs of each text, and the text without them where it has any.

    The text is the column ``text``, or number ``at`` of those in ``row``.
    """
    for batch in small(batches):
        spans, texts = [], []
        repeats = batch.column("repeats").to_pylist()
        column = batch.column("text") if at is None else pc.struct_field(batch.column("row"), [at])
        for row, end, offsets, raw in blocks(column):
            words = words_of(offsets, raw)
            start = chunk_starts(words.key, words.first)
            doc = words.doc[start] if len(start) else np.zeros(0, np.int64)
            for d in range(end - row):
                own = start[np.searchsorted(doc, d) : np.searchsorted(doc, d + 1)]
                found = _runs(repeats[row + d], own, words, d, min_words)
                spans.append([{"start_word": a, "n_words": n, "seen_in": s} for a, n, s, _, _ in found])
                texts.append(None)
                if found:
                    text = raw[offsets[d] : offsets[d + 1]].tobytes()
                    base, parts = int(offsets[d]), [0]
                    for _, _, _, a, b in found:
                        parts += [a - base, b - base]
                    parts.append(len(text))
                    texts[-1] = b"".join(text[a:b] for a, b in zip(parts[::2], parts[1::2])).decode()
        kind = pa.list_(pa.struct([("start_word", pa.int64()), ("n_words", pa.int64()), ("seen_in", pa.int64())]))
        yield pa.record_batch(
            [batch.column("row"), pa.array(spans, kind), pa.array(texts, pa.string())], ["row", "passages", "text"]
        )


def _runs(repeats, start, words, doc, min_words):
    """Start word, words, document seen in, first byte and last byte of each passage of a text."""
    low, high = int(words.first[doc]), int(words.first[doc + 1])
    if not repeats or not len(start):
        return []
    covered = np.zeros(len(start), bool)
    seen = np.zeros(len(start), np.int64)
    for item in repeats:
        if item["chunk"] < len(start):
            covered[item["chunk"] - 1 : item["chunk"] + 1] = True
            seen[item["chunk"]] = item["seen_in"]
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    bound = np.append(start, high)
    found = []
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
        first, last = int(bound[a]), int(bound[b])
        if last - first >= min_words:
            stop = int(words.start[last]) if last < high else int(words.end[last - 1])
            found.append((first - low, last - first, int(seen[b - 1]), int(words.start[first]), stop))
    return found


_SPANS = "array<struct<start_word: long, n_words: long, seen_in: long>>"


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, at, key, digest, text``: the rows with a number for each, written once so that later passes see the same."""
    rows = materialize(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "rows")
    key = F.coalesce(F.col("row").getField(id_col).cast("long"), F.lit(-(1 << 63)).cast("long"))
    text = F.col("row").getField(text_col).cast("string")
    return rows.select("row", "at", key.alias("key"), F.hash(text).alias("digest"), text.alias("text"))


def _repeats(rows: DataFrame) -> DataFrame:
    """Chunks of each row that occur at an earlier place, in a list for each row."""
    buckets = 64 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES
    schema = "bucket int, at long, chunk int, seen_in long, packs binary"
    packed = rows.select("at", "key", "digest", "text").mapInArrow(partial(_cut, buckets=buckets), schema)
    # Spark hands a task's packs to Python in one Arrow batch, so a task has about one bucket.
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets)
    met = packed.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    repeats = met.mapInArrow(_compare, "at long, chunk int, seen_in long")
    listed = repeats.groupBy("at").agg(F.collect_set(F.struct("chunk", "seen_in")).alias("repeats"))
    return materialize(listed, "repeats", fine=True)


def find_passages(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start_word, n_words, seen_in``: the passages that an earlier document, or earlier text, has.

    Earlier is by id, then position; ``seen_in`` is a document with an earlier copy of the end of the passage. Null,
    empty and short texts have no passages. Rows with one id are documents of their own, one after the other, so the
    first of equal ones has no passages for it; a null id is before all others. Other columns are not looked at.
    """
    rows = _numbered(docs.select(id_col, text_col), id_col, text_col)
    joined = rows.select("at", "key", "text").join(_repeats(rows), "at").select(F.col("key").alias("row"), "text", "repeats")
    found = joined.mapInArrow(partial(_passages, min_words=min_words), f"row long, passages {_SPANS}, text string")
    item = found.select("row", F.explode("passages").alias("p")).select("row", "p.*")
    null = F.lit(None).cast("long")
    clear = [F.when(F.col(c) != -(1 << 63), F.col(c)).otherwise(null).alias(n) for c, n in (("row", "doc_id"), ("seen_in", "seen_in"))]
    return item.select(clear[0], "start_word", "n_words", clear[1])


def cut_passages(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, text, n_passages``: every row as a struct of its columns, and its text without the repeated passages.

    What repeats is told as in ``find_passages``. Null texts come back empty.
    """
    rows = _numbered(docs, id_col, text_col)
    # The text moves once, in its row, and comes back only where something is cut.
    text = F.col("row").getField(text_col).cast("string")
    plain = [i for i, f in enumerate(docs.schema.fields) if f.name.lower() == text_col.lower() and isinstance(f.dataType, T.StringType)]
    at = plain[0] if len(plain) == 1 else None
    joined = rows.select("row", "at").join(_repeats(rows), "at", "left")
    joined = joined.select("row", "repeats", *([text.alias("text")] if at is None else []))
    schema = T.StructType([joined.schema["row"], *T.StructType.fromDDL(f"passages {_SPANS}, text string")])
    found = joined.mapInArrow(partial(_passages, min_words=min_words, at=at), schema)
    left = F.coalesce(F.col("text"), text, F.lit("")).alias("text")
    return found.select("row", left, F.size("passages").alias("n_passages"))
