"""Words of whole Arrow batches with numpy: positions and 64-bit keys, without a Python string per word.

A word is a run of bytes other than the white space of ASCII (0x20, 0x09 to 0x0D). A null text has no words.
Texts are handled a few megabytes at a time, so a task needs memory for one block, or for its longest text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit keys over the whole key (the usual shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Keeps the first 0 to 8 bytes of a little-endian load.
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def _two_byte_lower() -> np.ndarray:
    """Small letters of the characters that UTF-8 writes in two bytes, where those are two bytes as well."""
    table = np.arange(0x800, dtype=np.int32)
    for point in range(0x80, 0x800):
        small = chr(point).lower()
        if len(small) == 1 and 0x80 <= ord(small) < 0x800:
            table[point] = ord(small)
    return table


_TWO = _two_byte_lower()


def small_letters(raw: np.ndarray) -> np.ndarray:
    """The bytes of a text in small letters, in place: ASCII and letters of two bytes (Latin, Greek, Cyrillic, ...)."""
    data = _LOWER[raw]
    lead = np.flatnonzero((raw >= 0xC2) & (raw <= 0xDF))
    lead = lead[lead + 1 < len(raw)]
    point = _TWO[((raw[lead].astype(np.int32) & 31) << 6) | (raw[lead + 1] & 63)]
    data[lead], data[lead + 1] = 0xC0 | (point >> 6), 0x80 | (point & 63)
    return data


@dataclass
class Words:
    """The words of a block: ``first[d]`` to ``first[d + 1]`` are those of its document ``d``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    key: np.ndarray


def string_parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with up to ``most`` bytes of text, or one longer text: first row, end, offsets, bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    at, raw = string_parts(texts)
    row, rows = 0, len(texts)
    while row < rows:
        end = int(np.searchsorted(at, at[row] + most, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, at[row : end + 1] - at[row], raw[at[row] : at[end]]
        row = end


# Rows and bytes that are handled at once, and bytes that leave at once.
ROWS, BATCH_BYTES, PART_BYTES = 2_000, 16 << 20, 1 << 20


def small(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Batches of so many rows, put together or cut, so that what is made of one is small; freed memory goes back in between."""
    for batch in _together(batches, rows):
        for row in range(0, batch.num_rows, rows):
            yield batch.slice(row, rows)
            give_back()


def _together(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches as one, up to so many rows and ``BATCH_BYTES``."""
    held, many, size = [], 0, 0
    for batch in batches:
        if held and (many + batch.num_rows > rows or size + batch.nbytes > BATCH_BYTES):
            whole = pa.concat_batches(held)
            held, many, size = [], 0, 0
            yield whole
            del whole
        held.append(batch)
        many, size = many + batch.num_rows, size + batch.nbytes
        del batch
    if held:
        yield pa.concat_batches(held)


def in_parts(step: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A step over Arrow batches whose rows leave in parts of about ``PART_BYTES``, and that gives memory back at its end."""

    @wraps(step)
    def parts(batches, *args, **named):
        for made in step(batches, *args, **named):
            rows = max(1, made.num_rows * PART_BYTES // max(made.nbytes, 1))
            for row in range(0, made.num_rows, rows):
                yield made.slice(row, rows)
        made = None
        give_back()

    return parts


def give_back() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def words_of(offsets: np.ndarray, raw: np.ndarray, lower: bool = True, keys: bool = True) -> Words:
    """Words of a block; ``lower`` turns A-Z to a-z before keys are made."""
    docs = len(offsets) - 1
    data = _LOWER[raw] if lower else raw
    size = len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, none, np.zeros(docs + 1, np.int64), np.zeros(0, np.uint64))
    solid = ~_SPACE[data]
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    first = np.searchsorted(start, offsets, "left")
    key = word_keys(data, start, end) if keys else np.zeros(0, np.uint64)
    return Words(data, start, end, doc, first, key)


# Bytes of which cores are made: letters, digits and everything outside ASCII.
_CORE = np.zeros(256, bool)
_CORE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def cores(raw: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and document of each word without the punctuation around it; words of punctuation are left out."""
    if not len(words.start):
        return words.start, words.end, words.doc
    solid, place = _CORE[raw], np.arange(len(raw))
    following = np.minimum.accumulate(np.where(solid, place, len(raw))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(solid, place, -1))
    start, end = following[words.start], before[words.end - 1] + 1
    real = start < words.end
    return start[real], end[real], words.doc[real]


def word_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Keys from the length and eight bytes at a time; one pass for each eight bytes of the longer words."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = end - start
    key = length.astype(np.uint64) * _POWER
    live = np.flatnonzero(length <= 64)
    step = 0
    while len(live):
        part = eight[start[live] + step] & _MASK[np.minimum(length[live] - step, 8)]
        key[live] = mix(key[live] + part)
        step += 8
        live = live[length[live] > step]
    for word in np.flatnonzero(length > 64).tolist():
        raw = np.zeros(-(-int(length[word]) // 8) * 8, np.uint8)
        raw[: length[word]] = data[start[word] : end[word]]
        parts = mix(raw.view("<u8"))
        power = np.cumprod(np.full(len(parts), _POWER, np.uint64))
        key[word : word + 1] = mix(key[word : word + 1] + np.sum(parts * power, keepdims=True))
    return key


def spans(values: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        yield values[a:b]


def signed(keys: np.ndarray) -> np.ndarray:
    """64-bit keys as Spark's long."""
    return keys.view(np.int64)


def unsigned(keys: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(keys, dtype=np.int64).view(np.uint64)


def lists(values: list[np.ndarray], kind=pa.int64()) -> pa.ListArray:
    """An array column from one numpy array per row."""
    ends = np.cumsum([0] + [len(v) for v in values]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))
