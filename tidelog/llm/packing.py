"""Packing of tokenized documents into sequences of bounded length, by the sum-of-squares rule.

Each document goes where the squared counts of open sequences per remaining gap add up to least: into an open
sequence, or a new one. Documents longer than a sequence are cut into full pieces with the shorter one first; only
those pieces are not whole documents. Pieces are dealt to shards of bounded size by a hash, longest first in a
shard. What poorly filled sequences hold is packed again, first in the shard and then together with that of other
shards, so few sequences stay open however many shards there are.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.tokens import ByteBpe
from tidelog.llm.words import small
from tidelog.session import materialize

LIMIT = 1024
END_ID = 2

# Pieces that one task packs.
SHARD_PIECES = 25_000

# Times that a shard is packed; each time but the last, only well filled sequences stay.
ROUNDS = 4

_PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(size: int, limit: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: one, or full ones after a first that may be shorter."""
    if size <= limit:
        return [(0, size)]
    first = size % limit or limit
    return [(0, first)] + [(at, limit) for at in range(first, size, limit)]


def _tokenize(batches, tokenizer: str, limit: int):
    bpe = ByteBpe(tokenizer)
    end = np.array([END_ID], "<u4").tobytes()
    for batch in small(batches):
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = bpe.encode(text.as_py()) + end
            for piece, (start, length) in enumerate(cut(len(ids) // 4, limit)):
                rows.append((doc, piece, start, length, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])))
        doc, piece, start, length, crc = zip(*rows) if rows else ((),) * 5
        yield pa.record_batch(
            [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def pack(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken in the given order, and the gap that each bin keeps."""
    count = np.zeros(limit + 1, np.int64)  # open bins by gap; full and new ones count nothing
    held: list[list[int]] = [[] for _ in range(limit + 1)]
    bins, offsets, gaps = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    never = np.iinfo(np.int64).max
    for item, size in enumerate(lengths.tolist()):
        # Change of the sum of squares, for a bin of gap size, size + 1, ... limit - 1.
        before, after = count[size:limit], count[: limit - size]
        change = np.where(before > 0, 2 * (after - before) + 2, never)
        if len(change) and before[0] > 0:
            change[0] = 1 - 2 * before[0]  # it gets full, and no longer counts
        fresh = 2 * int(count[limit - size]) + 1 if size < limit else 0
        best = int(np.argmin(change)) if len(change) else -1
        if best >= 0 and change[best] < never and change[best] <= fresh:
            gap = size + best
            at = held[gap].pop()
            count[gap] -= 1
        else:
            gap, at = limit, len(gaps)
            gaps.append(limit)
        bins[item], offsets[item] = at, limit - gap
        gaps[at] = gap - size
        if gap > size:
            held[gap - size].append(at)
            count[gap - size] += 1
    return bins, offsets, np.array(gaps, np.int64)


def pack_in_rounds(lengths: np.ndarray, limit: int, rounds: int = ROUNDS):
    """``pack`` on descending lengths; the bins that keep a gap of more than ``limit`` / 256 are packed again."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    left, gaps = np.arange(len(lengths)), [np.zeros(0, np.int64)]
    made = 0
    for turn in range(rounds):
        found, offset, gap = pack(lengths[left], limit)
        done = gap <= (limit // 256 if turn < rounds - 1 else limit)
        number = made + np.cumsum(done) - 1
        placed = done[found]
        bins[left[placed]], offsets[left[placed]] = number[found[placed]], offset[placed]
        gaps.append(gap[done])
        made, left = made + int(done.sum()), left[~placed]
        if not len(left):
            break
    return bins, offsets, np.concatenate(gaps)


def _pack_shard(table: pa.Table, limit: int, keep: bool) -> pa.Table:
    """Packs one shard; unless ``keep``, the bins that are not full enough are marked to be packed again."""
    length = table.column("length").to_numpy()
    order = np.lexsort((table.column("row").to_numpy(), -length))
    bins, offsets, gaps = pack_in_rounds(length[order], limit)
    table = table.take(pa.array(order))
    shard = table.column("shard").to_numpy()
    again = np.zeros(len(bins), bool) if keep else (gaps > limit // 64)[bins]
    columns = {name: table.column(name) for name in ("row", "doc_id", "piece", "start", "length", "ids_crc32")}
    numbers = (shard << 32) + bins
    return pa.table(columns | {"sequence_id": pa.array(numbers), "offset": pa.array(offsets), "again": pa.array(again)})


def _shards(pieces: DataFrame, size: int, first: int) -> DataFrame:
    """Deals pieces to shards of about ``size`` pieces each, numbered from ``first``."""
    shards = max(1, round(pieces.count() / size))
    return pieces.withColumn("shard", F.expr(f"pmod(xxhash64(row), {shards}L) + {first}L"))


def pack_documents(
    docs: DataFrame,
    limit: int = LIMIT,
    tokenizer: str = "byte_bpe_50k",
    shard_pieces: int = SHARD_PIECES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its text's token ids and the end id; a null text counts as empty and is the end id alone. Every row
    is a document, also repeated rows and rows with a null id. The same rows give the same sequences in any order
    of rows only if ids differ, as ties in length go by row hash. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cutting = partial(_tokenize, tokenizer=tokenizer, limit=limit)
    made = rows.mapInArrow(cutting, "doc_id long, piece int, start long, length long, ids_crc32 long")
    row = F.xxhash64("doc_id", "piece", "ids_crc32")
    pieces = materialize(made.withColumn("row", row), "pieces", fine=True).select("row", "doc_id", "piece", "start", "length", "ids_crc32")
    schema = f"{_PIECES}, sequence_id long, offset long, again boolean"
    first = partial(_pack_shard, limit=limit, keep=False)
    packed = materialize(_shards(pieces, shard_pieces, 0).groupBy("shard").applyInArrow(lambda t: first(t), schema), "packed")
    last = partial(_pack_shard, limit=limit, keep=True)
    rest = packed.where("again").drop("sequence_id", "offset", "again")
    rest = _shards(rest, shard_pieces, 1 << 30).groupBy("shard").applyInArrow(lambda t: last(t), schema)
    return packed.where("not again").union(rest).drop("row", "again")
