"""Tokens against the reference library, and packing by its rules."""

import bisect
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidelog.llm.packing import cut, pack, pack_documents, pack_in_rounds
from tidelog.llm.tokens import ByteBpe


@pytest.fixture(scope="module")
def reference():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


ODD = ["it's we'll I'd", "a\n\nb", " lead", "trail ", "x,y.z 12 3.5%", "a b   c", "\n", "don't\nstop, now.", "<|endoftext|> x", "漢字 かな", " ", "\u00a0x", "x\u2003\u3000y", "a\x1c\x1cb", "x\u200b y", "Ünï cödé ß"]


def test_ids_equal_the_reference(reference, corpus):
    bpe = ByteBpe()
    for text in [t for _, t in corpus] + ODD:
        assert array("I", bpe.encode(text)).tolist() == reference(text)


def squares(rule_lengths, limit):
    """The rule without any table: try every open bin and a new one."""
    gaps = []
    for size in rule_lengths:
        def cost(after):
            open_gaps = [g for g in after if 0 < g < limit]
            return sum(open_gaps.count(g) ** 2 for g in set(open_gaps))

        choices = [(cost(gaps[:i] + [g - size] + gaps[i + 1 :]), 0, g, i) for i, g in enumerate(gaps) if g >= size]
        choices.append((cost(gaps + [limit - size]), 1, limit, len(gaps)))
        best = min(choices)
        if best[1]:
            gaps.append(limit - size)
        else:
            gaps[best[3]] -= size
    return sorted(gaps)


def test_pack_follows_the_rule():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = rng.integers(1, 17, 60)
        assert sorted(pack(lengths, 16)[2].tolist()) == squares(lengths.tolist(), 16)


def best_fit(lengths, limit):
    gaps = []
    for size in lengths:
        at = bisect.bisect_left(gaps, size)
        gap = gaps.pop(at) if at < len(gaps) else limit
        bisect.insort(gaps, gap - size)
    return len(gaps)


def test_rounds_place_everything_once():
    lengths = np.sort(np.random.default_rng(4).integers(1, 1024, 5000))[::-1].copy()
    bins, offsets, gaps = pack_in_rounds(lengths, 1024)
    assert np.array_equal(np.bincount(bins, lengths), 1024 - gaps)
    order = np.lexsort((offsets, bins))
    ends = (offsets + lengths)[order]
    begins = offsets[order]
    same = bins[order][1:] == bins[order][:-1]
    assert (begins[1:][same] == ends[:-1][same]).all() and (begins[np.r_[True, ~same]] == 0).all()
    assert len(gaps) <= 1.02 * best_fit(lengths.tolist(), 1024)


def test_cut():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)] and cut(9, 4) == [(0, 1), (1, 4), (5, 4)] and cut(8, 4) == [(0, 4), (4, 4)]


@pytest.mark.parametrize("limit", [64, 1024])
def test_documents(frame, corpus, reference, limit):
    rows = pack_documents(frame(corpus), limit=limit, shard_pieces=50).collect()
    ids = [(d, reference(t) + [2]) for d, t in corpus]
    want = []
    for d, own in ids:
        for piece, (start, length) in enumerate(cut(len(own), limit)):
            want.append((d, piece, start, length, zlib.crc32(np.array(own[start : start + length], "<u4").tobytes())))
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= limit
    assert len(places) <= 1.05 * -(-sum(len(own) for _, own in ids) // limit) + 3


def test_empty_table(frame):
    assert pack_documents(frame([])).count() == 0
