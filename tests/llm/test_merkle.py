"""Fingerprints: equality, where edits are, the registered edit, odd rows."""

import hashlib
import time

from pyspark.sql import functions as F

from tidelog.llm import merkle as M


def test_equal_texts_have_equal_roots(frame, corpus):
    rows = M.fingerprints(frame(corpus)).collect()
    assert len(rows) == len(corpus)
    by_text, by_print = {}, {}
    for r in rows:
        by_text.setdefault(r["text"], set()).add(r["fingerprint"])
        by_print.setdefault(r["fingerprint"], set()).add(r["text"])
    assert all(len(x) == 1 for x in [*by_text.values(), *by_print.values()])
    for r in rows:
        assert len(r["paragraphs"]) == len(r["text"].split("\n")) and r["n_chars"] == len(r["text"])


def test_pieces_cover_the_text(frame, corpus):
    found = M.fingerprints(frame(corpus)).select("text", F.flatten(F.transform(M.paragraphs(F.col("text")), lambda p: F.regexp_extract_all(p, F.lit(M._PIECE), F.lit(0)))).alias("cut"))
    for r in found.collect():
        assert "".join(r["cut"]) == r["text"].replace("\n", "")
        assert all(len(p) <= M.PIECE_CHARS + 3 or p.rstrip() != p for p in r["cut"])


def test_an_edit_shows_in_its_paragraph_and_section(frame):
    lines = [f"line {i} says something of its own, and a bit more" for i in range(40)]
    other = list(lines)
    other[17] = "another line altogether, and a bit more"
    a, b = M.fingerprints(frame([(1, "\n".join(lines)), (2, "\n".join(other))])).orderBy("doc_id").collect()
    assert [i for i, (x, y) in enumerate(zip(a["paragraphs"], b["paragraphs"])) if x != y] == [17]
    assert a["root"] != b["root"]
    assert 0 < len(set(a["sections"]) - set(b["sections"])) <= 2 < len(set(a["sections"]) & set(b["sections"]))


def test_the_edited_text(frame, corpus):
    rows = [(d, t) for d, t in corpus if d is not None and (d, t) != (7, corpus[7][1])] + [(7, corpus[7][1])]
    got = {r["doc_id"]: r for r in M.with_edits(frame(rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for i, (d, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        r = got[d]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (text == edited)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if text == after:
            assert r["near_next"] == 1


def held(fingerprint):
    """The pieces that a fingerprint names."""
    return {int(key, 16) for key in fingerprint.split(":")[2].split(".") if key}


def told(a, b):
    a, b = held(a), held(b)
    every = sorted(a | b)[: M.SKETCH]
    return sum(key in a and key in b for key in every) / len(every) if every else 1.0


def test_likeness_is_that_of_the_fingerprints(frame):
    words = [f"w{i % 97}x{i % 89}, " for i in range(9000)]
    rows = [(1, "".join(words[:40])), (2, "".join(words[20:60])), (3, "".join(words)), (4, "".join(words[4500:]) + "end"), (5, None), (6, "")]
    got = {r["doc_id"]: r for r in M.with_edits(frame(rows)).collect()}
    for d, r in got.items():
        after = got[d - 1 if d > 1 else 6]
        assert len(held(r["fingerprint"])) <= M.SKETCH
        assert abs(r["near_edited"] - told(r["fingerprint"], r["edited_fingerprint"])) < 1e-12
        assert abs(r["near_next"] - told(r["fingerprint"], after["fingerprint"])) < 1e-12
    pieces = {r["doc_id"]: {key for p in r["pieces"] for key in p} for r in M.fingerprints(frame(rows)).collect()}
    for d, after in ((2, 1), (3, 2), (4, 3)):
        exact = len(pieces[d] & pieces[after]) / len(pieces[d] | pieces[after])
        assert abs(got[d]["near_next"] - exact) < (0.1 if d > 2 else 1e-12)


def test_sections_cover_the_paragraphs(frame, corpus):
    for r in M.fingerprints(frame(corpus)).collect():
        spans = [(s["first"], s["last"]) for s in r["spans"]]
        assert [i for a, b in spans for i in range(a, b + 1)] == list(range(len(r["paragraphs"])))
        assert [s["key"] for s in r["spans"]] == r["sections"]


def test_many_lines_differ_where_they_do(spark, frame):
    lines = [f"line {i} has words of its own {i * i}, and more" for i in range(20_000)]
    other = [*lines[:300], "new one", *lines[300:9000], *lines[9100:], "new two", "new three"]
    other[15_000] = "changed"
    both = M.fingerprints(frame([(1, "\n".join(lines)), (2, "\n".join(other))]))
    a = both.where("doc_id = 1").select(F.col("sections").alias("s"), F.col("paragraphs").alias("p"))
    b = both.where("doc_id = 2").select("spans", "paragraphs")
    found = a.join(b).select(M.differing(F.col("s"), F.col("p"), F.col("spans"), F.col("paragraphs")).alias("d"))
    began = time.time()
    got = found.first()["d"]
    known = set(lines)
    assert got == [i for i, line in enumerate(other) if line not in known]
    assert time.time() - began < 60


def test_odd_rows(frame, corpus):
    assert M.with_edits(frame(corpus)).count() == len(corpus)
    assert M.with_edits(frame([])).count() == 0
    one = M.with_edits(frame([(4, "alone here")])).first()
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"alone halo").hexdigest()
