"""Passages against all 50-word windows, and the chunker's rules."""

import random
import re

import numpy as np
import pyarrow as pa

from tidelog.llm import substring_dedup as S
from tidelog.llm.words import PART_BYTES, in_parts, small, words_of


def keys_of(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return words_of(np.array([0, len(raw)]), raw).key


def corpus_with_passages():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    passages = [[rng.choice(words) for _ in range(rng.randint(51, 90))] for _ in range(30)]
    rows = []
    for d in range(300):
        text = [rng.choice(words) for _ in range(rng.choice([30, 100, 250]))]
        if d % 3 == 0:
            at = rng.randint(0, len(text))
            text[at:at] = passages[d % 30]
        rows.append((d, " ".join(text)))
    return rows


def test_insertions_move_only_near_bounds():
    rng = random.Random(1)
    words = [f"w{rng.randrange(500)}" for _ in range(400)]
    before = keys_of(" ".join(words))
    after = keys_of(" ".join(["new", "words", "here"] + words))
    cut = lambda k: set(S.chunk_starts(k, np.array([0, len(k)])).tolist())
    a, b = cut(before), {x - 3 for x in cut(after)}
    assert {x for x in a if x >= 8} == {x for x in b if x >= 8}


def test_long_runs_of_one_word_are_cut():
    key = keys_of("de " * 1000)
    start = S.chunk_starts(key, np.array([0, 1000]))
    assert np.diff(np.append(start, 1000)).max() <= S.MOST_WORDS


def test_repeated_passages_are_found_and_clean_documents_stay(frame):
    rows = corpus_with_passages()
    found = {}
    for r in S.find_passages(frame(rows)).collect():
        found.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["start_word"] + r["n_words"]))
        assert r["seen_in"] <= r["doc_id"]
    first, truth = {}, {}
    for d, text in rows:
        words = re.findall(r"\S+", text)
        for i in range(len(words) - 49):
            if first.setdefault(tuple(words[i : i + 50]), d) != d:
                truth.setdefault(d, set()).update(range(i, i + 50))
    assert truth and sum(d in found for d in truth) >= 0.98 * len(truth)
    assert set(found) <= set(truth)
    assert sum(len(truth[d] & found.get(d, set())) for d in truth) >= 0.75 * sum(map(len, truth.values()))


def test_cut_leaves_first_copies_and_other_columns(frame):
    rows = corpus_with_passages()
    kept = {r["row"]["doc_id"]: r for r in S.cut_passages(frame(rows)).collect()}
    spans = {}
    for r in S.find_passages(frame(rows)).collect():
        spans.setdefault(r["doc_id"], []).append((r["start_word"], r["n_words"]))
    assert len(kept) == len(rows)
    for d, text in rows:
        words = text.split(" ")
        gone = {i for a, n in spans.get(d, []) for i in range(a, a + n)}
        assert kept[d]["text"].split() == [w for i, w in enumerate(words) if i not in gone]
        assert kept[d]["row"]["text"] == text and kept[d]["n_passages"] == len(spans.get(d, []))


def test_odd_rows(frame, corpus):
    rows = corpus + [(None, "q " * 40 + "end")]
    assert S.cut_passages(frame(rows)).count() == len(rows)
    assert S.find_passages(frame([])).count() == 0
    texts = {r["row"]["doc_id"]: r["text"] for r in S.cut_passages(frame([(1, None), (2, ""), (3, "only ä few")])).collect()}
    assert texts == {1: "", 2: "", 3: "only ä few"}


def test_one_of_equal_rows_keeps_its_text_and_no_other_text_loses_words(frame):
    rng = random.Random(4)
    text = lambda: " ".join(f"w{rng.randrange(900)}" for _ in range(120))
    same_id, no_id, first, clean, other = text(), text(), text(), text(), text()
    rows = [(5, same_id)] * 3 + [(None, no_id)] * 3 + [(None, clean), (8, first), (8, other), (9, first)]
    made = [(r["row"]["doc_id"], r["row"]["text"], r["text"].strip()) for r in S.cut_passages(frame(rows)).collect()]
    kept = lambda d, t: sorted(after for i, before, after in made if (i, before) == (d, t))
    assert kept(5, same_id) == ["", "", same_id]
    assert kept(None, no_id) == ["", "", no_id]
    assert kept(None, clean) == [clean] and kept(8, other) == [other] and kept(8, first) == [first]
    assert kept(9, first) == [""]


def test_texts_move_once_and_come_back_where_something_is_cut(frame, capsys):
    rng = random.Random(4)
    text = lambda: " ".join(f"w{rng.randrange(900)}" for _ in range(120))
    same = text()
    rows = [(1, same), (2, text()), (3, same), (4, None), (5, "é 漢字"), (6, same + " and more")]
    cut = S.cut_passages(frame(rows))
    cut.explain()
    sent = [line.split("MapInArrow")[1].split(")#")[0] for line in capsys.readouterr().out.split("\n") if "MapInArrow" in line]
    assert sent and all("row#" in x and "repeats#" in x and "text#" not in x for x in sent)
    made = {r["row"]["doc_id"]: (r["row"]["text"], r["text"], r["n_passages"]) for r in cut.collect()}
    assert made[1] == (same, same, 0) and made[3] == (same, "", 1) and made[2][0] == made[2][1]
    assert made[4] == (None, "", 0) and made[5] == ("é 漢字", "é 漢字", 0)
    assert made[6][1].endswith("and more") and len(made[6][1]) < 60 and made[6][2] == 1


def test_a_text_that_is_no_string_is_cut_as_its_string(spark):
    docs = spark.sql("select id doc_id, cast(if(id = 3, null, 12345) as int) Text from range(4)")
    assert sorted(r["text"] for r in S.cut_passages(docs).collect()) == ["", "12345", "12345", "12345"]
    wide = spark.sql("select cast(null as string) other, id doc_id, concat_ws(' ', transform(sequence(1, 90), x -> 'w' || x)) Text from range(3)")
    assert sorted(r["text"] for r in S.cut_passages(wide).collect())[:2] == ["", ""]


def test_batches_are_put_together_or_cut_and_leave_in_parts():
    batch = lambda a, b: pa.record_batch([pa.array(range(a, b), pa.int64())], ["x"])
    sizes = [150, 0, 50, 700, 100, 4500, 3]
    ends = np.cumsum([0, *sizes]).tolist()
    made = list(small((batch(a, b) for a, b in zip(ends, ends[1:])), rows=1000))
    assert [m.num_rows for m in made] == [1000, 1000, 1000, 1000, 1000, 500, 3]
    assert [x for m in made for x in m.column("x").to_pylist()] == list(range(ends[-1]))
    assert list(small(iter([]))) == []

    @in_parts
    def give(batches, letter):
        for _ in batches:
            yield pa.record_batch([pa.array([letter * 100_000] * 40), pa.array(range(40))], ["text", "at"])

    parts = list(give([None, None], letter="x"))
    assert all(p.nbytes <= PART_BYTES for p in parts) and [x for p in parts for x in p.column("at").to_pylist()] == [*range(40)] * 2
