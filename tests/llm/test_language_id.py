"""Languages: held-out accuracy, Viterbi against all paths, mixed texts, odd rows."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidelog.llm import language_id as L

PARTS = {
    "aa": ["ka", "to", "ri", "mu", "sen"],
    "bb": ["schlo", "ung", "keit", "der", "ei"],
    "cc": ["приве", "ско", "ла", "ты", "но"],
}


def words(rng, lang, n):
    return ["".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def labelled(spark, n=300):
    rng = random.Random(3)
    rows = [(i, " ".join(words(rng, lang, rng.randint(2, 30))), lang) for i, lang in zip(range(n), itertools.cycle(PARTS))]
    rows += [(1000, "no language here", None), (1001, None, "aa")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = rng.integers(0, 6, 4)
        first = np.concatenate([[0], np.cumsum(sizes)])
        score = rng.normal(size=(first[-1], 3)) * 3
        label = L.viterbi(score, first, 2.0)

        def value(path, at):
            return sum(score[at + i, s] for i, s in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

        for a, b in zip(first[:-1], first[1:]):
            best = max((value(p, a) for p in itertools.product(range(3), repeat=b - a)), default=0)
            assert abs(value(label[a:b].tolist(), a) - best) < 1e-9


def test_held_out_texts_and_scripts(spark):
    df, rows = labelled(spark)
    model = L.train(df.where("doc_id % 3 <> 1 or doc_id > 150"))
    assert model.languages == ["aa", "bb", "cc"]
    found = {r["row"]["doc_id"]: r for r in L.identify(df, model).collect()}
    assert len(found) == len(rows)
    assert all(found[d]["lang_pred"] == lang for d, text, lang in rows if lang and text)
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert model.uses[2].sum() == 1 and not (model.uses[2] & model.uses[0]).any()


def test_spans_of_a_mixed_text(spark):
    rng = random.Random(4)
    model = L.train(labelled(spark)[0])
    text = " ".join(words(rng, "aa", 20) + words(rng, "bb", 30) + words(rng, "cc", 10))
    row = L.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    spans = [(s["start_word"], s["n_words"], s["lang"]) for s in row["spans"]]
    assert [s[2] for s in spans] == ["aa", "bb", "cc"] and spans[2][:2] == (50, 10)
    assert abs(spans[1][0] - 20) <= 2 and row["lang_pred"] == "bb" and row["score"] < 0.9


def test_odd_rows(spark, frame, corpus):
    model = L.train(labelled(spark)[0])
    rows = L.identify(frame(corpus), model).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        letters = any(c.isalpha() for c in r["row"]["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (r["score"] > 0) == letters
    assert L.identify(frame([]), model).count() == 0
    untrained = L.train(labelled(spark)[0].where(F.lit(False)))
    assert untrained is None
    assert {r["lang_pred"] for r in L.identify(frame(corpus), None).collect()} == {"und"}


def test_every_language_is_learned_and_texts_of_several_languages_stay(spark):
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    parts = {f"l{i:02}": ["".join(rng.choice(letters) for _ in range(4)) for _ in range(6)] for i in range(70)}
    say = lambda lang, n: " ".join(rng.choice(parts[lang]) for _ in range(n))
    docs = [(100 * i + k, say(lang, 30), lang) for i, lang in enumerate(parts) for k in range(2 + (i < 60))]
    mixed = " ".join(say(lang, 20) for lang in ("l00", "l30", "l65", "l69"))
    df = spark.createDataFrame([*docs, (9000, mixed, None), (9001, "12 34", None)], "doc_id long, text string, lang string")
    model = L.train(df)
    assert model.languages == sorted(parts)
    found = {r["row"]["doc_id"]: r for r in L.identify(df, model).collect()}
    assert all(found[d]["lang_pred"] == lang for d, _, lang in docs)
    assert found[9000]["score"] < 0.5 < 0.9 < found[9000]["known"] <= 1
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, df, "").collect()}
    assert kept == {d for d, _, _ in docs} | {9000}


def test_letters_of_the_third_plane_are_letters():
    reader = L.Reader()
    assert reader.letter[0x30000] and reader.letter[0x31350] and not reader.letter[0x3FFFF]
    assert reader.script_names[reader.script[0x30000]] == "han"
