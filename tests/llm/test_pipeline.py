"""Stages of the pipeline: the rows they keep and the tables that they leave."""

import os
import random

import corpus_pipeline
from tidelog.llm import decontaminate
from tidelog.session import scratch_root

SCHEMA = "doc_id long, text string, lang string, digest string, row long, number long"


def left(spark):
    """Bytes of the tables in the scratch folder."""
    root = scratch_root(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names)


def texts(n, length, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(5000)]
    return [" ".join(rng.choice(words) for _ in range(length)) for _ in range(n)]


def test_language_writes_no_copy_of_the_texts(spark, tmp_path):
    made = texts(300, 200, 1)
    spark.createDataFrame([(d, t, "en", None, None, None) for d, t in enumerate(made)], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in")
    before = left(spark)
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.count() == 300
    assert left(spark) - before < sum(map(len, made)) // 20


def test_language_keeps_repeats_and_drops_texts_without_letters(spark):
    one, other, third = texts(3, 60, 2)
    rows = [(1, one, "en"), (1, one, "en"), (1, other, "en"), (None, one, None), (None, third, None), (4, other, "en")]
    gone = [(2, None, "en"), (2, "", "en"), (None, None, None), (None, " 12 ", None), (5, " 12 ", "en"), (5, "\n", None), (1, "?!", "en")]
    docs = spark.createDataFrame([(*r, "d", 7, 8) for r in rows + gone], SCHEMA).repartition(3)
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    found = [tuple(r) for r in kept.collect()]
    assert sorted(found, key=str) == sorted([(*r, "d", 7, 8) for r in rows], key=str)


def test_language_without_rows_or_labels(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert corpus_pipeline.language(spark, none, "").count() == 0
    unlabelled = spark.createDataFrame([(1, "some words here", None, None, None, None)], SCHEMA)
    assert corpus_pipeline.language(spark, unlabelled, "").count() == 0


def test_decontamination_sends_small_batches(spark, tmp_path, monkeypatch):
    made = texts(1500, 12, 3)
    copy, item = texts(2, 40, 4)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(d, t) for d, t in enumerate([*made, f"{copy} {item}", copy, None])], "doc_id long, text string").coalesce(1)
    seek = decontaminate._document_windows

    def few(batches, **named):
        def checked():
            for batch in batches:
                if batch.num_rows > 200:
                    raise ValueError(f"{batch.num_rows} rows at once")
                yield batch

        yield from seek(checked(), **named)

    monkeypatch.setattr(decontaminate, "_document_windows", few)
    kept = corpus_pipeline.benchmark_leaks(spark, docs, str(tmp_path))
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [*range(1500), 1501, 1502]
