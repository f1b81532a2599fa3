"""Every registered query of this folder on the smallest tables, and the pipeline against its stages' rules."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidelog.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    if name.split("_")[0] in ("op1", "op3", "op6", "op8", "op10", "op12", "op13"):
        assert df.count() == documents and df.select("doc_id").distinct().count() == documents
    else:
        assert df.count() > 0


def test_all_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, FOLDER)
        assert made.columns == docs.columns and made.dtypes == docs.dtypes
        docs = corpus_pipeline.materialize(made, "test")
        seen.append(docs.count())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert seen == sorted(seen, reverse=True) and packed.select("doc_id").distinct().count() == seen[-1]
    again = corpus_pipeline.run(spark, FOLDER)
    assert again.select("doc_id", "piece", "ids_crc32").exceptAll(packed.select("doc_id", "piece", "ids_crc32")).count() == 0


def test_pipeline_takes_odd_rows(spark, tmp_path, corpus):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(d, t, "en" if (d or 0) % 2 else None, None, len(t or "")) for d, t in corpus]
    for name, data in (("full", rows), ("none", [])):
        folder = os.path.join(tmp_path, name)
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(data[:3], schema).selectExpr("doc_id as item_id", "text").write.parquet(f"{folder}/benchmark.parquet")
        packed = corpus_pipeline.run(spark, folder)
        assert (packed.count() > 0) == bool(data)
