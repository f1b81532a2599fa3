"""From raw documents to packed sequences, one operator of ``tidelog.llm`` per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import decontaminate, jaccard_join, language_id, packing, substring_dedup
from tidelog.session import materialize, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# A document goes if less than this part of its letters is surely in some language, or if it has no letters.
LEAST_KNOWN = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are mainly in languages that the labelled documents have, be it one or several."""
    model = language_id.train(docs)
    # Equal texts have equal languages, so a text's digest is its name and no copy of the rows is written for numbers.
    # Null and empty texts have no letters either way.
    digest = F.unhex(F.sha2(F.coalesce(F.col("row.text").cast("string"), F.lit("")), 256)).alias("digest")
    docs = docs.select(F.struct("*").alias("row")).select("row", digest)
    found = language_id.identify(docs.select("digest", "row.text"), model, carry=["digest"])
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("known") >= LEAST_KNOWN)
    # Texts go to the workers and not back; few rows go.
    gone = materialize(found.where(~known).select("row.digest").distinct(), "unknown", fine=True)
    return docs.join(gone, "digest", "left_anti").select("row.*")


def numbered(docs: DataFrame) -> DataFrame:
    """``row, number``: the rows as structs, each with a number, written once so that every pass sees the same."""
    return materialize(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")), "numbered")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of each group of linked ones (five-word shingles, similarity 0.8).

    Null ids come last. Rows with one id or none are rows like others.
    """
    docs = numbered(docs)
    rows = docs.select(F.col("row.doc_id").cast("long").alias("id"), F.col("number").alias("row"), F.col("row.text").cast("string").alias("text"))

    def repeats() -> DataFrame:
        groups = materialize(jaccard_join.linked_rows(rows, size=5, percent=80).where("group is not null"), "groups", fine=True)
        first = F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")
        heads = groups.groupBy("group").agg(first, F.count("*").alias("n")).where("n > 1").select("group", F.col("first.row").alias("head"))
        return groups.join(heads, "group").where("row != head").select(F.col("row").alias("number"))

    # Few rows go, so the texts need not move for them.
    gone = settle(spark, repeats, "gone")
    return docs.join(gone, "number", "left_anti").select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that occur before; a document of which nothing is left goes."""
    cut = substring_dedup.cut_passages(docs)
    keep = (F.col("n_passages") == 0) | (F.trim("text") != "")
    put = {"text": F.when(F.col("n_passages") == 0, F.col("row.text")).otherwise(F.col("text"))}
    put["n_chars"] = F.when(F.col("n_passages") == 0, F.col("row.n_chars")).otherwise(F.length("text").cast("long"))
    return cut.where(keep).select(*[put.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents that hold items of the benchmark."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    docs = numbered(docs)

    def leaks() -> DataFrame:
        found = decontaminate.find_leaks(docs.select("number", "row.text"), items, id_col="number")
        return found.select(F.col("doc_id").alias("number")).distinct()

    gone = settle(spark, leaks, "leaks", fine=True)
    return docs.join(gone, "number", "left_anti").select("row.*")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' tokens in sequences of at most 1024."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_leaks),
    ("best_fit_packing", sequences),
]

# Stages cut and count text in ways that SQL cannot express; tests compare them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
