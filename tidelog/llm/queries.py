"""The registered queries of this folder, over the driver tables. Each applies one operator to its whole table."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (
    chat_tools,
    class_lm,
    decontaminate,
    jaccard_join,
    language_id,
    merkle,
    packing,
    periodic_runs,
    pii,
    spelling,
    substring_dedup,
    token_rollup,
    toxicity,
)
from tidelog.session import materialize, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Component of each document under links of Jaccard similarity 0.9 or more between sets of word 3-grams."""
    found = jaccard_join.jaccard_components(table(spark, folder, "documents"), size=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Place of each piece of each document in sequences of at most 1024 tokens."""
    return packing.pack_documents(table(spark, folder, "documents"), limit=1024, tokenizer="byte_bpe_50k")


@query
def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of documents that occur before, in an earlier document or earlier in the same one."""
    return substring_dedup.find_passages(table(spark, folder, "documents"))


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold benchmark items, as they are or with other numbers, names and units."""
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of each document, learned from those that are not held out."""
    docs = table(spark, folder, "documents")
    out = F.coalesce(language_id.held_out("doc_id"), F.lit(False))
    model = language_id.train(docs.where(~out))
    found = language_id.identify(docs, model, carry=["doc_id"])
    out = F.coalesce(language_id.held_out("row.doc_id"), F.lit(False))
    return found.select("row.doc_id", out.alias("held_out"), "lang_pred", "score", "spans")


@query
def op6_class_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of all documents under a class bigram model, and under the unigram model it is held against."""
    out = F.coalesce(language_id.held_out("doc_id", 10, 0), F.lit(False))
    found = class_lm.score_texts(table(spark, folder, "documents"), training=~out)
    return found.withColumn("held_out", out)


@query
def op3_merkle_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Merkle fingerprints of all documents and of edited texts, and how alike they are."""
    return merkle.with_edits(table(spark, folder, "documents"))


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels of those that are not held out."""
    out = F.coalesce(language_id.held_out("doc_id"), F.lit(False))
    found = toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), training=~out)
    return found.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token totals after the corpus came, copies went and mail addresses were masked; one batch is sent twice."""
    versions = ["byte_bpe_50k", token_rollup.WORDS]
    ledger = token_rollup.TokenLedger(spark, scratch(spark, "tokens"), versions)
    for batch, changes in token_rollup.corpus_changes(table(spark, folder, "documents")):
        ledger.apply(changes, batch)
    return ledger.totals()


@query
def op9_chat_tools(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as linked, ordered and checked tool messages in canonical JSON."""
    messages = chat_tools.conversation_messages(table(spark, folder, "conversations"))
    return chat_tools.link_calls(messages, chat_tools.SCHEMAS)


@query
def op12_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents: counts and digest of what the first rules find, and the places of all of it."""
    found = pii.find_pii(table(spark, folder, "documents"))
    base = found.withColumn("base", F.filter("spans", lambda s: s["base"]))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return base.select("doc_id", *counts, F.sha2(pii.listing(F.col("base")), 256).alias("base_sha256"), pii.listing(F.col("spans")).alias("spans"))


def repeated_ends(doc: int | None, words: list[bytes]) -> list[bytes]:
    """Where the crc32 of the id is a multiple of 10, the words from some place on repeat the first of them."""
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if doc is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + period] * (-(-(n - a) // period)))[: n - a]


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of repeating words in all documents, the one of most periods, and the documents without the repeats."""
    found = periodic_runs.find_runs(table(spark, folder, "documents"), rewrite=repeated_ends)
    line = "transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))"
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.expr(line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def lost_letters(doc: int | None, runs: Counter[str]) -> Counter[str]:
    """Runs of which one in 199, told by the crc32 of id and run, has lost a letter."""
    if doc is None:
        return runs
    begin = zlib.crc32(f"{doc}:".encode())
    kept: Counter[str] = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), begin)
        if h % 199 == 0:
            lost = h % len(run)
            run = run[:lost] + run[lost + 1 :]
        kept[run] += n
    return kept


@query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of six letters and five occurrences or more, with the words one letter apart and the forms they vary."""
    words = materialize(spelling.vocabulary(table(spark, folder, "documents"), edit=lost_letters), "words")
    return spelling.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")
