"""Token totals by source, language and tokenizer version, kept by signed deltas.

A batch of changes becomes signed rows per document: what a document counted before, negative, and what it counts
now, positive. Totals are plain sums of these rows, so a batch costs the tokens of its own texts and a look at the narrow
ledger, never a new count of the corpus. A batch is written under a name of its own and counts from the moment its
mark exists; marks are made once, so a repeated or retried batch changes nothing.
"""

from __future__ import annotations

import uuid
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.tokens import ByteBpe
from tidelog.llm.words import blocks, words_of

# Versions: names of byte-level vocabularies, or words between white space.
WORDS = "words"

_LEDGER = "doc_id long, source string, lang string, tokenizer string, n_docs long, n_tokens long"


def _count(batches, tokenizers: list[str]):
    """The rest of each row with its token count, for each version."""
    coders = {name: ByteBpe(name) for name in tokenizers if name != WORDS}
    for batch in batches:
        texts = batch.column("text")
        for name in tokenizers:
            if name == WORDS:
                n = [int(c) for _, _, at, raw in blocks(texts) for c in _word_counts(at, raw)]
            else:
                n = [len(coders[name].encode(t.as_py())) // 4 for t in texts]
            same = [batch.column(c) for c in ("doc_id", "source", "lang")]
            yield pa.record_batch(
                [*same, pa.array([name] * batch.num_rows, pa.string()), pa.array([1] * batch.num_rows, pa.int64()), pa.array(n, pa.int64())],
                ["doc_id", "source", "lang", "tokenizer", "n_docs", "n_tokens"],
            )


def _word_counts(offsets, raw):
    first = words_of(offsets, raw, keys=False).first
    return first[1:] - first[:-1]


class TokenLedger:
    """Signed counts in a folder that all executors share.

    ``apply`` takes changes with ``op`` (``insert``, ``delete``, ``revise``), ``seq``, ``doc_id``, ``source``, ``lang``
    and ``text``. Of several changes of a document in a batch the last by ``seq`` holds (of equal ones the largest op,
    then text). An insert of a known document revises it, a revision of an unknown one inserts it, a delete of an
    unknown one does nothing; other ops and null ids do nothing. Null texts count as empty, null sources and
    languages are groups of their own. Other columns are not looked at.
    """

    def __init__(self, spark: SparkSession, root: str, tokenizers: list[str]):
        self.spark, self.root, self.tokenizers = spark, root.rstrip("/"), tokenizers

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def commits(self) -> dict[int, str]:
        """Folder of each batch that counts. A mark without content is none."""
        fs, path = self._path("commits")
        if not fs.exists(path):
            return {}
        marks = self.spark.read.text(f"{self.root}/commits").collect()
        return {int(r["value"].split(" ")[0]): r["value"].split(" ")[1] for r in marks}

    def _commit(self, batch: int, folder: str) -> bool:
        """Makes the mark, unless there is one. It is written under another name and renamed, so it is there whole."""
        fs, mark = self._path(f"commits/{batch}")
        _, fresh = self._path(f"commits/_{folder}")
        out = fs.create(fresh, True)
        out.write(f"{batch} {folder}\n".encode())
        out.close()
        if fs.exists(mark) and fs.getFileStatus(mark).getLen() == 0:
            fs.delete(mark, False)
        context = self.spark.sparkContext
        hadoop = context._jvm.org.apache.hadoop.fs
        files = hadoop.FileContext.getFileContext(mark.toUri(), context._jsc.hadoopConfiguration())
        try:  # fails where the mark is
            files.rename(fresh, mark, context._gateway.new_array(hadoop.Options.Rename, 0))
        except Exception:
            if not fs.exists(mark):
                raise
            fs.delete(fresh, False)
            return False
        return True

    def ledger(self) -> DataFrame:
        """Signed rows of all batches that count."""
        folders = [f"{self.root}/batches/{name}" for name in self.commits().values()]
        if not folders:
            return self.spark.createDataFrame([], _LEDGER)
        return self.spark.read.schema(_LEDGER).parquet(*folders)

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` of the groups that have documents."""
        groups = self.ledger().groupBy("source", "lang", "tokenizer")
        return groups.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs != 0")

    def deltas(self, changes: DataFrame) -> DataFrame:
        """The signed rows that a batch adds to the ledger as it is now."""
        valid = changes.where(F.col("doc_id").isNotNull() & F.col("op").isin("insert", "delete", "revise"))
        text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
        last = F.max(F.struct("seq", "op", text, F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang")))
        one = valid.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(last.alias("c")).select("doc_id", "c.*")
        now = one.where("op <> 'delete'").select("doc_id", "source", "lang", "text")
        added = now.mapInArrow(partial(_count, tokenizers=self.tokenizers), _LEDGER)
        touched = valid.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        known = self.ledger().join(touched, "doc_id", "left_semi").groupBy("doc_id", "source", "lang", "tokenizer")
        before = known.agg((-F.sum("n_docs")).alias("n_docs"), (-F.sum("n_tokens")).alias("n_tokens")).where("n_docs != 0")
        return added.unionByName(before)

    def apply(self, changes: DataFrame, batch: int) -> bool:
        """Adds a batch; false if it was there. Fit for ``foreachBatch``."""
        if batch in self.commits():
            return False
        folder = f"{batch}-{uuid.uuid4().hex}"
        self.deltas(changes).write.parquet(f"{self.root}/batches/{folder}")
        return self._commit(batch, folder)


def corpus_changes(docs: DataFrame) -> list[tuple[int, DataFrame]]:
    """A corpus as batches of changes: all documents come; later copies of a text go; mail addresses are masked."""
    base = docs.select("doc_id", "text", "source", "lang")
    come = base.select("*", F.lit(0).alias("seq"), F.lit("insert").alias("op"))
    keyed = base.withColumn("digest", F.sha2("text", 256))
    first = keyed.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    copies = keyed.select("doc_id", "source", "lang", "digest").join(first, "digest").where("doc_id > least")
    go = copies.select("doc_id", F.lit(None).cast("string").alias("text"), "source", "lang", F.lit(0).alias("seq"), F.lit("delete").alias("op"))
    mail = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
    masked = keyed.where(F.col("text").rlike(mail)).join(copies.select("doc_id"), "doc_id", "left_anti")
    revised = masked.select("doc_id", F.regexp_replace("text", mail, "<mail>").alias("text"), "source", "lang", F.lit(0).alias("seq"), F.lit("revise").alias("op"))
    return [(0, come), (1, go), (2, revised), (1, go)]
