"""A keyed table on plain files: per-batch deltas over a folded base.

Layout below the root::

    deltas/batch_id=N/     newest event per key of micro-batch N
    rejected/batch_id=N/   its events without a whole key, which no mirror can hold
    base/version=N/        newest event per key of all batches up to N, and a _FOLDED mark

A batch writes only its own delta, so the cost of a batch follows the batch and not the table. A delta counts
once it is finished, and a finished one is never written again, so readers see whole batches also while one is
repeated. Readers take the newest marked base and the deltas after it. Deletes stay in both as rows, so that an
older event that arrives late cannot bring a row back.

With ``buckets`` the base is bucketed by key: deltas are shuffled to it and it stays where it is. Without, base and
deltas are shuffled by key. Keys are never NULL, so both ways give the same rows.

With ``parts`` the base is kept by part of the key (``base/version=N/_p=K/``): a fold reads and writes only the parts that
have deltas, and readers merge only those. Batches of neighbouring keys touch few parts; a batch with more keys than
there are parts is likely to touch all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from hashlib import md5
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.apply import latest, merge_newest
from tidelog.schema import DELETE
from tidelog.sources import storage
from tidelog.streaming.parted import PART, Parted


class MirrorTable:
    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, key: Sequence[str], order: Sequence[str],
        buckets: int | None = None, parts: int | None = None,
    ):
        if buckets and parts:
            raise ValueError("a base has buckets or parts, not both")
        self.buckets, self.parts = buckets, parts
        self.spark, self.root, self.schema = spark, root, schema
        self.base = Parted(spark, f"{root}/base", schema) if parts else None
        self.key, self.order = list(key), list(order)

    def _delta(self, batch_id: int) -> str:
        return f"{self.root}/deltas/batch_id={batch_id}"

    def _base(self, version: int) -> str:
        return f"{self.root}/base/version={version}"

    def batches(self) -> list[int]:
        """Ids of the finished batches."""
        named = [int(f.split("=")[1]) for f in storage.folders(self.spark, f"{self.root}/deltas")]
        return sorted(b for b in named if storage.committed(self.spark, self._delta(b)))

    def versions(self) -> list[int]:
        """Batch ids up to which a finished base exists."""
        named = [int(f.split("=")[1]) for f in storage.folders(self.spark, f"{self.root}/base")]
        return sorted(v for v in named if storage.exists(self.spark, f"{self._base(v)}/_FOLDED"))

    def write_batch(self, log: DataFrame, batch_id: int) -> None:
        if storage.committed(self.spark, self._delta(batch_id)):
            return
        rows = log.select(*self.schema.names)
        whole = reduce(and_, [F.col(c).isNotNull() for c in self.key])
        rows.filter(~whole).write.mode("overwrite").parquet(f"{self.root}/rejected/batch_id={batch_id}")
        newest = latest(rows.filter(whole), self.key, self.order)
        newest.write.mode("overwrite").parquet(self._delta(batch_id))

    def each_batch(self, fold_every: int | None = None, keep_versions: int | None = None):
        """A function for ``runner.run`` that takes in a batch and folds every so many batches.

        With ``keep_versions`` only so many folded versions, and the deltas after the oldest, stay.
        """

        def apply(rows: DataFrame, batch_id: int) -> None:
            self.write_batch(rows, batch_id)
            if fold_every and (batch_id + 1) % fold_every == 0:
                self.fold(batch_id)
                if keep_versions and len(self.versions()) > keep_versions:
                    self.vacuum(self.versions()[-keep_versions])

        return apply

    def _read(self, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _base_table(self, version: int) -> str:
        return f"mirror_{md5(self._base(version).encode()).hexdigest()}"

    def _read_base(self, version: int) -> DataFrame:
        """The base with its bucketing, which Spark takes from the catalog; a new session adds the entry."""
        if not self.buckets:
            return self._read([self._base(version)])
        name, keys = self._base_table(version), ", ".join(f"`{c}`" for c in self.key)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self._base(version)}'"
        )
        return self.spark.table(name)

    def newest(self, through: int | None = None) -> DataFrame:
        """The newest event of every key, deletes included, as of batch ``through``."""
        last = through if through is not None else max([-1, *self.batches(), *self.versions()])
        usable = [v for v in self.versions() if v <= last]
        start = usable[-1] if usable else -1
        paths = [self._delta(b) for b in self.batches() if start < b <= last]
        deltas = self._read(paths)
        if self.base:
            touched = self._touched(deltas)
            return self._merged(start, deltas, touched).unionByName(self.base.read(start, but=touched))
        if not usable:
            return latest(deltas, self.key, self.order)
        base = self._read_base(start)
        if not paths:
            return base
        if self.buckets:
            # A delta holds a key at most once, so hashing deltas before the cut sends no hot key.
            hashed = deltas.repartition(self.buckets, *self.key)
            return merge_newest(base, hashed, self.key, self.order)
        return latest(base.unionByName(deltas), self.key, self.order)

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.parts)).cast("int")

    def _touched(self, deltas: DataFrame) -> list[int]:
        """Parts that have deltas: at most as many rows as there are parts."""
        return [r[0] for r in deltas.select(self._part()).distinct().collect()]

    def _merged(self, start: int, deltas: DataFrame, touched: Sequence[int]) -> DataFrame:
        return latest(self.base.read(start, only=touched).unionByName(deltas), self.key, self.order)

    def current(self, through: int | None = None) -> DataFrame:
        return self.newest(through).filter(~F.coalesce(F.col("op") == DELETE, F.lit(False)))

    def with_deleted(self, through: int | None = None) -> DataFrame:
        return self.newest(through).withColumn("deleted", F.coalesce(F.col("op") == DELETE, F.lit(False)))

    def fold(self, through: int | None = None) -> int:
        """Writes a new base up to batch ``through``. Old bases and deltas stay for history reads."""
        last = through if through is not None else max([-1, *self.batches()])
        if last in self.versions():
            return last
        if self.base:
            start = self.base.newest_before(last)
            deltas = self._read([self._delta(b) for b in self.batches() if start < b <= last])
            touched = self._touched(deltas)
            self.base.write(self._merged(start, deltas, touched).withColumn(PART, self._part()), last, touched)
            self.base.mark(last)
            return last
        folded = self.newest(last)
        if self.buckets:
            self._write_buckets(folded, last)
        else:
            folded.write.mode("overwrite").option("compression", "snappy").parquet(self._base(last))
        storage.touch(self.spark, f"{self._base(last)}/_FOLDED")
        return last

    def _write_buckets(self, rows: DataFrame, version: int) -> None:
        """One sorted file per bucket: rows are hashed the way the buckets are before the write."""
        name = self._base_table(version)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        storage.delete(self.spark, self._base(version))
        (
            rows.repartition(self.buckets, *self.key)
            .write.format("parquet")
            .option("path", self._base(version))
            .option("compression", "snappy")
            .bucketBy(self.buckets, *self.key)
            .sortBy(*self.key)
            .saveAsTable(name)
        )

    def vacuum(self, keep_from: int) -> None:
        """Removes bases and deltas that only states older than version ``keep_from`` need."""
        if keep_from not in self.versions():
            raise ValueError(f"no folded version {keep_from}")
        if self.base:
            self.base.vacuum(keep_from)
        for version in [] if self.base else self.versions():
            if version < keep_from:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._base_table(version)}")
                storage.delete(self.spark, self._base(version))
        for batch in self.batches():
            if batch <= keep_from:
                storage.delete(self.spark, self._delta(batch))
