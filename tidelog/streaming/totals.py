"""Totals of values that come and go, kept batch by batch.

A batch is signed rows: +1 for a row that is there from now on, -1 for one that is gone. The table keeps how often each
group has each value, so the smallest, largest and distinct values stay right when rows leave. Values are dealt to
parts by group and value: a group with a third of all rows is in all parts, and a value is in one. What each part holds of
each group is kept as well, and as no value is in two parts, those add up to the totals.

A batch rewrites only the parts that it touches, and reading totals reads the small sums alone. Signs may come in any
order and in any batch: a count may be below zero for a while, and counts for no distinct, smallest or largest value then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.sources import storage
from tidelog.streaming.parted import PART, Parted

MADE = ["rows", "filled", "distinct_values", "min_value", "max_value", "total"]


class SignedTotals:
    """``group`` columns and one ``value`` of a number type; ``schema`` has their types. NULL is a group like others."""

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, group: Sequence[str], value: str, sign: str = "sign",
        parts: int = 16,
    ):
        self.spark, self.root, self.parts = spark, root, parts
        self.group, self.value, self.sign = list(group), value, sign
        fields = [schema[c] for c in (*self.group, value)]
        self.counted = T.StructType([*fields, T.StructField("n", T.LongType())])
        self.values = Parted(spark, f"{root}/values", self.counted)
        empty = self._summed(self._parted(spark.createDataFrame([], self.counted)))
        self.sums = Parted(spark, f"{root}/sums", T.StructType([f for f in empty.schema.fields if f.name != PART]))

    def _delta(self, batch_id: int) -> str:
        return f"{self.root}/deltas/batch_id={batch_id}"

    def _batches(self) -> list[int]:
        named = [int(f.split("=")[1]) for f in storage.folders(self.spark, f"{self.root}/deltas")]
        return sorted(b for b in named if storage.committed(self.spark, self._delta(b)))

    def _counted(self, rows: DataFrame, amount) -> DataFrame:
        return rows.groupBy(*self.group, self.value).agg(F.sum(amount).cast("long").alias("n")).where("n != 0")

    def _parted(self, rows: DataFrame) -> DataFrame:
        place = F.pmod(F.xxhash64(*self.group, self.value), F.lit(self.parts)).cast("int")
        return rows.withColumn(PART, place)

    def _summed(self, counted: DataFrame) -> DataFrame:
        """What each part holds of each group."""
        here = (F.col("n") > 0) & F.col(self.value).isNotNull()
        value = F.when(here, F.col(self.value))
        return counted.groupBy(PART, *self.group).agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col(self.value).isNotNull(), F.col("n"))), F.lit(0).cast("long")).alias("filled"),
            F.count(value).alias("distinct_values"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
            F.sum(F.col(self.value) * F.col("n")).alias("total"),
        )

    def write_batch(self, signed: DataFrame, batch_id: int) -> None:
        if not storage.committed(self.spark, self._delta(batch_id)):
            self._counted(signed, F.col(self.sign)).write.mode("overwrite").parquet(self._delta(batch_id))

    def fold(self, through: int | None = None) -> int:
        """Takes finished batches up to ``through`` into the parts that they touch."""
        last = max([-1, *[b for b in self._batches() if through is None or b <= through]])
        start = self.sums.newest_before(last)
        new = [b for b in self._batches() if start < b <= last]
        if not new:
            return start
        deltas = self._parted(self.spark.read.schema(self.counted).parquet(*[self._delta(b) for b in new]))
        # At most as many rows as there are parts.
        touched = [r[0] for r in deltas.select(PART).distinct().collect()]
        both = self.values.read(start, only=touched).unionByName(deltas.drop(PART))
        self.values.write(self._parted(self._counted(both, F.col("n"))), last, touched)
        self.values.mark(last)
        written = self._parted(self.values.read(last, only=touched))
        self.sums.write(self._summed(written), last, touched)
        self.sums.mark(last)
        return last

    def each_batch(self, keep_versions: int | None = None):
        """A function for ``runner.run`` that takes in a batch; with ``keep_versions`` older totals go."""

        def apply(signed: DataFrame, batch_id: int) -> None:
            self.write_batch(signed, batch_id)
            self.fold(batch_id)
            versions = self.sums.versions()
            if keep_versions and len(versions) > keep_versions:
                self.vacuum(versions[-keep_versions])

        return apply

    def vacuum(self, keep_from: int) -> None:
        self.sums.vacuum(keep_from)
        self.values.vacuum(keep_from)
        for batch in self._batches():
            if batch <= keep_from:
                storage.delete(self.spark, self._delta(batch))

    def totals(self, through: int | None = None) -> DataFrame:
        """``rows``, ``filled``, ``distinct_values``, ``min_value``, ``max_value`` and ``total`` of each group that has rows."""
        last = self.sums.newest_before(through if through is not None else max([-1, *self.sums.versions()]))
        rows = self.sums.read(last)
        totals = rows.groupBy(*self.group).agg(
            F.sum("rows").alias("rows"),
            F.sum("filled").alias("filled"),
            F.sum("distinct_values").alias("distinct_values"),
            F.min("min_value").alias("min_value"),
            F.max("max_value").alias("max_value"),
            F.sum("total").alias("total"),
        )
        return totals.where("rows != 0")
