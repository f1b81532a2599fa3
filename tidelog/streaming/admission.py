"""Streams that take each event once and set late ones aside, however they are cut into batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import arrival
from tidelog.sources import storage
from tidelog.streaming.runner import EachBatch


def _before(spark: SparkSession, folder: str, batch_id: int) -> list[int]:
    found = [int(name.split("=")[1]) for name in storage.folders(spark, folder) if name.startswith("batch_id=")]
    return sorted(n for n in found if n < batch_id and storage.committed(spark, f"{folder}/batch_id={n}"))


def admit(root: str, source: str, position: str, time: str = "event_time", disorder: str = arrival.DISORDER) -> EachBatch:
    """Writes a micro-batch once, by ``standing``, and the intervals of the numbers that are known after it.

    A batch finds the intervals that the batch before left, so its cost follows its own rows and the gaps, never the
    age of the stream. A repeated batch finds what it found the first time. The intervals of the last two batches stay.
    """

    def each_batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        to, state = f"{root}/rows/batch_id={batch_id}", f"{root}/known/batch_id={batch_id}"
        earlier = _before(spark, f"{root}/known", batch_id)
        schema = arrival.known_schema(rows, source, position, time)
        known = spark.read.schema(schema).parquet(f"{root}/known/batch_id={earlier[-1]}") if earlier else spark.createDataFrame([], schema)
        if not storage.committed(spark, to):
            arrival.judged(rows, known, source, position, time, disorder).write.mode("overwrite").partitionBy("standing").parquet(to)
        if not storage.committed(spark, state):
            taken = read(spark, root, rows.schema, [batch_id]).where(F.col("standing") != arrival.REPEAT)
            arrival.merged(known, taken, source, position, time).write.mode("overwrite").parquet(state)
        for old in earlier[:-1]:
            storage.delete(spark, f"{root}/known/batch_id={old}")

    return each_batch


def read(spark: SparkSession, root: str, schema: T.StructType, batches: list[int] | None = None) -> DataFrame:
    """The rows of finished batches with their ``standing``; a filter on it reads only those files."""
    full = T.StructType([*schema.fields, T.StructField("standing", T.StringType())])
    if batches is None:
        batches = _before(spark, f"{root}/rows", 1 << 62)
    parts = [spark.read.schema(full).parquet(f"{root}/rows/batch_id={n}") for n in batches]
    if not parts:
        return spark.createDataFrame([], full)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def known(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The intervals after the last finished batch."""
    found = _before(spark, f"{root}/known", 1 << 62)
    return spark.read.schema(schema).parquet(f"{root}/known/batch_id={found[-1]}") if found else spark.createDataFrame([], schema)
