"""Starting streaming queries.

A query works in micro-batches that become visible when the batch is committed to the checkpoint.
``every`` sets the commit interval; without it the query takes what is there now and stops, which is
the batch form of the same code.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidelog.sources import storage

EachBatch = Callable[[DataFrame, int], None]


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB, off the JVM heap, with incremental changelog checkpoints."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def triggered(writer: DataStreamWriter, checkpoint: str, every: str | None) -> DataStreamWriter:
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def run(stream: DataFrame, each_batch: EachBatch, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Calls ``each_batch(rows, batch_id)`` for every micro-batch.

    A batch that failed is called again with the same id and the same rows, so ``each_batch`` must
    write to places that depend on the id only.
    """

    return finish(triggered(stream.writeStream.foreachBatch(each_batch), checkpoint, every).start(), every)


def start_moment(spark: SparkSession, checkpoint: str) -> dt.datetime:
    """When the stream with this checkpoint was first started: now, at the first call.

    ``message_stream(..., since=start_moment(spark, checkpoint))`` starts after the files that are there then. The
    moment is kept beside the checkpoint, so the plan is the same from the first batch on and after a restart.
    """
    place = f"{checkpoint}_start"
    if not storage.committed(spark, place):
        # Files are as old as their store says, in whole milliseconds; the next one belongs to the stream.
        spark.range(1).select(F.current_timestamp().alias("at")).write.mode("overwrite").parquet(place)
    return spark.read.parquet(place).first()["at"]


def finish(query: StreamingQuery, every: str | None) -> StreamingQuery:
    if every is None:
        query.awaitTermination()
    return query
