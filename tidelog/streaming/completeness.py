"""When a time partition can be called complete, and marking it so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.sources import storage
from tidelog.streaming.runner import EachBatch

# Out-of-orderness of the source, wait after the end of a partition, success marker.
DISORDER = "5 seconds"
DELAY = "1 minute"
MARKER = "_SUCCESS"


def _status(days: DataFrame, newest: Column, disorder: str, delay: str) -> DataFrame:
    end = (F.date_add("event_date", 1)).cast("timestamp_ntz")
    safe = newest.cast("timestamp_ntz") - F.expr(f"interval {disorder}") - F.expr(f"interval {delay}")
    return days.withColumn("complete", safe >= end)


def partition_completeness(
    df: DataFrame, time: str = "event_time", disorder: str = DISORDER, delay: str = DELAY
) -> DataFrame:
    """Rows and newest time per event date, and whether the watermark has passed its end plus delay.

    The watermark is the newest time in the table less the disorder, taken from the dates' own newest
    times, of which there is one row per date: the table is read once.
    """
    days = df.groupBy(F.to_date(time).alias("event_date")).agg(
        F.count("*").alias("rows"), F.max(time).alias("last_event")
    )
    newest = F.max("last_event").over(Window.partitionBy(F.lit(0)))
    return _status(days, newest, disorder, delay)


def commit_partitions(
    path: str, progress: str, time: str = "event_time", disorder: str = DISORDER, delay: str = DELAY
) -> EachBatch:
    """Writes batches into ``path/event_date=…`` and marks the partitions that became complete.

    Each batch leaves a summary in ``progress``, one row per date seen so far, made from the summary
    of the batch before and its own rows. Only these two are kept, so a batch costs the same however
    long the stream has run, and a repeated batch finds what it found the first time.
    """

    def each_batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        summary = lambda n: f"{progress}/batch_id={n}"
        earlier = [int(f.split("=")[1]) for f in storage.folders(spark, progress)]
        earlier = sorted(n for n in earlier if n < batch_id)
        dated = rows.withColumn("event_date", F.to_date(time)).persist()
        try:
            if not storage.committed(spark, f"{path}/batch_id={batch_id}"):
                dated.hint("rebalance", F.col("event_date")).write.mode("overwrite").partitionBy("event_date").parquet(
                    f"{path}/batch_id={batch_id}"
                )
            days = dated.groupBy("event_date").agg(F.max(time).alias("last_event"), F.count("*").alias("rows"))
            if earlier:
                days = days.unionByName(spark.read.schema(days.schema).parquet(summary(earlier[-1])))
                days = days.groupBy("event_date").agg(
                    F.max("last_event").alias("last_event"), F.sum("rows").alias("rows")
                )
            days.write.mode("overwrite").parquet(summary(batch_id))
        finally:
            dated.unpersist()
        for old in earlier[:-1]:
            storage.delete(spark, summary(old))
        seen = spark.read.parquet(summary(batch_id))
        done = _status(seen, seen.select(F.max("last_event")).scalar(), disorder, delay).filter("complete")
        marked = set(storage.folders(spark, f"{path}/_complete"))
        # One short row per date that became complete since.
        names = F.concat(F.lit("event_date="), "event_date")
        for row in done.filter(~names.isin(sorted(marked)) if marked else F.lit(True)).select(F.concat(F.lit("event_date="), "event_date").alias("name")).collect():
            if row["name"] not in marked:
                storage.touch(spark, f"{path}/_complete/{row['name']}/{MARKER}")

    return each_batch
