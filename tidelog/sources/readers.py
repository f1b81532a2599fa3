"""Batch and streaming readers. Each is a thin layer over ``spark.read`` or ``spark.readStream``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.schema import CORRUPT


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def parquet(spark: SparkSession, path: str, schema: T.StructType | None = None, merge: bool = False) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("mergeSchema", str(merge).lower()).parquet(path)


def csv(spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",", header: bool = True) -> DataFrame:
    """Delimited text with a declared schema; a line that does not fit is kept in ``corrupt``."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(full)
        .option("header", str(header).lower())
        .option("delimiter", delimiter)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines; without a schema the types are inferred in an extra pass."""
    return (spark.read if schema is None else spark.read.schema(schema)).json(path)


def literal(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    return spark.createDataFrame(list(rows), ddl)


def generator(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def message_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None, bytes_per_batch: int | None = None,
    since: dt.datetime | None = None,
) -> DataFrame:
    """Text files that keep arriving in a folder, one message per line, with their arrival time.

    A micro-batch is bounded by files or by bytes. With ``since`` the rows of files that are older do not enter the
    stream at all: they are left out at the scan, before any operator that keeps state.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    elif bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    stream = reader.format("text").load(path)
    if since is not None:
        stream = stream.filter(F.col("_metadata.file_modification_time") > F.lit(since))
    return stream.select("value", F.col("_metadata.file_modification_time").alias("record_time"))


def kafka_options(
    servers: str, topic: str, startup: str = "earliest", rows_per_batch: int | None = None, **more: str
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": startup,
        "failOnDataLoss": "true",
        **more,
    }
    if rows_per_batch:
        options["maxOffsetsPerTrigger"] = str(rows_per_batch)
    return options


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Topic messages with key, place and record time. Needs the Kafka connector on the classpath."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("record_time"),
    )


def database_snapshot(
    spark: SparkSession, url: str, name: str, split_on: str, low: int, high: int, parts: int, **more: str
) -> DataFrame:
    """A source table read over JDBC in ``parts`` key ranges. Needs the driver on the classpath."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=name, partitionColumn=split_on, **more)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", parts)
        .load()
    )


def tables_like(spark: SparkSession, pattern: str = "*", database: str | None = None, without: Sequence[str] = ()):
    """Names in the catalog that match ``pattern`` and are not in ``without``."""
    found = spark.catalog.listTables(database, pattern)
    return sorted(t.name for t in found if t.name not in set(without))
