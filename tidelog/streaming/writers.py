"""Table, file and message writers for batch and streaming DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.apply import latest
from tidelog.operators.normalize import accepted, quarantined
from tidelog.schema import DELETE, Feed
from tidelog.sources import storage
from tidelog.streaming.runner import EachBatch, finish, triggered

# Fixed value: the target file size in use.
TARGET_BYTES = 128 * 1024 * 1024


def append(
    stream: DataFrame, path: str, checkpoint: str, kind: str = "parquet", by: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Appends a stream to Parquet or JSON files, each row exactly once."""
    writer = stream.writeStream.format(kind).outputMode("append").option("path", path)
    if by:
        writer = writer.partitionBy(*by)
    return finish(triggered(writer, checkpoint, every).start(), every)


def show(stream: DataFrame, checkpoint: str, name: str | None = None, every: str | None = None) -> StreamingQuery:
    """Prints a stream, or with ``name`` keeps it as an in-memory table for a look at small data."""
    writer = stream.writeStream.outputMode("append")
    writer = writer.format("memory").queryName(name) if name else writer.format("console")
    return finish(triggered(writer, checkpoint, every).start(), every)


def create_table_as(df: DataFrame, name: str, path: str, by: Sequence[str] = ()) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS … AS SELECT`` for Parquet files at ``path``; returns the table."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        writer = df.write.format("parquet").option("path", path)
        (writer.partitionBy(*by) if by else writer).saveAsTable(name)
    return spark.table(name)


def stream_table_as(stream: DataFrame, name: str, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Creates the table if needed and appends the stream to it."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return finish(triggered(writer, checkpoint, every).toTable(name), every)


def spread(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups rows for a partitioned write.

    The rebalance hint makes adaptive execution put small partition values together and split a
    value that holds a large share of the rows, so file sizes stay near the advisory size.
    """
    return df.hint("rebalance", *[F.col(c) for c in by])


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    spark = df.sparkSession
    spread(df, by).write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fan_out(targets: Mapping[str, tuple[str, object]]) -> EachBatch:
    """One micro-batch into several places: ``{name: (folder, DataFrame -> DataFrame)}``.

    The batch is read and parsed once. Each target writes to a folder named after the batch id. A folder that
    was finished is left as it is when the batch is repeated, so a reader never sees a part of it;
    ``finished`` reads the finished ones.
    """

    def each_batch(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            for folder, shape in targets.values():
                to = f"{folder}/batch_id={batch_id}"
                if not storage.committed(rows.sparkSession, to):
                    shape(rows).write.mode("overwrite").parquet(to)
        finally:
            rows.unpersist()

    return each_batch


def finished(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows of all finished batches below a folder."""
    named = [f"{folder}/{name}" for name in storage.folders(spark, folder) if name.startswith("batch_id=")]
    whole = [path for path in named if storage.committed(spark, path)]
    return spark.read.schema(schema).parquet(*whole) if whole else spark.createDataFrame([], schema)


def quarantine(feed: Feed, log: str, aside: str, shape) -> EachBatch:
    """Two writes per micro-batch of parsed changes: the accepted ones through ``shape``, the others with a reason."""
    return fan_out({
        "log": (log, lambda rows: shape(accepted(rows, feed))),
        "aside": (aside, lambda rows: quarantined(rows, feed)),
    })


def compact_files(
    spark: SparkSession, source: str, target: str, by: Sequence[str] = (), order: Sequence[str] = (),
    target_bytes: int = TARGET_BYTES, schema: T.StructType | None = None,
) -> DataFrame:
    """Rewrites a folder of many small files as few of about ``target_bytes`` in a new folder.

    Rows are split by range over the partition columns and then ``order``, so a partition value of
    any size spreads over as many files as it needs. Partition values are copied as text, so that one
    like ``001`` keeps its folder name. The source stays as it is.
    """
    schema = schema or spark.read.parquet(source).schema
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in by else f.dataType) for f in schema.fields]
    )
    df = spark.read.schema(as_text).parquet(source)
    files = max(1, ceil(storage.size(spark, source) / target_bytes))
    columns = [*by, *(order or [c for c in df.columns if c not in by])]
    ranged = df.repartitionByRange(files, *columns).sortWithinPartitions(*columns)
    writer = ranged.write.option("compression", "snappy")
    (writer.partitionBy(*by) if by else writer).parquet(target)
    return spark.read.schema(schema).parquet(target)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``length`` of the Parquet files below a folder, listed by Spark; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(path).select("path", "length")


def compact_small(
    spark: SparkSession, source: str, target: str, by: Sequence[str] = (), order: Sequence[str] = (),
    small_bytes: int = TARGET_BYTES // 2, target_bytes: int = TARGET_BYTES, schema: T.StructType | None = None,
) -> DataFrame:
    """Rewrites only the files of a folder that are below ``small_bytes``, as files of about ``target_bytes`` in ``target``.

    Returns the table: the larger files where they are, and what was rewritten. Spark leaves the other files out when it
    lists them, so as many bytes are read and written as the small files have. The source stays as it is; its small
    files can go once nobody reads them. If the rewrite is repeated it starts again.
    """
    schema = schema or spark.read.parquet(source).schema
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in by else f.dataType) for f in schema.fields]
    )
    size = F.col("_metadata.file_size")
    small = file_sizes(spark, source).where(F.col("length") < small_bytes).agg(F.sum("length")).first()[0] or 0
    large = spark.read.schema(schema).parquet(source).where(size >= small_bytes)
    if not small:
        return large
    rows = spark.read.schema(as_text).parquet(source).where(size < small_bytes)
    columns = [*by, *(order or [c for c in rows.columns if c not in by])]
    ranged = rows.repartitionByRange(ceil(small / target_bytes), *columns).sortWithinPartitions(*columns)
    writer = ranged.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*by) if by else writer).parquet(target)
    return large.unionByName(spark.read.schema(schema).parquet(target))


def keyed_messages(log: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Log rows as messages: JSON key, JSON value, and a NULL value for a delete."""
    keep = {"ignoreNullFields": "false"}
    body = F.to_json(F.struct(*columns), keep)
    return log.select(
        F.to_json(F.struct(*key), keep).alias("key"),
        F.when(F.col("op") == DELETE, F.lit(None)).otherwise(body).alias("value"),
    )


def to_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Streams keyed messages to a topic. Needs the Kafka connector on the classpath."""
    writer = (
        messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    )
    return finish(triggered(writer, checkpoint, every).start(), every)


def merge_batch(name: str, key: Sequence[str], order: Sequence[str]) -> EachBatch:
    """Upserts through MERGE; a delete stays in the table as a row with its ``op`` and position.

    Only an event that comes after the row's own changes it, so late older events change nothing, also
    after a delete. Readers leave out the rows whose ``op`` is a delete. Needs a catalog whose tables support it.
    """

    def each_batch(rows: DataFrame, batch_id: int) -> None:
        newest = latest(rows, key, order).alias("s")
        same = F.lit(True)
        for c in key:
            same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"{name}.{c}"))
        later = F.struct(*[F.col(f"s.{c}") for c in order]) > F.struct(*[F.col(f"{name}.{c}") for c in order])
        (
            newest.mergeInto(name, same)
            .whenMatched(later)
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )

    return each_batch
