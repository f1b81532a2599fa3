"""Writing tables, in batch and from streams. Everything written goes to the shared folder."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import history
from tidelog.operators.arrival import REPEAT
from tidelog.operators.normalize import normalize
from tidelog.plans import changes as ch
from tidelog.plans.application import KEY, MIDDLE, NEWEST, ORDER, STATE_SQL, moment, row_log
from tidelog.plans.changes import FEED, LOG_SQL, MESSY_SQL, log_position
from tidelog.plans.registry import query
from tidelog.session import scratch
from tidelog.sources import readers, storage
from tidelog.sources.messages import parse_envelope
from tidelog.sources.readers import message_stream, table
from tidelog.streaming import admission, completeness, runner, writers
from tidelog.streaming.mirror_table import MirrorTable
from tidelog.streaming.totals import SignedTotals

# Text that one micro-batch of the registered queries takes, and the most messages in a landed file.
BATCH_BYTES = 1 << 30
FILE_MESSAGES = 1_000_000

# Buckets of a mirror for each gigabyte of landed text; the table keeps the number that it began with.
BUCKETS_PER_GB = 8

LIVE_SQL = f"WITH {MESSY_SQL}, newest AS (SELECT * FROM img {NEWEST}) SELECT {STATE_SQL} FROM newest WHERE op <> 'd'"
ALL_SQL = f"WITH {LOG_SQL} SELECT {STATE_SQL} FROM img"
MESSY_ALL_SQL = f"WITH {MESSY_SQL} SELECT {STATE_SQL} FROM img"


def land(messages: DataFrame, folder: str, file_messages: int = FILE_MESSAGES) -> int:
    """Writes messages as text files and returns their bytes."""
    messages.write.option("maxRecordsPerFile", file_messages).mode("append").text(folder)
    return storage.size(messages.sparkSession, folder)


def streamed_log(messages: DataFrame) -> DataFrame:
    """The same parser, quarantine and normaliser that the batch queries use, on a stream of text."""
    return ch.typed(parse_envelope(messages.select("value"), FEED), "row")


def incoming(
    spark: SparkSession, folder: str, purpose: str, batch_bytes: int = BATCH_BYTES, file_messages: int = FILE_MESSAGES
) -> tuple[DataFrame, str, int]:
    """A stream of the landed messy messages, a fresh root folder for what is made of it, and the landed bytes."""
    root = scratch(spark, purpose)
    size = land(ch.messy_envelopes(spark, folder), f"{root}/in", file_messages)
    return message_stream(spark, f"{root}/in", bytes_per_batch=batch_bytes), root, size


@query(MESSY_ALL_SQL)
def stream_append(spark, folder, **limits):
    messages, root, _ = incoming(spark, folder, "append", **limits)
    log = streamed_log(messages)
    writers.append(log, f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(log.schema).parquet(f"{root}/out")


def _mirror(spark, folder, purpose: str, kind: str, fold_every: int, **limits) -> MirrorTable:
    messages, root, size = incoming(spark, folder, purpose, **limits)
    log = streamed_log(messages)
    cut = {kind: max(2, ceil(size * BUCKETS_PER_GB / (1 << 30)))}
    mirror = MirrorTable(spark, f"{root}/mirror", log.schema, KEY, ORDER, **cut)
    runner.run(log, mirror.each_batch(fold_every=fold_every, keep_versions=2), f"{root}/checkpoint")
    return mirror


@query(LIVE_SQL)
def mirror_stream(spark, folder, **limits):
    """A bucketed mirror that is folded at every fourth batch."""
    return _mirror(spark, folder, "mirror", "buckets", 4, **limits).current()


@query(LIVE_SQL)
def mirror_merge_on_read(spark, folder, **limits):
    """Base and deltas together; at every sixteenth batch the touched parts of the base are written anew."""
    return _mirror(spark, folder, "deltas", "parts", 16, **limits).current()


@query(f"""
WITH {MESSY_SQL}, newest AS (SELECT * FROM img WHERE event_time < TIMESTAMP '{MIDDLE}' {NEWEST})
SELECT {STATE_SQL} FROM newest WHERE op <> 'd'
""")
def mirror_as_of_version(spark, folder):
    """Two batches, before and from a moment on; the table as it was after the first, read after the second."""
    root = scratch(spark, "versions")
    log = ch.messy_log(spark, folder)
    mirror = MirrorTable(spark, f"{root}/mirror", log.schema, KEY, ORDER)
    mirror.write_batch(log.filter(F.col("event_time") < moment()), 0)
    mirror.write_batch(log.filter(F.col("event_time") >= moment()), 1)
    return mirror.current(through=0)


@query(f"""
WITH {LOG_SQL}, tagged AS (
  SELECT CASE WHEN k IN (13, 17) THEN 'malformed' WHEN k = 19 THEN 'unknown_op'
              WHEN k = 23 AND op = 'd' THEN 'invalid_key' ELSE 'accepted' END AS reason, op FROM chg)
SELECT reason, COUNT(*) AS events FROM tagged GROUP BY reason
""")
def quarantine_stream(spark, folder, **limits):
    """Two writes per micro-batch: the log, and the messages that cannot be applied with the reason."""
    messages, root, _ = incoming(spark, folder, "quarantine", **limits)
    rows = parse_envelope(messages.select("value"), FEED)
    shape = lambda kept: normalize(kept, FEED, image="row", carry=log_position(), processing_time=False)
    runner.run(rows, writers.quarantine(FEED, f"{root}/log", f"{root}/aside", shape), f"{root}/checkpoint")
    log = writers.finished(spark, f"{root}/log", shape(rows).schema).select(F.lit("accepted").alias("reason"))
    aside = writers.finished(spark, f"{root}/aside", T.StructType([T.StructField("reason", T.StringType())]))
    return log.unionByName(aside).groupBy("reason").agg(F.count("*").alias("events"))


ROUND_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
ROUND_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query(ROUND_SQL)
def csv_round_trip(spark, folder):
    """A table written as delimited text and read with a declared schema."""
    root, rows = scratch(spark, "csv"), table(spark, folder, "customer").select(*ROUND_COLUMNS)
    rows.write.option("header", "true").option("delimiter", ";").csv(root)
    return readers.csv(spark, root, rows.schema, delimiter=";").filter("corrupt IS NULL").drop("corrupt")


@query(ROUND_SQL)
def json_round_trip(spark, folder):
    """A table written as JSON lines and read with a declared schema."""
    root, rows = scratch(spark, "json"), table(spark, folder, "customer").select(*ROUND_COLUMNS)
    rows.write.json(root)
    return readers.json(spark, root, rows.schema)


@query(f"WITH {LOG_SQL} SELECT {STATE_SQL} FROM img WHERE op IN ('c', 'u', 'r')")
def ctas_changes(spark, folder):
    root = scratch(spark, "ctas")
    log = ch.change_log(spark, folder, image="row", ops=("c", "u", "r"))
    name = "changes_" + root.rsplit("-", 1)[1]
    return writers.create_table_as(log, name, root)


@query(f"""
WITH {LOG_SQL}
SELECT event_type, COUNT(*) AS rows, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
FROM img GROUP BY event_type
""")
def partition_by_value(spark, folder):
    written = writers.write_partitioned(row_log(spark, folder), scratch(spark, "by-value"), ["event_type"])
    return written.groupBy("event_type").agg(
        F.count("*").alias("rows"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total_amount")
    )


@query(f"""
WITH {LOG_SQL}
SELECT strftime(event_time, '%Y-%m-%d') AS event_date, COUNT(*) AS rows, COUNT(DISTINCT user_id) AS users
FROM img GROUP BY 1
""")
def partition_by_event_date(spark, folder):
    """Written by date and read back, every date."""
    log = row_log(spark, folder).withColumn("event_date", F.date_format("event_time", "yyyy-MM-dd"))
    written = writers.write_partitioned(log, scratch(spark, "by-date"), ["event_date"])
    return written.groupBy("event_date").agg(
        F.count("*").alias("rows"), F.count_distinct("user_id").alias("users")
    )


@query(f"""
WITH {LOG_SQL}, w AS (SELECT MAX(event_time) - INTERVAL 5 SECOND - INTERVAL 1 MINUTE AS safe FROM img)
SELECT CAST(event_time AS DATE) AS event_date, COUNT(*) AS rows, MAX(event_time) AS last_event,
       (SELECT safe FROM w) >= CAST(event_time AS DATE) + INTERVAL 1 DAY AS complete
FROM img GROUP BY ALL
""")
def partition_completeness(spark, folder):
    return completeness.partition_completeness(row_log(spark, folder))


@query(ALL_SQL)
def compact_files(spark, folder):
    """Many small files per partition value, rewritten to the target size."""
    root = scratch(spark, "compact")
    log = row_log(spark, folder)
    log.write.partitionBy("operation").parquet(f"{root}/small")
    return writers.compact_files(spark, f"{root}/small", f"{root}/large", ["operation"], ["user_id", "lsn"])


@query(ALL_SQL)
def compact_small_files(spark, folder):
    """Files below the mean size are rewritten together; the larger ones stay where they are."""
    root = scratch(spark, "compact-small")
    row_log(spark, folder).write.partitionBy("operation").parquet(f"{root}/table")
    mean = writers.file_sizes(spark, f"{root}/table").agg(F.avg("length")).first()[0] or 0
    return writers.compact_small(
        spark, f"{root}/table", f"{root}/packed", ["operation"], ["user_id", "lsn"], small_bytes=ceil(mean)
    )


@query(f"""
WITH {LOG_SQL}, newest AS (SELECT * FROM img {NEWEST})
SELECT event_type, COUNT(*) AS rows, COUNT(amount) AS filled, COUNT(DISTINCT amount) AS distinct_values,
       MIN(amount) AS min_value, MAX(amount) AS max_value, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM newest WHERE op <> 'd' GROUP BY event_type
""")
def retracted_totals(spark, folder, **bounds):
    """Totals of the current table by event type, kept batch by batch from signed rows."""
    root = scratch(spark, "totals")
    signed = history.row_changes(row_log(spark, folder), KEY, ORDER)
    signed = signed.select("sign", "event_type", F.col("amount").cast("decimal(18,2)").alias("amount"))
    signed.write.option("maxRecordsPerFile", FILE_MESSAGES).parquet(f"{root}/in")
    reader = spark.readStream.schema(signed.schema)
    for name, most in (bounds or {"maxBytesPerTrigger": BATCH_BYTES}).items():
        reader = reader.option(name, most)
    parts = max(2, ceil(storage.size(spark, f"{root}/in") * BUCKETS_PER_GB / (1 << 30)))
    totals = SignedTotals(spark, f"{root}/totals", signed.schema, ["event_type"], "amount", parts=parts)
    runner.run(reader.parquet(f"{root}/in"), totals.each_batch(keep_versions=2), f"{root}/checkpoint")
    doubles = [F.col(c).cast("double").alias(c) for c in ("min_value", "max_value", "total")]
    return totals.totals().select("event_type", "rows", "filled", "distinct_values", *doubles)


@query(f"""
WITH {LOG_SQL}
SELECT to_json({{'user_id': user_id}}) AS key,
       CASE WHEN op <> 'd' THEN to_json({{'user_id': user_id, 'event_type': event_type, 'amount': amount}}) END AS value
FROM img
""")
def keyed_messages(spark, folder):
    return writers.keyed_messages(row_log(spark, folder), ["user_id"], ["user_id", "event_type", "amount"])


@query(f"""
WITH {MESSY_SQL}
SELECT 'log' AS target, COUNT(*) AS rows, COUNT(amount) AS amounts, CAST(NULL AS VARCHAR) AS data_source FROM img
UNION ALL SELECT 'debug', COUNT(*), COUNT(amount), 'PostgreSQL_CDC' FROM img WHERE op <> 'd'
""")
def fan_out(spark, folder):
    messages, root, _ = incoming(spark, folder, "fan-out")
    log = streamed_log(messages)
    tagged = lambda rows: rows.filter("op <> 'd'").select(
        "user_id", "amount", F.lit("PostgreSQL_CDC").alias("data_source")
    )
    targets = {"log": (f"{root}/log", lambda rows: rows), "debug": (f"{root}/debug", tagged)}
    runner.run(log, writers.fan_out(targets), f"{root}/checkpoint")
    counts = [
        writers.finished(spark, path, shape(log).schema).agg(
            F.lit(name).alias("target"),
            F.count("*").alias("rows"),
            F.count("amount").alias("amounts"),
            (F.max("data_source") if name == "debug" else F.lit(None).cast("string")).alias("data_source"),
        )
        for name, (path, shape) in targets.items()
    ]
    return counts[0].unionByName(counts[1])


@query(ALL_SQL)
def stream_watermark_dedupe(spark, folder, file_messages=FILE_MESSAGES, **bounds):
    """Each message is delivered twice; the stream takes each once, by its position, and sets late ones aside.

    What came before is known by intervals of positions and the newest time in them, so the result does not depend
    on how the stream is cut into batches or on the order of rows in one. Late rows stay in the log.
    """
    root = scratch(spark, "dedupe")
    twice = ch.envelopes(spark, folder).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    land(twice, f"{root}/in", file_messages)
    log = streamed_log(message_stream(spark, f"{root}/in", **(bounds or {"bytes_per_batch": BATCH_BYTES})))
    named = log.withColumn("origin", F.lit("app"))
    runner.run(named, admission.admit(root, "origin", "lsn"), f"{root}/checkpoint")
    taken = admission.read(spark, root, named.schema).where(F.col("standing") != REPEAT)
    return taken.drop("origin", "standing")
