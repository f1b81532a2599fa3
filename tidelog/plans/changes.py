"""The change log that the registered queries work on, derived from whole tables row by row.

``events`` becomes a log keyed by ``user_id``: signup is a create, view a snapshot read, error a
delete, anything else an update. The number ``k`` in ``props`` decides the old image and the gaps:

* an update has an old image if k >= 20; a delete always has one; creates and reads never do
* the new value of an update is NULL if k >= 90 (an update to NULL)
* the new row time is missing if k < 30

``LOG_SQL`` says the same for DuckDB. Both are plain projections, so the derivation adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.normalize import accepted, normalize
from tidelog.schema import Feed
from tidelog.sources.messages import parse_envelope, to_envelope
from tidelog.sources.readers import table

FEED = Feed.of(
    {"user_id": "long", "event_type": "string", "value": "double", "created_at": "long"},
    key=("user_id",),
    rename={"value": "amount"},
)

HOUR_MICROS = 3_600_000_000


def instant(column: str = "ts"):
    return F.col(column).cast("timestamp")


def change_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Typed change rows: lsn, k, before, after, op, ts_ms, source."""
    events = table(spark, folder, "events")
    micros = F.unix_micros(instant())
    k = F.get_json_object("props", "$.k").cast("long")
    kind = F.col("event_type")
    op = F.when(kind == "signup", "c").when(kind == "view", "r").when(kind == "error", "d").otherwise("u")
    rows = events.select(
        F.col("event_id").alias("lsn"), "user_id", "event_type", "value", k.alias("k"), micros.alias("us"),
        op.alias("op"),
    )
    is_update, is_delete = F.col("op") == "u", F.col("op") == "d"
    before = F.struct(
        F.col("user_id"),
        F.when(F.col("k") >= 50, "view").alias("event_type"),
        F.col("k").cast("double").alias("value"),
        (F.col("us") - HOUR_MICROS).alias("created_at"),
    )
    after = F.struct(
        F.col("user_id"),
        F.col("event_type"),
        F.when(~(is_update & (F.col("k") >= 90)), F.col("value")).alias("value"),
        F.when(F.col("k") >= 30, F.col("us")).alias("created_at"),
    )
    return rows.select(
        "lsn",
        "k",
        F.when(is_delete | (is_update & (F.col("k") >= 20)), before).alias("before"),
        F.when(~is_delete, after).alias("after"),
        "op",
        F.unix_millis(F.timestamp_micros("us")).alias("ts_ms"),
    )


def _source():
    return F.struct(
        F.lit("postgresql").alias("connector"), F.lit("app").alias("db"), F.col("lsn").alias("lsn")
    ).alias("source")


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """The log as envelope text."""
    return as_envelopes(change_rows(spark, folder))


def as_envelopes(rows: DataFrame, *more: str) -> DataFrame:
    rows = rows.withColumn("source", _source())
    return rows.select(to_envelope(rows.drop(*more)).alias("value"), *more)


def wrapped(spark: SparkSession, folder: str) -> DataFrame:
    rows = change_rows(spark, folder)
    body = F.struct("before", "after", "op", "ts_ms", _source())
    return rows.select(F.to_json(F.struct(body.alias("payload"))).alias("value"))


def flat(spark: SparkSession, folder: str) -> DataFrame:
    """Unwrapped rows. Snapshot reads carry no code, and every row with k < 5 is a tombstone."""
    rows = change_rows(spark, folder)
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    rows = rows.withColumn("image", image)
    body = F.struct(
        *[F.col("image")[c].alias(c) for c in FEED.row.names],
        F.when(F.col("op") != "r", F.col("op")).alias("__op"),
        F.col("ts_ms").alias("__source_ts_ms"),
        F.lit("app").alias("__source_db"),
        F.col("lsn").alias("__source_lsn"),
        F.when(F.col("op") == "d", "true").otherwise("false").alias("__deleted"),
    )
    return rows.select(F.when(F.col("k") >= 5, F.to_json(body)).alias("value"))


def prefixed(spark: SparkSession, folder: str) -> DataFrame:
    rows = change_rows(spark, folder)
    parts = [
        F.col(side)[c].alias(f"{side}_{c}") for side in ("before", "after") for c in FEED.row.names
    ]
    return rows.select(F.to_json(F.struct(*parts, "op", "ts_ms", "lsn")).alias("value"))


def messy_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Envelope text with faults: k = 13 is not JSON, k = 17 has a text for the key, k = 19 an
    unknown code, and a delete with k = 23 has no old image."""
    rows = change_rows(spark, folder).withColumn("source", _source())
    k = F.col("k")
    rows = rows.withColumn("op", F.when(k == 19, "t").otherwise(F.col("op")))
    rows = rows.withColumn("before", F.when(~((k == 23) & (F.col("op") == "d")), F.col("before")))
    good = to_envelope(rows)
    typed_badly = F.regexp_replace(good, r'"user_id":(\d+)', '"user_id":"x$1"')
    return rows.select(
        F.when(k == 13, "not json").when(k == 17, typed_badly).otherwise(good).alias("value")
    )


def parsed(spark: SparkSession, folder: str) -> DataFrame:
    return parse_envelope(envelopes(spark, folder), FEED)


def log_position() -> dict:
    return {"lsn": F.col("source.lsn")}


def change_log(spark: SparkSession, folder: str, image: str = "column", **options) -> DataFrame:
    """Envelope text through the parser into the typed change log."""
    return typed(parsed(spark, folder), image, **options)


def typed(rows: DataFrame, image: str, **options) -> DataFrame:
    """The change log of the events that can be applied; the others belong to the quarantine."""
    return normalize(accepted(rows, FEED), FEED, image=image, carry=log_position(), processing_time=False, **options)


def messy_log(spark: SparkSession, folder: str) -> DataFrame:
    return typed(parse_envelope(messy_envelopes(spark, folder), FEED), "row")


def line_log(spark: SparkSession, folder: str) -> DataFrame:
    """A wide log from ``lineitem`` keyed by order and line: N creates, R updates, A deletes."""
    flag = F.col("l_returnflag")
    op = F.when(flag == "N", "c").when(flag == "R", "u").otherwise("d")
    return table(spark, folder, "lineitem").withColumn("op", op)


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_linestatus", "l_returnflag",
]

LOG_SQL = """
raw AS (
  SELECT event_id AS lsn, user_id, event_type, value, epoch_us(ts) AS us, epoch_us(ts) // 1000 AS ts_ms,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op
  FROM events),
chg AS (
  SELECT lsn, user_id, k, op, ts_ms, make_timestamp(ts_ms * 1000) AS event_time,
         op = 'd' OR (op = 'u' AND k >= 20) AS has_before, op <> 'd' AS has_after,
         CASE WHEN k >= 50 THEN 'view' END AS old_type, CAST(k AS DOUBLE) AS old_value,
         us - 3600000000 AS old_created,
         event_type AS new_type, CASE WHEN NOT (op = 'u' AND k >= 90) THEN value END AS new_value,
         CASE WHEN k >= 30 THEN us END AS new_created
  FROM raw),
col AS (
  SELECT lsn, k, op, ts_ms, event_time,
         CASE op WHEN 'c' THEN 'CREATE' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'READ' END AS operation,
         user_id,
         COALESCE(CASE WHEN has_after THEN new_type END, CASE WHEN has_before THEN old_type END) AS event_type,
         COALESCE(CASE WHEN has_after THEN new_value END, CASE WHEN has_before THEN old_value END) AS amount,
         COALESCE(CASE WHEN has_after THEN new_created END, CASE WHEN has_before THEN old_created END) AS created_at
  FROM chg),
img AS (
  SELECT lsn, k, op, ts_ms, event_time,
         CASE op WHEN 'c' THEN 'CREATE' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'READ' END AS operation,
         user_id,
         CASE WHEN has_after THEN new_type ELSE old_type END AS event_type,
         CASE WHEN has_after THEN new_value ELSE old_value END AS amount,
         CASE WHEN has_after THEN new_created ELSE old_created END AS created_at
  FROM chg)
"""

# The log of the messy messages: what a quarantine leaves.
MESSY_SQL = LOG_SQL.replace(
    "  FROM events)",
    "  FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) NOT IN (13, 17, 19)\n"
    "    AND NOT (CAST(json_extract(props, '$.k') AS BIGINT) = 23 AND event_type = 'error'))",
)

LINE_SQL = """
llog AS (
  SELECT *, CASE l_returnflag WHEN 'N' THEN 'c' WHEN 'R' THEN 'u' ELSE 'd' END AS op FROM lineitem),
lnew AS (
  SELECT * FROM llog QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
             l_discount DESC, l_tax DESC, l_linestatus DESC, l_returnflag DESC) = 1)
"""
