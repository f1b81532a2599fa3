"""Messages that drift away from the declared row.

New images of the change log as JSON without empty fields: from k = 70 on they have a field ``channel`` that nobody declared
(text, from 85 on a number), at k = 44 ``value`` is a text, and at k from 31 to 33 ``event_type`` is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import drift
from tidelog.plans import changes as ch
from tidelog.plans.changes import FEED, LOG_SQL
from tidelog.plans.registry import query
from tidelog.sources.messages import parse_envelope


def drifting(spark: SparkSession, folder: str) -> DataFrame:
    rows = ch.change_rows(spark, folder)
    k, after = F.col("k"), F.col("after")
    image = F.struct(
        after["user_id"].alias("user_id"),
        F.when(~k.between(31, 33), after["event_type"]).alias("event_type"),
        after["value"].alias("value"),
        after["created_at"].alias("created_at"),
        F.when(k >= 70, F.concat(F.lit("c"), k.cast("string"))).alias("channel"),
    )
    rows = rows.withColumn("after", F.when(after.isNotNull(), image))
    text = F.to_json(F.struct("after", "op", "ts_ms"))
    text = F.when(k == 44, F.regexp_replace(text, r'"value":([-0-9.E]+)', r'"value":"$1"')).otherwise(text)
    text = F.when(k >= 85, F.regexp_replace(text, r'"channel":"c(\d+)"', r'"channel":$1')).otherwise(text)
    return rows.select(text.alias("value"))


@query(f"""
WITH {LOG_SQL}, img1 AS (
  SELECT k, CASE WHEN k NOT BETWEEN 31 AND 33 THEN new_type END AS t, new_value AS v, new_created AS c FROM chg WHERE has_after),
seen AS (
  SELECT 'user_id' AS field, 'whole' AS kind, 'as_declared' AS status FROM img1
  UNION ALL SELECT 'event_type', 'text', 'as_declared' FROM img1 WHERE t IS NOT NULL
  UNION ALL SELECT 'event_type', NULL, 'dropped' FROM img1 WHERE t IS NULL
  UNION ALL SELECT 'value', CASE WHEN k = 44 THEN 'text' ELSE 'number' END,
                   CASE WHEN k = 44 THEN 'retyped' ELSE 'as_declared' END FROM img1 WHERE v IS NOT NULL
  UNION ALL SELECT 'value', NULL, 'dropped' FROM img1 WHERE v IS NULL
  UNION ALL SELECT 'created_at', 'whole', 'as_declared' FROM img1 WHERE c IS NOT NULL
  UNION ALL SELECT 'created_at', NULL, 'dropped' FROM img1 WHERE c IS NULL
  UNION ALL SELECT 'channel', CASE WHEN k >= 85 THEN 'whole' ELSE 'text' END, 'added' FROM img1 WHERE k >= 70)
SELECT field, kind, status, COUNT(*) AS messages FROM seen GROUP BY ALL
""")
def schema_drift(spark, folder):
    return drift.schema_drift(drifting(spark, folder), FEED)


@query(f"""
WITH {LOG_SQL}
SELECT lsn_free.user_id AS user_id, CASE WHEN k >= 85 THEN CAST(k AS VARCHAR) WHEN k >= 70 THEN 'c' || k END AS channel,
       COUNT(*) AS messages
FROM (SELECT user_id, k FROM chg WHERE has_after) lsn_free GROUP BY ALL
""")
def drift_widened(spark, folder):
    """The same messages read with the columns that the drift found."""
    messages = drifting(spark, folder)
    feed = drift.widened(FEED, drift.added_columns(drift.schema_drift(messages, FEED)))
    rows = parse_envelope(messages, feed).where("after is not null")
    return rows.groupBy("after.user_id", "after.channel").agg(F.count("*").alias("messages"))
