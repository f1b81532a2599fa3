"""Reading change events: parsers, normalisation, quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions.changes import (
    connector_decimal, from_millis, key_valid, merged, micro_time, record_id, unixtime_text,
)
from tidelog.operators.normalize import normalize, quarantined, row_kinds, signed_count
from tidelog.plans import changes as ch
from tidelog.plans.changes import FEED, LOG_SQL, log_position
from tidelog.plans.registry import query
from tidelog.schema import LABELS_SQL, OPS
from tidelog.sources.messages import json_paths, parse_envelope, parse_flat, parse_prefixed, parse_wrapped, raw
from tidelog.sources.readers import table

IMAGES_SQL = f"""
WITH {LOG_SQL}
SELECT lsn, op, ts_ms,
       CASE WHEN has_before THEN user_id END AS before_user, CASE WHEN has_before THEN old_type END AS before_type,
       CASE WHEN has_before THEN old_value END AS before_value,
       CASE WHEN has_after THEN user_id END AS after_user, CASE WHEN has_after THEN new_type END AS after_type,
       CASE WHEN has_after THEN new_value END AS after_value
FROM chg
"""


def _images(rows):
    parts = [
        F.col(f"{s}.{c}").alias(f"{s}_{short}")
        for s in ("before", "after")
        for c, short in (("user_id", "user"), ("event_type", "type"), ("value", "value"))
    ]
    return rows.select(F.col("source.lsn").alias("lsn"), "op", "ts_ms", *parts)


@query(IMAGES_SQL)
def cdc_envelope_parse(spark, folder):
    return _images(parse_envelope(ch.envelopes(spark, folder), FEED))


@query(IMAGES_SQL)
def cdc_wrapped_parse(spark, folder):
    return _images(parse_wrapped(ch.wrapped(spark, folder), FEED))


@query(IMAGES_SQL)
def cdc_prefixed_parse(spark, folder):
    return _images(parse_prefixed(ch.prefixed(spark, folder), FEED))


@query(f"""
WITH {LOG_SQL}
SELECT lsn, CASE WHEN op = 'r' THEN 'u' ELSE op END AS op, user_id, event_type, amount, event_time
FROM img WHERE k >= 5
""")
def cdc_flat_parse(spark, folder):
    rows = parse_flat(ch.flat(spark, folder), FEED)
    log = normalize(rows, FEED, ops=("c", "u", "d"), null_op_as="u", image="row", carry=log_position(),
                    processing_time=False)
    return log.select("lsn", "op", "user_id", "event_type", "amount", "event_time")


@query("SELECT props AS raw_message FROM events")
def raw_land(spark, folder):
    messages = table(spark, folder, "events").select(F.col("props").alias("value"))
    return raw(messages).select("raw_message")


@query(f"""
WITH {LOG_SQL}
SELECT user_id, new_type AS event_type, new_value AS value, event_time FROM chg WHERE has_after
""")
def raw_json_path(spark, folder):
    paths = {
        "user_id": ("$.after.user_id", "bigint"),
        "event_type": ("$.after.event_type", "string"),
        "value": ("$.after.value", "double"),
        "ts_ms": ("$.ts_ms", "bigint"),
    }
    rows = json_paths(ch.envelopes(spark, folder), paths, require="user_id")
    return rows.select("user_id", "event_type", "value", from_millis(F.col("ts_ms")).alias("event_time"))


LOG_COLUMNS = "op, operation, user_id, event_type, amount, created_at, event_time, lsn"


@query(f"""
WITH {LOG_SQL}
SELECT {LOG_COLUMNS}, CAST(user_id AS VARCHAR) || '_' || event_type AS record_id FROM col
""")
def cdc_normalize(spark, folder):
    return ch.change_log(spark, folder, record_id_from=("user_id", "event_type"))


@query(f"WITH {LOG_SQL} SELECT {LOG_COLUMNS} FROM img")
def cdc_image_row(spark, folder):
    return ch.change_log(spark, folder, image="row")


@query(f"""
WITH {LOG_SQL}
SELECT lsn, user_id,
       CASE op WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' WHEN 'r' THEN 'SNAPSHOT'
               ELSE 'UNKNOWN' END AS operation
FROM col
""")
def cdc_labels_alt(spark, folder):
    return ch.change_log(spark, folder, labels=LABELS_SQL).select("lsn", "user_id", "operation")


@query(f"""
WITH {LOG_SQL}
SELECT lsn, CAST(user_id AS VARCHAR) || '_' || event_type AS plain_id,
       CAST(user_id AS VARCHAR) || '_' || COALESCE(event_type, 'unknown') AS safe_id
FROM col
""")
def cdc_record_id(spark, folder):
    parts = [merged("user_id"), merged("event_type")]
    return ch.parsed(spark, folder).select(
        F.col("source.lsn").alias("lsn"),
        record_id(parts).alias("plain_id"),
        record_id(parts, null_part="unknown").alias("safe_id"),
    )


@query(f"""
WITH {LOG_SQL}
SELECT lsn, COALESCE(make_timestamp((created_at // 1000) * 1000), event_time) AS created_at FROM col
""")
def cdc_micro_time(spark, folder):
    rows = ch.parsed(spark, folder)
    made = micro_time("created_at", fallback=from_millis(F.col("ts_ms")))
    return rows.select(F.col("source.lsn").alias("lsn"), made.alias("created_at"))


@query(f"""
WITH {LOG_SQL}
SELECT lsn, strftime(make_timestamp((ts_ms // 1000) * 1000000), '%Y-%m-%d %H:%M:%S') AS event_time_text FROM chg
""")
def cdc_unixtime(spark, folder):
    rows = ch.parsed(spark, folder)
    return rows.select(
        F.col("source.lsn").alias("lsn"), unixtime_text(F.col("ts_ms")).alias("event_time_text")
    )


@query("""
SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
       CAST(-CAST(l_discount AS DECIMAL(18,2)) AS DOUBLE) AS discount
FROM lineitem
""")
def cdc_decimal_decode(spark, folder):
    """Prices as eight bytes and negated discounts as four bytes, the way a connector sends them."""
    cents = lambda c: (F.col(c).cast("decimal(18,2)") * 100).cast("bigint")
    wide = F.lpad(F.hex(cents("l_extendedprice")), 16, "0")
    negated = -cents("l_discount")
    narrow = F.right(F.lpad(F.hex(negated), 16, "0"), F.lit(8))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.base64(F.unhex(wide)).alias("price64"),
        F.base64(F.unhex(narrow)).alias("discount64"),
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        connector_decimal(F.col("price64"), 2, 18).cast("double").alias("price"),
        connector_decimal(F.col("discount64"), 2, 18).cast("double").alias("discount"),
    )


@query(f"WITH {LOG_SQL} SELECT {LOG_COLUMNS} FROM col WHERE op IN ('c', 'u', 'd')")
def changes_only(spark, folder):
    return ch.change_log(spark, folder, ops=("c", "u", "d"))


@query(f"""
WITH {LOG_SQL}
SELECT lsn, op, user_id FROM chg WHERE k NOT IN (13, 17, 19) AND NOT (k = 23 AND op = 'd')
""")
def cdc_key_valid(spark, folder):
    rows = parse_envelope(ch.messy_envelopes(spark, folder), FEED)
    good = rows.filter(F.col("op").isin(*OPS) & key_valid(FEED.key))
    user = F.coalesce("after.user_id", "before.user_id")
    return good.select(F.col("source.lsn").alias("lsn"), "op", user.alias("user_id"))


@query(f"""
WITH {LOG_SQL}
SELECT reason, COUNT(*) AS events FROM (
  SELECT CASE WHEN k IN (13, 17) THEN 'malformed' WHEN k = 19 THEN 'unknown_op'
              WHEN k = 23 AND op = 'd' THEN 'invalid_key' END AS reason FROM chg)
WHERE reason IS NOT NULL GROUP BY reason
""")
def quarantine_counts(spark, folder):
    bad = quarantined(parse_envelope(ch.messy_envelopes(spark, folder), FEED), FEED)
    return bad.groupBy("reason").agg(F.count("*").alias("events"))


KINDS_SQL = f"""
WITH {LOG_SQL},
kinds AS (
  SELECT lsn, CASE op WHEN 'u' THEN '-U' ELSE '-D' END AS row_kind, user_id, old_type AS event_type,
         old_value AS amount, old_created AS created_at
  FROM chg WHERE has_before AND op IN ('u', 'd')
  UNION ALL
  SELECT lsn, CASE op WHEN 'u' THEN '+U' ELSE '+I' END, user_id, new_type, new_value, new_created
  FROM chg WHERE has_after AND op IN ('c', 'r', 'u'))
"""


def _kinds(spark, folder):
    rows = ch.parsed(spark, folder).withColumn("lsn", F.col("source.lsn"))
    return row_kinds(rows, FEED, carry=["lsn"])


@query(KINDS_SQL + "SELECT * FROM kinds")
def cdc_row_kinds(spark, folder):
    return _kinds(spark, folder)


@query(KINDS_SQL + """
SELECT user_id, CAST(SUM(CASE WHEN row_kind LIKE '+%' THEN 1 ELSE -1 END) AS BIGINT) AS net_rows,
       CAST(SUM(CASE WHEN row_kind LIKE '+%' THEN 1 ELSE -1 END * CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount
FROM kinds GROUP BY user_id
""")
def changelog_signed_count(spark, folder):
    kinds = _kinds(spark, folder).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    counts = signed_count(kinds, ["user_id"], ["amount"])
    return counts.withColumn("sum_amount", F.col("sum_amount").cast("double"))
