"""Reconciliation and observability reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import apply, observe, reconcile
from tidelog.plans.application import KEY, NEWEST, ORDER, row_log
from tidelog.plans.changes import LOG_SQL
from tidelog.plans.registry import query
from tidelog.sources.readers import table


@query(f"""
WITH {LOG_SQL}, newest AS (SELECT * FROM img {NEWEST}),
n AS (SELECT (SELECT COUNT(*) FROM events) AS a, (SELECT COUNT(*) FROM img) AS b,
             (SELECT COUNT(*) FROM newest WHERE op <> 'd') AS c),
v AS (SELECT *, CASE WHEN a > 0 AND b > 0 AND c > 0 THEN 'GOOD' WHEN a > 0 AND b > 0 THEN 'IN PROGRESS'
                ELSE 'NOT ESTABLISHED' END AS verdict FROM n)
SELECT 'source' AS stage, 1 AS position, a AS rows, a - a AS behind_source, verdict FROM v
UNION ALL SELECT 'change_log', 2, b, a - b, verdict FROM v
UNION ALL SELECT 'mirror', 3, c, a - c, verdict FROM v
""")
def stage_counts(spark, folder):
    log = row_log(spark, folder)
    return reconcile.stage_counts({
        "source": table(spark, folder, "events"),
        "change_log": log,
        "mirror": apply.mirror_current(log, KEY, ORDER),
    })


@query("""
SELECT COUNT(*) AS row_count, CAST(SUM(CAST('0x' || substr(md5(
  COALESCE(length(CAST(o_orderkey AS VARCHAR)) || ':' || CAST(o_orderkey AS VARCHAR), '~') || COALESCE(length(CAST(o_custkey AS VARCHAR)) || ':' || CAST(o_custkey AS VARCHAR), '~') || COALESCE(length(CAST(o_orderstatus AS VARCHAR)) || ':' || CAST(o_orderstatus AS VARCHAR), '~') || COALESCE(length(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)) || ':' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '~') ||
  COALESCE(length(CAST(o_orderdate AS VARCHAR)) || ':' || CAST(o_orderdate AS VARCHAR), '~') || COALESCE(length(CAST(o_orderpriority AS VARCHAR)) || ':' || CAST(o_orderpriority AS VARCHAR), '~')), 1, 15) AS BIGINT)) AS VARCHAR) AS checksum FROM orders
""")
def table_checksum(spark, folder):
    orders = table(spark, folder, "orders")
    columns = {c: F.col(c) for c in orders.columns}
    columns["o_totalprice"] = F.col("o_totalprice").cast("decimal(18,2)")
    return reconcile.table_checksum(orders, columns, portable=True)


LAST_COMMIT = "2024-01-30 12:00:00"


@query(f"""
WITH ends AS (SELECT event_type, MAX(event_id) AS end_offset, MIN(event_id) AS f FROM events GROUP BY event_type),
done AS (SELECT event_type, MAX(event_id) AS committed_offset FROM events
         WHERE ts <= TIMESTAMP '{LAST_COMMIT}' GROUP BY event_type)
SELECT event_type, end_offset, committed_offset, end_offset - COALESCE(committed_offset, f - 1) AS lag,
       CASE WHEN end_offset - COALESCE(committed_offset, f - 1) < 100 THEN 'PASS' ELSE 'FAIL' END AS status
FROM ends LEFT JOIN done USING (event_type)
""")
def consumer_lag(spark, folder):
    """One log partition per event type; the consumer last committed at a given moment."""
    log = table(spark, folder, "events")
    progress = log.filter(F.col("ts") <= F.lit(LAST_COMMIT).cast("timestamp_ntz")).select(
        "event_type", F.col("event_id").alias("position")
    )
    return observe.consumer_lag(log, progress, "event_type", "event_id", "position")


@query("""
WITH t AS (SELECT event_type, ((epoch_us(ts) // 1000) // 30000 + 1) * 30000 - epoch_us(ts) // 1000 AS ms FROM events)
SELECT event_type, COUNT(*) AS rows, ROUND(CAST(SUM(ms) AS DOUBLE) / COUNT(*), 3) AS avg_ms,
       quantile_disc(ms, 0.5) AS p50_ms, quantile_disc(ms, 0.95) AS p95_ms, MAX(ms) AS max_ms
FROM t GROUP BY event_type
""")
def latency_stats(spark, folder):
    """From the event to the next commit when one happens every 30 seconds."""
    started = F.col("ts").cast("timestamp")
    ms = F.unix_millis(started)
    commit = F.timestamp_millis(ms - F.pmod(ms, F.lit(30000)) + 30000)
    events = table(spark, folder, "events")
    return observe.latency_stats(events, started, commit, ["event_type"], accuracy=100_000)


@query("""
WITH t AS (SELECT event_type, ((epoch_us(ts) // 1000) // 30000 + 1) * 30000 - epoch_us(ts) // 1000 AS ms FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ms) AS i,
             COUNT(*) OVER (PARTITION BY event_type) AS n FROM t WHERE ms IS NOT NULL)
SELECT event_type, COUNT(*) AS rows, MIN(ms) FILTER (100 * i >= 50 * n) AS p50_ms,
       MIN(ms) FILTER (100 * i >= 95 * n) AS p95_ms, MIN(ms) FILTER (100 * i >= 99 * n) AS p99_ms
FROM r GROUP BY event_type
""")
def latency_percentiles(spark, folder):
    """From the event to the next commit, exact."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    waited = ms - F.pmod(ms, F.lit(30000)) + 30000 - ms
    shares = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    return observe.percentiles(table(spark, folder, "events"), waited, shares, ["event_type"])


CAP = 495_000


@query(f"""
WITH target AS (
  SELECT o_orderkey, LEAST(o_totalprice, {CAP}) AS o_totalprice, o_orderstatus FROM orders
  WHERE NOT (o_orderstatus = 'P' AND o_totalprice < 1500)),
m AS (
  SELECT s.o_orderkey, t.o_orderkey IS NULL AS gone, s.o_totalprice IS DISTINCT FROM t.o_totalprice AS price,
         s.o_orderstatus IS DISTINCT FROM t.o_orderstatus AS status
  FROM orders s LEFT JOIN target t ON s.o_orderkey = t.o_orderkey)
SELECT o_orderkey, CASE WHEN gone THEN 'missing' ELSE 'changed' END AS status,
       CASE WHEN NOT gone THEN 'o_totalprice' END AS columns_changed
FROM m WHERE gone OR price OR status
""")
def diff_by_ranges(spark, folder):
    """Orders against a copy that caps large amounts and lost some small open orders."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    lost = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 1500)
    capped = F.least("o_totalprice", F.lit(float(CAP))).alias("o_totalprice")
    copy = orders.where(~lost).select("o_orderkey", capped, "o_orderstatus")
    return reconcile.diff_by_ranges(orders, copy, "o_orderkey", ["o_totalprice", "o_orderstatus"])


@query("""
SELECT c_custkey AS cust, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS arrived
FROM customer
""")
def arrival_check(spark, folder):
    """Which customers have a finished order downstream."""
    sent = table(spark, folder, "customer").select(F.col("c_custkey").alias("cust"))
    log = table(spark, folder, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("cust"))
    return reconcile.arrival_check(sent, log, ["cust"])


@query("""
WITH c AS (
  SELECT (COUNT(*) > 0)::INT + (COUNT(*) = COUNT(user_id))::INT + (MIN(value) > 0)::INT + (MAX(value) <= 120)::INT
    + (COUNT(*) = COUNT(DISTINCT event_id))::INT AS passed FROM events)
SELECT CAST(passed AS BIGINT) AS passed, CAST(5 AS BIGINT) AS total, CAST(passed * 100 // 5 AS BIGINT) AS score,
       CASE WHEN passed * 100 // 5 >= 90 THEN 'EXCELLENT' WHEN passed * 100 // 5 >= 70 THEN 'GOOD'
            WHEN passed * 100 // 5 >= 50 THEN 'DEGRADED' ELSE 'CRITICAL' END AS status
FROM c
""")
def health_score(spark, folder):
    conditions = {
        "has_rows": F.count("*") > 0,
        "keys_filled": F.count("*") == F.count("user_id"),
        "values_positive": F.min("value") > 0,
        "values_in_range": F.max("value") <= 120,
        "ids_unique": F.count("*") == F.count_distinct("event_id"),
    }
    return observe.health_score(observe.checks(table(spark, folder, "events"), conditions))


@query(f"""
WITH {LOG_SQL}
SELECT operation, date_trunc('hour', event_time) AS period, COUNT(*) AS events FROM img GROUP BY ALL
""")
def op_counts(spark, folder):
    return observe.op_counts(row_log(spark, folder), "event_time")
