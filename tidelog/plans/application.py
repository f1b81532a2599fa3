"""Applying the change log: mirrors, history, edits, keyed matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import apply
from tidelog.operators.reconcile import join_inner, reconcile_diff
from tidelog.plans import changes as ch
from tidelog.plans.changes import LINE_KEY, LINE_ORDER, LINE_SQL, LOG_SQL, MESSY_SQL
from tidelog.plans.registry import query
from tidelog.sources.readers import table

KEY = ["user_id"]
ORDER = ["event_time", "lsn"]
MIDDLE = "2024-01-15 00:00:00"

STATE_SQL = "op, operation, user_id, event_type, amount, created_at, event_time, lsn"
NEWEST = "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, lsn DESC) = 1"


def moment(text: str = MIDDLE):
    return F.lit(text).cast("timestamp")


def row_log(spark, folder):
    return ch.change_log(spark, folder, image="row")


@query(f"WITH {MESSY_SQL}, newest AS (SELECT * FROM img {NEWEST}) SELECT {STATE_SQL} FROM newest WHERE op <> 'd'")
def mirror_current(spark, folder):
    """From messages of which some cannot be applied."""
    return apply.mirror_current(ch.messy_log(spark, folder), KEY, ORDER)


@query(f"WITH {LINE_SQL} SELECT * FROM lnew WHERE op <> 'd'")
def mirror_current_wide(spark, folder):
    return apply.mirror_current(ch.line_log(spark, folder), LINE_KEY, LINE_ORDER)


@query(f"WITH {LOG_SQL}, newest AS (SELECT * FROM img {NEWEST}) SELECT {STATE_SQL}, op = 'd' AS deleted FROM newest")
def mirror_soft_delete(spark, folder):
    return apply.mirror_soft_delete(row_log(spark, folder), KEY, ORDER)


@query(f"""
WITH {LOG_SQL}, newest AS (SELECT * FROM img WHERE event_time <= TIMESTAMP '{MIDDLE}' {NEWEST})
SELECT {STATE_SQL} FROM newest WHERE op <> 'd'
""")
def state_as_of(spark, folder):
    return apply.state_as_of(row_log(spark, folder), KEY, ORDER, moment())


SNAPSHOT_SQL = """
both_parts AS (
  SELECT 0 AS phase, 'r' AS op, c_custkey AS cust, c_acctbal AS amount, CAST(NULL AS TIMESTAMP) AS event_time,
         CAST(NULL AS BIGINT) AS lsn
  FROM customer
  UNION ALL
  SELECT 1, CASE o_orderstatus WHEN 'P' THEN 'd' ELSE 'u' END, o_custkey, o_totalprice, o_orderdate, o_orderkey
  FROM orders)
"""


@query(f"""
WITH {SNAPSHOT_SQL},
newest AS (SELECT * FROM both_parts QUALIFY row_number() OVER (
  PARTITION BY cust ORDER BY phase DESC, event_time DESC NULLS LAST, lsn DESC NULLS LAST) = 1)
SELECT cust, op, amount, event_time, lsn FROM newest WHERE op <> 'd'
""")
def snapshot_then_changes(spark, folder):
    snapshot = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("cust"), F.lit("r").alias("op"), F.col("c_acctbal").alias("amount")
    )
    changes = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("cust"),
        F.when(F.col("o_orderstatus") == "P", "d").otherwise("u").alias("op"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("event_time"),
        F.col("o_orderkey").alias("lsn"),
    )
    state = apply.snapshot_then_changes(snapshot, changes, ["cust"], ORDER)
    return state.select("cust", "op", "amount", "event_time", "lsn")


@query(f"WITH {LOG_SQL}, newest AS (SELECT * FROM img {NEWEST}) SELECT {STATE_SQL} FROM newest WHERE op <> 'd'")
def mirror_apply_join(spark, folder):
    """State at a past moment, then the later changes matched onto it by key."""
    log = row_log(spark, folder)
    state = apply.state_as_of(log, KEY, ORDER, moment())
    later = log.filter(F.col("event_time") > moment())
    return apply.apply_join(state, later, KEY, ORDER)


@query(f"""
WITH {LOG_SQL}, newest AS (SELECT * FROM img {NEWEST}),
live AS (SELECT user_id, amount FROM newest WHERE op <> 'd')
SELECT user_id, amount FROM live
UNION ALL
SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM live)
""")
def insert_if_absent(spark, folder):
    target = apply.mirror_current(row_log(spark, folder), KEY, ORDER).select("user_id", "amount")
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("amount")
    )
    return apply.insert_if_absent(target, rows, ["user_id"], ["amount"])


@query("""
SELECT p_partkey, p_name, p_brand, p_type,
       CAST(CASE WHEN p_name LIKE '%ring%' THEN p_size + 1 ELSE p_size END AS INTEGER) AS p_size,
       CASE WHEN p_name LIKE '%ring%' THEN p_retailprice + 1000 ELSE p_retailprice END AS p_retailprice
FROM part
""")
def conditional_update(spark, folder):
    match = F.col("p_name").like("%ring%")
    values = {"p_size": F.col("p_size") + 1, "p_retailprice": F.col("p_retailprice") + 1000}
    return apply.update_where(table(spark, folder, "part"), match, values)


@query("SELECT * FROM part WHERE NOT (p_type = 'PROMO' AND p_size > 25)")
def conditional_delete(spark, folder):
    gone = (F.col("p_type") == "PROMO") & (F.col("p_size") > 25)
    return apply.delete_where(table(spark, folder, "part"), gone)


@query(f"WITH {LOG_SQL} SELECT {STATE_SQL} FROM img")
def dedupe_events(spark, folder):
    """Every update is delivered twice and every delete three times."""
    log = row_log(spark, folder)
    times = F.when(F.col("op") == "u", 2).when(F.col("op") == "d", 3).otherwise(1)
    delivered = log.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")
    return apply.dedupe_events(delivered, KEY, ["lsn"])


@query(f"WITH {LOG_SQL} SELECT {STATE_SQL} FROM img WHERE amount IS NOT NULL AND event_type IS NOT NULL")
def not_null_drop(spark, folder):
    return apply.not_null(row_log(spark, folder), ["amount", "event_type"])


@query(f"""
WITH {LOG_SQL}
SELECT COUNT(CASE WHEN amount IS NOT NULL AND event_type IS NOT NULL THEN 1 END) AS kept_rows,
       COUNT(CASE WHEN amount IS NULL OR event_type IS NULL THEN 1 END) AS dropped_rows FROM img
""")
def not_null_counts(spark, folder):
    return apply.not_null_counts(row_log(spark, folder), ["amount", "event_type"])


@query(f"""
WITH {LOG_SQL}
SELECT lsn, user_id, event_time, CASE WHEN event_time > TIMESTAMP '{MIDDLE}' THEN amount END AS amount FROM img
""")
def evolve_add_column(spark, folder):
    """``amount`` exists only from a certain moment on."""
    log = row_log(spark, folder).select("lsn", "user_id", "event_time", "amount")
    old = log.filter(F.col("event_time") <= moment()).drop("amount")
    return apply.evolve(old, log.filter(F.col("event_time") > moment()))


@query("""
SELECT c_custkey, c_name, n_nationkey, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey
""", name="join_inner")
def nation_of_customer(spark, folder):
    customers = table(spark, folder, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    joined = join_inner(customers, table(spark, folder, "nation"), ["n_nationkey"])
    return joined.select("c_custkey", "c_name", "n_nationkey", "n_name", "n_regionkey")


@query(f"""
WITH {LOG_SQL},
a AS (SELECT * FROM (SELECT * FROM img {NEWEST}) WHERE op <> 'd'),
b AS (SELECT * FROM (SELECT * FROM img WHERE event_time <= TIMESTAMP '{MIDDLE}' {NEWEST}) WHERE op <> 'd'),
m AS (
  SELECT COALESCE(a.user_id, b.user_id) AS user_id,
         CASE WHEN b.user_id IS NULL THEN 'missing' WHEN a.user_id IS NULL THEN 'extra'
              WHEN a.event_type IS DISTINCT FROM b.event_type OR a.amount IS DISTINCT FROM b.amount THEN 'changed'
              ELSE 'same' END AS status,
         a.event_type IS DISTINCT FROM b.event_type AS t, a.amount IS DISTINCT FROM b.amount AS v
  FROM a FULL OUTER JOIN b ON a.user_id = b.user_id)
SELECT user_id, status,
       CASE WHEN status <> 'changed' THEN NULL WHEN t AND v THEN 'event_type,amount' WHEN t THEN 'event_type'
            ELSE 'amount' END AS columns_changed
FROM m WHERE status <> 'same'
""", name="reconcile_diff")
def diff(spark, folder):
    """A mirror that stopped at a past moment against the current one."""
    log = row_log(spark, folder)
    source = apply.mirror_current(log, KEY, ORDER)
    target = apply.state_as_of(log, KEY, ORDER, moment())
    return reconcile_diff(source, target, KEY, ["event_type", "amount"])
