"""Order of arrival, sources that fall silent, and the history of keys.

The deliveries of these queries come from ``events``: a row's source is its number modulo 4, its position the number divided
by 4, so positions have no gaps of their own. Where the number ``k`` in ``props`` is 41 the row is lost; from 95 on it
comes twice; below 10 its time is k times 37 minutes earlier, so it may be late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import arrival, history
from tidelog.plans import changes as ch
from tidelog.plans.application import KEY, row_log
from tidelog.plans.changes import LOG_SQL
from tidelog.plans.registry import query
from tidelog.session import scratch
from tidelog.sources.readers import message_stream, table
from tidelog.streaming import admission, runner

SOURCES = 4
IDLE = "20 minutes"

DELIVERIES_SQL = """
rows AS (
  SELECT event_id AS lsn, event_id % 4 AS source, event_id // 4 AS position, user_id, value AS amount,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k, ts FROM events),
once AS (
  SELECT lsn, source, position, user_id, amount, k,
         CASE WHEN k < 10 THEN ts - to_minutes(k * 37) ELSE ts END AS event_time FROM rows WHERE k <> 41),
standing AS (
  SELECT *, CASE WHEN event_time < max(event_time) OVER (
    PARTITION BY source ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 5 SECONDS
    THEN 'late' ELSE 'on_time' END AS standing FROM once)
"""

STANDING_SQL = f"""WITH {DELIVERIES_SQL}
SELECT lsn, source, position, user_id, amount, event_time, standing FROM standing
UNION ALL SELECT lsn, source, position, user_id, amount, event_time, 'repeat' FROM standing WHERE k >= 95"""


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    events = table(spark, folder, "events").withColumn("k", k).where("k <> 41")
    time = ch.instant()
    early = time - F.make_dt_interval(mins=(F.col("k") * 37).cast("int"))
    number = F.col("event_id")
    once = events.select(
        number.alias("lsn"), (number % SOURCES).alias("source"), F.floor(number / SOURCES).alias("position"), "user_id",
        F.col("value").alias("amount"), F.when(F.col("k") < 10, early).otherwise(time).alias("event_time"), "k",
    )
    times = F.when(F.col("k") >= 95, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return once.withColumn("copy", F.explode(times)).drop("copy", "k")


@query(STANDING_SQL)
def arrival_standing(spark, folder):
    """On time, late or a repeat: every delivery by those that came before it from its source."""
    rows = deliveries(spark, folder)
    known = arrival.nothing_known(spark, rows, "source", "position", "event_time")
    return arrival.judged(rows, known, "source", "position")


def admitted(spark: SparkSession, folder: str, **bounds) -> tuple[DataFrame, str]:
    """The deliveries landed as text in the order of their numbers, and taken by a stream; the rows and their folder."""
    root = scratch(spark, "admission")
    rows = deliveries(spark, folder)
    # JSON times have milliseconds only.
    wire = rows.withColumn("event_time", F.unix_micros("event_time"))
    ordered = wire.repartitionByRange("lsn").sortWithinPartitions("lsn")
    ordered.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/in")
    stream = message_stream(spark, f"{root}/in", **(bounds or {"bytes_per_batch": 1 << 30}))
    parsed = stream.select(F.from_json("value", wire.schema).alias("row")).select("row.*")
    parsed = parsed.withColumn("event_time", F.timestamp_micros("event_time")).select(*rows.columns)
    runner.run(parsed, admission.admit(root, "source", "position"), f"{root}/checkpoint")
    return admission.read(spark, root, rows.schema), root


@query(STANDING_SQL)
def stream_admission(spark, folder):
    """The same from a stream that keeps late rows and repeats in tables beside the log."""
    return admitted(spark, folder)[0]


@query(f"""WITH {DELIVERIES_SQL},
gap AS (SELECT source, position, lag(position) OVER (PARTITION BY source ORDER BY position) AS earlier FROM once)
SELECT source, earlier + 1 AS first_missing, position - 1 AS last_missing FROM gap WHERE position > earlier + 1""")
def lost_positions(spark, folder):
    rows = deliveries(spark, folder)
    known = arrival.nothing_known(spark, rows, "source", "position", "event_time")
    return arrival.gaps(arrival.merged(known, rows, "source", "position"))


PROGRESS_SQL = """
clock AS (SELECT event_type AS source, ts, max(ts) OVER (ORDER BY event_id) AS arrived FROM events),
each AS (SELECT source, count(*) AS rows, max(ts) AS last_event, max(arrived) AS last_arrival FROM clock GROUP BY source),
progress AS (
  SELECT *, last_arrival < (SELECT max(last_arrival) FROM each) - INTERVAL 20 MINUTES AS idle,
         last_event - INTERVAL 5 SECONDS AS watermark FROM each)
"""


def clocked(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", F.col("event_type").alias("source"), ch.instant().alias("event_time"))
    return arrival.clock(events, "event_id")


@query(f"WITH {PROGRESS_SQL} SELECT * FROM progress")
def source_progress(spark, folder):
    """How far each source is, and which have fallen silent; event types stand for sources."""
    return arrival.source_watermarks(clocked(spark, folder), "source", idle=IDLE)


@query(f"""WITH {PROGRESS_SQL},
days AS (SELECT CAST(ts AS DATE) AS event_date, count(*) AS rows, count(DISTINCT source) AS sources, max(ts) AS last_event
         FROM clock GROUP BY 1)
SELECT *, (SELECT min(watermark) FROM progress WHERE NOT idle) - INTERVAL 1 MINUTE >= event_date + INTERVAL 1 DAY AS complete
FROM days""")
def source_completeness(spark, folder):
    return arrival.source_completeness(clocked(spark, folder), "source", idle=IDLE)


SHOWN = ["lsn", "user_id", "op", "event_type", "amount"]


@query(f"""WITH {LOG_SQL}, spans AS (
  SELECT *, event_time AS valid_from, lead(event_time) OVER (PARTITION BY user_id ORDER BY event_time, lsn) AS valid_to FROM img)
SELECT {', '.join(SHOWN)}, valid_from, valid_to FROM spans WHERE op <> 'd'""")
def history_intervals(spark, folder):
    log = history.validity(row_log(spark, folder), KEY, ["event_time", "lsn"])
    return log.select(*SHOWN, "valid_from", "valid_to")


@query(f"""WITH {LOG_SQL},
asked AS (SELECT event_id AS question, user_id, ts - INTERVAL 1 HOUR AS moment FROM events WHERE event_type = 'purchase'),
state AS (SELECT * FROM img QUALIFY row_number() OVER (PARTITION BY user_id, event_time ORDER BY lsn DESC) = 1),
met AS (SELECT a.question, a.user_id, s.lsn, s.op, s.amount FROM asked a ASOF LEFT JOIN state s
        ON a.user_id = s.user_id AND a.moment >= s.event_time)
SELECT question, user_id, CASE WHEN op <> 'd' THEN lsn END AS lsn, CASE WHEN op <> 'd' THEN amount END AS amount FROM met""")
def history_lookup(spark, folder):
    """The state of a user one hour before each purchase."""
    events = table(spark, folder, "events").where("event_type = 'purchase'")
    asked = events.select(F.col("event_id").alias("question"), "user_id", (ch.instant() - F.expr("interval 1 hour")).alias("moment"))
    found = history.lookup(row_log(spark, folder), asked, KEY, ["event_time", "lsn"])
    return found.select("question", "user_id", "found.lsn", "found.amount")
