"""What the order of arrival tells: late rows, repeats, lost positions, idle sources.

Each source numbers its events; the numbers are the order in which they arrive. A row is late if its time is before the
newest time that came earlier, less the disorder. It is a repeat if its number came before. Both follow from the data
and not from how a stream was cut into batches.

What is known of earlier rows is a table of intervals ``source, start, end, newest``: the numbers that came, without
gaps, and their newest time. Its size follows the gaps, not the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.sequences import carried

# Out-of-orderness of a source, and the silence after which it holds nothing back.
DISORDER = "5 seconds"
IDLE = "30 seconds"

ON_TIME, LATE, REPEAT = "on_time", "late", "repeat"


def known_schema(rows: DataFrame, source: str, position: str, time: str) -> T.StructType:
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    named = (("source", kinds[source]), ("start", kinds[position]), ("end", kinds[position]), ("newest", kinds[time]))
    return T.StructType([T.StructField(name, kind) for name, kind in named])


def nothing_known(spark: SparkSession, rows: DataFrame, source: str, position: str, time: str) -> DataFrame:
    return spark.createDataFrame([], known_schema(rows, source, position, time))


def _spans(rows: DataFrame, source: str, position: str, time: str) -> DataFrame:
    """Rows as intervals of one number."""
    return rows.select(F.col(source).alias("source"), F.col(position).alias("start"), F.col(position).alias("end"), F.col(time).alias("newest"))


def judged(
    rows: DataFrame, known: DataFrame, source: str, position: str, time: str = "event_time", disorder: str = DISORDER
) -> DataFrame:
    """Adds ``standing``: ``on_time``, ``late`` or ``repeat``, by the rows that came before and those known already.

    Of rows with one number the first by time and then by content stays. A row without a number is no repeat and on
    time; one without a time is not late. A NULL source is a source.
    """
    whole, start = F.struct(*rows.columns), F.col(position)
    inside = rows.select(
        F.col(source).alias("source"), start.alias("start"), start.alias("end"), F.when(start.isNotNull(), F.col(time)).alias("newest"),
        F.lit(1).alias("kind"), F.xxhash64(whole).alias("tie"), F.monotonically_increasing_id().alias("number"), whole.alias("row"),
    )
    earlier = known.select("source", "start", "end", "newest", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("tie"), F.lit(0).cast("long").alias("number"))
    both = inside.unionByName(earlier, allowMissingColumns=True)
    order = ["start", "kind", "newest", "tie", "number"]
    seen = carried(both, ["source"], order, {"reached": ("end", "max"), "before": ("newest", "max")}, current=False)
    late = F.col("newest") < F.col("before") - F.expr(f"interval {disorder}")
    standing = F.when(F.col("start").isNull(), ON_TIME).when(F.col("reached") >= F.col("start"), REPEAT).when(late, LATE).otherwise(ON_TIME)
    return seen.where("kind = 1").select("row.*", standing.alias("standing"))


def merged(known: DataFrame, rows: DataFrame, source: str, position: str, time: str = "event_time") -> DataFrame:
    """The known intervals with the numbers of ``rows`` put in; intervals that touch become one."""
    new = _spans(rows.where(F.col(position).isNotNull()), source, position, time)
    both = known.unionByName(new).groupBy("source", "start", "end").agg(F.max("newest").alias("newest"))
    before = carried(both, ["source"], ["start", "end"], {"reached": ("end", "max")}, current=False)
    opens = F.col("reached").isNull() | (F.col("start") > F.col("reached") + 1)
    counted = carried(before.withColumn("opens", opens.cast("long")), ["source"], ["start", "end"], {"island": ("opens", "sum")})
    one = counted.groupBy("source", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("newest").alias("newest"))
    return one.select("source", "start", "end", "newest")


def gaps(known: DataFrame) -> DataFrame:
    """``source, first_missing, last_missing``: the numbers between known ones that did not come."""
    ends = carried(known, ["source"], ["start"], {"reached": ("end", "max")}, current=False)
    missing = ends.where(F.col("start") > F.col("reached") + 1)
    return missing.select("source", (F.col("reached") + 1).alias("first_missing"), (F.col("start") - 1).alias("last_missing"))


def clock(rows: DataFrame, position: str, time: str = "event_time") -> DataFrame:
    """Adds ``arrived``: the newest time up to each row in the order of arrival, over all sources. It never goes back."""
    return carried(rows, [], [position], {"arrived": (time, "max")})


def source_watermarks(
    rows: DataFrame, source: str, time: str = "event_time", arrived: str = "arrived", disorder: str = DISORDER, idle: str = IDLE
) -> DataFrame:
    """``source, rows, last_event, last_arrival, idle, watermark``: how far each source is.

    A source that was silent for ``idle`` before the last arrival of all is idle.
    """
    each = rows.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("rows"), F.max(time).alias("last_event"), F.max(arrived).alias("last_arrival"))
    newest = each.agg(F.max("last_arrival").alias("newest"))
    # One row against one row per source.
    both = each.join(newest, F.col("newest") >= F.col("last_arrival"), "left")
    silent = F.coalesce(F.col("last_arrival") < F.col("newest") - F.expr(f"interval {idle}"), F.lit(True))
    return both.select(
        "source", "rows", "last_event", "last_arrival", silent.alias("idle"), (F.col("last_event") - F.expr(f"interval {disorder}")).alias("watermark")
    )


def combined(watermarks: DataFrame) -> Column:
    """The least watermark of the sources that are not idle; of all, if all are."""
    active, every = F.min(F.when(~F.col("idle"), F.col("watermark"))), F.min("watermark")
    return watermarks.agg(F.coalesce(active, every).alias("w")).select("w").scalar()


def source_completeness(
    rows: DataFrame, source: str, time: str = "event_time", arrived: str = "arrived", disorder: str = DISORDER,
    delay: str = "1 minute", idle: str = IDLE,
) -> DataFrame:
    """``event_date, rows, sources, last_event, complete``: dates that every source which still speaks has passed."""
    by_source = rows.groupBy(F.to_date(time).alias("event_date"), F.col(source).alias("source")).agg(F.count("*").alias("rows"), F.max(time).alias("last_event"))
    days = by_source.groupBy("event_date").agg(F.sum("rows").alias("rows"), F.count("*").alias("sources"), F.max("last_event").alias("last_event"))
    safe = combined(source_watermarks(rows, source, time, arrived, disorder, idle)).cast("timestamp_ntz") - F.expr(f"interval {delay}")
    return days.withColumn("complete", safe >= F.date_add("event_date", 1).cast("timestamp_ntz"))
