"""Lag, latency, file and health reports as jobs over tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.rules import at_least
from tidelog.operators.analytics import exact_mean
from tidelog.operators.quality import _tall
from tidelog.operators.sequences import carried

# A lag below 100 messages passes, a data file below 1000 bytes is small.
LAG_LIMIT = 100
SMALL_FILE_BYTES = 1000

# Health bands, percent of checks passed.
HEALTH_BANDS = ((90, "EXCELLENT"), (70, "GOOD"), (50, "DEGRADED"))
HEALTH_OTHERWISE = "CRITICAL"


def consumer_lag(
    log: DataFrame, progress: DataFrame, partition: str, offset: str, committed: str, limit: int = LAG_LIMIT
) -> DataFrame:
    """Newest position against committed position per partition of the log.

    A partition nobody committed to yet counts from its first position.
    """
    ends = log.groupBy(partition).agg(
        F.max(offset).alias("end_offset"), F.min(offset).alias("_first")
    )
    done = progress.groupBy(partition).agg(F.max(committed).alias("committed_offset"))
    lag = F.col("end_offset") - F.coalesce(F.col("committed_offset"), F.col("_first") - 1)
    return ends.join(done, partition, "left").select(
        partition,
        "end_offset",
        "committed_offset",
        lag.alias("lag"),
        F.when(lag < limit, "PASS").otherwise("FAIL").alias("status"),
    )


def latency_stats(
    df: DataFrame, started: Column, arrived: Column, by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """Milliseconds from event to arrival: rows, mean, median, 95th percentile, largest.

    Percentiles are sketched, off by at most one part in ``accuracy`` of the rows.
    """
    ms = F.unix_millis(arrived.cast("timestamp")) - F.unix_millis(started.cast("timestamp"))
    timed = df.select(*by, ms.alias("_ms")).filter(F.col("_ms").isNotNull())
    ranks = F.percentile_approx("_ms", [0.5, 0.95], accuracy)
    return timed.groupBy(*by).agg(
        F.count("*").alias("rows"),
        exact_mean(F.col("_ms"), 3).alias("avg_ms"),
        ranks[0].alias("p50_ms"),
        ranks[1].alias("p95_ms"),
        F.max("_ms").alias("max_ms"),
    )


def percentiles(df: DataFrame, value: Column, shares: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact percentiles of each group: ``rows`` and, for each share, the smallest value that so many rows do not exceed.

    Equal values become one row before any order is needed. Those are dealt by range over group and value, and their
    counts run on from range to range, so a group with a third of the rows is in no one place. NULL values count for
    nothing, a NULL group is a group; a group without values is left out. Works for whatever has an order.
    """
    if not by:
        return percentiles(df.withColumn("pc_all", F.lit(0)), value, shares, ["pc_all"]).drop("pc_all")
    values = df.select(*by, value.alias("pc_value")).where("pc_value is not null")
    counted = values.groupBy(*by, "pc_value").agg(F.count("*").alias("pc_rows"))
    running = carried(counted, by, ["pc_value"], {"pc_upto": ("pc_rows", "sum")})
    # The running count of the last value of a group is its size, so no second pass over the rows is needed.
    totals = running.groupBy(*by).agg(F.max("pc_upto").alias("pc_total"))
    names = [f"pc_by_{i}" for i in range(len(by))]
    totals = totals.select(*[F.col(c).alias(n) for c, n in zip(by, names)], "pc_total")
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names)]
    ranked = running.join(totals, reduce(and_, same))
    reached = {n: F.col("pc_upto") >= F.ceil(F.col("pc_total") * F.lit(Decimal(str(s)))) for n, s in shares.items()}
    found = [F.min(F.when(cond, F.col("pc_value"))).alias(n) for n, cond in reached.items()]
    return ranked.groupBy(*by).agg(F.max("pc_total").alias("rows"), *found)


def file_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size and change time of every file below ``path``; contents are not read."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return listed.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def file_audit(files: DataFrame, small: int = SMALL_FILE_BYTES) -> DataFrame:
    """Files, bytes, small files and verdict per file type."""
    kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    tiny = F.count_if(F.col("bytes") < small)
    return files.groupBy(F.when(kind == "", "none").otherwise(kind).alias("file_type")).agg(
        F.count("*").alias("files"),
        F.sum("bytes").alias("total_bytes"),
        tiny.alias("small_files"),
        F.min("bytes").alias("smallest"),
        F.max("bytes").alias("largest"),
        F.when((tiny == 0) & (F.sum("bytes") > 0), "PASS").otherwise("FAIL").alias("status"),
    )


def new_files(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """Files in the later listing that the earlier one lacks or shows with another size."""
    return later.join(earlier.select("path", "bytes"), ["path", "bytes"], "left_anti")


def op_counts(log: DataFrame, time: str, period: str = "hour", operation: str = "operation") -> DataFrame:
    return log.groupBy(operation, F.date_trunc(period, F.col(time)).alias("period")).agg(
        F.count("*").alias("events")
    )


def checks(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """``(check_name, passed)`` rows from aggregate conditions that are all computed in one pass."""
    names = {f"c{i}": cond for i, cond in enumerate(conditions.values())}
    one = df.agg(*[F.coalesce(cond, F.lit(False)).alias(n) for n, cond in names.items()])
    return _tall(one, [(F.lit(k), F.col(n)) for k, n in zip(conditions, names)], ["check_name", "passed"])


def health_score(results: DataFrame) -> DataFrame:
    """Passed checks in whole percent, rounded down, with the band it falls into."""
    passed, total = F.count_if("passed"), F.count("*")
    rows = results.agg(passed.alias("passed"), total.alias("total"))
    score = F.try_divide(F.col("passed") * 100 - F.pmod(F.col("passed") * 100, F.col("total")), F.col("total"))
    score = score.cast("bigint")
    return rows.select(
        "passed", "total", score.alias("score"),
        at_least(score, HEALTH_BANDS, HEALTH_OTHERWISE).alias("status"),
    )
