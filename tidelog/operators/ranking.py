"""Ranks over a whole table without putting the table into one task.

A plain window without PARTITION BY sends every row to a single task. Here rows are range-partitioned
by the order columns, written once to the shared folder, and ranked from each row's position in its
range plus the number of rows in the ranges before it. Only one row per range reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import materialize

# monotonically_increasing_id puts the partition number above these bits and the row position in them.
_POSITION_BITS = 33

# A value with more than this share of all rows is hot, so there can be at most 1 / share of them.
HOT_SHARE = 1e-3


def _ranged(df: DataFrame, order: Sequence[Column], purpose: str) -> DataFrame:
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    written = materialize(placed, purpose)
    return written.withColumn("_range", F.shiftright("_slot", _POSITION_BITS)).withColumn(
        "_position", F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    )


def _with_offset(ranged: DataFrame, weight: Column) -> DataFrame:
    """Adds ``_before``: the weight of all ranges before the row's own."""
    spark = ranged.sparkSession
    # One row per range, so as many rows as the shuffle has partitions.
    sizes = sorted(
        (r["_range"], r["_size"]) for r in ranged.groupBy("_range").agg(F.sum(weight).alias("_size")).collect()
    )
    starts = accumulate([0] + [size for _, size in sizes[:-1]])
    offsets = spark.createDataFrame(
        [(number, start) for (number, _), start in zip(sizes, starts)], "_range BIGINT, _before BIGINT"
    )
    return ranged.join(F.broadcast(offsets), "_range")


def global_row_number(
    df: DataFrame, measure: str, key: Sequence[str], name: str = "row_number", descending: bool = True
) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY measure [DESC], key)`` over the whole table.

    The key makes the order total and lets a value that many rows share spread over ranges.
    NULL ranks last.
    """
    first = F.col(measure).desc_nulls_last() if descending else F.col(measure).asc_nulls_last()
    ranged = _ranged(df, [first, *[F.col(c).asc() for c in key]], "row-number")
    placed = _with_offset(ranged, F.lit(1))
    return placed.withColumn(name, F.col("_before") + F.col("_position") + 1).drop(
        "_slot", "_range", "_position", "_before"
    )


def running_counts(df: DataFrame, measure: str) -> DataFrame:
    """For each distinct value: ``value, rows, below`` (rows with a smaller value; NULL is last)."""
    values = df.groupBy(F.col(measure).alias("value")).agg(F.count("*").alias("rows"))
    ranged = _ranged(values, [F.col("value").asc_nulls_last()], "value-counts")
    earlier = Window.partitionBy("_range").orderBy("_position").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    placed = _with_offset(ranged, F.col("rows"))
    return placed.select("value", "rows", (F.col("_before") + inside).alias("below"))


def join_lookup(
    df: DataFrame,
    lookup: DataFrame,
    column: str,
    total: int,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Inner join of ``df[column]`` with the unique ``lookup.value``, NULL matching NULL.

    The values that own more than ``hot_share`` of the rows are broadcast, of which there are at most
    ``1 / hot_share``, and the rest is joined without a hint: no hot value is left in it.
    """
    keep = [c for c in lookup.columns if c != "value"]

    def attach(rows: DataFrame, side: DataFrame) -> DataFrame:
        return rows.join(side, F.col(column).eqNullSafe(F.col("value"))).select(*df.columns, *keep)

    is_hot = F.col("rows") > F.lit(int(total * hot_share))
    hot = F.broadcast(lookup.filter(is_hot))
    cold_rows = df.join(hot, F.col(column).eqNullSafe(F.col("value")), "left_anti")
    return attach(df, hot).unionByName(attach(cold_rows, lookup.filter(~is_hot)))


def global_percent_rank(
    df: DataFrame, measure: str, name: str = "percent_rank", **limits
) -> DataFrame:
    """``PERCENT_RANK() OVER (ORDER BY measure)`` over the whole table: (rank - 1) / (rows - 1)."""
    counts = materialize(running_counts(df, measure), "percent-rank")
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    ranked = join_lookup(df, counts, measure, total, **limits)
    share = F.col("below") / F.lit(float(max(total - 1, 1)))
    return ranked.select(*df.columns, share.alias(name))
