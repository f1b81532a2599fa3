"""The ad-hoc query set: counts, top lists, rollups, global figures, filtered projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_all(df: DataFrame, name: str = "total_records") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def top_n(df: DataFrame, measure: str, key: Sequence[str], n: int = 10, columns: Sequence[str] = ("*",)) -> DataFrame:
    """The ``n`` rows with the largest ``measure``; the key breaks ties, NULL comes last."""
    ordered = df.orderBy(F.col(measure).desc_nulls_last(), *key)
    return ordered.limit(n).select(*columns)


def latest_n(df: DataFrame, time: str, key: Sequence[str], n: int = 10, columns: Sequence[str] = ("*",)) -> DataFrame:
    return top_n(df, time, key, n, columns)


def temporal_range(df: DataFrame, time: str) -> DataFrame:
    return df.agg(
        F.min(time).alias("earliest_record"),
        F.max(time).alias("latest_record"),
        F.count("*").alias("total_records"),
        F.count_distinct(F.to_date(time)).alias("unique_dates"),
    )


def daily_counts(df: DataFrame, time: str, days: int = 7, as_of: Column | None = None) -> DataFrame:
    """Rows per day from ``days`` days before ``as_of`` on, newest first.

    ``as_of`` defaults to the newest time in the table, found by a scalar subquery whose result
    becomes an ordinary filter on the scan.
    """
    last = df.select(F.max(time)).scalar() if as_of is None else as_of
    kind = dict(df.dtypes)[time]
    start = F.date_sub(F.to_date(last), days).cast(kind)
    recent = df.filter(F.col(time) >= start)
    counts = recent.groupBy(F.to_date(time).alias("record_date")).agg(F.count("*").alias("records_per_day"))
    return counts.orderBy(F.desc("record_date"))


def group_totals(
    df: DataFrame, by: Sequence[str], total: str, mean: str, n: int | None = 15,
    names: tuple[str, str, str] = ("row_count", "total", "average"),
) -> DataFrame:
    """Rows, sum and average per group, largest sum first."""
    rows, whole, average = names
    grouped = df.groupBy(*by).agg(
        F.count("*").alias(rows), F.sum(total).alias(whole), exact_mean(F.col(mean)).alias(average)
    )
    ordered = grouped.orderBy(F.col(whole).desc_nulls_last(), *by)
    return ordered if n is None else ordered.limit(n)


def exact_mean(value: Column, digits: int = 6, scale: int = 6) -> Column:
    """Mean from an exact sum, so that the result does not depend on the order of addition.

    Values are rounded to ``scale`` decimals before they are added; smaller ones need a larger scale.
    """
    exact = F.sum(value.cast(f"decimal(28,{scale})")).cast("double")
    return F.round(F.try_divide(exact, F.count(value).cast("double")), digits)


def global_agg(df: DataFrame, mean: str, total: str, low: str, high: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("record_count"),
        exact_mean(F.col(mean)).alias("avg_value"),
        F.sum(total).alias("sum_value"),
        F.min(low).alias("min_value"),
        F.max(high).alias("max_value"),
    )


def filter_project(df: DataFrame, condition: Column, columns: Sequence[str]) -> DataFrame:
    return df.filter(condition).select(*columns)


def union_all(*parts: DataFrame) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
