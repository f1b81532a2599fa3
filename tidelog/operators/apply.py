"""Applying a change log: mirrors, history and table edits.

A log row has a key, the columns of ``order`` that rank the events of one key, and an ``op`` code.
``order`` runs from the most to the least significant column and must tell any two events of a key
apart; NULL ranks lowest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.schema import DELETE


def latest(log: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest event of every key.

    A rank filter of 1 lets Spark cut each key down to one row per input split before the shuffle,
    so a key that owns a large share of the log sends one row per task, not its whole history.
    """
    newest = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return log.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def oldest(log: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    first = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return log.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def _deleted() -> Column:
    return F.coalesce(F.col("op") == DELETE, F.lit(False))


def mirror_current(log: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table as it stands: newest event per key, without the keys whose newest is a delete."""
    return latest(log, key, order).filter(~_deleted())


def mirror_soft_delete(log: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table with deleted rows kept and flagged."""
    return latest(log, key, order).withColumn("deleted", _deleted())


def state_as_of(
    log: DataFrame, key: Sequence[str], order: Sequence[str], at, time_column: str = "event_time"
) -> DataFrame:
    """The table as it stood at ``at`` (a literal or a column), that moment included."""
    return mirror_current(log.filter(F.col(time_column) <= at), key, order)


def snapshot_then_changes(
    snapshot: DataFrame, changes: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Initial rows followed by changes. A snapshot row never outranks a change."""
    rows = snapshot.withColumn("_phase", F.lit(0)).unionByName(
        changes.withColumn("_phase", F.lit(1)), allowMissingColumns=True
    )
    return mirror_current(rows, key, ["_phase", *order]).drop("_phase")


def merge_newest(state: DataFrame, changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest event of every key in ``state`` or ``changes``, as one keyed full outer match.

    ``state`` holds one log row per key. Changes are cut to the newest per key first, so both sides
    are unique and no key can blow up the match.
    """
    new = latest(changes, key, order).select(F.struct("*").alias("_new"), *key)
    old = state.select(F.struct("*").alias("_old"), *key)
    both = old.join(new, list(key), "full_outer")

    def rank(side: str) -> Column:
        return F.struct(*[F.col(side)[c] for c in order])

    wins = F.col("_old").isNull() | (F.col("_new").isNotNull() & (rank("_new") >= rank("_old")))
    return both.select(
        *[F.when(wins, F.col("_new")[c]).otherwise(F.col("_old")[c]).alias(c) for c in state.columns]
    )


def apply_join(state: DataFrame, changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``state`` with newer ``changes`` applied and deleted rows gone."""
    return merge_newest(state, changes, key, order).filter(~_deleted())


def insert_if_absent(
    target: DataFrame, rows: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Adds the rows whose key the target lacks; among new rows of one key the first wins."""
    fresh = oldest(rows, key, order).join(target.select(*key), list(key), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def update_where(rows: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """``SET column = value WHERE condition``; an unknown condition changes nothing."""
    kinds = dict(rows.dtypes)
    return rows.select(
        *[
            F.when(condition, values[c]).otherwise(F.col(c)).cast(kinds[c]).alias(c) if c in values else F.col(c)
            for c in rows.columns
        ]
    )


def delete_where(rows: DataFrame, condition: Column) -> DataFrame:
    return rows.filter(~F.coalesce(condition, F.lit(False)))


def not_null(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which all of ``columns`` have a value."""
    return rows.dropna(how="any", subset=list(columns))


def not_null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows ``not_null`` keeps and drops, in one pass."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    return rows.agg(
        F.count_if(complete).alias("kept_rows"), F.count_if(~complete).alias("dropped_rows")
    )


def dedupe_events(log: DataFrame, key: Sequence[str], position: Sequence[str]) -> DataFrame:
    """One row for each delivered event, however often it was delivered."""
    return log.dropDuplicates([*key, *position])


def dedupe_stream(
    log: DataFrame, key: Sequence[str], position: Sequence[str], time_column: str = "event_time",
    disorder: str = "5 seconds",
) -> DataFrame:
    """Streaming form: state is kept only as long as the watermark allows duplicates to arrive."""
    return log.withWatermark(time_column, disorder).dropDuplicatesWithinWatermark([*key, *position])


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union across an added nullable column; rows from before the change read NULL."""
    return old.unionByName(new, allowMissingColumns=True)
