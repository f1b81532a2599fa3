"""Running values over a whole table in order, for keys of any size.

Rows are dealt by range over key and order and written once, so a key with a third of the rows spreads over many
ranges. In a range the running value is a window's; what the ranges before hold of the same key comes from a table with
one row per range. No task sees more than a range, and no key is held in one place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import materialize

PART = "_part"

# How values run, and how a later one goes with those before.
_OVER = {"last": lambda c: F.last(c, ignorenulls=True), "max": F.max, "sum": F.sum}
_WITH = {
    "last": lambda here, before: F.coalesce(here, before),
    "max": lambda here, before: F.greatest(here, before),
    "sum": lambda here, before: F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0)),
}


def in_order(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows in ranges of key and order, numbered by ``_part``."""
    dealt = rows.repartitionByRange(*[F.col(c) for c in (*keys, *order)])
    return materialize(dealt.withColumn(PART, F.spark_partition_id()), "in-order")


def carried(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, tuple[str, str]],
    current: bool = True, backward: bool = False,
) -> DataFrame:
    """Adds ``{name: (column, how)}``: the ``last`` value that is not null, the ``max`` or the ``sum`` so far.

    So far is all rows of the same key up to this one in ``order``, or before it unless ``current``; from the end with
    ``backward``. ``order`` must tell the rows of a key apart. A NULL key is a key, NULL comes first in order. Names
    with a leading underscore are used inside.
    """
    placed = in_order(rows, keys, order)
    sorting = [F.col(c).desc() if backward else F.col(c).asc() for c in order]
    window = Window.partitionBy(PART, *keys).orderBy(*sorting).rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    key = F.struct(F.lit(0), *[F.col(c) for c in keys])
    first, last = (F.max, F.min) if backward else (F.min, F.max)
    ends = placed.groupBy(PART).agg(first(key).alias("_first"), last(key).alias("_last"))
    # What each range holds of the key that may go on in the next one.
    place = F.struct(*[F.col(c) for c in order])
    newest = F.min_by if backward else F.max_by

    def summed(column: str, how: str) -> Column:
        if how != "last":
            return _OVER[how](column)
        return newest(column, F.when(F.col(column).isNotNull(), place))

    open_keys = ends.select(F.col(PART).alias("_p"), F.col("_last").alias("_key"))
    going = placed.join(open_keys, (F.col(PART) == F.col("_p")) & key.eqNullSafe(F.col("_key")))
    tails = going.groupBy(PART, "_key").agg(*[summed(c, how).alias(f"_{n}") for n, (c, how) in values.items()])
    heads = ends.select(PART, F.col("_first").alias("_key"), F.lit(0).alias("_kind"))
    both = tails.withColumn("_kind", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    parts = F.col(PART).desc() if backward else F.col(PART).asc()
    # One row per range and kind.
    before = Window.partitionBy("_key").orderBy(parts, "_kind").rowsBetween(Window.unboundedPreceding, -1)
    carry = both.select(PART, "_key", "_kind", *[_OVER[how](f"_{n}").over(before).alias(f"_{n}") for n, (_, how) in values.items()])
    carry = carry.where("_kind = 0").select(F.col(PART).alias("_p"), "_key", *[f"_{n}" for n in values])
    here = placed.select("*", *[_OVER[how](c).over(window).alias(f"_here_{n}") for n, (c, how) in values.items()])
    joined = here.join(carry, (F.col(PART) == F.col("_p")) & key.eqNullSafe(F.col("_key")), "left")
    made = [_WITH[how](F.col(f"_here_{n}"), F.col(f"_{n}")).alias(n) for n, (_, how) in values.items()]
    return joined.select(*rows.columns, *made)
