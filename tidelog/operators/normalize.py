"""From change rows to the typed change log, the quarantine and the row-kind view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.changes import (
    connector_decimal, from_millis, key_valid, merged, op_label, op_or, record_id, row_image,
)
from tidelog.schema import CORRUPT, CREATE, DELETE, LABELS, OPS, READ, UPDATE, Feed

IMAGES = {"column": merged, "row": row_image}


def _decoded(value: Column, column: str, feed: Feed) -> Column:
    if column not in feed.decimals:
        return value
    precision, scale = feed.decimals[column]
    return connector_decimal(value, scale, precision)


def normalize(
    changes: DataFrame,
    feed: Feed,
    ops: Sequence[str] = OPS,
    null_op_as: str | None = None,
    labels: Mapping[str, str] = LABELS,
    image: str = "column",
    record_id_from: Sequence[str] | None = None,
    null_part: str | None = None,
    carry: Mapping[str, Column] | None = None,
    processing_time: bool = True,
) -> DataFrame:
    """One typed row per event: op, operation, [record_id], the row, event_time, carried columns.

    ``ops`` keeps events with these codes; events without a code are dropped unless ``null_op_as``
    names the code to give them. ``image="column"`` merges old and new image column by column,
    ``image="row"`` takes the whole new row. ``carry`` adds expressions over the change row, such
    as the log position.
    """
    pick = IMAGES[image]
    code = F.col("op") if null_op_as is None else op_or(F.col("op"), null_op_as)
    rows = changes.filter(code.isin(*ops))
    columns = [_decoded(pick(c), c, feed).alias(feed.target(c)) for c in feed.row.names]
    out = [code.alias("op"), op_label(code, labels).alias("operation")]
    if record_id_from:
        out.append(record_id([pick(c) for c in record_id_from], null_part).alias("record_id"))
    out += columns
    out.append(from_millis(F.col("ts_ms")).alias("event_time"))
    out += [expr.alias(name) for name, expr in (carry or {}).items()]
    if processing_time:
        out.append(F.current_timestamp().alias("processing_time"))
    return rows.select(*out)


def with_reason(changes: DataFrame, feed: Feed, ops: Sequence[str] = OPS, null_op_as: str | None = None) -> DataFrame:
    """Adds ``reason``: why an event cannot be applied, NULL if it can."""
    code = F.col("op") if null_op_as is None else op_or(F.col("op"), null_op_as)
    known = F.coalesce(code.isin(*ops), F.lit(False))
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), "malformed")
        .when(~known, "unknown_op")
        .when(~key_valid(feed.key, code), "invalid_key")
    )
    return changes.withColumn("reason", reason)


def accepted(changes: DataFrame, feed: Feed, **options) -> DataFrame:
    return with_reason(changes, feed, **options).filter(F.col("reason").isNull()).drop("reason")


def quarantined(changes: DataFrame, feed: Feed, **options) -> DataFrame:
    return with_reason(changes, feed, **options).filter(F.col("reason").isNotNull())


def row_kinds(changes: DataFrame, feed: Feed, carry: Sequence[str] = ()) -> DataFrame:
    """Signed rows: c, r give +I; u gives -U and +U; d gives -D. Absent images give no row."""
    op = F.col("op")
    old_kind = F.when(op == UPDATE, "-U").when(op == DELETE, "-D")
    new_kind = F.when(op.isin(CREATE, READ), "+I").when(op == UPDATE, "+U")
    both = F.array(
        F.struct(old_kind.alias("row_kind"), F.col("before").alias("image")),
        F.struct(new_kind.alias("row_kind"), F.col("after").alias("image")),
    )
    kept = F.filter(both, lambda k: k["row_kind"].isNotNull() & k["image"].isNotNull())
    rows = changes.select(*carry, F.explode(kept).alias("_k"))
    columns = [_decoded(F.col("_k.image")[c], c, feed).alias(feed.target(c)) for c in feed.row.names]
    return rows.select(*carry, "_k.row_kind", *columns)


def signed_count(kinds: DataFrame, by: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Row count per group, and exact sums, that a signed change log adds up to."""
    sign = F.when(F.col("row_kind").startswith("+"), 1).otherwise(-1)
    totals = [F.sum(sign * F.col(c)).alias(f"sum_{c}") for c in sums]
    return kinds.groupBy(*by).agg(F.sum(sign).cast("bigint").alias("net_rows"), *totals)
