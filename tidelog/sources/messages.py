"""Parsers for the wire shapes of change events.

Every parser takes rows with one text column and returns *change rows*: the columns it found next
to the text, then ``before``, ``after``, ``op``, ``ts_ms``, ``source`` and ``corrupt``. ``corrupt``
holds the text of a message that did not parse; lenient parsing fills missing fields with NULL and
ignores unknown ones. A NULL message is a tombstone: parsers skip it.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.schema import CORRUPT, DELETE, ORIGIN, Feed


def _once(value: Column, name: str, where: Column) -> Column:
    """``value`` as column ``name`` of the rows with ``where``, computed once per row.

    Spark moves a filter below a projection by repeating the projected expression in the filter,
    which would parse every message again for each condition on its fields, and repeat whatever made
    the message for the condition on the message. It moves nothing below a generator, and a
    generator gives no row for NULL.
    """
    return F.inline(F.when(where, F.array(F.struct(value.alias(name)))))


def _decoded(messages: DataFrame, schema: T.StructType, column: str, strict: bool) -> DataFrame:
    text = F.col(column)
    if strict:
        parsed = F.from_json(text, schema, {"mode": "FAILFAST"})
    else:
        lenient = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        parsed = F.from_json(text, lenient, options)
    rows = messages.select(*_carried(messages, column), _once(parsed, "_m", text.isNotNull()))
    corrupt = F.lit(None).cast("string") if strict else F.col(f"_m.{CORRUPT}")
    return rows.withColumn(CORRUPT, corrupt)


def _carried(messages: DataFrame, column: str) -> list[str]:
    return [c for c in messages.columns if c != column]


def parse_envelope(messages: DataFrame, feed: Feed, column: str = "value", strict: bool = False) -> DataFrame:
    """``{"before": …, "after": …, "op": …, "ts_ms": …, "source": …}``"""
    rows = _decoded(messages, feed.envelope, column, strict)
    return rows.select(
        *_carried(messages, column), "_m.before", "_m.after", "_m.op", "_m.ts_ms", "_m.source", CORRUPT
    )


def parse_wrapped(messages: DataFrame, feed: Feed, column: str = "value", strict: bool = False) -> DataFrame:
    """An envelope below ``payload``."""
    rows = _decoded(messages, feed.wrapped, column, strict)
    parts = [f"_m.payload.{c}" for c in ("before", "after", "op", "ts_ms", "source")]
    return rows.select(*_carried(messages, column), *parts, CORRUPT)


def _origin(**known: Column) -> Column:
    return F.struct(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ORIGIN.fields]
    )


def _image(feed: Feed, pick, present: Column | None = None) -> Column:
    """A row image from loose columns; NULL where ``present`` fails or every column is NULL."""
    columns = {name: pick(name) for name in feed.row.names}
    filled = reduce(or_, [c.isNotNull() for c in columns.values()])
    cond = filled if present is None else filled & present
    return F.when(cond, F.struct(*[c.alias(n) for n, c in columns.items()]))


def parse_flat(messages: DataFrame, feed: Feed, column: str = "value", strict: bool = False) -> DataFrame:
    """Unwrapped rows: table columns next to ``__op``, ``__source_ts_ms`` and ``__source_db``.

    Deletes come rewritten, as the last row with ``__deleted`` true; their row is the old image.
    """
    rows = _decoded(messages, feed.flat, column, strict)
    deleted = F.coalesce(F.lower(F.col("_m.__deleted")) == "true", F.lit(False)) | F.coalesce(
        F.col("_m.__op") == DELETE, F.lit(False)
    )
    pick = lambda name: F.col("_m")[name]
    source = _origin(
        ts_ms=F.col("_m.__source_ts_ms"), db=F.col("_m.__source_db"), lsn=F.col("_m.__source_lsn")
    )
    return rows.select(
        *_carried(messages, column),
        _image(feed, pick, deleted).alias("before"),
        _image(feed, pick, ~deleted).alias("after"),
        F.when(deleted, F.lit(DELETE)).otherwise(F.col("_m.__op")).alias("op"),
        F.col("_m.__source_ts_ms").alias("ts_ms"),
        source.alias("source"),
        CORRUPT,
    )


def from_prefixed(rows: DataFrame, feed: Feed) -> DataFrame:
    """Change rows from ``before_x`` and ``after_x`` columns."""
    loose = {f"{side}_{name}" for side in ("before", "after") for name in feed.row.names}
    lsn = F.col("lsn") if "lsn" in rows.columns else F.lit(None)
    rest = [c for c in rows.columns if c not in loose | {"op", "ts_ms", "lsn", CORRUPT}]
    corrupt = F.col(CORRUPT) if CORRUPT in rows.columns else F.lit(None).cast("string")
    return rows.select(
        *rest,
        _image(feed, lambda n: F.col(f"before_{n}")).alias("before"),
        _image(feed, lambda n: F.col(f"after_{n}")).alias("after"),
        "op",
        "ts_ms",
        _origin(lsn=lsn).alias("source"),
        corrupt.alias(CORRUPT),
    )


def parse_prefixed(messages: DataFrame, feed: Feed, column: str = "value", strict: bool = False) -> DataFrame:
    """Messages whose images are flattened into ``before_x`` and ``after_x`` fields."""
    rows = _decoded(messages, feed.prefixed, column, strict)
    flat = rows.select(*_carried(messages, column), "_m.*") if strict else rows.select(
        *_carried(messages, column), *[F.col("_m")[n].alias(n) for n in feed.prefixed.names], CORRUPT
    )
    return from_prefixed(flat, feed)


PARSERS = {
    "envelope": parse_envelope,
    "wrapped": parse_wrapped,
    "flat": parse_flat,
    "prefixed": parse_prefixed,
}


def json_paths(
    messages: DataFrame,
    paths: Mapping[str, tuple[str, str]],
    require: str | None = None,
    column: str = "value",
) -> DataFrame:
    """Single values out of raw text: ``{name: (path, type)}``; bad values become NULL.

    The text is parsed once into a variant however many paths are read. ``require`` names the
    output column that must not be NULL.
    """
    others = _carried(messages, column)
    parsed = messages.select(*others, _once(F.try_parse_json(F.col(column)), "_v", F.lit(True)))
    found = parsed.select(
        *others, *[F.try_variant_get("_v", path, kind).alias(name) for name, (path, kind) in paths.items()]
    )
    return found if require is None else found.filter(F.col(require).isNotNull())


def raw(messages: DataFrame, column: str = "value") -> DataFrame:
    """The text as it came, with the time it was handled."""
    return messages.select(F.col(column).alias("raw_message"), F.current_timestamp().alias("processing_time"))


def to_envelope(changes: DataFrame, ignore_null: bool = True) -> Column:
    """Change rows back to envelope text."""
    parts = [c for c in ("before", "after", "op", "ts_ms", "source") if c in changes.columns]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": str(ignore_null).lower()})
