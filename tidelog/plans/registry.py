"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.session import pin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def zoneless(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock timestamps, the form in which the driver tables hold time."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in df.schema.fields
        ]
    )


def query(sql: str | None = None, name: str | None = None):
    """Registers a function under its name, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        label = name or fn.__name__

        @wraps(fn)
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            return zoneless(fn(pin(spark), folder.rstrip("/")))

        QUERIES[label] = prepared
        if sql is not None:
            ORACLES[label] = sql.strip()
        return fn

    return register
