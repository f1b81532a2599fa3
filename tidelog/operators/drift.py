"""What messages hold against what a feed declares."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.schema import Feed, struct
from tidelog.session import materialize

AS_DECLARED, ADDED, RETYPED, DROPPED = "as_declared", "added", "retyped", "dropped"

# Kinds of a JSON value, and the kinds that a declared type takes.
NUMBER, WHOLE, TEXT, BOOLEAN, NULL = "number", "whole", "text", "boolean", "null"
OBJECT, ARRAY = "object", "array"


def _kind(value: Column) -> Column:
    """Kind of a variant, from the type that Spark gives it."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return (
        F.when(value.isNull() | (name == "VOID"), NULL)
        .when(name == "BIGINT", WHOLE)
        .when(name.isin("DECIMAL", "DOUBLE", "FLOAT"), NUMBER)
        .when(name == "STRING", TEXT)
        .when(name == "BOOLEAN", BOOLEAN)
        .when(name == "OBJECT", OBJECT)
        .otherwise(ARRAY)
    )


def _takes(kind: T.DataType) -> set[str]:
    if isinstance(kind, T.IntegralType):
        return {WHOLE}
    if isinstance(kind, T.NumericType):
        return {WHOLE, NUMBER}
    if isinstance(kind, T.BooleanType):
        return {BOOLEAN}
    if isinstance(kind, (T.StructType, T.MapType)):
        return {OBJECT}
    return {ARRAY} if isinstance(kind, T.ArrayType) else {TEXT}


def field_kinds(messages: DataFrame, path: str = "$.after", value: str = "value") -> DataFrame:
    """``field, kind, messages``: the fields of the object at ``path``, by the kind of their value.

    ``field`` NULL counts the objects. Text that is no JSON, or has no object there, counts nowhere. Fields are taken
    apart by Spark's variant type, so names need not be known, and are counted before anything is shuffled.
    """
    image = F.try_variant_get(F.try_parse_json(value), path, "variant")
    images = messages.select(image.alias("image")).where(F.schema_of_variant("image").startswith("OBJECT"))
    spark = messages.sparkSession
    fields = images.lateralJoin(spark.tvf.variant_explode(F.col("image").outer()))
    counted = fields.select(F.col("key").alias("field"), _kind(F.col("value")).alias("kind"))
    one = images.select(F.lit(None).cast("string").alias("field"), F.lit(OBJECT).alias("kind"))
    return counted.unionByName(one).groupBy("field", "kind").agg(F.count("*").alias("messages"))


def schema_drift(messages: DataFrame, feed: Feed, path: str = "$.after", value: str = "value") -> DataFrame:
    """``field, kind, status, messages``: fields as declared, added, retyped and dropped, with how many objects show it.

    A field is dropped where an object does not name it (``kind`` NULL); null is a value of any type. The kinds of a
    declared field are compared by what its type can read: a whole number is a number, but no text.
    """
    counts = materialize(field_kinds(messages, path, value), "fields")
    spark = messages.sparkSession
    declared = [(f.name, sorted(_takes(f.dataType) | {NULL})) for f in feed.row.fields]
    known = spark.createDataFrame(declared, "name string, takes array<string>")
    found = counts.where("field is not null")
    status = F.when(F.col("name").isNull(), ADDED).when(F.array_contains("takes", F.col("kind")), AS_DECLARED).otherwise(RETYPED)
    # The declaration is a list of columns in memory, as small as a table's schema.
    shown = found.join(F.broadcast(known), F.col("field") == F.col("name"), "left")
    shown = shown.select("field", "kind", status.alias("status"), "messages")
    present = found.groupBy("field").agg(F.sum("messages").alias("n"))
    objects = counts.where("field is null").agg(F.coalesce(F.sum("messages"), F.lit(0)).alias("objects"))
    absent = known.join(present, F.col("field") == F.col("name"), "left").join(F.broadcast(objects))
    gone = (F.col("objects") - F.coalesce("n", F.lit(0))).cast("long")
    dropped = absent.select(
        F.col("name").alias("field"), F.lit(None).cast("string").alias("kind"), F.lit(DROPPED).alias("status"), gone.alias("messages")
    ).where("messages > 0")
    return shown.unionByName(dropped)


# Types that added fields get; anything else is kept as text.
_TYPES = {frozenset({WHOLE}): "long", frozenset({NUMBER}): "double", frozenset({WHOLE, NUMBER}): "double", frozenset({BOOLEAN}): "boolean"}


def added_columns(drift: DataFrame, least: int = 1) -> Mapping[str, str]:
    """``{field: type}`` for fields that the feed lacks and at least ``least`` objects have.

    Fields with values of several kinds become text. What comes back is a list of columns.
    """
    added = drift.where(F.col("status") == ADDED).groupBy("field")
    kept = added.agg(F.sum("messages").alias("n"), F.collect_set("kind").alias("kinds")).where(F.col("n") >= least)
    return {r["field"]: _TYPES.get(frozenset(set(r["kinds"]) - {NULL}), "string") for r in kept.orderBy("field").collect()}


def widened(feed: Feed, columns: Mapping[str, str]) -> Feed:
    """The feed with more columns at its end; messages without them read NULL."""
    return Feed(T.StructType([*feed.row.fields, *struct(columns).fields]), feed.key, feed.rename, feed.decimals)
