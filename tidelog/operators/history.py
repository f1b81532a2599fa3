"""The history of keyed rows as intervals, and many lookups in it at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.sequences import carried
from tidelog.schema import DELETE


def validity(log: DataFrame, key: Sequence[str], order: Sequence[str], time: str = "event_time") -> DataFrame:
    """The rows of the log that a key had, with ``valid_from`` and ``valid_to`` (NULL: still valid).

    A row holds from its time until that of the key's next event; deletes end a row and are no rows. Events of one
    moment follow each other by ``order``, so all but the last hold for no time. Rows without a key are left out.
    """
    keyed = log.dropna(subset=list(key))
    ended = carried(keyed, key, order, {"valid_to": (time, "last")}, current=False, backward=True)
    return ended.where(F.col("op") != DELETE).withColumn("valid_from", F.col(time))


def lookup(
    log: DataFrame, asked: DataFrame, key: Sequence[str], order: Sequence[str], moment: str = "moment"
) -> DataFrame:
    """The rows of ``asked`` with ``found``, the log row that their key had at their ``moment``; NULL if it had none.

    Log and questions are put in one order and gone through once, so it makes no difference how many questions a
    key has, or how many events. The first of ``order`` is the event's time; an event of the very moment counts.
    """
    time, *rest = order
    row, question = F.struct(*log.columns), F.struct(*asked.columns)
    events = log.dropna(subset=[*key, time]).select(
        *key, F.col(time).alias("_at"), F.lit(0).alias("_kind"), *rest, row.alias("_row"),
    )
    questions = asked.select(*key, F.col(moment).alias("_at"), F.lit(1).alias("_kind"), F.monotonically_increasing_id().alias("_number"), question.alias("_asked"))
    both = events.unionByName(questions, allowMissingColumns=True)
    found = carried(both, key, ["_at", "_kind", *rest, "_number"], {"_found": ("_row", "last")})
    held = F.when((F.col("_found.op") != DELETE) & F.col("_at").isNotNull(), F.col("_found"))
    return found.where("_kind = 1").select("_asked.*", held.alias("found"))


def row_changes(log: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The log as signed rows: ``sign`` -1 with the row that a key had before the event, +1 with the one it has after.

    ``change`` holds the event's ``order``. The row before is the key's own previous event, so the signs of all events up
    to a moment add up to the table at that moment. A delete has no row after it, nor does its successor have one before.
    Rows without a key are left out.
    """
    rows = log.dropna(subset=list(key)).withColumn("_row", F.struct(*log.columns))
    known = carried(rows, key, order, {"_before": ("_row", "last")}, current=False)
    both = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("_before").alias("row")),
        F.struct(F.lit(1).alias("sign"), F.col("_row").alias("row")),
    )
    signed = known.select(F.struct(*order).alias("change"), F.explode(both).alias("_signed")).select("change", "_signed.*")
    return signed.where((F.col("row.op") != DELETE) | (F.col("row").isNotNull() & F.col("row.op").isNull())).select("change", "sign", "row.*")
