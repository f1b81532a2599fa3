"""Tool calls of conversations: linked to their results, ordered, checked and written as canonical JSON.

Messages are rows ``conv_id, turn, kind, call_id, name, body, after``: a ``call`` has the tool's name, arguments as JSON and
the ids of the calls whose results it uses; a ``result`` has the id of its call; other kinds are plain messages. All
steps are joins and groups, so a conversation with a third of all rows is spread over tasks like any other.

* Link: calls and results are joined by conversation and identifier. Of several calls with one identifier the first by
  turn holds, the others are ``repeated``; of several results all are kept.
* Order: a call stands after the calls that it names in ``after``, a result after its call; otherwise turns decide. The
  level of a call is the longest way to it. Calls on a circle, or behind one, have no level and are ``circular``.
* Check: arguments must be a JSON object with the parameters that the tool's schema requires, of its types, and no others.
* Write: keys in order, no white space, null values left out.
"""

from __future__ import annotations

import json
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.session import materialize

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list}


def canonical(value) -> str:
    """JSON with sorted keys, without white space and without null members."""
    if isinstance(value, dict):
        value = {k: v for k, v in value.items() if v is not None}
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float) and value.is_integer() and abs(value) < 1 << 53:
        value = int(value)
    return json.dumps(value, ensure_ascii=False, allow_nan=False)


def check_arguments(body: str | None, schema: dict | None) -> tuple[str | None, str | None]:
    """Canonical arguments and what is wrong with them, if anything."""
    if schema is None:
        return None, "unknown_tool"
    try:
        value = json.loads(body or "", parse_constant=lambda _: 1 / 0)
        if not isinstance(value, dict):
            return None, "not_an_object"
        written = canonical(value)
    except (ValueError, ZeroDivisionError, RecursionError):
        return None, "bad_json"
    known = schema["parameters"]
    if missing := sorted(set(schema.get("required", ())) - {k for k, v in value.items() if v is not None}):
        return written, f"missing:{missing[0]}"
    for name in sorted(value):
        if name not in known:
            return written, f"unknown:{name}"
        kind = _TYPES[known[name]]
        given = value[name]
        if given is not None and (not isinstance(given, kind) or isinstance(given, bool) and known[name] != "boolean"):
            return written, f"type:{name}"
    return written, None


def _check(batches, schemas: dict):
    for batch in batches:
        found = [
            check_arguments(body, schemas.get(name))
            for name, body in zip(batch.column("name").to_pylist(), batch.column("body").to_pylist())
        ]
        rest = [batch.column(n) for n in batch.schema.names if n != "body"]
        columns = [*rest, pa.array([a for a, _ in found], pa.string()), pa.array([e for _, e in found], pa.string())]
        yield pa.record_batch(columns, [*(n for n in batch.schema.names if n != "body"), "arguments", "error"])


def levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` for the calls that are on no circle and behind none; others are absent.

    ``calls`` has ``conv_id, call_id, after``; names of calls that are not there are no reason to wait. Where no call waits
    for more than one, ways are doubled each round (about log2 of the longest); otherwise a round takes away the calls
    that wait for none that is left, so there are as many rounds as levels.
    """
    calls = materialize(calls.select("conv_id", "call_id", "after"), "calls")
    named = calls.select("conv_id", "call_id", F.explode("after").alias("first")).where("first is not null").distinct()
    heads = calls.select("conv_id", F.col("call_id").alias("first"))
    edges = materialize(named.join(heads, ["conv_id", "first"]), "waits")
    single = edges.groupBy("conv_id", "call_id").agg(F.count("*").alias("n"), F.min("first").alias("to"))
    if single.where("n > 1").limit(1).count() == 0:
        return _chains(calls, single)
    done = calls.join(edges.select("conv_id", "call_id").distinct(), ["conv_id", "call_id"], "left_anti")
    done = materialize(done.select("conv_id", "call_id", F.lit(0).alias("level")), "level")
    left, level, every = edges, 0, [done]
    while True:
        gone = done.select("conv_id", F.col("call_id").alias("first"))
        waiting = left.select("conv_id", "call_id").distinct()
        left = materialize(left.join(gone, ["conv_id", "first"], "left_anti"), "waits")
        level += 1
        free = waiting.join(left.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")
        done = materialize(free.select("conv_id", "call_id", F.lit(level).alias("level")), "level")
        if not done.limit(1).count():
            break
        every.append(done)
    found = every[0]
    for more in every[1:]:
        found = found.unionAll(more)
    return found


def _chains(calls: DataFrame, single: DataFrame) -> DataFrame:
    """Levels where every call waits for one call at most, by pointer doubling."""
    now = calls.select("conv_id", "call_id").join(single.select("conv_id", "call_id", "to"), ["conv_id", "call_id"], "left")
    now = now.withColumn("level", F.when(F.col("to").isNull(), 0).otherwise(1).cast("long"))
    now = materialize(now, "chains")
    most = calls.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(int(most).bit_length() + 1):
        if not now.where("to is not null").limit(1).count():
            break
        there = now.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("level").alias("more"))
        step = now.join(there, ["conv_id", "to"], "left")
        level = F.col("level") + F.coalesce("more", F.lit(0))
        now = materialize(step.select("conv_id", "call_id", F.col("next").alias("to"), level.alias("level")), "chains")
    return now.where("to is null").select("conv_id", "call_id", F.col("level").cast("int").alias("level"))


def link_calls(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``conv_id, step, turn, kind, call_id, status, json`` for every distinct message; its place is by ``step, turn``.

    ``step`` is twice the level of the message's call, and one more for a result. ``status`` is ``ok``,
    ``repeated``, ``circular``, ``unanswered``, ``no_call`` or what is wrong with the arguments. Plain messages and those
    whose call has no level take level 0. A null conversation is one of its own; a null identifier links nothing.
    """
    columns = ["conv_id", "turn", "kind", "call_id", "name", "body", "after"]
    one = messages.select(*columns).dropDuplicates()
    one = materialize(one.withColumn("conv_id", F.coalesce("conv_id", F.lit(-(1 << 63)))), "messages")
    isolated = ["conv_id", "call_id"]
    call = one.where("kind = 'call'")
    first = call.where("call_id is not null").groupBy(isolated).agg(F.min(F.struct("turn", "name", "body", "after")).alias("c"))
    first = materialize(first.select("conv_id", "call_id", "c.*"), "first")
    level = levels(first)
    answered = one.where("kind = 'result'").select(isolated).distinct().withColumn("answered", F.lit(True))
    kept = first.select("conv_id", "call_id", F.struct("turn", "name", "body", "after").alias("own"))
    same = call.join(kept, isolated, "left").join(level, isolated, "left").join(answered, isolated, "left")
    repeated = ~F.struct("turn", "name", "body", "after").eqNullSafe(F.col("own"))
    calls = same.select(*columns, "level", repeated.alias("repeated"), F.coalesce("answered", F.lit(False)).alias("answered"))
    schema = "conv_id long, turn long, kind string, call_id string, name string, after array<string>, level int, repeated boolean, answered boolean, arguments string, error string"
    checked = calls.mapInArrow(partial(_check, schemas=schemas), schema)
    status = (
        F.when(F.col("repeated") & F.col("call_id").isNotNull(), "repeated")
        .when(F.col("call_id").isNotNull() & F.col("level").isNull(), "circular")
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(~F.col("answered"), "unanswered")
        .otherwise("ok")
    )
    body = F.to_json(F.struct(F.sort_array(F.coalesce("after", F.array())).alias("after"), F.col("call_id").alias("id"), "name"))
    written = F.concat(F.lit('{"arguments":'), F.coalesce("arguments", F.lit("{}")), F.lit(","), F.substring(body, 2, 1 << 30))
    out_calls = checked.select("conv_id", (2 * F.coalesce("level", F.lit(0))).alias("step"), "turn", "kind", "call_id", status.alias("status"), written.alias("json"))
    results = one.where("kind = 'result'").join(first.select(*isolated, F.lit(True).alias("called")), isolated, "left").join(level, isolated, "left")
    said = F.to_json(F.struct(F.col("body").alias("content"), F.col("call_id").alias("id")))
    out_results = results.select(
        "conv_id", (2 * F.coalesce("level", F.lit(0)) + 1).alias("step"), "turn", "kind", "call_id",
        F.when(F.col("called"), "ok").otherwise("no_call").alias("status"), said.alias("json"),
    )
    plain = one.where("kind is null or kind not in ('call', 'result')")
    out_plain = plain.select("conv_id", F.lit(0).alias("step"), "turn", "kind", "call_id", F.lit("ok").alias("status"), F.to_json(F.struct(F.col("body").alias("content"), F.col("kind").alias("role"))).alias("json"))
    everything = out_calls.unionAll(out_results).unionAll(out_plain)
    conv = F.when(F.col("conv_id") != -(1 << 63), F.col("conv_id"))
    return everything.select(
        conv.alias("conv_id"), F.col("step").cast("int").alias("step"), F.col("turn").cast("long").alias("turn"),
        "kind", "call_id", "status", "json",
    )


# Tools of the registered query: parameters by type, and those that a call must have.
SCHEMAS = {
    "search": {"parameters": {"query": "string", "limit": "integer"}, "required": ["query"]},
    "count": {"parameters": {"text": "string", "words": "integer"}, "required": ["text", "words"]},
}


def conversation_messages(turns: DataFrame) -> DataFrame:
    """Turns of plain conversations as tool messages: what the user says is a call, and what follows its result.

    A call waits for the user's turn before. Its text chooses the tool and the form of the arguments, so that some
    calls name an unknown tool and some give a parameter of the wrong type.
    """
    user, turn = F.col("role") == "user", F.col("turn")
    name = F.when(~F.col("text").contains("."), "lookup").when(F.col("text").contains("\n"), "count").otherwise("search")
    words = F.size(F.split("text", r"\s+"))
    count = F.when(F.length("text") % 5 == 0, F.to_json(F.struct("text", words.cast("string").alias("words"))))
    count = F.coalesce(count, F.to_json(F.struct("text", words.alias("words"))))
    search = F.to_json(F.struct(F.col("text").alias("query"), turn.alias("limit")))
    kind = F.when(user, "call").when(F.col("role") == "assistant", "result").otherwise(F.col("role"))
    call = F.when(user, turn).when(F.col("role") == "assistant", turn - 1)
    return turns.select(
        "conv_id",
        "turn",
        kind.alias("kind"),
        F.concat(F.lit("c"), call.cast("string")).alias("call_id"),
        F.when(user, name).alias("name"),
        F.when(user & (name == "count"), count).when(user, search).otherwise(F.col("text")).alias("body"),
        F.when(user & (turn > 1), F.array(F.concat(F.lit("c"), (turn - 2).cast("string")))).otherwise(F.array().cast("array<string>")).alias("after"),
    )
