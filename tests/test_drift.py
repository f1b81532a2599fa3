"""Drift of message fields against planted messages."""

import json

from tidelog.operators import drift
from tidelog.schema import Feed
from tidelog.sources.messages import parse_envelope

FEED = Feed.of({"id": "long", "name": "string", "size": "double", "open": "boolean"}, key=("id",))


def found(spark, images, feed=FEED):
    texts = [(i if isinstance(i, str) or i is None else json.dumps({"after": i, "op": "c"}),) for i in images]
    return spark.createDataFrame(texts, "value string"), {
        (r["field"], r["kind"], r["status"]): r["messages"]
        for r in drift.schema_drift(spark.createDataFrame(texts, "value string").repartition(3), feed).collect()
    }


def test_added_dropped_and_retyped_fields(spark):
    whole = {"id": 1, "name": "a", "size": 1.5, "open": True}
    images = [whole] * 5
    images += [{**whole, "size": 2}, {**whole, "size": None}, {**whole, "id": "x"}, {**whole, "open": "yes"}]
    images += [{**whole, "tags": [1]}, {**whole, "more": {"a": 1}}, {**whole, "level": 3}, {**whole, "level": 4.5}, {**whole, "level": None}]
    images += [{"id": 2}, {}, "no json", None, '{"after": null}', '{"after": 3}', '{"op": "d"}']
    _, got = found(spark, images)
    assert got == {
        ("id", "whole", "as_declared"): 14,
        ("id", "text", "retyped"): 1,
        ("id", None, "dropped"): 1,
        ("name", "text", "as_declared"): 14,
        ("name", None, "dropped"): 2,
        ("size", "number", "as_declared"): 12,
        ("size", "whole", "as_declared"): 1,
        ("size", "null", "as_declared"): 1,
        ("size", None, "dropped"): 2,
        ("open", "boolean", "as_declared"): 13,
        ("open", "text", "retyped"): 1,
        ("open", None, "dropped"): 2,
        ("tags", "array", "added"): 1,
        ("more", "object", "added"): 1,
        ("level", "whole", "added"): 1,
        ("level", "number", "added"): 1,
        ("level", "null", "added"): 1,
    }


def test_no_messages(spark):
    assert found(spark, [None])[1] == {}


def test_a_widened_feed_reads_added_fields(spark):
    texts, _ = found(spark, [{"id": 1, "level": 3, "note": "n"}, {"id": 2, "level": 4, "flag": True}, {"id": 3, "note": 5}])
    columns = drift.added_columns(drift.schema_drift(texts, FEED))
    assert columns == {"flag": "boolean", "level": "long", "note": "string"}
    assert drift.added_columns(drift.schema_drift(texts, FEED), least=2) == {"level": "long", "note": "string"}
    wide = drift.widened(FEED, columns)
    rows = {r["id"]: r for r in parse_envelope(texts, wide).select("after.*").collect()}
    assert (rows[1]["level"], rows[2]["flag"], rows[3]["note"], rows[3]["level"]) == (3, True, "5", None)
