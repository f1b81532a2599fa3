"""Linking, order, checks and canonical JSON, also against a plain ordering."""

import json
import random

import pytest

from tidelog.llm import chat_tools as C

SCHEMAS = {"f": {"parameters": {"x": "integer", "y": "string"}, "required": ["x"]}}
SCHEMA = "conv_id long, turn long, kind string, call_id string, name string, body string, after array<string>, level string"


def run(spark, rows):
    return C.link_calls(spark.createDataFrame([(*r, None) for r in rows], SCHEMA), SCHEMAS).collect()


@pytest.mark.parametrize(
    "body,written,error",
    [
        ('{"y": "é", "x": 2.0, "z": null}', '{"x":2,"y":"é"}', "type:x"),
        ('{"x":1, "y":null}', '{"x":1}', None),
        ('{"y":"b"}', '{"y":"b"}', "missing:x"),
        ('{"x":true}', '{"x":true}', "type:x"),
        ('{"x":1,"q":2}', '{"q":2,"x":1}', "unknown:q"),
        ("[1]", None, "not_an_object"),
        ('{"x":NaN}', None, "bad_json"),
        (None, None, "bad_json"),
    ],
)
def test_arguments(body, written, error):
    assert C.check_arguments(body, SCHEMAS["f"]) == (written, error)


def test_unknown_tool():
    assert C.check_arguments("{}", None) == (None, "unknown_tool")


def test_links_and_order(spark):
    rows = [
        (1, 0, "system", None, None, "be kind", None),
        (1, 1, "call", "b", "f", '{"x":1}', ["a"]),
        (1, 2, "call", "a", "f", '{"x":2,"y":"s"}', []),
        (1, 3, "result", "b", None, "two", None),
        (1, 4, "result", "a", None, "one", None),
        (1, 5, "call", "a", "f", '{"x":3}', []),
        (1, 6, "result", "zz", None, "lost", None),
        (1, 7, "call", "c", "f", '{"x":4}', ["d"]),
        (1, 8, "call", "d", "f", '{"x":4}', ["c"]),
        (1, 9, "call", None, "f", '{"x":4}', None),
        (2, 0, "call", "a", "g", "{}", ["not there"]),
        (None, 0, None, None, None, None, None),
    ]
    got = run(spark, rows + rows[:2])
    assert len(got) == len(rows)
    status = {(r["conv_id"], r["turn"]): (r["step"], r["status"]) for r in got}
    assert status[1, 2] == (0, "ok") and status[1, 4] == (1, "ok") and status[1, 1] == (2, "ok") and status[1, 3] == (3, "ok")
    assert status[1, 5][1] == "repeated" and status[1, 6][1] == "no_call" and status[1, 9][1] == "unanswered"
    assert status[1, 7][1] == status[1, 8][1] == "circular" and status[2, 0] == (0, "unknown_tool")
    text = next(r["json"] for r in got if r["turn"] == 1 and r["conv_id"] == 1)
    assert text == '{"arguments":{"x":1},"after":["a"],"id":"b","name":"f"}' and json.loads(text)


@pytest.mark.parametrize("parents", [1, 3])
def test_levels_are_longest_ways(spark, parents):
    rng = random.Random(parents)
    after = {i: rng.sample(range(i), min(i, rng.randint(0, parents))) if i % 7 else [] for i in range(60)}
    rows = [(i % 2 * 0, f"c{i}", [f"c{j}" for j in own]) for i, own in after.items()]
    want = {}
    for i, own in after.items():
        want[f"c{i}"] = max((want[f"c{j}"] + 1 for j in own), default=0)
    got = C.levels(spark.createDataFrame(rows, "conv_id long, call_id string, after array<string>"))
    assert {r["call_id"]: r["level"] for r in got.collect()} == want


def test_empty(spark):
    assert run(spark, []) == []
