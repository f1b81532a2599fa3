"""Wire shapes, one message per case."""

import json

import pytest
from pyspark.sql import functions as F

from tidelog.operators.normalize import accepted, normalize, quarantined, row_kinds, with_reason
from tidelog.schema import DEMOGRAPHICS, LABELS_SQL, Feed
from tidelog.sources import messages as m

FEED = Feed.of({"id": "long", "x": "long", "name": "string"}, key=("id",), rename={"name": "title"})
NEW = {"id": 1, "x": 5, "name": "new"}
OLD = {"id": 1, "x": 4, "name": "old"}

CASES = {
    "snapshot": {"before": None, "after": NEW, "op": "r"},
    "create": {"before": None, "after": NEW, "op": "c"},
    "update": {"before": OLD, "after": NEW, "op": "u"},
    "update without old": {"before": None, "after": NEW, "op": "u"},
    "update to null": {"before": OLD, "after": {"id": 1, "x": None, "name": "new"}, "op": "u"},
    "delete": {"before": OLD, "after": None, "op": "d"},
    "delete without key": {"before": None, "after": None, "op": "d"},
    "unknown op": {"before": None, "after": NEW, "op": "t"},
    "no op": {"before": None, "after": NEW},
    "extra field": {"before": None, "after": {**NEW, "more": 1}, "op": "c", "transaction": "t1"},
    "bad type": {"before": {"id": "x", "x": 4, "name": "old"}, "after": None, "op": "d"},
}


def envelopes(spark, cases=CASES):
    rows = [(name, json.dumps({"ts_ms": 1718000000123, "source": {"lsn": 7}, **body})) for name, body in cases.items()]
    rows += [("garbage", "not json"), ("tombstone", None)]
    return spark.createDataFrame(rows, "case STRING, value STRING")


@pytest.fixture(scope="module")
def parsed(spark):
    return m.parse_envelope(envelopes(spark), FEED)


def test_operations_and_images(parsed):
    log = normalize(parsed, FEED, carry={"case": F.col("case")}, null_op_as=None)
    got = {r["case"]: (r["operation"], r["id"], r["x"], r["title"]) for r in log.collect()}
    assert got["snapshot"] == ("READ", 1, 5, "new")
    assert got["create"] == got["extra field"] == ("CREATE", 1, 5, "new")
    assert got["update"] == got["update without old"] == ("UPDATE", 1, 5, "new")
    assert got["update to null"] == ("UPDATE", 1, 4, "new")
    assert got["delete"] == ("DELETE", 1, 4, "old")
    assert not {"no op", "unknown op", "garbage", "tombstone"} & set(got)


def test_row_image_keeps_an_update_to_null(parsed):
    log = normalize(parsed.filter("case = 'update to null'"), FEED, image="row")
    assert log.first()["x"] is None


def test_missing_op_can_get_a_default(parsed):
    log = normalize(parsed, FEED, null_op_as="c", labels=LABELS_SQL, carry={"case": F.col("case")})
    got = {r["case"]: r["operation"] for r in log.collect()}
    assert got["no op"] == "INSERT" and got["snapshot"] == "SNAPSHOT"


def test_times(parsed):
    row = normalize(parsed.filter("case = 'create'"), FEED).select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("t"),
        (F.col("processing_time") >= F.lit("2024-01-01").cast("timestamp")).alias("now"),
    ).first()
    assert (row["t"], row["now"]) == ("2024-06-10 06:13:20.123", True)


def test_quarantine_reasons(parsed):
    got = {r["case"]: r["reason"] for r in with_reason(parsed, FEED).collect()}
    assert got["garbage"] == got["bad type"] == "malformed"
    assert got["unknown op"] == got["no op"] == "unknown_op"
    assert got["delete without key"] == "invalid_key"
    assert "tombstone" not in got
    fine = {c for c, reason in got.items() if reason is None}
    assert {r["case"] for r in accepted(parsed, FEED).collect()} == fine
    assert {r["case"] for r in quarantined(parsed, FEED).collect()} == set(got) - fine


def test_a_bad_field_leaves_the_others(parsed):
    row = parsed.filter("case = 'bad type'").first()
    assert row["before"]["id"] is None and row["before"]["x"] == 4 and row["corrupt"]


def test_row_kinds(parsed):
    rows = row_kinds(parsed, FEED, carry=["case"]).collect()
    got = {}
    for r in rows:
        got.setdefault(r["case"], []).append((r["row_kind"], r["x"]))
    assert got["snapshot"] == got["create"] == [("+I", 5)]
    assert got["update"] == [("-U", 4), ("+U", 5)]
    assert got["update without old"] == [("+U", 5)]
    assert got["delete"] == [("-D", 4)]
    assert "delete without key" not in got


def test_strict_parsing_fails_on_garbage(spark):
    with pytest.raises(Exception, match="(?i)malformed"):
        m.parse_envelope(envelopes(spark), FEED, strict=True).collect()


def test_wrapped(spark):
    text = json.dumps({"schema": {}, "payload": {"before": OLD, "after": NEW, "op": "u", "ts_ms": 5}})
    row = m.parse_wrapped(spark.createDataFrame([(text,)], "value STRING"), FEED).first()
    assert (row["before"]["x"], row["after"]["x"], row["op"], row["ts_ms"]) == (4, 5, "u", 5)


def test_flat_deletes_and_defaults(spark):
    rows = [
        json.dumps({**NEW, "__op": "c", "__source_ts_ms": 9, "__source_db": "app"}),
        json.dumps({**NEW}),
        json.dumps({**OLD, "__op": "d", "__deleted": "true"}),
        None,
    ]
    parsed = m.parse_flat(spark.createDataFrame([(r,) for r in rows], "value STRING"), FEED)
    got = [(r["op"], r["before"] and r["before"]["x"], r["after"] and r["after"]["x"]) for r in parsed.collect()]
    assert got == [("c", None, 5), (None, None, 5), ("d", 4, None)]
    log = normalize(parsed, FEED, ops=("c", "u", "d"), null_op_as="u", image="row")
    assert [r["operation"] for r in log.collect()] == ["CREATE", "UPDATE", "DELETE"]


def test_prefixed(spark):
    rows = [
        json.dumps({"after_id": 1, "after_x": 5, "op": "c", "ts_ms": 3, "lsn": 8}),
        json.dumps({"before_id": 1, "before_x": 4, "op": "d", "ts_ms": 4}),
    ]
    got = m.parse_prefixed(spark.createDataFrame([(r,) for r in rows], "value STRING"), FEED).collect()
    assert got[0]["before"] is None and got[0]["after"]["x"] == 5 and got[0]["source"]["lsn"] == 8
    assert got[1]["after"] is None and got[1]["before"]["x"] == 4


def test_prefixed_columns_without_text(spark):
    ddl = "before_id LONG, before_x LONG, before_name STRING, after_id LONG, after_x LONG, after_name STRING, op STRING, ts_ms LONG"
    rows = spark.createDataFrame([(None, None, None, 1, 5, "n", "c", 2)], ddl)
    row = m.from_prefixed(rows, FEED).first()
    assert row["before"] is None and row["after"]["name"] == "n"


def test_json_paths(spark):
    texts = [json.dumps({"after": {"id": "12", "age": "x"}}), "garbage", json.dumps({"after": {}}), None]
    messages = spark.createDataFrame([(t,) for t in texts], "value STRING")
    paths = {"id": ("$.after.id", "bigint"), "age": ("$.after.age", "int")}
    assert [tuple(r) for r in m.json_paths(messages, paths, require="id").collect()] == [(12, None)]
    assert m.json_paths(messages, paths).count() == 4


def test_raw(spark):
    row = m.raw(spark.createDataFrame([("hello",)], "value STRING")).first()
    assert row["raw_message"] == "hello" and row["processing_time"] is not None


def test_feed_rejects_unknown_columns():
    with pytest.raises(ValueError, match="rename"):
        Feed.of({"id": "long"}, rename={"population_count": "n"})
    with pytest.raises(ValueError, match="key"):
        Feed.of({"id": "long"}, key=("other",))
    with pytest.raises(ValueError, match="same name"):
        Feed.of({"id": "long", "x": "long"}, rename={"x": "id"})


def test_demographics_reads_the_renamed_count(spark):
    row = {"city": "A", "state": "S", "race": "R", "count": 12, "median_age": 35.5}
    text = json.dumps({"before": None, "after": row, "op": "c", "ts_ms": 0})
    parsed = m.parse_envelope(spark.createDataFrame([(text,)], "value STRING"), DEMOGRAPHICS)
    log = normalize(parsed, DEMOGRAPHICS, record_id_from=("city", "state"))
    got = log.first()
    assert (got["population_count"], got["record_id"], got["median_age"]) == (12, "A_S", 35.5)
    assert len(log.columns) == 17 and DEMOGRAPHICS.target_key == ("city", "state", "race")


def test_parsing_happens_once_per_row(spark, parsed, capsys):
    normalize(parsed, FEED).filter("x > 1").explain()
    plan = capsys.readouterr().out
    assert plan.count("from_json(") == 1 and "Generate" in plan
