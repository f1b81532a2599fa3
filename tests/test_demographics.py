"""The city table end to end: insert, update, three inserts, delete; then the analytic queries on the mirror."""

import base64
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidelog.functions.rules import bands, or_default, percent
from tidelog.operators import analytics, apply, observe, quality, ranking, reconcile
from tidelog.operators.normalize import accepted, normalize, quarantined
from tidelog.schema import DEMOGRAPHICS, DEMOGRAPHICS_ENCODED, Feed
from tidelog.sources.messages import parse_envelope, parse_flat
from tidelog.sources.readers import message_stream
from tidelog.streaming import runner
from tidelog.streaming.mirror_table import MirrorTable

KEY, ORDER = ["city", "state", "race"], ["event_time", "lsn"]


def city(name, state, age, male, female, race="White", count=100, **more):
    total = None if male is None else male + female
    return {
        "city": name, "state": state, "median_age": age, "male_population": male, "female_population": female,
        "total_population": total, "number_of_veterans": 10, "foreign_born": 20, "average_household_size": 2.5,
        "state_code": state[:2].upper(), "race": race, "count": count, **more,
    }


ONE = city("Quill Harbor", "Ostmark", 36.25, 1000, 1200)
TWO = {**ONE, "total_population": 3200, "median_age": 37.5}
OTHERS = [
    city("A", "North", 29.0, 400, 500), city("B", "North", 41.0, 600, 600, race="Asian"),
    city("B", "North", 41.0, 600, 600, race="White"), city("C", "South", 130.0, 0, 0), city("D", "South", None, None, None),
]
EVENTS = (
    [("r", None, ONE), ("u", ONE, TWO)] + [("c", None, c) for c in OTHERS]
    + [("c", None, city("Gone", "South", 50.0, 1, 1)), ("d", city("Gone", "South", 50.0, 1, 1), None)]
    + [("d", None, None)]
)


def message(op, before, after, lsn):
    return json.dumps({"before": before, "after": after, "op": op, "ts_ms": 1_718_000_000_000 + lsn, "source": {"lsn": lsn}})


@pytest.fixture(scope="module")
def texts():
    return [message(op, b, a, i) for i, (op, b, a) in enumerate(EVENTS)]


def change_log(changes, feed=DEMOGRAPHICS):
    return normalize(
        accepted(changes, feed), feed, image="row", record_id_from=("city", "state"), null_part="unknown",
        carry={"lsn": F.col("source.lsn")},
    )


@pytest.fixture(scope="module")
def mirror(spark, texts):
    changes = parse_envelope(spark.createDataFrame([(t,) for t in texts], "value STRING"), DEMOGRAPHICS)
    return apply.mirror_current(change_log(changes), KEY, ORDER).cache()


def test_stream_gives_the_same_mirror(spark, tmp_path, texts, mirror):
    (tmp_path / "in").mkdir()
    for i in range(0, len(texts), 4):
        (tmp_path / "in" / f"{i:02d}.txt").write_text("\n".join(texts[i : i + 4]))
    changes = parse_envelope(message_stream(spark, f"{tmp_path}/in", 1).select("value"), DEMOGRAPHICS)
    log = change_log(changes).drop("processing_time")
    table = MirrorTable(spark, f"{tmp_path}/m", log.schema, KEY, ORDER)
    runner.run(log, table.each_batch(fold_every=2), f"{tmp_path}/cp")
    assert reconcile.reconcile_diff(mirror, table.current(), KEY, ["total_population", "median_age", "lsn"]).count() == 0


def test_the_event_without_a_key_is_set_aside(spark, texts):
    changes = parse_envelope(spark.createDataFrame([(t,) for t in texts], "value STRING"), DEMOGRAPHICS)
    assert [r["reason"] for r in quarantined(changes, DEMOGRAPHICS).collect()] == ["invalid_key"]


def test_rows_and_ids(mirror):
    rows = {r["record_id"]: r for r in mirror.filter("race = 'White'").collect()}
    assert set(rows) == {"Quill Harbor_Ostmark", "A_North", "B_North", "C_South", "D_South"}
    one = rows["Quill Harbor_Ostmark"]
    assert (one["operation"], one["total_population"], one["median_age"], one["population_count"]) == ("UPDATE", 3200, 37.5, 100)


def test_encoded_decimals(spark):
    def encode(cents):
        return base64.b64encode(cents.to_bytes(2, "big", signed=True)).decode()

    row = {**ONE, "median_age": encode(3550), "average_household_size": encode(-231)}
    text = message("c", None, row, 1)
    changes = parse_envelope(spark.createDataFrame([(text,)], "value STRING"), DEMOGRAPHICS_ENCODED)
    got = normalize(changes, DEMOGRAPHICS_ENCODED).first()
    assert (got["median_age"], got["average_household_size"]) == (Decimal("35.50"), Decimal("-2.31"))
    with pytest.raises(ValueError, match="decimals"):
        Feed.of({"x": "double"}, decimals={"x": (5, 2)})


def test_unwrapped_rows_give_the_same_log(spark):
    rows = [json.dumps({**ONE, "__op": "c", "__source_ts_ms": 1, "__source_db": "app"}),
            json.dumps({**TWO, "__op": "u", "__source_ts_ms": 2, "__source_db": "app"})]
    flat = parse_flat(spark.createDataFrame([(r,) for r in rows], "value STRING"), DEMOGRAPHICS)
    log = normalize(flat, DEMOGRAPHICS, ops=("c", "u", "d"), null_op_as="u", image="row")
    assert [(r["operation"], r["total_population"]) for r in log.collect()] == [("CREATE", 2200), ("UPDATE", 3200)]


def test_quality_queries(mirror):
    total, age = F.col("total_population"), F.col("median_age")
    profile = quality.null_profile(mirror, ["city", "state", "total_population"], {"population": total <= 0}).first()
    assert tuple(profile) == (6, 6, 6, 5, 1)
    rules = [("NULL_POPULATION", total.isNull()), ("INVALID_POPULATION", total <= 0), ("INVALID_AGE", (age < 0) | (age > 120))]
    got = [(r["city"], r["data_quality_status"]) for r in quality.quality_violations(mirror, rules, KEY).collect()]
    assert got == [("C", "INVALID_POPULATION"), ("D", "NULL_POPULATION")]
    parts = F.col("male_population") + F.col("female_population")
    worst = quality.sum_consistency(mirror, total, parts, KEY).collect()
    assert [(r["city"], r["difference"], r["consistency"]) for r in worst][:2] == [("Quill Harbor", 1000, "INCONSISTENT"), ("A", 0, "CONSISTENT")]
    assert [tuple(r) for r in quality.duplicate_keys(mirror, ["city", "state"]).collect()] == [("B", "North", 2)]
    assert quality.duplicate_keys(mirror, KEY).count() == 0


def test_rollups_and_summary(mirror):
    totals = analytics.group_totals(mirror, ["state"], "total_population", "median_age", 15, ("city_count", "state_population", "avg_state_age"))
    assert [tuple(r) for r in totals.collect()] == [
        ("North", 3, 3300, 37.0), ("Ostmark", 1, 3200, 37.5), ("South", 2, 0, 130.0),
    ]
    total, age = F.col("total_population"), F.col("median_age")
    metrics = {
        "Total Records": F.count("*"), "Unique Cities": F.count_distinct("city"), "Unique States": F.count_distinct("state"),
        "Records with Valid Population": F.count_if(total > 0), "Data Quality Score": quality.quality_score((total > 0) & age.between(0, 120)),
    }
    got = [tuple(r) for r in quality.validation_summary(mirror, metrics).collect()]
    assert got == [("Total Records", "6"), ("Unique Cities", "5"), ("Unique States", "3"),
                   ("Records with Valid Population", "4"), ("Data Quality Score", "66.67%")]
    row = analytics.global_agg(mirror, "median_age", "total_population", "male_population", "female_population").first()
    assert tuple(row) == (6, 55.7, 6500, 0, 1200)


def test_projections_and_ranks(mirror):
    positive = mirror.filter("total_population > 0").select(
        "city", bands(F.col("median_age"), [(40, "High"), (30, "Medium")], "Low").alias("age_category"),
        percent(F.col("male_population"), F.col("total_population")).alias("male_percentage"),
    )
    assert {tuple(r) for r in positive.collect()} == {
        ("Quill Harbor", "Medium", 31.25), ("A", "Low", 44.44), ("B", "High", 50.0),
    }
    ranked = ranking.global_row_number(mirror.select(*KEY, "total_population"), "total_population", KEY, "population_rank")
    assert [r["city"] for r in ranked.orderBy("population_rank").collect()] == ["Quill Harbor", "B", "B", "A", "C", "D"]
    shares = ranking.global_percent_rank(mirror.select("city", "median_age"), "median_age", "age_percentile")
    assert {(r["city"], r["age_percentile"]) for r in shares.collect()} == {
        ("A", 0.0), ("Quill Harbor", 0.2), ("B", 0.4), ("C", 0.8), ("D", 1.0),
    }
    safe = mirror.filter("city = 'D'").select(*or_default({"median_age": 0.0, "total_population": 0})).first()
    assert tuple(safe) == (0.0, 0)


def test_the_update_arrived(spark, mirror):
    sent = spark.createDataFrame([("Quill Harbor",), ("Nowhere",)], "city STRING")
    got = {tuple(r) for r in reconcile.arrival_check(sent, mirror, ["city"]).collect()}
    assert got == {("Quill Harbor", True), ("Nowhere", False)}
    results = observe.checks(mirror, {"has_rows": F.count("*") > 0, "ages_in_range": F.max("median_age") <= 120})
    assert observe.health_score(results).first()["status"] == "DEGRADED"
