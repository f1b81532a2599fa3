"""Quality, reconciliation and observability reports on small tables."""

import re

import pytest
from pyspark.sql import functions as F

from tidelog.operators import analytics, observe, quality, reconcile
from tidelog.session import materialize


def test_health_bands(spark):
    for passed, total, want in ((9, 10, (90, "EXCELLENT")), (7, 10, (70, "GOOD")), (2, 3, (66, "DEGRADED")), (1, 3, (33, "CRITICAL")), (0, 0, (None, "CRITICAL"))):
        rows = [(f"c{i}", i < passed) for i in range(total)]
        row = observe.health_score(spark.createDataFrame(rows, "check_name STRING, passed BOOLEAN")).first()
        assert (row["score"], row["status"]) == want


def test_checks_are_rows(spark):
    got = observe.checks(spark.range(3), {"has_rows": F.count("*") > 0, "unknown": F.max(F.lit(None).cast("int")) > 0})
    assert {tuple(r) for r in got.collect()} == {("has_rows", True), ("unknown", False)}


def test_stage_verdicts(spark):
    full, empty = spark.range(3), spark.range(0)

    def verdict(*stages):
        return reconcile.stage_counts({f"s{i}": s for i, s in enumerate(stages)}).first()["verdict"]

    assert verdict(full, full, full) == "GOOD"
    assert verdict(full, full, empty) == "IN PROGRESS"
    assert verdict(full, empty, full) == "NOT ESTABLISHED"


def test_lag(spark):
    log = spark.createDataFrame([("a", i) for i in range(200)] + [("b", i) for i in range(5)], "p STRING, o LONG")
    progress = spark.createDataFrame([("a", 50), ("a", 99)], "p STRING, c LONG")
    got = {r["p"]: (r["lag"], r["status"]) for r in observe.consumer_lag(log, progress, "p", "o", "c").collect()}
    assert got == {"a": (100, "FAIL"), "b": (5, "PASS")}


def test_replication_position_lag(spark):
    slots = spark.createDataFrame([("slot_a", 5000, 4990)], "slot STRING, restart LONG, confirmed LONG")
    row = observe.consumer_lag(slots, slots, "slot", "restart", "confirmed").first()
    assert (row["lag"], row["status"]) == (10, "PASS")


def test_file_audit_and_new_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.parquet").write_bytes(b"0" * 2000)
    (tmp_path / "a" / "y.json").write_bytes(b"0" * 10)
    before = materialize(observe.file_listing(spark, str(tmp_path)), "listing")
    got = {r["file_type"]: (r["files"], r["total_bytes"], r["small_files"], r["status"]) for r in observe.file_audit(before).collect()}
    assert got == {"parquet": (1, 2000, 0, "PASS"), "json": (1, 10, 1, "FAIL")}
    (tmp_path / "a" / "z.parquet").write_bytes(b"0" * 5)
    (tmp_path / "a" / "y.json").write_bytes(b"0" * 11)
    later = observe.new_files(before, observe.file_listing(spark, str(tmp_path)))
    assert sorted(r["path"].rsplit("/", 1)[1] for r in later.collect()) == ["y.json", "z.parquet"]


def test_arrival(spark):
    sent = spark.createDataFrame([(1,), (2,), (2,)], "id LONG")
    log = spark.createDataFrame([(2,), (2,), (None,)], "id LONG")
    got = {tuple(r) for r in reconcile.arrival_check(sent, log, ["id"]).collect()}
    assert got == {(1, False), (2, True)}


def test_latency(spark):
    rows = spark.range(101).select(
        F.timestamp_millis(F.lit(0)).alias("a"), F.timestamp_millis(F.col("id") * 10).alias("b")
    )
    row = observe.latency_stats(rows, F.col("a"), F.col("b")).first()
    assert (row["rows"], row["avg_ms"], row["p50_ms"], row["max_ms"]) == (101, 500.0, 500, 1000)


def test_summary_of_an_empty_table(spark):
    metrics = {"Total": F.count("*"), "Score": quality.quality_score(F.col("id") > 0)}
    got = [tuple(r) for r in quality.validation_summary(spark.range(0), metrics).collect()]
    assert got == [("Total", "0"), ("Score", None)]


def test_profile_with_a_sketch(spark):
    row = quality.column_profile(spark.range(50), approximate=True).first()
    assert (row["column_name"], row["non_null"], row["nulls"]) == ("id", 50, 0) and abs(row["distinct_values"] - 50) < 5


def test_profile_deals_rows_before_it_removes_repeats(spark, plan):
    text = plan(quality.column_profile(spark.range(0, 1000, 1, 1).selectExpr("id", "cast(id % 7 as string) AS s")))
    assert not re.search(r"SortAggregate\(key=\[[^]]", text)  # no task sorts all rows of a split, once for each column
    assert text.rindex("REPARTITION_BY_NUM") > text.rindex("HashAggregate(keys=[i")


def test_profile_of_odd_values(spark):
    rows = [(1, 2, -0.0, "b", [1]), (None, 2, float("nan"), "a", None), (3, None, 5.0, "a", [1]), (3, 2, 0.0, None, [2, 0])]
    got = quality.column_profile(spark.createDataFrame(rows, "a LONG, b LONG, x DOUBLE, s STRING, l ARRAY<INT>"), ["x", "b", "a", "s", "l"])
    assert [tuple(r)[:5] for r in got.collect()] == [
        ("x", "double", 4, 0, 3), ("b", "bigint", 3, 1, 1), ("a", "bigint", 3, 1, 2), ("s", "string", 3, 1, 2), ("l", "array<int>", 3, 1, 2)
    ]
    assert [tuple(r)[5:] for r in got.collect()][1:] == [("2", "2"), ("1", "3"), ("a", "b"), ("[1]", "[2, 0]")]
    only = quality.column_profile(spark.createDataFrame([(-0.0,)], "x DOUBLE")).first()
    assert (only["min_value"], only["max_value"]) == ("-0.0", "-0.0")
    none = quality.column_profile(spark.createDataFrame([], "a LONG, s STRING")).collect()
    assert [tuple(r) for r in none] == [("a", "bigint", 0, 0, 0, None, None), ("s", "string", 0, 0, 0, None, None)]


def test_sum_consistency_bound(spark):
    rows = spark.createDataFrame([(1, 200, 100), (2, 201, 100), (3, None, 1)], "id LONG, t LONG, p LONG")
    got = quality.sum_consistency(rows, F.col("t"), F.col("p"), ["id"]).collect()
    assert [(r["id"], r["consistency"]) for r in got] == [(2, "INCONSISTENT"), (1, "CONSISTENT")]


def test_ties_are_broken_by_the_key(spark):
    rows = spark.createDataFrame([(3, 1), (1, 1), (2, None), (4, 2)], "id LONG, v LONG")
    assert [r["id"] for r in analytics.top_n(rows, "v", ["id"], 3).collect()] == [4, 1, 3]


def test_daily_counts_from_a_given_day(spark):
    rows = spark.sql("SELECT timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,cast(id as int)) AS t FROM range(20)")
    got = analytics.daily_counts(rows, "t", days=2, as_of=F.lit("2024-01-10").cast("date")).collect()
    assert [str(r["record_date"]) for r in got][-1] == "2024-01-08" and len(got) == 13


@pytest.fixture
def plan(capsys):
    def text(df):
        capsys.readouterr()
        df.explain()
        return capsys.readouterr().out

    return text


def test_one_scan_for_the_summary(spark, small, plan):
    from tidelog.plans import QUERIES

    assert plan(QUERIES["validation_summary"](spark, small)).count("FileScan") == 1
    assert plan(QUERIES["column_profile"](spark, small)).count("FileScan") == 1
    assert plan(QUERIES["health_score"](spark, small)).count("FileScan") == 1


def test_filters_and_columns_reach_the_scan(spark, small, plan):
    from tidelog.plans import QUERIES

    text = plan(QUERIES["filter_project"](spark, small))
    assert "GreaterThan(o_totalprice,1000.0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in text


def test_newest_per_key_is_cut_before_the_shuffle(spark, small, plan):
    from tidelog.plans import QUERIES

    text = plan(QUERIES["mirror_current"](spark, small))
    assert text.index("Exchange hashpartitioning(user_id") < text.index("row_number(), 1, Partial")


def test_top_lists_do_not_sort_everything(spark, small, plan):
    from tidelog.plans import QUERIES

    for name in ("top_n", "latest_n", "duplicate_keys", "quality_violations"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, small))


def test_percentiles_equal_a_sorted_list(spark):
    # A third group is NULL, one value of the hot group is most of its rows, one group has only NULL values.
    rows = [("hot", 7)] * 4000 + [("hot", i) for i in range(2000)] + [("b", i * i - 50) for i in range(101)]
    rows += [(None, i) for i in range(9)] + [("none", None)] + [("b", None)]
    df = spark.createDataFrame(rows, "g STRING, v LONG").repartition(7)
    shares = {"least": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "most": 1.0}
    got = {r["g"]: r.asDict() for r in observe.percentiles(df, F.col("v"), shares, ["g"]).collect()}
    assert set(got) == {"hot", "b", None}
    for g, row in got.items():
        held = sorted(v for k, v in rows if k == g and v is not None)
        assert row["rows"] == len(held)
        for name, share in shares.items():
            assert row[name] == held[max(0, -(-len(held) * round(share * 100) // 100) - 1)], (g, name)


def test_percentiles_of_a_whole_table_and_of_none(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 1001)], "v DOUBLE")
    assert observe.percentiles(df, F.col("v"), {"p": 0.999}).first() == (1000, 999.0)
    assert observe.percentiles(df.where("v < 0"), F.col("v"), {"p": 0.5}, ["v"]).count() == 0


def both_diffs(source, target, ranges=16):
    whole = reconcile.reconcile_diff(source, target, ["k"], ["a", "b"])
    some = reconcile.diff_by_ranges(source, target, "k", ["a", "b"], ranges)
    def listed(df):
        return sorted(map(str, df.collect()))
    assert listed(some) == listed(whole)
    return some


def test_diff_by_ranges_equals_the_whole_diff(spark):
    schema = "k LONG, a LONG, b STRING"
    rows = [(i, i % 7, None if i % 5 == 0 else str(i)) for i in range(-100, 900)]
    source = spark.createDataFrame([*rows, (None, 1, "x")], schema)
    changed = [(k, a + (k == 400), None if k == 401 else b) for k, a, b in rows if k not in (402, -100, 899)]
    target = spark.createDataFrame([*changed, (950, 1, "new"), (None, 1, "x")], schema)
    assert both_diffs(source, target).count() == 8
    assert both_diffs(source, source.where("k is not null")).count() == 1
    assert both_diffs(source.where("k is not null"), source.where("k is not null")).count() == 0
    assert both_diffs(source, source.where("false")).count() == 1001
    assert both_diffs(source.where("false"), target.where("false")).count() == 0


def test_diff_by_ranges_reads_only_those_ranges(spark):
    source = materialize(spark.range(10_000).select(F.col("id").alias("k"), F.lit(1).alias("a"), F.lit("x").alias("b")), "diff")
    target = source.withColumn("a", F.when(F.col("k") == 5000, 2).otherwise(F.col("a")))
    assert reconcile.differing_ranges(source, target, "k", ["a", "b"], 100) == [(5000, 5099)]
    plan = both_diffs(source, target, 100)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,5000)" in plan and "LessThanOrEqual(k,5099)" in plan
