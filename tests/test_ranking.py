"""Whole-table ranks against Spark's own single-task windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelog.operators import ranking


@pytest.fixture(scope="module", autouse=True)
def many_ranges(spark):
    """Keeps adaptive execution from putting these small tables into one range."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(i, 5 if rng.random() < 0.34 else rng.choice([None, *range(40)])) for i in range(4000)]
    return spark.createDataFrame(data, "id LONG, v INT").repartition(5).persist()


def bag(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("descending", [True, False])
def test_row_number(rows, descending):
    first = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    want = rows.select("id", F.row_number().over(Window.orderBy(first, "id")).alias("n"))
    got = ranking.global_row_number(rows, "v", ["id"], "n", descending).select("id", "n")
    assert bag(got) == bag(want)


@pytest.mark.parametrize("limits", [{}, {"hot_share": 0.1}, {"hot_share": 1.0}])
def test_percent_rank(rows, limits):
    want = rows.select("id", F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_last())).alias("p"))
    got = ranking.global_percent_rank(rows, "v", "p", **limits).select("id", "p")
    assert bag(got) == bag(want)


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_tables(spark, n):
    rows = spark.range(n).withColumn("v", F.lit(1))
    assert ranking.global_row_number(rows, "v", ["id"], "n").count() == n
    assert [r["p"] for r in ranking.global_percent_rank(rows, "v", "p").collect()] == [0.0] * n


def test_hot_value_is_split_over_ranges(rows):
    placed = ranking._ranged(rows.filter("v = 5"), [F.col("v"), F.col("id")], "test")
    assert placed.select("_range").distinct().count() > 1


def test_no_single_task_exchange(rows, capsys):
    ranking.global_row_number(rows, "v", ["id"]).explain()
    ranking.global_percent_rank(rows, "v").explain()
    assert "SinglePartition" not in capsys.readouterr().out
