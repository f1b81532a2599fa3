import os

import pyarrow as pa
from pyspark.sql import functions as F

from tidelog.session import SHUFFLE_CLEANUP, materialize, scratch_root, settle


def tables(spark):
    root = scratch_root(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_tables_on_the_way_go_and_the_result_stays(spark):
    before = tables(spark)
    kept = materialize(spark.range(20), "kept-before")

    def build():
        half = materialize(kept.where("id < 10"), "half")
        counted = settle(spark, lambda: materialize(half.groupBy((F.col("id") % 3).alias("k")).count(), "inner"), "counted")
        return half.join(counted, F.col("id") == F.col("k"))

    result = settle(spark, build, "result")
    assert sorted(r[0] for r in result.select("id").collect()) == [0, 1, 2]
    assert kept.count() == 20
    assert sorted(t.rsplit("-", 1)[0] for t in tables(spark) - before) == ["kept-before", "result"]


def test_a_failure_keeps_the_tables_and_the_session_as_it_was(spark):
    before, choice = tables(spark), spark.conf.get(SHUFFLE_CLEANUP)

    def build():
        made = materialize(spark.range(5), "made")
        return made.select(F.raise_error(F.lit("no")).cast("int").alias("x"))

    try:
        settle(spark, build, "result")
    except Exception as error:
        assert "no" in str(error)
    else:
        raise AssertionError("nothing was raised")
    assert any(t.startswith("made-") for t in tables(spark) - before)
    assert spark.conf.get(SHUFFLE_CLEANUP) == choice
    assert materialize(spark.range(3), "after").count() == 3


def test_workers_get_small_batches_while_a_table_is_written(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    def sent(rows, letters):
        made = spark.range(0, rows, 1, 1).select(F.expr(f"repeat('x', {letters})").alias("text")).mapInArrow(sizes, "n long, size long")
        return [tuple(r) for r in materialize(made, "sizes", fine=True).collect()]

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    assert {n for n, _ in sent(5000, 5)} == {200}
    large = sent(400, 20000)
    assert sum(n for n, _ in large) == 400 and max(size for _, size in large) <= 11 << 17
    assert spark.conf.get(name) == before and spark.conf.get(name, None) is None
    spark.conf.set(name, "700")  # a session's own choice
    try:
        assert max(n for n, _ in sent(2000, 5)) == 700 and spark.conf.get(name) == "700"
    finally:
        spark.conf.unset(name)
