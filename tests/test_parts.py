"""Parts of a table, totals under retraction, compaction of small files only."""

import datetime as dt
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import apply, history
from tidelog.session import scratch
from tidelog.sources import storage
from tidelog.streaming import writers
from tidelog.streaming.mirror_table import MirrorTable
from tidelog.streaming.parted import PART, Parted
from tidelog.streaming.totals import SignedTotals

LOG = "id long, op string, town string, amount decimal(18,2), at long"


def bag(rows):
    return sorted(map(repr, (tuple(r) for r in (rows.collect() if hasattr(rows, "collect") else rows))))


def events(seed, size):
    """A log whose first key has a third of the events; NULL keys, towns and amounts among them."""
    rng = random.Random(seed)
    for at in range(size):
        key = 0 if rng.random() < 0.33 else rng.choice([None, *range(1, 60)])
        town = rng.choice(["hot", "hot", "b", None])
        yield (key, rng.choice("cuurd"), town, rng.choice([None, *range(8)]), at)


def log_of(spark, rows):
    return spark.createDataFrame(list(rows), "id long, op string, town string, a int, at long").select(
        "id", "op", "town", F.col("a").cast("decimal(18,2)").alias("amount"), "at"
    )


def parts_written(root, version):
    return {name for name in os.listdir(f"{root}/version={version}") if name.startswith(PART)}


def test_folds_touch_only_parts_with_deltas(spark, tmp_path):
    rows = list(events(1, 400))
    schema = log_of(spark, rows).schema
    mirror = MirrorTable(spark, f"{tmp_path}/m", schema, ["id"], ["at"], parts=8)
    mirror.write_batch(log_of(spark, rows), 0)
    mirror.fold()
    assert len(parts_written(f"{tmp_path}/m/base", 0)) == 8
    more = [(5, "u", "new", 3, 1000), (5, "u", "newer", 4, 1001)]
    mirror.write_batch(log_of(spark, more), 1)
    want = [r for r in apply.mirror_current(log_of(spark, [r for r in [*rows, *more] if r[0] is not None]), ["id"], ["at"]).collect()]
    assert bag(mirror.current()) == bag(want)
    # A fold that did not end leaves readers where they were.
    mirror.base.write(mirror.newest(1).withColumn(PART, mirror._part()).limit(1), 1, [])
    assert mirror.versions() == [0] and bag(mirror.current()) == bag(want)
    mirror.fold()
    assert len(parts_written(f"{tmp_path}/m/base", 1)) == 1
    assert mirror.versions() == [0, 1] and bag(mirror.current()) == bag(want)
    before = bag(apply.mirror_current(log_of(spark, [r for r in rows if r[0] is not None]), ["id"], ["at"]))
    assert bag(mirror.current(through=0)) == before
    mirror.vacuum(1)
    assert mirror.versions() == [1] and bag(mirror.current()) == bag(want)
    assert len(parts_written(f"{tmp_path}/m/base", 0)) == 7
    mirror.write_batch(log_of(spark, [(5, "d", None, None, 2000)]), 2)
    mirror.fold()
    assert bag(mirror.current()) == bag([r for r in want if r[0] != 5])


@pytest.mark.parametrize("every", [1, 3])
def test_parts_equal_a_whole_base(spark, tmp_path, every):
    rows = list(events(2, 300))
    schema = log_of(spark, rows).schema
    kinds = {"parts": {"parts": 4}, "whole": {}}
    tables = {k: MirrorTable(spark, f"{tmp_path}/{k}", schema, ["id"], ["at"], **more) for k, more in kinds.items()}
    order = random.Random(3).sample(rows, len(rows))
    for batch in range(5):
        for mirror in tables.values():
            mirror.each_batch(fold_every=every, keep_versions=2)(log_of(spark, order[batch::5]), batch)
        assert bag(tables["parts"].with_deleted()) == bag(tables["whole"].with_deleted())
    with pytest.raises(ValueError):
        MirrorTable(spark, f"{tmp_path}/no", schema, ["id"], ["at"], buckets=2, parts=2)


def test_a_part_without_rows_hides_the_older_one(spark, tmp_path):
    schema = T.StructType([T.StructField("v", T.LongType())])
    parted = Parted(spark, f"{tmp_path}/p", schema)
    assert parted.read(5).count() == 0 and parted.newest_before(5) == -1
    rows = spark.range(10).select(F.col("id").alias("v"), (F.col("id") % 2).cast("int").alias(PART))
    parted.write(rows, 0, [0, 1])
    parted.mark(0)
    parted.write(rows.limit(0), 3, [1])
    assert parted.read(3).count() == 10
    parted.mark(3)
    assert bag(parted.read(3)) == bag([(v,) for v in range(0, 10, 2)])
    assert parted.read(2).count() == 10 and parted.read(3, only=[1]).count() == 0 and parted.read(3, but=[0]).count() == 0
    parted.vacuum(3)
    assert parted.versions() == [3] and parted.read(3).count() == 5


def recount(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row[3])
    found = []
    for town, amounts in groups.items():
        some = [a for a in amounts if a is not None]
        found.append((town, len(amounts), len(some), len(set(some)), min(some, default=None), max(some, default=None), sum(some) if some else None))
    return sorted(found, key=repr)


def table_after(rows):
    newest = {}
    for row in sorted(rows, key=lambda r: r[4]):
        if row[0] is not None:
            newest[row[0]] = row
    return [r for r in newest.values() if r[1] != "d"]


@pytest.mark.parametrize("batches", [1, 6])
def test_totals_equal_a_recount_after_each_batch(spark, batches):
    rows = list(events(7, 360))
    changes = history.row_changes(log_of(spark, rows), ["id"], ["at"]).select("change", "sign", "town", "amount")
    totals = SignedTotals(spark, scratch(spark, "totals"), changes.schema, ["town"], "amount", parts=4)
    assert totals.totals().count() == 0
    each, step = totals.each_batch(keep_versions=2), len(rows) // batches
    for batch in range(batches):
        part = changes.where(F.col("change.at").between(batch * step, (batch + 1) * step - 1))
        each(part, batch)
        each(part, batch)  # a repeated batch counts once
        got = [tuple(int(v) if hasattr(v, "as_tuple") else v for v in r) for r in totals.totals().collect()]
        assert sorted(got, key=repr) == recount(table_after(rows[: (batch + 1) * step]))


def test_signs_in_any_order_and_batch(spark):
    rows = list(events(8, 200))
    changes = history.row_changes(log_of(spark, rows), ["id"], ["at"]).select("sign", "town", "amount").collect()
    mixed = random.Random(1).sample(changes, len(changes))
    kind = "sign int, town string, amount decimal(18,2)"
    root = scratch(spark, "totals")
    for batch in range(4):
        part = spark.createDataFrame(mixed[batch::4], kind)
        totals = SignedTotals(spark, root, part.schema, ["town"], "amount", parts=4)
        totals.each_batch()(part, batch)
    got = [tuple(int(v) if hasattr(v, "as_tuple") else v for v in r) for r in totals.totals().collect()]
    assert sorted(got, key=repr) == recount(table_after(rows))


def test_a_batch_rewrites_only_the_parts_it_touches(spark):
    rows = [(1, "t", i) for i in range(200)]
    df = spark.createDataFrame(rows, "sign int, town string, amount int")
    root = scratch(spark, "totals")
    totals = SignedTotals(spark, root, df.schema, ["town"], "amount", parts=8)
    totals.each_batch()(df, 0)
    totals.each_batch()(spark.createDataFrame([(-1, "t", 199), (-1, "t", 199), (1, "t", 199)], df.schema), 1)
    path = root.removeprefix("file:")
    for kept in ("values", "sums"):
        assert len(parts_written(f"{path}/{kept}", 0)) == 8 and len(parts_written(f"{path}/{kept}", 1)) == 1
    assert [tuple(r) for r in totals.totals().collect()] == [("t", 199, 199, 199, 0, 198, sum(range(199)))]
    assert totals.totals(through=0).first()["max_value"] == 199


def test_only_small_files_are_rewritten(spark, tmp_path):
    big = spark.range(40_000).select(F.col("id"), F.rand(1).alias("x"), F.lit("001").alias("day")).coalesce(1)
    few = spark.range(40_000, 40_600).select("id", F.rand(2).alias("x"), F.when(F.col("id") % 3 == 0, "002").when(F.col("id") % 3 == 1, "001").alias("day"))
    source, target = f"{tmp_path}/s", f"{tmp_path}/t"
    big.write.partitionBy("day").parquet(source)
    few.repartition(12).write.mode("append").partitionBy("day").parquet(source)
    schema = T.StructType.fromDDL("id long, x double, day string")
    table = spark.read.schema(schema).parquet(source)
    sizes = sorted(r["length"] for r in writers.file_sizes(spark, source).collect())
    assert sizes[-1] > 100_000 > 10 * sizes[-2]
    packed = writers.compact_small(spark, source, target, ["day"], ["id"], small_bytes=100_000, schema=schema)
    assert bag(packed) == bag(table)
    written = [r["length"] for r in writers.file_sizes(spark, target).collect()]
    assert len(written) == 3 and sum(written) < sum(sizes[:-1])
    assert spark.read.schema(schema).parquet(target).count() == 600
    assert "day=001" in storage.folders(spark, target)
    alone = writers.compact_small(spark, source, f"{tmp_path}/none", ["day"], small_bytes=1, schema=schema)
    assert alone.count() == 40_600 and not storage.exists(spark, f"{tmp_path}/none")
