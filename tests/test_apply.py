"""Change application against a fold in plain Python, with one hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import apply
from tidelog.operators.normalize import row_kinds, signed_count
from tidelog.operators.reconcile import reconcile_diff, table_checksum
from tidelog.schema import Feed

DDL = "id LONG, seq LONG, lsn LONG, op STRING, x LONG, event_time TIMESTAMP"
KEY, ORDER = ["id"], ["seq", "lsn"]
START = dt.datetime(2024, 1, 1)


def make_log(seed: int, n: int = 3000):
    """A third of the events belong to one key, sequence numbers tie, and order of arrival is random."""
    rng = random.Random(seed)
    rows = []
    for lsn in range(n):
        key = 0 if rng.random() < 0.34 else rng.randint(1, 200)
        seq = rng.choice([None] + list(range(n // 3)))
        when = START + dt.timedelta(minutes=seq or 0)
        rows.append((key, seq, lsn, rng.choice("ccuurd"), rng.choice([None, rng.randint(0, 9)]), when))
    rng.shuffle(rows)
    return rows


def fold(rows):
    newest = {}
    for row in rows:
        rank = (row[1] is not None, row[1] or 0, row[2])
        if row[0] not in newest or rank > newest[row[0]][0]:
            newest[row[0]] = (rank, row)
    return {k: row for k, (_, row) in newest.items()}


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return make_log(request.param)


@pytest.fixture(scope="module")
def log(spark, rows):
    return spark.createDataFrame(rows, DDL).repartition(7).persist()


def test_mirror_is_the_fold(log, rows):
    live = sorted((r for r in fold(rows).values() if r[3] != "d"), key=repr)
    assert bag(apply.mirror_current(log, KEY, ORDER)) == live


def test_soft_delete_keeps_every_key(log, rows):
    got = bag(apply.mirror_soft_delete(log, KEY, ORDER))
    assert got == sorted(((*r, r[3] == "d") for r in fold(rows).values()), key=repr)


def test_as_of(log, rows):
    at = START + dt.timedelta(minutes=400)
    live = [r for r in fold([r for r in rows if r[5] <= at]).values() if r[3] != "d"]
    assert bag(apply.state_as_of(log, KEY, ORDER, F.lit(at))) == sorted(live, key=repr)
    forever = apply.state_as_of(log, KEY, ORDER, F.lit(dt.datetime(2100, 1, 1)))
    assert bag(forever) == bag(apply.mirror_current(log, KEY, ORDER))


def test_state_plus_changes_is_the_mirror(spark, log, rows):
    early = log.filter("seq < 300")
    state = apply.mirror_current(early, KEY, ORDER)
    got = apply.apply_join(state, log.filter("seq >= 300"), KEY, ORDER)
    want = [r for r in fold([r for r in rows if r[1] is not None]).values() if r[3] != "d"]
    assert bag(got) == sorted(want, key=repr)


def test_an_older_change_does_not_overwrite(spark):
    state = spark.createDataFrame([(1, 9, 9, "u", 5, START)], DDL)
    late = spark.createDataFrame([(1, 3, 3, "d", None, START), (2, 3, 4, "c", 7, START)], DDL)
    assert bag(apply.apply_join(state, late, KEY, ORDER)) == [(1, 9, 9, "u", 5, START), (2, 3, 4, "c", 7, START)]


def test_repeated_delivery_changes_nothing(log):
    twice = log.unionByName(log)
    assert bag(apply.mirror_current(twice, KEY, ORDER)) == bag(apply.mirror_current(log, KEY, ORDER))
    assert bag(apply.dedupe_events(twice, KEY, ["lsn"])) == bag(log)


def test_delete_then_create_and_equal_time(spark):
    rows = [(1, 1, 1, "d", 0, START), (1, 1, 2, "c", 3, START), (2, 5, 1, "c", 1, START), (2, 5, 2, "d", 1, START)]
    got = apply.mirror_current(spark.createDataFrame(rows, DDL), KEY, ORDER)
    assert [(r["id"], r["x"]) for r in got.collect()] == [(1, 3)]


def test_snapshot_first(spark):
    snapshot = spark.createDataFrame([(1, "r", 10), (2, "r", 20), (3, "r", 30)], "id LONG, op STRING, x LONG")
    changes = spark.createDataFrame([(1, "u", 11, 0), (2, "d", None, 0), (4, "c", 40, 0)], "id LONG, op STRING, x LONG, seq LONG")
    got = apply.snapshot_then_changes(snapshot, changes, KEY, ["seq"])
    assert {(r["id"], r["x"]) for r in got.collect()} == {(1, 11), (3, 30), (4, 40)}


def test_edits(spark):
    rows = spark.createDataFrame([(1, "Sample A"), (2, None), (3, "b")], "id LONG, name STRING")
    like = F.col("name").like("Sample%")
    assert bag(apply.update_where(rows, like, {"id": F.col("id") + 1000})) == sorted(
        [(1001, "Sample A"), (2, None), (3, "b")], key=repr
    )
    assert bag(apply.delete_where(rows, like)) == sorted([(2, None), (3, "b")], key=repr)
    assert apply.not_null(rows, ["name"]).count() == 2
    assert tuple(apply.not_null_counts(rows, ["name"]).first()) == (2, 1)


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, 10)], "id LONG, x LONG")
    rows = spark.createDataFrame([(1, 99), (2, 5), (2, 4)], "id LONG, x LONG")
    once = apply.insert_if_absent(target, rows, KEY, ["x"])
    assert bag(once) == [(1, 10), (2, 4)]
    assert bag(apply.insert_if_absent(once, rows, KEY, ["x"])) == [(1, 10), (2, 4)]


def test_added_column(spark, tmp_path):
    old = spark.createDataFrame([(1,)], "id LONG")
    new = spark.createDataFrame([(2, "n")], "id LONG, note STRING")
    assert bag(apply.evolve(old, new)) == sorted([(1, None), (2, "n")], key=repr)
    from tidelog.sources.readers import parquet

    old.write.parquet(f"{tmp_path}/t/part=1")
    new.write.parquet(f"{tmp_path}/t/part=2")
    assert bag(parquet(spark, f"{tmp_path}/t", merge=True).select("id", "note")) == sorted([(1, None), (2, "n")], key=repr)


def test_signed_counts_of_a_consistent_log(spark):
    """Each key is created, updated and deleted in turn, so its signed count is 0 or 1."""
    rng, rows, live = random.Random(5), [], {}
    for lsn in range(2000):
        key = 0 if rng.random() < 0.34 else rng.randint(1, 50)
        if key not in live:
            live[key] = rng.randint(0, 99)
            rows.append((lsn, None, (key, live[key]), "c"))
        elif rng.random() < 0.6:
            old, live[key] = live[key], rng.randint(0, 99)
            rows.append((lsn, (key, old), (key, live[key]), "u"))
        else:
            rows.append((lsn, (key, live.pop(key)), None, "d"))
    image = "STRUCT<id: LONG, x: LONG>"
    changes = spark.createDataFrame(rows, f"lsn LONG, before {image}, after {image}, op STRING")
    feed = Feed.of({"id": "long", "x": "long"}, key=("id",))
    got = {r["id"]: (r["net_rows"], r["sum_x"]) for r in signed_count(row_kinds(changes, feed), ["id"], ["x"]).collect()}
    assert got == {k: ((1, live[k]) if k in live else (0, 0)) for k in {(r[1] or r[2])[0] for r in rows}}


def test_diff_and_checksum(spark, log):
    mirror = apply.mirror_current(log, KEY, ORDER)
    assert reconcile_diff(mirror, mirror, KEY, ["x", "op"]).count() == 0
    a = spark.createDataFrame([(1, 1), (2, None), (3, 3), (4, None)], "id LONG, x LONG")
    b = spark.createDataFrame([(1, 1), (2, 2), (4, None), (5, 5)], "id LONG, x LONG")
    got = {(r["id"], r["status"], r["columns_changed"]) for r in reconcile_diff(a, b, KEY, ["x"]).collect()}
    assert got == {(2, "changed", "x"), (3, "missing", None), (5, "extra", None)}
    assert table_checksum(log).first() == table_checksum(log.repartition(3)).first()
    assert table_checksum(a).first() != table_checksum(b).first()


def test_checksum_tells_neighbouring_cells_apart(spark):
    make = lambda a, b: spark.createDataFrame([(a, b)], "a STRING, b STRING")
    for portable in (True, False):
        value = lambda a, b: table_checksum(make(a, b), portable=portable).first()["checksum"]
        assert value("a|b", "c") != value("a", "b|c") and value(None, "c") != value("c", None)
        assert value("1:a", "") != value("", "1:a") and value("~", None) != value(None, "~")
        assert value("x", None) == value("x", None)
