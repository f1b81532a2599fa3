"""Running values, arrival and history against plain Python, over many batches and in any order of rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import arrival, history
from tidelog.operators.sequences import carried
from tidelog.session import scratch
from tidelog.sources import storage
from tidelog.streaming import admission

START = dt.datetime(2024, 1, 1)
ROWS = "source string, position long, event_time timestamp, note string, start string, row string, kind string"


def bag(rows):
    return sorted(map(repr, (tuple(r) for r in (rows.collect() if hasattr(rows, "collect") else rows))))


@pytest.mark.parametrize("current", [True, False])
@pytest.mark.parametrize("backward", [True, False])
def test_running_values_of_hot_and_null_keys(spark, current, backward):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "hot", None, "a", f"k{i % 50}"]), i, rng.choice([None, rng.randrange(100)])) for i in range(900)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, at long, v long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        how = {"l": ("v", "last"), "m": ("v", "max"), "s": ("v", "sum")}
        got = carried(df, ["key"], ["at"], how, current=current, backward=backward).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(rows)
    for r in got:
        same = sorted((at, v) for k, at, v in rows if k == r["key"])
        same = [(at, v) for at, v in same if (at >= r["at"] if backward else at <= r["at"]) and (current or at != r["at"])]
        values = [v for _, v in (same[::-1] if backward else same) if v is not None]
        assert (r["l"], r["m"], r["s"]) == (values[-1] if values else None, max(values, default=None), sum(values))


def test_running_values_of_a_whole_table(spark):
    df = spark.range(500).withColumn("v", (F.col("id") * 37) % 101)
    got = {r["id"]: r["m"] for r in carried(df, [], ["id"], {"m": ("v", "max")}).collect()}
    best = -1
    for i in range(500):
        best = max(best, i * 37 % 101)
        assert got[i] == best
    assert carried(df.limit(0), [], ["id"], {"m": ("v", "max")}).count() == 0


def delivered(seed, size):
    """Deliveries in order: lost positions, repeats, late times, NULL sources, times and positions."""
    rng, rows = random.Random(seed), []
    for i in range(size):
        source = rng.choice(["hot", "hot", "b", None])
        time = START + dt.timedelta(seconds=i * 10 - rng.choice([0, 0, 0, 4, 600]))
        row = (source, i if rng.random() > 0.02 else None, time if rng.random() > 0.02 else None, f"n{i}", None, None, None)
        if rng.random() > 0.1:
            rows += [row] * (2 if rng.random() < 0.2 else 1)
    return rows


def expected(rows):
    found, newest, seen = [], {}, set()
    for row in sorted(rows, key=lambda r: -1 if r[1] is None else r[1]):
        source, position, time = row[:3]
        if position is None:
            found.append((*row, "on_time"))
            continue
        if (source, position) in seen:
            found.append((*row, "repeat"))
            continue
        seen.add((source, position))
        late = time is not None and source in newest and time < newest[source] - dt.timedelta(seconds=5)
        found.append((*row, "late" if late else "on_time"))
        if time is not None:
            newest[source] = max(time, newest.get(source, time))
    return found


def missing(rows):
    found = []
    for source in {r[0] for r in rows}:
        places = sorted({r[1] for r in rows if r[0] == source and r[1] is not None})
        found += [(source, a + 1, b - 1) for a, b in zip(places, places[1:]) if b > a + 1]
    return found


@pytest.mark.parametrize("batches", [1, 6, 20])
def test_standing_does_not_depend_on_batches_or_order_in_them(spark, batches):
    rows = delivered(1, 400)
    root = scratch(spark, "admission")
    step = -(-len(rows) // batches)
    each = admission.admit(root, "source", "position")
    rng = random.Random(batches)
    parts = []
    for at in range(0, len(rows), step):
        part = rows[at : at + step]
        while at + len(part) < len(rows) and rows[at + len(part)] == part[-1]:
            break  # a repeat may be in the next batch
        parts.append(rng.sample(part, len(part)))
    schema = spark.createDataFrame([], ROWS).schema
    for i, part in enumerate(parts):
        batch = spark.createDataFrame(part, ROWS).repartition(3)
        each(batch, i)
        each(batch, i)  # a batch that is repeated changes nothing
    assert bag(admission.read(spark, root, schema)) == bag(expected(rows))
    known = admission.known(spark, root, arrival.known_schema(spark.createDataFrame([], ROWS), "source", "position", "event_time"))
    assert bag(arrival.gaps(known)) == bag(missing(rows))
    assert len(storage.folders(spark, f"{root}/known")) <= 2


def test_replays_after_any_time_and_lost_rows_that_come_later(spark):
    rows = [(1, 10), (1, 11), (1, 15), (2, 3)]
    frame = lambda pairs: spark.createDataFrame([(s, p, START) for s, p in pairs], "source long, position long, event_time timestamp")
    first = frame(rows)
    known = arrival.merged(arrival.nothing_known(spark, first, "source", "position", "event_time"), first, "source", "position")
    assert bag(arrival.gaps(known)) == bag([(1, 12, 14)])
    again = frame([(1, 10), (1, 12), (1, 13), (1, 14), (2, 4), (3, 1), (1, 15)])
    standing = {(r["source"], r["position"]): r["standing"] for r in arrival.judged(again, known, "source", "position").collect()}
    assert [p for p, s in sorted(standing.items()) if s == "repeat"] == [(1, 10), (1, 15)]
    after = arrival.merged(known, again, "source", "position")
    assert bag(after.select("source", "start", "end")) == bag([(1, 10, 15), (2, 3, 4), (3, 1, 1)])


def test_state_follows_gaps_and_not_rows(spark):
    rows = spark.range(20_000).where("id not in (7, 8, 500)").select((F.col("id") % 1).alias("source"), F.col("id").alias("position"), F.timestamp_seconds("id").alias("event_time"))
    known = arrival.merged(arrival.nothing_known(spark, rows, "source", "position", "event_time"), rows, "source", "position")
    assert bag(known.select("start", "end")) == bag([(0, 6), (9, 499), (501, 19_999)])


def test_silent_sources_hold_nothing_back(spark):
    at = lambda seconds: START + dt.timedelta(seconds=seconds)
    rows = [(0, "a", at(0)), (1, "b", at(20)), (2, "a", at(100)), (3, "b", at(90)), (4, "c", None)]
    clocked = arrival.clock(spark.createDataFrame(rows, "n long, source string, event_time timestamp"), "n")
    assert [r["arrived"] for r in clocked.orderBy("n").collect()] == [at(0), at(20), at(100), at(100), at(100)]
    marks = {r["source"]: r for r in arrival.source_watermarks(clocked, "source").collect()}
    assert not marks["a"]["idle"] and not marks["b"]["idle"] and marks["c"]["watermark"] is None
    assert spark.range(1).select(arrival.combined(arrival.source_watermarks(clocked, "source"))).first()[0] == at(85)
    later = spark.createDataFrame(rows + [(5, "a", at(200))], "n long, source string, event_time timestamp")
    marks = {r["source"]: r["idle"] for r in arrival.source_watermarks(arrival.clock(later, "n"), "source").collect()}
    assert marks == {"a": False, "b": True, "c": True}


def test_lookups_equal_one_state_per_moment(spark):
    rng = random.Random(8)
    log = [(rng.choice([1, 1, 1, 2, 3, None]), START + dt.timedelta(minutes=rng.randrange(300)), i, rng.choice("cud"), rng.random()) for i in range(400)]
    asked = [(rng.choice([1, 1, 2, 9, None]), START + dt.timedelta(minutes=rng.randrange(-5, 310)) if rng.random() > 0.05 else None, i) for i in range(200)]
    events = spark.createDataFrame(log, "key long, event_time timestamp, lsn long, op string, amount double").repartition(5)
    questions = spark.createDataFrame(asked, "key long, moment timestamp, question long").repartition(3)
    got = {r["question"]: r for r in history.lookup(events, questions, ["key"], ["event_time", "lsn"]).collect()}
    spans = history.validity(events, ["key"], ["event_time", "lsn"]).collect()
    assert len(got) == len(asked)
    for key, moment, question in asked:
        before = [e for e in log if key is not None and moment and e[0] == key and e[1] <= moment]
        last = max(before, key=lambda e: (e[1], e[2]), default=None)
        wanted = last[2] if last and last[3] != "d" else None
        assert (got[question]["found"] and got[question]["found"]["lsn"]) == wanted
        held = [s["lsn"] for s in spans if s["key"] == key and moment and s["valid_from"] <= moment and (s["valid_to"] is None or moment < s["valid_to"])]
        assert held == ([wanted] if wanted is not None else [])
