"""Column expressions against plain Python."""

import base64
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tidelog.functions import changes as c
from tidelog.functions import rules as r


def encode(unscaled: int) -> str:
    size = max(1, (unscaled.bit_length() + 8) // 8)
    return base64.b64encode(unscaled.to_bytes(size, "big", signed=True)).decode()


def test_known_decimals(spark):
    rows = spark.createDataFrame([("DhA=",), ("DeU=",), ("/2o=",), (None,), ("?",)], "e STRING")
    got = [x[0] for x in rows.select(c.connector_decimal(F.col("e"), 2, 18)).collect()]
    assert got == [Decimal("36.00"), Decimal("35.57"), Decimal("-1.50"), None, None]


def test_decimals_of_every_length(spark):
    rng = random.Random(7)
    values = [0, -1, 127, 128, -128, -129, 2**63 - 1, -(2**63), 2**63, 2**64, 10**38 - 1, 1 - 10**38]
    values += [rng.choice((1, -1)) * rng.getrandbits(rng.randint(1, 125)) for _ in range(400)]
    rows = spark.createDataFrame([(str(v), encode(v)) for v in values], "v STRING, e STRING")
    for scale in (0, 2, 9):
        got = rows.select("v", c.connector_decimal(F.col("e"), scale, 38).alias("d")).collect()
        for row in got:
            sign, digits, exponent = row["d"].as_tuple()
            assert exponent == -scale
            assert (-1) ** sign * int("".join(map(str, digits))) == int(row["v"])


def test_short_decimals_out_of_range_are_null(spark):
    rows = spark.createDataFrame([(encode(10**18),), (encode(-(2**70)),)], "e STRING")
    assert [x[0] for x in rows.select(c.connector_decimal(F.col("e"), 2, 18)).collect()] == [None, None]


def test_micro_time(spark):
    rows = spark.createDataFrame(
        [((1718000000123456,), None), (None, (1718000000123456,)), (None, None), ((-1,), None)],
        "after STRUCT<t: LONG>, before STRUCT<t: LONG>",
    )
    at = c.micro_time("t", fallback=F.lit(0).cast("timestamp"))
    got = [x[0] for x in rows.select(F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")).collect()]
    assert got[0] == got[1] == "2024-06-10 06:13:20.123000"
    assert got[2:] == ["1970-01-01 00:00:00.000000", "1969-12-31 23:59:59.999000"]


def test_record_id(spark):
    rows = spark.createDataFrame([("a", "b"), ("a", None)], "x STRING, y STRING")
    parts = [F.col("x"), F.col("y")]
    got = rows.select(c.record_id(parts), c.record_id(parts, null_part="unknown")).collect()
    assert [tuple(g) for g in got] == [("a_b", "a_b"), (None, "a_unknown")]


def test_unixtime_text(spark):
    assert spark.range(1).select(c.unixtime_text(F.lit(1718000000999))).first()[0] == "2024-06-10 06:13:20"


def test_bands_percent_and_rules(spark):
    rows = spark.createDataFrame([(41, 1, 2), (31, 1, 0), (30, 1, 3), (None, 1, 1)], "a INT, p INT, w INT")
    broken = r.first_broken([("MISSING", F.col("a").isNull()), ("BIG", F.col("a") > 40)])
    got = rows.select(
        r.bands(F.col("a"), [(40, "High"), (30, "Medium")], "Low"), r.percent(F.col("p"), F.col("w")), broken
    ).collect()
    assert [tuple(g) for g in got] == [
        ("High", 50.0, "BIG"), ("Medium", None, "VALID"), ("Low", 33.33, "VALID"), ("Low", 100.0, "MISSING"),
    ]
    assert rows.select(*r.or_default({"a": 0})).collect()[3]["a"] == 0


def test_jitter_is_repeatable_and_spread(spark):
    rows = spark.range(1000).repartition(5)
    draw = lambda seed: {x["id"]: x["j"] for x in rows.select("id", r.jitter(["id"], 10, seed).alias("j")).collect()}
    assert draw(1) == draw(1) != draw(2) and set(draw(1).values()) == set(range(10))
