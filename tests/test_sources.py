"""Readers, batch writers and catalog helpers."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import session
from tidelog.schema import struct
from tidelog.sources import readers, storage
from tidelog.streaming import writers

CITY = struct({"id": "integer", "city": "string", "population": "integer", "created_at": "timestamp"})
CSV = """id,city,population,created_at
1,Port Ellery,71250,2023-02-14 07:05:31.250000
2,Quill Harbor,1804,2023-02-15 19:40:00.000001
x,Nowhere,1,2023-02-16 00:00:00.000000
"""


def test_csv_with_header_and_bad_line(spark, tmp_path):
    (tmp_path / "c.csv").write_text(CSV)
    rows = readers.csv(spark, str(tmp_path / "c.csv"), CITY).cache()
    assert rows.count() == 3
    bad = rows.filter("corrupt IS NOT NULL").collect()
    assert [r["city"] for r in bad] == ["Nowhere"] and bad[0]["id"] is None
    (tmp_path / "d.csv").write_text(CSV.replace(",", ";"))
    assert readers.csv(spark, str(tmp_path / "d.csv"), CITY, delimiter=";").filter("id = 1").count() == 1


def test_json_types_are_inferred(spark, tmp_path):
    record = {"city": "Quill Harbor", "state": "Ostmark", "median_age": 44.25, "total_population": 1804}
    (tmp_path / "r.json").write_text(json.dumps(record) + "\n")
    rows = readers.json(spark, str(tmp_path / "r.json"))
    kinds = dict(rows.dtypes)
    assert (kinds["median_age"], kinds["total_population"], kinds["city"]) == ("double", "bigint", "string")
    row = rows.first()
    assert (row["city"], row["median_age"], row["total_population"]) == ("Quill Harbor", 44.25, 1804)
    typed = readers.json(spark, str(tmp_path / "r.json"), struct({"total_population": "integer"}))
    assert typed.first()["total_population"] == 1804


def test_literal_rows(spark, tmp_path):
    import datetime as dt

    when = dt.datetime(2025, 6, 9, 10, 0)
    rows = readers.literal(spark, [("A", "S", 1, when), ("B", "S", 2, when)], "city STRING, state STRING, population LONG, test_timestamp TIMESTAMP_NTZ")
    rows.write.parquet(f"{tmp_path}/t")
    assert readers.parquet(spark, f"{tmp_path}/t").count() == 2
    assert readers.parquet(spark, f"{tmp_path}/t", rows.schema).filter(F.col("test_timestamp") == F.lit(when)).count() == 2


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.parquet(spark, f"{tmp_path}/none").count()


def test_create_table_if_not_exists(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS made_once")
    first = writers.create_table_as(spark.range(3), "made_once", f"{tmp_path}/t")
    again = writers.create_table_as(spark.range(9), "made_once", f"{tmp_path}/t2")
    assert first.count() == again.count() == 3
    assert readers.tables_like(spark, "made_*") == ["made_once"]
    assert readers.tables_like(spark, "made_*", without=["made_once"]) == []
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lake COMMENT 'tables' LOCATION '{tmp_path}/lake'")
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    spark.sql("DROP DATABASE IF EXISTS lake")
    spark.sql("DROP TABLE IF EXISTS made_once")
    spark.sql("DROP TABLE IF EXISTS made_once")


def test_partitioned_write_is_pruned(spark, tmp_path, capsys):
    rows = spark.range(100).withColumn("day", (F.col("id") / 40).cast("int").cast("string"))
    written = writers.write_partitioned(rows, f"{tmp_path}/t", ["day"])
    assert storage.folders(spark, f"{tmp_path}/t") == ["day=0", "day=1", "day=2"]
    written.filter("day = '1'").explain()
    assert "PartitionFilters: [isnotnull(day" in capsys.readouterr().out


def test_a_hot_partition_value_gets_several_files(spark, tmp_path):
    """Most rows share one value; the rebalance step splits it by size."""
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 5).otherwise(99).alias("city"), F.sha2(F.col("id").cast("string"), 256).alias("body")
    ).repartition(8)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "2MB")
    try:
        written = writers.write_partitioned(rows, f"{tmp_path}/t", ["city"])
    finally:
        spark.conf.unset(size)
    hot = [f for f in os.listdir(f"{tmp_path}/t/city=99") if f.endswith(".parquet")]
    assert len(hot) > 2 and written.count() == 300_000


def test_compaction_makes_few_files_of_the_target_size(spark, tmp_path):
    rows = spark.range(20_000).select("id", (F.col("id") % 2).cast("string").alias("part"), F.sha2(F.col("id").cast("string"), 256).alias("body"))
    rows.repartition(40).write.partitionBy("part").parquet(f"{tmp_path}/small")

    def files(folder):
        return spark.read.parquet(folder).select(F.col("_metadata.file_path")).distinct().count()

    few = writers.compact_files(spark, f"{tmp_path}/small", f"{tmp_path}/large", ["part"], ["id"])
    assert files(f"{tmp_path}/small") == 80 and files(f"{tmp_path}/large") == 2
    assert sorted(few.collect()) == sorted(spark.read.schema(few.schema).parquet(f"{tmp_path}/small").collect())
    total = storage.size(spark, f"{tmp_path}/small")
    writers.compact_files(spark, f"{tmp_path}/small", f"{tmp_path}/split", ["part"], ["id"], target_bytes=total // 6)
    assert 4 <= files(f"{tmp_path}/split") <= 10


def test_compaction_keeps_partition_names(spark, tmp_path):
    rows = spark.createDataFrame([("001", 1), ("1", 2), ("2024-01-01", 3), (None, 4)], "part STRING, id LONG")
    rows.write.partitionBy("part").parquet(f"{tmp_path}/small")
    few = writers.compact_files(spark, f"{tmp_path}/small", f"{tmp_path}/large", ["part"], schema=rows.select("id", "part").schema)
    assert storage.folders(spark, f"{tmp_path}/large") == storage.folders(spark, f"{tmp_path}/small")
    assert {(r["part"], r["id"]) for r in few.collect()} == {(r["part"], r["id"]) for r in rows.collect()}


def test_keyed_messages(spark):
    log = spark.createDataFrame([(1, "u", 5), (1, "d", 5), (2, "c", None)], "id LONG, op STRING, x LONG")
    got = [tuple(r) for r in writers.keyed_messages(log, ["id"], ["id", "x"]).collect()]
    assert got == [('{"id":1}', '{"id":1,"x":5}'), ('{"id":1}', None), ('{"id":2}', '{"id":2,"x":null}')]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = session.scratch(spark, "x")
    assert path != session.scratch(spark, "x")
    if named:
        assert path.startswith(named)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_struct_types():
    assert struct({"a": "decimal(5,2)", "b": "long"}) == T.StructType(
        [T.StructField("a", T.DecimalType(5, 2)), T.StructField("b", T.LongType())]
    )
