"""Small file-system operations that work on any store Spark can reach. They need a classic session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def committed(spark: SparkSession, path: str) -> bool:
    """Whether Spark finished writing a folder: its committer leaves a mark as the last thing."""
    return exists(spark, f"{path}/_SUCCESS")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file; an existing one is replaced."""
    fs, p = _at(spark, path)
    fs.create(p, True).close()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it does not exist."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def file_count(spark: SparkSession, path: str) -> int:
    """Data files directly in ``path``."""
    fs, p = _at(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]
    return sum(not n.startswith(("_", ".")) for n in names)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``."""
    fs, p = _at(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
