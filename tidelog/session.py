"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager, nullcontext
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tidelog.sources import storage

def is_local(spark: SparkSession) -> bool:
    """One process runs everything, so its own folders are shared by all there is."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def local_session(name: str = "tidelog", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark. A cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(os.cpu_count() if cores == "*" else cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Event times are instants, so every session reads and prints them in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a session of one process, as tests and the benchmark start, may use a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tidelog-")
    context.setCheckpointDir(own)
    return context.getCheckpointDir().rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tidelog/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder; nothing is created yet."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Removes everything this application materialized. Results that still read it end here."""
    storage.delete(spark, scratch_root(spark))


# Removes the shuffle files of a query when it ends, and not when the driver next collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_on_the_way: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries that run inside leave no shuffle files behind. The session's own choice comes back at the end."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


# Rows and bytes of a batch that Spark hands to a Python worker. An executor's buffers for batches of a few megabytes and
# more stay in the arenas of its C library, one for each thread, and add up over stages.
ARROW_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "200", "spark.sql.execution.arrow.maxBytesPerBatch": "1m"}


@contextmanager
def small_batches(spark: SparkSession):
    """Queries that run inside hand rows to Python workers in small batches. Sizes that the session names itself stay."""
    own = [name for name in ARROW_BATCHES if spark.conf.get(name, None) is None]
    try:
        for name in own:
            spark.conf.set(name, ARROW_BATCHES[name])
        yield
    finally:
        for name in own:
            spark.conf.unset(name)


def materialize(df: DataFrame, purpose: str, fine: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later passes see exactly the same rows and splits even if executors are lost, and they read
    only the columns they need. Shuffle files of the write go as soon as it ends. ``fine`` is for steps in Python that
    put batches together as they need them (``words.small``).
    """
    spark = df.sparkSession
    path = scratch(spark, purpose)
    if (made := _on_the_way.get()) is not None:
        made.append(path)
    with shuffles_removed(spark), small_batches(spark) if fine else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, build: Callable[[], DataFrame], purpose: str, fine: bool = False) -> DataFrame:
    """``materialize(build(), purpose, fine)``; the tables that were materialized on the way are removed once it is written.

    No other DataFrame may go on reading those tables. If something fails, they stay for a look and for ``clear_scratch``.
    """
    outer = _on_the_way.get()
    made: list[str] = []
    token = _on_the_way.set(made)
    try:
        settled = materialize(build(), purpose, fine)
    finally:
        _on_the_way.reset(token)
    *passing, kept = made
    if outer is not None:
        outer.append(kept)
    for path in passing:
        storage.delete(spark, path)
    return settled
