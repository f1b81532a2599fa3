"""A table in parts, of which a new version writes only those that changed.

Layout below the root: ``version=N/_p=K/`` holds part K as of version N. A version has the parts that changed since the one
before; the others are in older versions. ``_FOLDED`` marks a finished version, and until it is there no reader looks
at the version's folders, so a reader sees every part whole. ``_HELD`` marks an older version that only lends its parts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidelog.sources import storage

PART = "_p"


class Parted:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root, schema

    def _at(self, version: int) -> str:
        return f"{self.root}/version={version}"

    def _marked(self, *marks: str) -> list[int]:
        named = [int(f.split("=")[1]) for f in storage.folders(self.spark, self.root)]
        return sorted(v for v in named if any(storage.exists(self.spark, f"{self._at(v)}/{m}") for m in marks))

    def versions(self) -> list[int]:
        """Versions that can be read."""
        return self._marked("_FOLDED")

    def newest_before(self, through: int) -> int:
        """The newest version up to ``through``, -1 if there is none."""
        return max([-1, *[v for v in self.versions() if v <= through]])

    def _parts_in(self, version: int) -> list[int]:
        return [int(f.split("=")[1]) for f in storage.folders(self.spark, self._at(version)) if f.startswith(f"{PART}=")]

    def holders(self, through: int) -> dict[int, int]:
        """For each part the version that holds it as of version ``through``."""
        held: dict[int, int] = {}
        for version in self._marked("_FOLDED", "_HELD"):
            if version <= through:
                held |= dict.fromkeys(self._parts_in(version), version)
        return held

    def read(self, through: int, only: Iterable[int] | None = None, but: Iterable[int] = ()) -> DataFrame:
        """The rows as of a version; ``only`` some parts, or all ``but`` some."""
        held = self.holders(through)
        wanted = (set(held) if only is None else set(held) & set(only)) - set(but)
        paths = [f"{self._at(held[part])}/{PART}={part}" for part in sorted(wanted)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame, version: int, touched: Iterable[int]) -> None:
        """Writes the ``touched`` parts, with all rows that they have now; ``rows`` has their numbers in ``_p``.

        A part that is left without rows gets an empty folder, so that no older one counts. ``mark`` makes it readable.
        """
        spread = rows.select(*self.schema.names, PART).hint("rebalance", PART)
        spread.write.mode("overwrite").partitionBy(PART).option("compression", "snappy").parquet(self._at(version))
        for part in set(touched) - set(self._parts_in(version)):
            storage.touch(self.spark, f"{self._at(version)}/{PART}={part}/_EMPTY")

    def mark(self, version: int) -> None:
        storage.touch(self.spark, f"{self._at(version)}/_FOLDED")

    def vacuum(self, keep_from: int) -> None:
        """Removes what only versions older than ``keep_from`` need. Parts that newer ones still read stay."""
        needed = self.holders(keep_from)
        for version in self._marked("_FOLDED", "_HELD"):
            if version >= keep_from:
                continue
            kept = {part for part, holder in needed.items() if holder == version}
            if kept:
                storage.touch(self.spark, f"{self._at(version)}/_HELD")
                storage.delete(self.spark, f"{self._at(version)}/_FOLDED")
                for part in set(self._parts_in(version)) - kept:
                    storage.delete(self.spark, f"{self._at(version)}/{PART}={part}")
            else:
                storage.delete(self.spark, self._at(version))
