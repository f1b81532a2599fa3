"""Shapes of change events and of the tables they describe."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Operation codes of a change event, and the two label sets in use.
CREATE, UPDATE, DELETE, READ = "c", "u", "d", "r"
OPS = (CREATE, UPDATE, DELETE, READ)
LABELS = {"c": "CREATE", "u": "UPDATE", "d": "DELETE", "r": "READ"}
LABELS_SQL = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}



def struct(columns: Mapping[str, str]) -> T.StructType:
    """``{name: type}`` as a struct of nullable fields; needs no running session.

    Types are Spark's JSON type names: string, long, integer, double, decimal(5,2), timestamp, ...
    """
    fields = [{"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in columns.items()]
    return T.StructType.fromJson({"fields": fields})


# The origin block of an envelope.
ORIGIN = struct(
    {
        "version": "string",
        "connector": "string",
        "name": "string",
        "ts_ms": "long",
        "snapshot": "string",
        "db": "string",
        "sequence": "string",
        "schema": "string",
        "table": "string",
        "txId": "long",
        "lsn": "long",
        "xmin": "long",
    }
)

CORRUPT = "corrupt"


@dataclass(frozen=True)
class Feed:
    """One captured table: its row image, its key, and how columns are renamed on the way.

    ``row`` uses the names found in the messages; so do the others. ``rename`` maps message names to
    table names. ``decimals`` gives (precision, scale) of text columns in which the connector sends
    encoded decimals.
    """

    row: T.StructType
    key: tuple[str, ...] = ()
    rename: Mapping[str, str] = field(default_factory=dict)
    decimals: Mapping[str, tuple[int, int]] = field(default_factory=dict)

    def __post_init__(self):
        names = set(self.row.names)
        for label, used in (("rename", self.rename), ("key", self.key), ("decimals", self.decimals)):
            absent = [c for c in used if c not in names]
            if absent:
                raise ValueError(f"{label} names columns that the row does not have: {absent}")
        numbers = [c for c in self.decimals if not isinstance(self.row[c].dataType, T.StringType)]
        if numbers:
            raise ValueError(f"decimals are text in the messages, but these are not: {numbers}")
        target = [self.target(c) for c in self.row.names]
        if len(set(target)) != len(target):
            raise ValueError(f"two columns end up with the same name: {target}")

    @classmethod
    def of(
        cls,
        columns: Mapping[str, str],
        key: tuple[str, ...] = (),
        rename: Mapping[str, str] | None = None,
        decimals: Mapping[str, tuple[int, int]] | None = None,
    ):
        return cls(struct(columns), tuple(key), dict(rename or {}), dict(decimals or {}))

    def target(self, column: str) -> str:
        return self.rename.get(column, column)

    @property
    def target_key(self) -> tuple[str, ...]:
        return tuple(self.target(c) for c in self.key)

    @property
    def columns(self) -> list[str]:
        """Table column names, in row order."""
        return [self.target(c) for c in self.row.names]

    @property
    def envelope(self) -> T.StructType:
        return (
            T.StructType()
            .add("before", self.row)
            .add("after", self.row)
            .add("op", T.StringType())
            .add("ts_ms", T.LongType())
            .add("source", ORIGIN)
        )

    @property
    def wrapped(self) -> T.StructType:
        return T.StructType().add("payload", self.envelope)

    @property
    def flat(self) -> T.StructType:
        meta = struct(
            {
                "__op": "string",
                "__source_ts_ms": "long",
                "__source_db": "string",
                "__source_lsn": "long",
                "__deleted": "string",
            }
        )
        return T.StructType(list(self.row.fields) + list(meta.fields))

    @property
    def prefixed(self) -> T.StructType:
        fields = [
            T.StructField(f"{side}_{f.name}", f.dataType)
            for side in ("before", "after")
            for f in self.row.fields
        ]
        tail = struct({"op": "string", "ts_ms": "long", "lsn": "long"})
        return T.StructType(fields + list(tail.fields))


# The city demographics table, twelve columns.
DEMOGRAPHICS_COLUMNS = {
    "city": "string",
    "state": "string",
    "median_age": "double",
    "male_population": "long",
    "female_population": "long",
    "total_population": "long",
    "number_of_veterans": "long",
    "foreign_born": "long",
    "average_household_size": "double",
    "state_code": "string",
    "race": "string",
    "count": "long",
}
DEMOGRAPHICS = Feed.of(
    DEMOGRAPHICS_COLUMNS, key=("city", "state", "race"), rename={"count": "population_count"}
)

# The same table from a connector that sends its two decimals encoded.
DEMOGRAPHICS_ENCODED = Feed.of(
    {**DEMOGRAPHICS_COLUMNS, "median_age": "string", "average_household_size": "string"},
    key=("city", "state", "race"),
    rename={"count": "population_count"},
    decimals={"median_age": (5, 2), "average_household_size": (3, 2)},
)
