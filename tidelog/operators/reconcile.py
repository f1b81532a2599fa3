"""Comparing a source with what arrived downstream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_inner(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Equi-join without a hint: Spark broadcasts a side it knows to be small and splits hot keys."""
    return left.join(right, list(on), "inner")


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each stage in pipeline order, with a verdict that looks at the whole chain.

    GOOD: every stage has rows. IN PROGRESS: all but the last have. NOT ESTABLISHED: anything else.
    """
    names = list(stages)
    counted = None
    for name, df in stages.items():
        part = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows")
        counted = part if counted is None else counted.unionByName(part)
    one = counted.agg(
        *[F.max(F.when(F.col("stage") == n, F.col("rows"))).alias(f"n{i}") for i, n in enumerate(names)]
    )
    filled = [F.col(f"n{i}") > 0 for i in range(len(names))]
    upstream = F.lit(True)
    for cond in filled[:-1]:
        upstream = upstream & cond
    verdict = F.when(upstream & filled[-1], "GOOD").when(upstream, "IN PROGRESS").otherwise("NOT ESTABLISHED")
    cells = []
    for i, n in enumerate(names):
        cells += [F.lit(n), F.lit(i + 1), F.col(f"n{i}"), F.col("n0") - F.col(f"n{i}")]
    return one.select(
        F.stack(F.lit(len(names)), *cells).alias("stage", "position", "rows", "behind_source"),
        verdict.alias("verdict"),
    )


def reconcile_diff(
    source: DataFrame, target: DataFrame, key: Sequence[str], compare: Sequence[str], all_rows: bool = False
) -> DataFrame:
    """Keys on which two tables differ: ``missing`` downstream, ``extra`` downstream, or ``changed``.

    Both tables hold one row per key. NULL equals NULL. ``columns_changed`` names the differences.
    """
    left = source.select(*key, F.struct(*compare).alias("_s"))
    right = target.select(*key, F.struct(*compare).alias("_t"))
    both = left.join(right, list(key), "full_outer")
    differs = [
        F.when(~F.col("_s")[c].eqNullSafe(F.col("_t")[c]), F.lit(c)) for c in compare
    ]
    changed = F.concat_ws(",", *differs)
    status = (
        F.when(F.col("_t").isNull(), "missing")
        .when(F.col("_s").isNull(), "extra")
        .when(changed != "", "changed")
        .otherwise("same")
    )
    rows = both.select(
        *key,
        status.alias("status"),
        F.when(status == "changed", changed).alias("columns_changed"),
    )
    return rows if all_rows else rows.filter("status <> 'same'")


def range_checksums(df: DataFrame, key: str, compare: Sequence[str], low: int, width: int) -> DataFrame:
    """``range, rows, sum_1, sum_2`` for each run of ``width`` key values from ``low`` on; NULL keys have no range."""
    place = ((F.col(key) - F.lit(low)) / F.lit(width)).cast("bigint")
    parts = [part for c in (key, *compare) for part in (F.col(c).isNull(), F.col(c))]
    sums = [F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)")).alias(f"sum_{seed}") for seed in (1, 2)]
    return df.where(F.col(key).isNotNull()).groupBy(place.alias("range")).agg(F.count("*").alias("rows"), *sums)


def differing_ranges(
    source: DataFrame, target: DataFrame, key: str, compare: Sequence[str], ranges: int = 1024
) -> list[tuple[int, int]]:
    """First and last key of the key ranges whose checksums differ; neighbouring ones are one.

    The keys are whole numbers. They are cut into at most ``ranges`` ranges, so that is what reaches the driver.
    """
    ends = source.select(key).unionByName(target.select(key)).agg(F.min(key), F.max(key)).first()
    if ends[0] is None:
        return []
    low, width = int(ends[0]), -(-(int(ends[1]) - int(ends[0]) + 1) // ranges)
    sides = [range_checksums(df, key, compare, low, width) for df in (source, target)]
    left, right = (df.select("range", F.struct("rows", "sum_1", "sum_2").alias(n)) for df, n in zip(sides, ("_s", "_t")))
    differ = left.join(right, "range", "full_outer").where(~F.col("_s").eqNullSafe(F.col("_t"))).select("range")
    found: list[tuple[int, int]] = []
    for number in sorted(r[0] for r in differ.collect()):
        first, last = low + number * width, low + (number + 1) * width - 1
        if found and found[-1][1] + 1 == first:
            first = found.pop()[0]
        found.append((first, last))
    return found


def diff_by_ranges(
    source: DataFrame, target: DataFrame, key: str, compare: Sequence[str], ranges: int = 1024
) -> DataFrame:
    """The rows of ``reconcile_diff`` with checksums of key ranges first: only ranges that differ are compared.

    The ranges go to the scans as bounds on the key, so files and row groups without such keys are not read. Rows
    with a NULL key match nothing and are always compared. Both tables are taken to hold one row per key.
    """
    wanted = F.col(key).isNull()
    for first, last in differing_ranges(source, target, key, compare, ranges):
        wanted = wanted | F.col(key).between(first, last)
    return reconcile_diff(source.where(wanted), target.where(wanted), [key], compare)


def table_checksum(df: DataFrame, columns: Mapping[str, Column] | None = None, portable: bool = False) -> DataFrame:
    """Row count and a checksum that does not depend on row order.

    The fast form sums 64-bit hashes of values and null flags in place. ``portable=True`` sums the first 60 bits
    of an MD5 over the columns as text, each as its length, a colon and itself, or ``~`` for NULL, which any
    database can repeat. So a value cannot pass for a part of its neighbour.
    """
    chosen = columns or {c: F.col(c) for c in df.columns}
    if portable:
        cells = [c.cast("string") for c in chosen.values()]
        text = F.concat(*[F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("~")) for c in cells])
        value = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    else:
        value = F.xxhash64(*[part for c in chosen.values() for part in (c.isNull(), c)])
    return df.agg(
        F.count("*").alias("row_count"),
        F.sum(value.cast("decimal(28,0)")).cast("string").alias("checksum"),
    )


def arrival_check(sent: DataFrame, log: DataFrame, key: Sequence[str]) -> DataFrame:
    """For every sent key, whether the log holds it. Repeats are removed before the match."""
    seen = log.select(*key).dropna().distinct().withColumn("_seen", F.lit(True))
    asked = sent.select(*key).distinct()
    return asked.join(seen, list(key), "left").select(
        *key, F.coalesce("_seen", F.lit(False)).alias("arrived")
    )
