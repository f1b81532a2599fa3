"""Data-quality reports. Each report is one pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.rules import first_broken


def null_profile(df: DataFrame, columns: Sequence[str], invalid: Mapping[str, Column]) -> DataFrame:
    """Row count, filled values per column, and rows that meet each ``invalid`` condition."""
    return df.agg(
        F.count("*").alias("total_records"),
        *[F.count(c).alias(f"non_null_{c}") for c in columns],
        *[F.count_if(cond).alias(f"invalid_{name}") for name, cond in invalid.items()],
    )


def quality_violations(
    df: DataFrame, rules: Sequence[tuple[str, Column]], key: Sequence[str], n: int | None = 20,
    status: str = "data_quality_status",
) -> DataFrame:
    """Rows that break a rule, with the first rule they break; ``n`` is the length of the report."""
    broken = F.lit(False)
    for _, condition in rules:
        broken = broken | F.coalesce(condition, F.lit(False))
    rows = df.filter(broken).withColumn(status, first_broken(rules))
    return rows if n is None else rows.orderBy(*key).limit(n)


def sum_consistency(
    df: DataFrame, total: Column, parts: Column, key: Sequence[str], tolerance=100, n: int | None = 20
) -> DataFrame:
    """Compares a stored total with the sum of its parts; the worst differences first."""
    diff = F.abs(total - parts)
    known = df.filter(total.isNotNull() & parts.isNotNull())
    rows = known.select(
        *key,
        total.alias("stated_total"),
        parts.alias("calculated_total"),
        diff.alias("difference"),
        F.when(diff > tolerance, "INCONSISTENT").otherwise("CONSISTENT").alias("consistency"),
    )
    return rows if n is None else rows.orderBy(F.desc("difference"), *key).limit(n)


def duplicate_keys(df: DataFrame, key: Sequence[str], n: int | None = 10) -> DataFrame:
    counts = df.groupBy(*key).agg(F.count("*").alias("duplicate_count")).filter("duplicate_count > 1")
    return counts if n is None else counts.orderBy(F.desc("duplicate_count"), *key).limit(n)


def _tall(one_row: DataFrame, rows: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """Turns a one-row result into one row per entry of ``rows``."""
    cells = [cell for row in rows for cell in row]
    return one_row.select(F.stack(F.lit(len(rows)), *cells).alias(*names))


def validation_summary(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """``(metric, value)`` rows from aggregates that are all computed in one pass."""
    named = {f"m{i}": expr.cast("string") for i, expr in enumerate(metrics.values())}
    one = df.agg(*[expr.alias(name) for name, expr in named.items()])
    rows = [(F.lit(metric), F.col(name)) for metric, name in zip(metrics, named)]
    return _tall(one, rows, ["metric", "value"])


def quality_score(valid: Column) -> Column:
    """Share of valid rows as text, such as ``98.5%``; NULL for an empty table."""
    score = F.round(
        F.try_divide(F.count_if(valid).cast("double") * 100.0, F.count("*").cast("double")), 2
    )
    return F.concat(score.cast("string"), F.lit("%"))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Type, filled, missing and distinct values, smallest and largest value of every column.

    Exact distinct counts take one row per column and value through a shuffle after removing repeats on the map side.
    A large table may lie in few splits, so its rows are dealt to the session's shuffle partitions before that, and a
    task holds the values of its part only. ``approximate=True`` uses a sketch and no shuffle.
    """
    kinds = dict(df.dtypes)
    chosen = list(columns or df.columns)
    if approximate:
        parts = [F.count("*").alias("n")]
        for i, c in enumerate(chosen):
            col = F.col(c)
            parts += [F.count(col).alias(f"f{i}"), F.approx_count_distinct(col).alias(f"d{i}"), F.min(col).alias(f"lo{i}"), F.max(col).alias(f"hi{i}")]
        one = df.agg(*parts)
    else:
        one = _exact_profile(df, chosen)
    rows = [
        (F.lit(c), F.lit(kinds[c]), F.col(f"f{i}"), F.col("n") - F.col(f"f{i}"), F.col(f"d{i}"),
         F.col(f"lo{i}").cast("string"), F.col(f"hi{i}").cast("string"))
        for i, c in enumerate(chosen)
    ]
    names = ["column_name", "data_type", "non_null", "nulls", "distinct_values", "min_value", "max_value"]
    return _tall(one, rows, names)


def _exact_profile(df: DataFrame, chosen: Sequence[str]) -> DataFrame:
    """``n`` and for the i-th column ``f{i}, d{i}, lo{i}, hi{i}``, told from its distinct values and their counts."""
    values = df.select(*[F.col(c).alias(f"v{i}") for i, c in enumerate(chosen)])
    types = [field.dataType for field in values.schema.fields]
    slots = list({kind.json(): kind for kind in types}.values())  # columns of one type share a slot
    slot = [f"s{slots.index(kind)}" for kind in types]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = values.withColumn("at", F.monotonically_increasing_id()).repartition(tasks, "at")
    cells = [
        F.struct(
            F.lit(i).alias("i"),
            *[(F.col(f"v{i}") if f"s{k}" == slot[i] else F.lit(None).cast(kind)).alias(f"s{k}") for k, kind in enumerate(slots)],
        )
        for i in range(len(chosen))
    ]
    cell = dealt.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    # Grouping makes -0.0 and 0.0 one value, so what there is of them is kept beside it.
    signs = [f"s{k}" for k, kind in enumerate(slots) if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType)]
    ends = [part for s in signs for part in (F.min(s).alias(f"lo_{s}"), F.max(s).alias(f"hi_{s}"))]
    distinct = cell.groupBy("i", *[f"s{k}" for k in range(len(slots))]).agg(F.count("*").alias("rows"), *ends)
    parts = [F.coalesce(F.sum(F.when(F.col("i") == 0, F.col("rows"))), F.lit(0)).alias("n")]
    for i, s in enumerate(slot):
        own = (F.col("i") == i) & F.col(s).isNotNull()
        low, high = (f"lo_{s}", f"hi_{s}") if s in signs else (s, s)
        parts += [
            F.coalesce(F.sum(F.when(own, F.col("rows"))), F.lit(0)).alias(f"f{i}"),
            F.count_if(own).alias(f"d{i}"),
            F.min(F.when(own, F.col(low))).alias(f"lo{i}"),
            F.max(F.when(own, F.col(high))).alias(f"hi{i}"),
        ]
    return distinct.agg(*parts)
