"""Column tests: not null, unique, accepted values, accepted range. One result row per test."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, WARN = "block", "warn"


@dataclass(frozen=True)
class Check:
    column: str
    kind: str
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    inclusive: bool = True
    severity: str = BLOCK

    def violation(self) -> Column:
        """True for a row that breaks the rule. NULL breaks only ``not_null``."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "accepted_values":
            return ~c.isin(*self.values)
        if self.kind == "accepted_range":
            sides = []
            if self.low is not None:
                sides.append(c >= self.low if self.inclusive else c > self.low)
            if self.high is not None:
                sides.append(c <= self.high if self.inclusive else c < self.high)
            return ~reduce(lambda a, b: a & b, sides)
        raise ValueError(f"{self.kind} is not a row rule")


def not_null(*columns: str) -> tuple[Check, ...]:
    return tuple(Check(c, "not_null") for c in columns)


def unique(column: str) -> Check:
    return Check(column, "unique")


def accepted_values(column: str, *values: str) -> Check:
    return Check(column, "accepted_values", values=values)


def accepted_range(column: str, low: float | None, high: float | None = None, inclusive: bool = True) -> Check:
    return Check(column, "accepted_range", low=low, high=high, inclusive=inclusive)


def check_table(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame | None:
    """Violations per check: all row rules in one pass, each uniqueness test by its own grouping.

    A row rule counts rows; a uniqueness test counts values that occur more than once.
    """
    parts = []
    rules = [c for c in checks if c.kind != "unique"]
    if rules:
        counts = df.agg(*[F.count_if(c.violation()).alias(f"_{i}") for i, c in enumerate(rules)])
        lines = [_line(table, c, F.col(f"_{i}")) for i, c in enumerate(rules)]
        parts.append(counts.select(F.explode(F.array(*lines)).alias("_l")).select("_l.*"))
    for c in checks:
        if c.kind == "unique":
            repeated = duplicate_values(df, c.column).agg(F.count("*").alias("_n"))
            parts.append(repeated.select(_line(table, c, F.col("_n")).alias("_l")).select("_l.*"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their number of occurrences."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def _line(table: str, check: Check, violations: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        violations.cast("bigint").alias("violations"),
    )


def check_tables(
    tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence[Check]], kinds: Sequence[str] | None = None
) -> DataFrame:
    """All checks (or those of the given kinds) of all tables."""
    results = []
    for name, df in tables.items():
        wanted = [c for c in checks.get(name, ()) if kinds is None or c.kind in kinds]
        result = check_table(df, name, wanted)
        if result is not None:
            results.append(result)
    return reduce(DataFrame.unionByName, results)


def blocking(results: DataFrame) -> DataFrame:
    """Failed checks that stop the chain."""
    return results.filter((F.col("violations") > 0) & (F.col("severity") == BLOCK))
