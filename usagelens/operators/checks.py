"""Data-quality checks: each returns the failing rows, so an empty result passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.temporal import at, unix_seconds


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; NULLs are not compared."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    return counts.where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with another value; NULL passes."""
    return df.where(~F.col(column).isin(list(values)))


def expression_is_true(df: DataFrame, condition: Column) -> DataFrame:
    """Rows on which the condition is false or NULL."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def source_freshness(
    df: DataFrame, loaded_at: str, as_of: datetime, warn_hours: float, error_hours: float
) -> DataFrame:
    """One row: newest load, its age in hours and pass / warn / error. No rows is an error."""
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = (unix_seconds(at(as_of)) - unix_seconds(F.col("max_loaded_at"))) / 3600
    status = (
        F.when(age.isNull() | (age > error_hours), "error")
        .when(age > warn_hours, "warn")
        .otherwise("pass")
    )
    return newest.select(
        "max_loaded_at", age.cast("double").alias("age_hours"), status.alias("status")
    )


def source_freshness_all(
    tables: Mapping[str, DataFrame], limits: Mapping[str, tuple[str, float, float]], as_of: datetime
) -> DataFrame:
    """One row per source with declared limits: (source, newest load, age, state).

    ``limits`` holds the load-time column and the hours to warn and to fail at.
    """
    rows = None
    for name, (loaded_at, warn_hours, error_hours) in limits.items():
        found = source_freshness(tables[name], loaded_at, as_of, warn_hours, error_hours)
        found = found.select(F.lit(name).alias("source"), "*")
        rows = found if rows is None else rows.unionByName(found)
    return rows


@dataclass(frozen=True)
class Check:
    """A declared check on a model's output."""

    kind: str
    column: str = ""
    values: tuple = ()
    condition: str = ""
    severity: str = "error"
    label: str = field(default="")

    @property
    def name(self) -> str:
        return self.label or f"{self.kind}_{self.column}"

    def failing(self, df: DataFrame) -> DataFrame:
        if self.kind == "not_null":
            return not_null(df, self.column)
        if self.kind == "unique":
            return unique(df, self.column)
        if self.kind == "accepted_values":
            return accepted_values(df, self.column, self.values)
        if self.kind == "expression_is_true":
            return expression_is_true(df, F.expr(self.condition))
        raise ValueError(f"unknown check {self.kind!r}")

    def row_failure(self) -> Column | None:
        """Failure as a row predicate, for the kinds that need no grouping."""
        column = F.col(self.column) if self.column else None
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "accepted_values":
            return ~column.isin(list(self.values))
        if self.kind == "expression_is_true":
            return ~F.coalesce(F.expr(self.condition), F.lit(False))
        return None


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``check, severity, failures, passed`` per check.

    All row checks share one scan with partial aggregation; each uniqueness check adds a
    grouped count.
    """
    by_row = [c for c in checks if c.kind != "unique"]
    parts = []
    if by_row:
        counts = df.agg(
            *[F.count_if(c.row_failure()).alias(f"c{i}") for i, c in enumerate(by_row)]
        )
        entries = [
            F.struct(
                F.lit(c.name).alias("check"),
                F.lit(c.severity).alias("severity"),
                F.col(f"c{i}").alias("failures"),
            )
            for i, c in enumerate(by_row)
        ]
        parts.append(counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))
    for c in checks:
        if c.kind == "unique":
            parts.append(
                c.failing(df)
                .agg(F.count("*").alias("failures"))
                .select(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), "failures")
            )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn("passed", F.col("failures") == 0)
