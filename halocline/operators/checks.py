"""Consistency checks.  Each returns the offending rows; ``require_none`` raises on any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from halocline.functions.calendar import within_months, year_month
from halocline.schema import CELL


class CheckFailed(ValueError):
    """A consistency check found offending rows."""


def require_none(offending: DataFrame, what: str, show: int = 5) -> None:
    rows = offending.take(show)
    if rows:
        raise CheckFailed(f"{what}: {[r.asDict() for r in rows]}")


def require_some(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise CheckFailed(what)


def time_bounds(df: DataFrame, dataset: Sequence[str]) -> DataFrame:
    """First and last step and the number of steps.

    Steps are counted from the distinct (dataset, time) pairs, so no task holds a
    dataset's rows.
    """
    steps = df.select(*dataset, "time").distinct()
    return steps.groupBy(*dataset).agg(
        F.min("time").alias("start"), F.max("time").alias("end"), F.count("*").alias("months"),
    )


def uncovered(df: DataFrame, dataset: Sequence[str], start: str | None, end: str | None) -> DataFrame:
    """Datasets that begin after ``start`` or end before ``end``."""
    bounds = df.groupBy(*dataset).agg(F.min("time").alias("first"), F.max("time").alias("last"))
    problem: Column = F.lit(None).cast("string")
    if end is not None:
        problem = F.when(year_month("last") < end, F.lit("ends early")).otherwise(problem)
    if start is not None:
        problem = F.when(year_month("first") > start, F.lit("starts late")).otherwise(problem)
    return bounds.withColumn("problem", problem).where(F.col("problem").isNotNull())


def time_slice(df: DataFrame, dataset: Sequence[str], start: str | None, end: str | None) -> DataFrame:
    """Month window, inclusive; every dataset must cover it."""
    if start is None and end is None:
        return df
    require_none(uncovered(df, dataset, start, end), f"window {start}..{end} not covered")
    out = df.where(within_months("time", start, end))
    require_some(out, f"no step between {start} and {end}")
    return out


def repeated_steps(df: DataFrame, dataset: Sequence[str], cell: Sequence[str] = CELL) -> DataFrame:
    """Cells holding a time step more than once (time must increase strictly)."""
    return (
        df.groupBy(*dataset, *cell, "time").agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )


def unordered_steps(df: DataFrame, dataset: Sequence[str], position: str = "t_idx") -> DataFrame:
    """Steps of an axis table that do not come after their predecessor."""
    w = Window.partitionBy(*dataset).orderBy(position)
    return df.withColumn("previous", F.lag("time").over(w)).where(F.col("time") <= F.col("previous"))


def wrong_period(df: DataFrame, dataset: Sequence[str], start: str, end: str, months: int) -> DataFrame:
    """Datasets whose first month, last month or number of months is not as expected."""
    b = time_bounds(df, dataset).select(
        *dataset, year_month("start").alias("start"), year_month("end").alias("end"), "months")
    fine = (F.col("start") == start) & (F.col("end") == end) & (F.col("months") == months)
    return b.where(~fine)


def incomplete(df: DataFrame, keys: Sequence[str], expected: int = 12) -> DataFrame:
    """Groups with fewer rows than expected."""
    return df.groupBy(*keys).agg(F.count("*").alias("files")).where(F.col("files") < expected)


def require_columns(df: DataFrame, *alternatives: Sequence[str]) -> None:
    """At least one of the column sets must be present."""
    if not any(set(a) <= set(df.columns) for a in alternatives):
        raise CheckFailed(f"columns {df.columns} match none of {[list(a) for a in alternatives]}")
