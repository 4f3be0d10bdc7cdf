"""Per-cell time series: monthly reduction, trend, climatology, anomaly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from halocline.functions.calendar import month_start
from halocline.functions.numeric import ratio
from halocline.operators.axis import with_time_index
from halocline.schema import CELL

COORDS = ("lat", "lon")


def monthly(df: DataFrame, dataset: Sequence[str], how: str = "max", value: str = "value",
            cell: Sequence[str] = CELL) -> DataFrame:
    """Reduce to one row per cell and year-month ("max", "mean" or "min")."""
    reduce = {"max": F.max, "mean": F.avg, "min": F.min}[how]
    return (
        df.groupBy(*dataset, *cell, month_start("time").alias("time"))
        .agg(*[F.min(c).alias(c) for c in COORDS if c in df.columns], reduce(value).alias(value))
    )


def climatology(df: DataFrame, dataset: Sequence[str], value: str = "value",
                cell: Sequence[str] = CELL) -> DataFrame:
    """Mean of each calendar month over all years, per cell."""
    return (
        df.groupBy(*dataset, *cell, F.month("time").alias("month"))
        .agg(F.avg(value).alias("climatology"))
    )


def by_calendar_month(df: DataFrame, keys: Sequence[str], how: str = "mean",
                      value: str = "value") -> DataFrame:
    reduce = {"max": F.max, "mean": F.avg}[how]
    return df.groupBy(*keys, F.month("time").alias("month")).agg(reduce(value).alias(value))


def _windows(dataset: Sequence[str], cell: Sequence[str]) -> tuple[Window, Window]:
    """Whole-cell and cell-by-calendar-month windows sharing one exchange and one sort.

    The first one is ordered by month only to ask for the order the second needs;
    its frame is the whole partition either way.
    """
    whole = (
        Window.partitionBy(*dataset, *cell).orderBy("_month")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return whole, Window.partitionBy(*dataset, *cell, "_month")


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("_month", F.month("time"))


def solved(df: DataFrame) -> DataFrame:
    """Adds ``_c0, _c1, _c2``, the quadratic of power sums ``_s0`` to ``_s4`` and cross sums ``_b0`` to ``_b2``."""
    s = [F.col(f"_s{k}") for k in range(5)]
    b = [F.col(f"_b{k}") for k in range(3)]

    df = df.withColumns({"_l1": ratio(s[1], s[0]), "_l2": ratio(s[2], s[0])})
    l1, l2 = F.col("_l1"), F.col("_l2")
    df = df.withColumns({
        "_d1": s[2] - l1 * s[1], "_e1": s[3] - l1 * s[2], "_z1": b[1] - l1 * b[0],
    })
    d1, e1, z1 = F.col("_d1"), F.col("_e1"), F.col("_z1")
    slope_ok = d1 > 0
    df = df.withColumn("_l3", F.when(slope_ok, ratio(e1, d1)).otherwise(0e0))
    l3 = F.col("_l3")
    df = df.withColumns({
        "_d2": s[4] - l2 * s[2] - l3 * e1, "_z2": b[2] - l2 * b[0] - l3 * z1,
    })
    df = df.withColumn(
        "_c2", F.when(slope_ok & (F.col("_d2") > 0), ratio(F.col("_z2"), F.col("_d2"))).otherwise(0e0))
    c2 = F.col("_c2")
    df = df.withColumn("_c1", F.when(slope_ok, ratio(z1, d1) - l3 * c2).otherwise(0e0))
    c1 = F.col("_c1")
    df = df.withColumn("_c0", ratio(b[0], s[0]) - l1 * c1 - l2 * c2)
    return df


def _detrended(df: DataFrame, whole: Window, value: str) -> DataFrame:
    """Residual of a degree-2 least-squares fit over positions scaled to [-1, 1].

    The normal equations are solved by symmetric elimination, which stays stable
    when a cell has few values close together.  If rounding exhausts a pivot the
    fit falls back to the lower degree.
    """
    y = F.col(value)
    present = y.isNotNull()
    last = F.nullif(F.col("n_time") - 1, F.lit(0)).cast("double")
    df = df.withColumn("_x", F.coalesce(F.col("t_idx") * 2e0 / last, F.lit(0e0)) - 1e0)
    x = F.col("_x")

    def moment(power: int, weighted: bool) -> Column:
        term = F.lit(1e0)
        for _ in range(power):
            term = term * x
        return F.sum(F.when(present, term * y if weighted else term)).over(whole)

    df = df.select(
        "*",
        *[moment(k, False).alias(f"_s{k}") for k in range(5)],
        *[moment(k, True).alias(f"_b{k}") for k in range(3)],
    )
    df = solved(df)
    fit = F.col("_c0") + x * (F.col("_c1") + x * F.col("_c2"))
    return df.withColumn(value, F.when(F.col("_s0") >= 3, y - fit))


def _drop_scratch(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def _indexed(df: DataFrame, dataset: Sequence[str]) -> DataFrame:
    return df if {"t_idx", "n_time"} <= set(df.columns) else with_time_index(df, dataset)


def quadratic_detrend(df: DataFrame, dataset: Sequence[str], value: str = "value",
                      cell: Sequence[str] = CELL) -> DataFrame:
    """Remove a quadratic trend from every cell.

    The abscissa is the position on the dataset's time axis, so calendar gaps do
    not stretch it.  NULL stays NULL; a cell with fewer than 3 values becomes all
    NULL.  t_idx and n_time are computed unless present (see ``densify``).
    """
    whole, _ = _windows(dataset, cell)
    return _drop_scratch(_detrended(_with_month(_indexed(df, dataset)), whole, value))


def month_anomaly(df: DataFrame, dataset: Sequence[str], value: str = "value",
                  cell: Sequence[str] = CELL) -> DataFrame:
    """Subtract each cell's calendar-month mean."""
    _, by_month = _windows(dataset, cell)
    df = _with_month(df)
    return _drop_scratch(df.withColumn(value, F.col(value) - F.avg(value).over(by_month)))


def anomaly(df: DataFrame, dataset: Sequence[str], value: str = "value",
            cell: Sequence[str] = CELL) -> DataFrame:
    """Quadratic detrend, then calendar-month anomaly, in one exchange by cell."""
    whole, by_month = _windows(dataset, cell)
    df = _detrended(_with_month(_indexed(df, dataset)), whole, value)
    return _drop_scratch(df.withColumn(value, F.col(value) - F.avg(value).over(by_month)))
