"""Trend and climatology from sums that add up over periods, so that new months need no rescan of old ones.

A quadratic fit and calendar-month means need only power sums of the positions and cross
sums with the values, for every cell and calendar month.  Positions count from the
dataset's first step, so the sums of a period never change; appending one adds its sums
to those that are kept.  The fit is taken over positions scaled to [-1, 1] of the whole axis,
into which the sums are moved by the binomial rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

from pyspark.sql import Column, DataFrame, Window, functions as F

from halocline.functions.numeric import ratio
from halocline.operators.series import solved
from halocline.schema import CELL

#: Positions are counted in this unit, which keeps fourth powers moderate and divides exactly.
UNIT = 1024.0
SUMS = ("s0", "s1", "s2", "s3", "s4", "b0", "b1", "b2")


def period_sums(df: DataFrame, dataset: Sequence[str], value: str = "value", cell: Sequence[str] = CELL) -> DataFrame:
    """(dataset, cell, month, sums) of rows whose ``t_idx`` counts from the first step of the dataset.

    One aggregate with partial sums; a cell without values has sums of 0 or NULL and is kept.
    """
    y, u = F.col(value), F.col("t_idx") / F.lit(UNIT)

    def total(power: int, weighted: bool) -> Column:
        term = F.lit(1e0)
        for _ in range(power):
            term = term * u
        return F.sum(F.when(y.isNotNull(), term * y if weighted else term))

    return df.groupBy(*dataset, *cell, F.month("time").alias("month")).agg(
        *[F.coalesce(total(k, False), F.lit(0e0)).alias(f"s{k}") for k in range(5)],
        *[F.coalesce(total(k, True), F.lit(0e0)).alias(f"b{k}") for k in range(3)])


def merged_sums(sums: DataFrame, dataset: Sequence[str], cell: Sequence[str] = CELL) -> DataFrame:
    """The sums of several periods as those of one."""
    return sums.groupBy(*dataset, *cell, "month").agg(*[F.sum(s).alias(s) for s in SUMS])


def _moved(kind: str, power: int, a: Column, b: float) -> Column:
    """The sum over (a u + b) ** power from sums over powers of u."""
    out = F.lit(0e0)
    for j in range(power + 1):
        term = F.col(f"{kind}{j}") * F.lit(float(comb(power, j) * b ** (power - j)))
        for _ in range(j):
            term = term * a
        out = out + term
    return out


def fitted(sums: DataFrame, lengths: DataFrame, dataset: Sequence[str], cell: Sequence[str] = CELL) -> DataFrame:
    """(dataset, cell, n_time, fit, clim): the quadratic over [-1, 1] and the mean residual of each calendar month.

    ``lengths`` (dataset, n_time) has a row for each dataset.  ``fit`` is NULL where a cell has fewer than three values.
    One exchange by cell.
    """
    keys = [*dataset, *cell]
    last = F.nullif(F.col("n_time") - 1, F.lit(0)).cast("double")
    a = F.coalesce(F.lit(2e0 * UNIT) / last, F.lit(0e0))
    rows = sums.join(F.broadcast(lengths), list(dataset)) if dataset else sums.crossJoin(F.broadcast(lengths))
    rows = rows.select(
        *keys, "month", "n_time",
        *[_moved("s", k, a, -1e0).alias(f"m_s{k}") for k in range(5)], *[_moved("b", k, a, -1e0).alias(f"m_b{k}") for k in range(3)])
    whole = Window.partitionBy(*keys)
    rows = solved(rows.select("*", *[F.sum(f"m_{s}").over(whole).alias(f"_{s}") for s in SUMS]))
    trend = F.col("_c0") * F.col("m_s0") + F.col("_c1") * F.col("m_s1") + F.col("_c2") * F.col("m_s2")
    enough = F.col("_s0") >= 3
    return rows.groupBy(*keys).agg(
        F.first("n_time").alias("n_time"),
        F.first(F.when(enough, F.struct(F.col("_c0").alias("c0"), F.col("_c1").alias("c1"), F.col("_c2").alias("c2")))).alias("fit"),
        F.map_from_entries(F.collect_list(F.struct("month", ratio(F.col("m_b0") - trend, F.col("m_s0"))))).alias("clim"))


def anomalies(df: DataFrame, fit: DataFrame, dataset: Sequence[str], value: str = "value", cell: Sequence[str] = CELL) -> DataFrame:
    """Values less their cell's fitted trend and calendar-month mean; ``df`` holds any of the months, with their ``t_idx``."""
    keys = [*dataset, *cell]
    own = fit.select(*keys, F.col("n_time").alias("_n"), F.col("fit").alias("_fit"), F.col("clim").alias("_clim"))
    last = F.nullif(F.col("_n") - 1, F.lit(0)).cast("double")
    joined = df.join(own, keys).withColumn("_x", F.coalesce(F.col("t_idx") * 2e0 / last, F.lit(0e0)) - 1e0)
    x = F.col("_x")
    trend = F.col("_fit.c0") + x * (F.col("_fit.c1") + x * F.col("_fit.c2"))
    clim = F.element_at("_clim", F.month("time"))
    return joined.withColumn(value, F.col(value) - trend - clim).withColumn("n_time", F.col("_n")).drop("_n", "_fit", "_clim", "_x")
