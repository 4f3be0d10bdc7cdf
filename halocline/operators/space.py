"""Boxes, area means and longitude seams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from halocline.functions.calendar import within_months
from halocline.functions.numeric import ratio
from halocline.functions.position import area_weight, lon_360, shortest_step
from halocline.operators.sizing import need_keys

# Fixed region of the index.
NINO34_LAT = (-5.0, 5.0)
NINO34_LON = (190.0, 240.0)


def box(df: DataFrame, lat: tuple[float, float] | None = None,
        lon: tuple[float, float] | None = None) -> DataFrame:
    """Inclusive on all sides; the stored order of the axes does not matter."""
    if lat is not None:
        df = df.where(F.col("lat").between(min(lat), max(lat)))
    if lon is not None:
        df = df.where(F.col("lon").between(*lon))
    return df


def weighted_mean(df: DataFrame, keys: Sequence[str], value: str = "value",
                  weight: Column | None = None, name: str | None = None) -> DataFrame:
    """Area-weighted mean over everything but ``keys``; NULLs carry no weight."""
    w = area_weight(F.col("lat")) if weight is None else weight
    v = F.col(value)
    return df.groupBy(*keys).agg(
        ratio(F.sum(w * v), F.sum(F.when(v.isNotNull(), w))).alias(name or value)
    )


def nino34(df: DataFrame, dataset: Sequence[str] = (), value: str = "value",
           start: str | None = None, end: str | None = None) -> DataFrame:
    """Area-weighted mean over 5S-5N, 170W-120W for every time step."""
    lon = F.col("lon")
    lo, hi = NINO34_LON
    # Both spellings of the box are written on the stored column, so the filter
    # reaches the scan; lon_360 alone would hide it behind an expression.
    in_lon = lon.between(lo, hi) | lon.between(lo - 360.0, hi - 360.0)
    kept = (
        df.where(within_months("time", start, end))
        .where(F.col("lat").between(*NINO34_LAT) & in_lon)
    )
    return weighted_mean(kept, [*dataset, "time"], value, name="nino34")


def hovmoller(df: DataFrame, dataset: Sequence[str] = (), value: str = "value",
              lat: tuple[float, float] = (-5.0, 5.0), lon: tuple[float, float] = (140.0, 180.0),
              start: str | None = None, end: str | None = None) -> DataFrame:
    """Latitude-weighted mean of a band as (time, lon)."""
    kept = box(df.where(within_months("time", start, end)), lat, lon)
    return weighted_mean(kept, [*dataset, "time", "lon"], value)


def _steps(grid: DataFrame, dataset: Sequence[str], row: str, col: str) -> DataFrame:
    """Longitude steps along ``col``; a grid row is at most one grid dimension long."""
    w = Window.partitionBy(*dataset, row).orderBy(col)
    lifted = grid.withColumn("_lon", lon_360(F.col("lon")))
    return lifted.withColumn("_step", F.col("_lon") - F.lag("_lon").over(w))


def unwrap_longitude(grid: DataFrame, dataset: Sequence[str], row: str = "iy",
                     col: str = "ix") -> DataFrame:
    """Make longitudes run on across the seam of a grid table.

    Applied to a dataset only if some step along ``col`` drops by more than half a
    turn; otherwise its longitudes are returned untouched.  Adds ``seam``.
    """
    keys = need_keys(dataset)
    stepped = _steps(grid, keys, row, col)
    flags = stepped.groupBy(*keys).agg((F.min("_step") < -180e0).alias("seam"))
    running = (
        Window.partitionBy(*keys, row).orderBy(col)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    shift = shortest_step(F.col("_step")) - F.col("_step")
    joined = stepped.join(flags, keys)
    out = F.col("_lon") + F.coalesce(F.sum(shift).over(running), F.lit(0e0))
    return (
        joined.withColumn("seam", F.coalesce("seam", F.lit(False)))
        .withColumn("lon", F.when(F.col("seam"), out).otherwise(F.col("lon")))
        .drop("_lon", "_step")
    )


def wrap_scores(grid: DataFrame, dataset: Sequence[str]) -> DataFrame:
    """Half-turn jumps along each index axis and the axis longitudes run along.

    The axis with more jumps wins; the longer one breaks a tie, then ``iy``.
    """
    keys = need_keys(dataset)
    jump = F.sum(F.when(F.abs("_step") > 180e0, 1).otherwise(0))
    sides = [
        _steps(grid, keys, row, col).groupBy(*keys).agg(
            jump.alias(f"wraps_{col}"), F.countDistinct(col).alias(f"size_{col}"))
        for row, col in (("ix", "iy"), ("iy", "ix"))
    ]
    both = sides[0].join(sides[1], keys)
    score = {c: F.col(f"wraps_{c}") + F.col(f"size_{c}") * 1e-6 for c in ("iy", "ix")}
    return both.withColumn(
        "lon_axis", F.when(score["ix"] > score["iy"], F.lit("ix")).otherwise(F.lit("iy")))
