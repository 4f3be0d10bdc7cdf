"""Anomalies on the common grid, for all variables and datasets at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from halocline.operators import axis, regrid, series, space
from halocline.operators.sizing import settle
from halocline.schema import OCEAN_VARS, TargetGrid, drop_spatial_bounds


def regrid_field(df: DataFrame, dataset: Sequence[str], target: TargetGrid = TargetGrid(), *,
                 grid_keys: Sequence[str] = ("var",), missing: str = "renormalise") -> DataFrame:
    """Bilinear to ``target``; longitudes of ocean grids are run on across their seam first.

    ``grid_keys`` tell source grids apart (models have their own).
    """
    keys = list(grid_keys)
    df = drop_spatial_bounds(df, keep=[*dataset, *keys, "value"])  # corners of the old cells mean nothing on the new grid
    grid = settle(regrid.grid_of(df, keys))
    if "var" in keys:
        ocean = F.col("var").isin(*sorted(OCEAN_VARS))
        mended = space.unwrap_longitude(grid.where(ocean), keys).drop("seam")
        grid = mended.unionByName(grid.where(~ocean))
    weights = regrid.bilinear_weights(grid, target, keys)
    return regrid.apply_weights(df, weights, [*dataset, "time"], keys=keys, missing=missing)


def anomaly_job(df: DataFrame, dataset: Sequence[str], target: TargetGrid = TargetGrid(),
                **regrid_options) -> DataFrame:
    """Detrend and remove the calendar-month mean on the native grid, then regrid.

    ``dataset`` identifies one series of grids, variable included.
    """
    native = series.anomaly(df, dataset)
    return regrid_field(native, dataset, target, **regrid_options)


def wind_maximum_job(daily: DataFrame, dataset: Sequence[str], target: TargetGrid = TargetGrid(),
                     **regrid_options) -> DataFrame:
    """Anomalies of the monthly maximum (signed) of daily winds, as variable ``uasmax``."""
    top = series.monthly(daily, dataset, "max")
    return anomaly_job(top, dataset, target, **regrid_options).withColumn("var", F.lit("uasmax"))


def anomaly_steps(df: DataFrame, dataset: Sequence[str]) -> dict[str, DataFrame]:
    """The intermediate results, for whoever wants to keep them."""
    indexed = df if {"t_idx", "n_time"} <= set(df.columns) else axis.with_time_index(df, dataset)
    detrended = series.quadratic_detrend(indexed, dataset)
    return {
        "detrended": detrended,
        "climatology": series.climatology(detrended, dataset),
        "anomaly": series.month_anomaly(detrended, dataset),
    }
