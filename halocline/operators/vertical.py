"""Columns of water: surface level, heat content, mixed layer."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from halocline.functions.numeric import overlap_thickness, ratio
from halocline.functions.seawater import with_sigma0
from halocline.operators.axis import level_axis
from halocline.operators.sizing import need_keys, small_side
from halocline.schema import CELL


def surface_level(df: DataFrame, dataset: Sequence[str], value: str = "value", lev: str = "lev",
                  cell: Sequence[str] = CELL, depths: DataFrame | None = None,
                  carry: Sequence[str] = ()) -> DataFrame:
    """Value at the shallowest level of each dataset, missing or not.

    The shallowest level belongs to the shared axis, not to the cell, so it is
    found once per dataset and the cube is only filtered: no shuffle of the cube.
    ``depths`` (dataset, lev), where known from elsewhere, spares a pass over ``df``.
    ``carry`` names further columns to keep.
    """
    keys = need_keys(dataset)
    top = (df if depths is None else depths).groupBy(*keys).agg(F.min(lev).alias(lev))
    return df.join(small_side(top), [*keys, lev]).select(
        *dict.fromkeys([*keys, *cell, "time", "lat", "lon", lev, value, *carry]))


def first_level(df: DataFrame, index: str = "lev_idx") -> DataFrame:
    """Rows of the first level in file order."""
    return df.where(F.col(index) == 0).drop(index)


def layer_thickness(df: DataFrame, dataset: Sequence[str], zmax: float = 300.0,
                    zmin: float = 0.0, lev: str = "lev") -> DataFrame:
    """Depth axis with edges and the thickness of each layer inside [zmin, zmax].

    ``df`` is the field or any smaller table that has its depths.
    """
    axis = level_axis(df, dataset, lev)
    return axis.withColumn("dz", overlap_thickness(F.col("z_lo"), F.col("z_hi"), zmin, zmax))


def heat_content(
    df: DataFrame,
    dataset: Sequence[str],
    value: str = "value",
    lev: str = "lev",
    cell: Sequence[str] = CELL,
    *,
    zmax: float = 300.0,
    rho0: float = 1025.0,
    cp0: float = 3992.0,
    mask_shallow: bool = False,
    shallow_eps: float = 1e-3,
    depths: DataFrame | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Integral of temperature over 0..zmax times rho0*cp0, per cell and time.

    A missing layer counts as 0 and an all-missing column is NULL.  With
    ``mask_shallow`` a cell must also be wet down to ``zmax`` at the first time
    step of its dataset.  ``depths`` (dataset, lev), where known from elsewhere,
    spares a pass over ``df``; so does a t_idx column for the mask.  ``carry`` names
    columns that are the same on all levels of a column of water and go along.
    """
    keys = need_keys(dataset)
    thick = layer_thickness(df if depths is None else depths, keys, zmax, lev=lev).select(*keys, lev, "dz")
    layered = df.join(small_side(thick), [*keys, lev])
    t = F.col(value)
    out = layered.groupBy(*keys, *cell, "time").agg(
        F.min("lat").alias("lat"), F.min("lon").alias("lon"),
        F.when(
            F.count(t) > 0,
            F.sum(F.coalesce(t, F.lit(0e0)) * F.col("dz")) * F.lit(float(rho0) * float(cp0)),
        ).alias("ohc"),
        *[F.min(c).alias(c) for c in carry],
    )
    if not mask_shallow:
        return out
    if "t_idx" in df.columns:
        first = layered.where(F.col("t_idx") == 0)
    else:
        start = df.groupBy(*keys).agg(F.min("time").alias("time"))
        first = layered.join(small_side(start), [*keys, "time"])
    deep = (
        first.groupBy(*keys, *cell)
        .agg(F.sum(F.when(t.isNotNull(), F.col("dz")).otherwise(0e0)).alias("_wet"))
        .where(F.col("_wet") >= float(zmax) - float(shallow_eps))
        .select(*keys, *cell, F.lit(True).alias("_deep"))
    )
    return (
        out.join(deep, [*keys, *cell], "left")
        .withColumn("ohc", F.when(F.col("_deep"), F.col("ohc")))
        .drop("_deep")
    )


def mixed_layer_depth(
    df: DataFrame,
    dataset: Sequence[str],
    salinity: str = "salt",
    temperature: str = "temp",
    lev: str = "lev",
    cell: Sequence[str] = CELL,
    *,
    ref_depth: float = 10.0,
    delta_sigma: float = 0.03,
    zmax: float = 1000.0,
    density: Callable[[DataFrame, str, str, str], DataFrame] = with_sigma0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Depth where density first reaches that at ``ref_depth`` plus ``delta_sigma``.

    The search starts at the shallowest valid level; between two levels the depth
    is interpolated.  NULL where fewer than two levels are valid, where the
    reference depth is not strictly inside the valid range, or where no level
    reaches the threshold.  ``density(df, salinity, temperature, out)`` adds the
    density column.  ``carry`` names columns that are the same on all levels and go along.  One exchange and one sort by column; a column is at
    most one depth axis long.
    """
    column = [*dataset, *cell, "time"]
    z, ref = F.col(lev).cast("double"), F.lit(float(ref_depth))
    usable = (
        F.col(salinity).isNotNull() & F.col(temperature).isNotNull()
        & F.col(lev).between(0.0, float(zmax))
    )
    # Single-precision inputs, double-precision arithmetic.
    rows = df.select(
        *column, "lat", "lon", *carry, F.when(usable, z).alias("_z"), (~usable).alias("_gap"),
        *[F.when(usable, F.col(c).cast("float").cast("double")).alias(n)
          for c, n in ((salinity, "_salt"), (temperature, "_temp"))],
    )
    rows = density(rows, "_salt", "_temp", "_rho").drop("_salt", "_temp")

    order = Window.partitionBy(*column).orderBy("_gap", "_z")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    point = F.struct("_z", "_rho")
    rows = rows.select(
        "*",
        F.count("_z").over(whole).alias("_n"),
        F.min("_z").over(whole).alias("_zmin"),
        F.max("_z").over(whole).alias("_zmax"),
        F.max(F.when(F.col("_z") <= ref, point)).over(whole).alias("_above"),
        F.min(F.when(F.col("_z") >= ref, point)).over(whole).alias("_below"),
        F.lag("_z").over(order).alias("_z0"),
        F.lag("_rho").over(order).alias("_rho0"),
    )
    za, ra = F.col("_above._z"), F.col("_above._rho")
    zb, rb = F.col("_below._z"), F.col("_below._rho")
    at_ref = F.coalesce(ra + (ref - za) * ratio(rb - ra, zb - za), ra)
    searchable = (F.col("_n") >= 2) & (ref > F.col("_zmin")) & (ref < F.col("_zmax"))
    rows = rows.withColumn("_limit", F.when(searchable, at_ref + F.lit(float(delta_sigma))))

    d1, d0 = F.col("_rho") - F.col("_limit"), F.col("_rho0") - F.col("_limit")
    between = F.col("_z0") - d0 * ratio(F.col("_z") - F.col("_z0"), d1 - d0)
    crossing = F.when(d1 >= 0, F.struct("_z", F.coalesce(between, F.col("_z")).alias("_mld")))
    return rows.groupBy(*column).agg(
        F.min("lat").alias("lat"), F.min("lon").alias("lon"), F.min(crossing)["_mld"].alias("mld"),
        *[F.min(c).alias(c) for c in carry],
    )
