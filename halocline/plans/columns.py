"""Surface fields, heat content and mixed-layer depth from depth-resolved fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from halocline.functions.numeric import celsius, depth_metres, salinity_g_per_kg
from halocline.operators import checks, merge, vertical
from halocline.operators.sizing import settle
from halocline.schema import CELL, SURFACE_OUTPUT


def _unit(units: str | Column | None) -> Column:
    return units if isinstance(units, Column) else F.lit(units)


def surface_job(df: DataFrame, dataset: Sequence[str], *, by_depth: bool = True,
                units: str | Column | None = None, depths: DataFrame | None = None) -> DataFrame:
    """First vertical level of every dataset under its surface name.

    ``by_depth`` takes the shallowest level, otherwise the first in file order.
    Salinity in mass-fraction ``units`` (one for all, or a column of ``df``) becomes g/kg.
    """
    keys = list(dict.fromkeys([*dataset, "var"]))
    var = F.col("var")
    fixed = F.when(var == "salt", salinity_g_per_kg(F.col("value"), _unit(units))).otherwise(F.col("value"))
    df = df.withColumn("value", fixed)
    top = vertical.surface_level(df, keys, depths=depths) if by_depth else vertical.first_level(df)
    value = F.col("value")
    renamed = F.coalesce(F.create_map(*[F.lit(x) for kv in SURFACE_OUTPUT.items() for x in kv])[var], var)
    keep = [c for c in top.columns if c not in ("lev", "lev_idx")]
    return top.select(*keep).withColumns({"value": value, "var": renamed})


def heat_content_job(df: DataFrame, dataset: Sequence[str], units: str | Column = "degC",
                     to_celsius: bool = True, **options) -> DataFrame:
    """Heat content as variable ``ohc300``; Kelvin is converted when the unit says so."""
    warm = df.withColumn("value", celsius(F.col("value"), _unit(units), loose=False)) if to_celsius else df
    out = vertical.heat_content(warm, dataset, **options)
    return out.withColumnRenamed("ohc", "value").withColumn("var", F.lit("ohc300"))


def _require_aligned(left: DataFrame, right: DataFrame, dataset: Sequence[str], at: Sequence[str]) -> None:
    """Equal positions, and coordinates equal but for rounding.

    Fingerprints of both sides decide for most datasets in one pass over the keys; only datasets whose
    fingerprints differ are compared row by row.
    """
    suspect = merge.differing(left, right, dataset, [*at, "lat", "lon"])
    if suspect.isEmpty():
        return
    some = settle(suspect)
    a, b = (side.join(some, list(dataset), "left_semi") for side in (left, right))
    checks.require_none(merge.unmatched_keys(a, b, at), "fields do not align")
    checks.require_none(merge.grid_mismatch(a, b, dataset), "grids differ")


def mixed_layer_job(temperature: DataFrame, salinity: DataFrame, dataset: Sequence[str], *,
                    temp_units: str = "degC", depth_units: str = "m", check: bool = True,
                    **options) -> DataFrame:
    """Mixed-layer depth as variable ``mlotst``; the two fields must align exactly.

    Matching is by grid index, level and time; coordinates are those of the
    temperature field.  ``dataset`` must not contain ``var``.
    """
    at = [*dataset, *CELL, "lev_idx", "time"]
    if check:
        _require_aligned(temperature, salinity, dataset, at)
    # Both fields meet by column of water, which is also how the search below
    # needs them: one exchange for the pairing and the search.
    sides = temperature.select(*at, "lat", "lon", "lev", "value", F.lit(True).alias("_t")).unionByName(
        salinity.select(*at, "lat", "lon", "lev", "value", F.lit(False).alias("_t")))

    def of(col: str, warm: bool):
        return F.max(F.when(F.col("_t") == warm, F.col(col)))

    both = (
        sides.repartition(*dataset, *CELL, "time").groupBy(*at)
        .agg(*[of(c, True).alias(c) for c in ("lat", "lon", "lev")],
             of("value", True).alias("temp"), of("value", False).alias("salt"),
             (F.max("_t") & ~F.min("_t")).alias("_both"))
        .where("_both")
        .withColumns({
            "lev": depth_metres(F.col("lev"), F.lit(depth_units)),
            "temp": celsius(F.col("temp"), F.lit(temp_units)),
        })
    )
    out = vertical.mixed_layer_depth(both, dataset, **options)
    return out.withColumnRenamed("mld", "value").withColumn("var", F.lit("mlotst"))
