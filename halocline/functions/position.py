"""Longitude and latitude expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def lon_360(lon: Column) -> Column:
    """Lift negative longitudes by one turn; others stay as they are."""
    return F.when(lon < 0, lon + 360e0).otherwise(lon)


def lon_modulo(lon: Column) -> Column:
    return F.pmod(lon + 360e0, F.lit(360e0))


def area_weight(lat: Column) -> Column:
    return F.cos(F.radians(lat))


def shortest_step(step: Column) -> Column:
    """A longitude step brought into [-180, 180]; +180 keeps its sign."""
    folded = F.pmod(step + 180e0, F.lit(360e0)) - 180e0
    folded = F.when((folded == -180e0) & (step > 0), F.lit(180e0)).otherwise(folded)
    return F.when(F.abs(step) < 180e0, step).otherwise(folded)
