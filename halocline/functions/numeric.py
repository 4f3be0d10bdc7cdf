"""Unit handling and small numeric rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed spellings of a mass-fraction unit.
MASS_FRACTION_UNITS = ("kg/kg", "kg kg-1", "kg kg^-1", "kgkg-1", "kgkg^-1", "mass fraction")


def normal_units(units: Column) -> Column:
    """Lower case, '**' as '^', single spaces, no outer blanks."""
    text = F.replace(F.lower(F.coalesce(units, F.lit(""))), F.lit("**"), F.lit("^"))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def salinity_g_per_kg(value: Column, units: Column) -> Column:
    return F.when(normal_units(units).isin(*MASS_FRACTION_UNITS), value * 1000e0).otherwise(value)


def celsius(value: Column, units: Column, loose: bool = True) -> Column:
    """Kelvin to Celsius.  ``loose`` also accepts any unit containing 'kelvin'."""
    u = F.lower(F.trim(F.coalesce(units, F.lit(""))))
    kelvin = u.isin("k", "kelvin")
    if loose:
        kelvin = kelvin | F.contains(u, F.lit("kelvin"))
    return F.when(kelvin, value - F.lit(273.15)).otherwise(value)


def depth_metres(lev: Column, units: Column) -> Column:
    in_cm = F.contains(F.lower(F.coalesce(units, F.lit(""))), F.lit("cm"))
    return F.when(in_cm, lev / F.lit(100e0)).otherwise(lev)


def overlap_thickness(lo: Column, hi: Column, zmin: float, zmax: float) -> Column:
    """Length of [lo, hi] inside [zmin, zmax]; the edges may come in either order."""
    below = F.least(F.greatest(lo, hi), F.lit(float(zmax)))
    above = F.greatest(F.least(lo, hi), F.lit(float(zmin)))
    return F.greatest(below - above, F.lit(0e0))


def all_close(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Near equality; two missing values are equal."""
    near = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(near)


def level_spacing(limit: Column, count: int = 21) -> Column:
    """``count`` evenly spaced contour levels from -limit to limit."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda i: -limit + i * (2e0 * limit) / F.lit(float(count - 1)),
    )


def ratio(num: Column, den: Column) -> Column:
    """NULL on a zero denominator (ANSI mode would raise)."""
    return num / F.nullif(den, F.lit(0e0))
