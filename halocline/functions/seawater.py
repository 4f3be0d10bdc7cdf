"""Sea-water density from the published TEOS-10 polynomials, as column expressions.

Absolute salinity comes from practical salinity with the reference-composition
factor; the regional composition anomaly (an atlas lookup) can be passed as a
ratio column.  Leaving it out shifts density by up to about 0.02 kg/m3, nearly
the same over one column, so a density *difference* is affected far less.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# ---- fixed values (Roquet et al. 2015; IOC et al. 2010) --------------------
SA_PER_SP = 35.16504 / 35.0
SALT_SCALE = 0.0248826675584615
SALT_OFFSET = 5.971840214030754e-1
HEAT_CAPACITY = 3991.86795711963

# Specific volume at zero pressure: rows by power of temperature (CT / 40),
# columns by power of sqrt(scaled salinity).
VOLUME = (
    (1.0769995862e-3, -3.1038981976e-4, 6.6928067038e-4, -8.5047933937e-4,
     5.8086069943e-4, -2.1092370507e-4, 3.1932457305e-5),
    (-1.5649734675e-5, 3.5009599764e-5, -4.3592678561e-5, 3.4532461828e-5,
     -1.1959409788e-5, 1.3864594581e-6),
    (2.7762106484e-5, -3.7435842344e-5, 3.5907822760e-5, -1.8698584187e-5, 3.8595339244e-6),
    (-1.6521159259e-5, 2.4141479483e-5, -1.4353633048e-5, 2.2863324556e-6),
    (6.9111322702e-6, -8.7595873154e-6, 4.3703680598e-6),
    (-8.0539615540e-7, -3.3052758900e-7),
    (2.0543094268e-7,),
)

# Potential enthalpy: rows by power of sqrt(scaled salinity), columns by power
# of temperature (pt / 40).
ENTHALPY = (
    (61.01362420681071, 168776.46138048015, -2735.2785605119625, 2574.2164453821433,
     -1536.6644434977543, 545.7340497931629, -50.91091728474331, -18.30489878927802),
    (),
    (268.5520265845071, -12019.028203559312, 3734.858026725145, -2046.7671145057618,
     465.28655623826234, -0.6370820302376359, -10.650848542359153),
    (937.2099110620707, 588.1802812170108, 248.39476522971285, -3.871557904936333,
     -2.6268019854268356),
    (-1687.914374187449, 936.3206544460336, -942.7827304544439, 369.4389437509002,
     -33.83664947895248, -9.987880382780322),
    (246.9598888781377,),
    (123.59576582457964,),
    (-48.5891069025409,),
)
# ----------------------------------------------------------------------------


def _poly(coefs: Sequence[float | Column], x: Column) -> Column:
    total: Column | None = None
    for c in reversed(coefs):
        term = c if isinstance(c, Column) else F.lit(c)
        total = term if total is None else term + x * total
    return F.lit(0e0) if total is None else total


def _poly2(rows: Sequence[Sequence[float]], outer: Column, inner: Column) -> Column:
    return _poly([_poly(row, inner) for row in rows], outer)


def absolute_salinity(sp: Column, anomaly_ratio: Column | None = None) -> Column:
    sa = F.greatest(sp, F.lit(0e0)) * F.lit(SA_PER_SP)
    return sa if anomaly_ratio is None else sa * (1e0 + anomaly_ratio)


def conservative_temperature(sa: Column, pt: Column) -> Column:
    x = F.sqrt(F.lit(SALT_SCALE) * F.greatest(sa, F.lit(0e0)))
    return _poly2(ENTHALPY, x, pt * 0.025e0) / F.lit(HEAT_CAPACITY)


def sigma0(sa: Column, ct: Column) -> Column:
    """Density at the surface minus 1000 kg/m3."""
    x = F.sqrt(F.lit(SALT_SCALE) * F.greatest(sa, F.lit(0e0)) + F.lit(SALT_OFFSET))
    return 1e0 / _poly2(VOLUME, ct * 0.025e0, x) - 1000e0


def with_sigma0(df: DataFrame, salinity: str, temperature: str, out: str,
                anomaly_ratio: str | None = None) -> DataFrame:
    """Add sigma0 from practical salinity and potential temperature.

    Done in stages: each intermediate is a column of its own, computed once a row.
    """
    ratio = None if anomaly_ratio is None else F.col(anomaly_ratio)
    df = df.withColumn("_sa", absolute_salinity(F.col(salinity), ratio))
    df = df.withColumn("_root", F.sqrt(F.lit(SALT_SCALE) * F.col("_sa")))
    df = df.withColumns({
        "_ct": _poly2(ENTHALPY, F.col("_root"), F.col(temperature) * 0.025e0) / F.lit(HEAT_CAPACITY),
        "_root": F.sqrt(F.lit(SALT_SCALE) * F.col("_sa") + F.lit(SALT_OFFSET)),
    })
    rho = 1e0 / _poly2(VOLUME, F.col("_ct") * 0.025e0, F.col("_root"))
    return df.withColumn(out, rho - 1000e0).drop("_sa", "_root", "_ct")


def with_linear_sigma(df: DataFrame, salinity: str, temperature: str, out: str) -> DataFrame:
    """A linear equation of state, for idealised columns."""
    t, s = F.col(temperature), F.col(salinity)
    return df.withColumn(out, 26e0 - 0.2e0 * (t - 10e0) + 0.8e0 * (s - 35e0))
