"""Plain SQL for every registered query, written apart from the operators.

Windows, Cramer's rule and direct grid arithmetic stand against the operators'
aggregates, elimination and corner tables.
"""

from __future__ import annotations

from halocline.functions.seawater import (
    ENTHALPY, HEAT_CAPACITY, SALT_OFFSET, SALT_SCALE, SA_PER_SP, VOLUME,
)

SQL: dict[str, str] = {}


def _cells(table: str, key: str, rest: str) -> str:
    return (f"SELECT ({key}) % 4 + 4 * (({key}) // 864) AS member, CAST((({key}) // 4 + 5) % 12 AS INTEGER) AS iy, "
            f"CAST((({key}) // 48) % 18 AS INTEGER) AS ix, {rest} FROM {table}")


LATLON = "-55e0 + iy * 10e0 AS lat, -170e0 + ix * 20e0 + member % 4 * 3e0 AS lon"
MEAN = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT({0}) AS DOUBLE)"

LINES = "lines AS (" + _cells(
    "lineitem", "l_suppkey",
    "l_shipdate + to_months(CAST(l_suppkey % 4 AS INTEGER)) AS time, l_extendedprice, l_quantity, l_discount, l_linenumber") + ")"
ORDERS = "ord AS (" + _cells(
    "orders", "o_custkey // 15", "o_orderdate + to_months(CAST((o_custkey // 15) % 4 AS INTEGER)) AS time, o_totalprice") + ")"


def obs(name: str, src: str, amount: str) -> str:
    return (f"{name} AS (SELECT member, iy, ix, {LATLON}, time, value FROM (SELECT member, iy, ix, "
            f"date_trunc('month', time) AS time, {MEAN.format(amount)} AS value "
            f"FROM {src} GROUP BY 1, 2, 3, 4))")


def cube(name: str, of: str) -> str:
    """Dense cube ``name`` of observations ``of``."""
    return f"""{of}_axis AS (
  SELECT member, time, row_number() OVER (PARTITION BY member ORDER BY time) - 1 AS t_idx,
         COUNT(*) OVER (PARTITION BY member) AS n_time
  FROM (SELECT DISTINCT member, time FROM {of})),
{name} AS (
  SELECT c.member, c.iy, c.ix, a.time, c.lat, c.lon, a.t_idx, a.n_time, o.value
  FROM (SELECT DISTINCT member, iy, ix, lat, lon FROM {of}) c
  JOIN {of}_axis a ON a.member = c.member
  LEFT JOIN {of} o ON o.member = c.member AND o.iy = c.iy AND o.ix = c.ix AND o.time = a.time)"""


LINE_OBS = LINES + ", " + obs("lobs", "lines", "l_extendedprice")
LINE_CUBE = LINE_OBS + ", " + cube("lcube", "lobs")
ORDER_OBS = ORDERS + ", " + obs("oobs", "ord", "o_totalprice")
ORDER_CUBE = ORDER_OBS + ", " + cube("ocube", "oobs")
WIND = LINES + f""", wind AS (
  SELECT member, iy, ix, {LATLON}, time, value FROM (
    SELECT member, iy, ix, time,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))
                    * (CAST(0.05 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2)))) AS DOUBLE)
           / CAST(COUNT(*) AS DOUBLE) AS value
    FROM lines GROUP BY 1, 2, 3, 4))"""
WIND_MAX = WIND + """, wmax AS (
  SELECT member, iy, ix, date_trunc('month', time) AS time, min(lat) AS lat, min(lon) AS lon,
         max(value) AS value
  FROM wind GROUP BY 1, 2, 3, 4)"""
THREE_CUBES = LINE_CUBE + ", " + obs("qobs", "lines", "l_quantity") + ", " + cube("qcube", "qobs") + ", " + ORDER_CUBE
for _c in ("lines", "lobs", "qobs", "ord", "oobs", "lcube", "qcube", "ocube"):
    THREE_CUBES = THREE_CUBES.replace(f"{_c} AS (", f"{_c} AS MATERIALIZED (")
FIELDS = (
    THREE_CUBES + """, fields AS MATERIALIZED (
  SELECT 'tos' AS var, member, iy, ix, time, lat, lon, value FROM lcube
  UNION ALL SELECT 'sos', member, iy, ix, time, lat, lon, value FROM qcube
  UNION ALL SELECT 'psl', member, iy, ix, time, lat, lon, value FROM ocube)"""
)
PROFILE = LINES + f""", pobs AS (
  SELECT member, iy, ix, l_linenumber - 1 AS lev_idx, date_trunc('month', time) AS time,
         {MEAN.format('l_quantity')} AS q, {MEAN.format('l_discount')} AS d
  FROM lines GROUP BY 1, 2, 3, 4, 5),
depths(lev_idx, lev) AS (VALUES (0, 5e0), (1, 15e0), (2, 40e0), (3, 90e0), (4, 160e0), (5, 250e0), (6, 400e0)),
prof AS (
  SELECT c.member, c.iy, c.ix, c.lev_idx, z.lev * (1e0 + c.member % 4 * 0.25e0) AS lev, a.time,
         -55e0 + c.iy * 10e0 AS lat, -170e0 + c.ix * 20e0 + c.member % 4 * 3e0 AS lon,
         28e0 - z.lev * (1e0 + c.member % 4 * 0.25e0) * 0.06e0 + (o.q - 25e0) / 50e0 AS temp,
         34e0 + z.lev * (1e0 + c.member % 4 * 0.25e0) * 0.004e0 + (o.d - 0.05e0) * 4e0 AS salt
  FROM (SELECT DISTINCT member, iy, ix, lev_idx FROM pobs) c
  JOIN (SELECT DISTINCT member, time FROM pobs) a ON a.member = c.member
  JOIN depths z ON z.lev_idx = c.lev_idx
  LEFT JOIN pobs o ON o.member = c.member AND o.iy = c.iy AND o.ix = c.ix
       AND o.lev_idx = c.lev_idx AND o.time = a.time)"""


def rnd(x: str, digits: int) -> str:
    return f"(round(({x}) + 0.0314159e-{digits}, {digits}) + 0e0)"


def r(x: str, digits: int = 4, name: str | None = None) -> str:
    """Rounded as on the Spark side: moved off ties first."""
    return f"{rnd(x, digits)} AS {name or x}"


def detrended(src: str) -> str:
    """Cramer's rule on the normal equations, as CTE ``det``."""
    return f"""mom AS (
  SELECT *, count(value) OVER w AS s0,
    sum(CASE WHEN value IS NOT NULL THEN x END) OVER w AS s1,
    sum(CASE WHEN value IS NOT NULL THEN x*x END) OVER w AS s2,
    sum(CASE WHEN value IS NOT NULL THEN x*x*x END) OVER w AS s3,
    sum(CASE WHEN value IS NOT NULL THEN x*x*x*x END) OVER w AS s4,
    sum(value) OVER w AS b0, sum(value*x) OVER w AS b1, sum(value*x*x) OVER w AS b2
  FROM (SELECT *, -1e0 + 2e0 * t_idx / (n_time - 1) AS x FROM {src})
  WINDOW w AS (PARTITION BY member, iy, ix)),
coef AS (
  SELECT *, s0*(s2*s4-s3*s3) - s1*(s1*s4-s2*s3) + s2*(s1*s3-s2*s2) AS dd,
    b0*(s2*s4-s3*s3) - s1*(b1*s4-b2*s3) + s2*(b1*s3-b2*s2) AS d0,
    s0*(b1*s4-b2*s3) - b0*(s1*s4-s2*s3) + s2*(s1*b2-s2*b1) AS d1,
    s0*(s2*b2-s3*b1) - s1*(s1*b2-s2*b1) + b0*(s1*s3-s2*s2) AS d2
  FROM mom),
det AS (
  SELECT member, iy, ix, time, lat, lon, t_idx, n_time,
    CASE WHEN s0 >= 3 THEN value - (d0 + d1*x + d2*x*x) / nullif(dd, 0) END AS value
  FROM coef)"""


def anomalies(src: str, out: str = "anom") -> str:
    return f"""{out} AS (
  SELECT * REPLACE (value - avg(value) OVER (PARTITION BY member, iy, ix, month(time)) AS value) FROM {src})"""


def area_mean(src: str, where: str, keys: str, name: str, digits: int = 4) -> str:
    mean = ("sum(cos(radians(lat)) * value) "
            "/ nullif(sum(CASE WHEN value IS NOT NULL THEN cos(radians(lat)) END), 0)")
    return f"SELECT {keys}, {r(mean, digits, name)} FROM {src} WHERE {where} GROUP BY {keys}"


BOX = "lat BETWEEN -5 AND 5 AND (CASE WHEN lon < 0 THEN lon + 360 ELSE lon END) BETWEEN 190 AND 240"
SQL["nino34_index"] = f"WITH {LINE_CUBE} " + area_mean("lcube", BOX, "member, time", "nino34")
SQL["nino34_window"] = f"WITH {LINE_CUBE} " + area_mean(
    "lcube", BOX + " AND time >= TIMESTAMP '1996-03-01' AND time <= TIMESTAMP '2000-02-29 23:59:59'",
    "member, time", "nino34")
SQL["nino34_of_anomaly"] = (
    f"WITH {LINE_CUBE}, {detrended('lcube')}, {anomalies('det')} "
    + area_mean("anom", BOX, "member, time", "nino34", 3))

BAND = LINE_CUBE + """, band AS (
  SELECT member, time, lon, sum(cos(radians(lat)) * value)
      / nullif(sum(CASE WHEN value IS NOT NULL THEN cos(radians(lat)) END), 0) AS value
  FROM (SELECT * REPLACE (CASE WHEN lon < 0 THEN lon + 360 ELSE lon END AS lon) FROM lcube)
  WHERE lat BETWEEN -25 AND 25 AND lon BETWEEN 190 AND 300 GROUP BY 1, 2, 3)"""
SQL["hovmoller"] = f"WITH {BAND} SELECT member, time, lon, {r('value')} FROM band"
for _how, _fn in (("max", "max"), ("mean", "avg")):
    SQL[f"calendar_month_{_how}"] = (
        f"WITH {BAND} SELECT member, lon, month(time) AS month, {r(f'{_fn}(value)', 4, 'value')} "
        "FROM band GROUP BY 1, 2, 3")
SQL["shared_colour_limit"] = (
    f"WITH {BAND} SELECT member, {r('greatest(max(abs(value)), max(abs(top)))', 4, '\"limit\"')} FROM ("
    "SELECT member, value, max(value) OVER (PARTITION BY member, lon, month(time)) AS top FROM band) GROUP BY 1")
SQL["contour_levels"] = (
    f"WITH {BAND}, lim AS (SELECT member, max(abs(value)) AS v FROM band GROUP BY 1) "
    f"SELECT member, CAST(i AS INTEGER) AS step, {r('-v + 2e0 * v * i / 20e0', 4, 'level')} "
    "FROM lim, range(21) AS t(i)")

SQL["monthly_max"] = f"WITH {WIND_MAX} SELECT member, iy, ix, time, lat, lon, {r('value', 6)} FROM wmax"
SQL["climatology"] = (
    f"WITH {LINE_CUBE} SELECT member, iy, ix, month(time) AS month, "
    f"{r('avg(value)', 4, 'climatology')} FROM lcube GROUP BY 1, 2, 3, 4")
_CUBE_OUT = "member, iy, ix, time, lat, lon, t_idx, n_time"
SQL["monthly_anomaly"] = f"WITH {LINE_CUBE}, {anomalies('lcube')} SELECT {_CUBE_OUT}, {r('value')} FROM anom"
SQL["quadratic_detrend"] = f"WITH {LINE_CUBE}, {detrended('lcube')} SELECT {_CUBE_OUT}, {r('value', 3)} FROM det"
SQL["detrend_sparse_cells"] = (
    f"WITH {ORDER_CUBE}, sparse AS (SELECT * FROM ocube WHERE value IS NOT NULL), {detrended('sparse')} "
    f"SELECT {_CUBE_OUT}, {r('value', 3)} FROM det")
SQL["anomaly_full"] = (
    f"WITH {LINE_CUBE}, {detrended('lcube')}, {anomalies('det')} SELECT {_CUBE_OUT}, {r('value', 3)} FROM anom")
SQL["anomaly_after_append"] = SQL["anomaly_full"]
SQL["monmax_anomaly"] = (
    f"WITH {WIND_MAX}, {cube('wcube', 'wmax')}, {detrended('wcube')}, {anomalies('det')} "
    f"SELECT {_CUBE_OUT}, {r('value')} FROM anom")
SQL["time_index"] = f"WITH {ORDER_CUBE} SELECT member, time, t_idx, n_time FROM oobs_axis"

_TOP = "(SELECT member, min(lev) AS lev FROM prof GROUP BY 1)"
SQL["surface_level_sorted"] = (
    f"WITH {PROFILE} SELECT member, iy, ix, time, lat, lon, lev, {r('temp', 6)} "
    f"FROM prof JOIN {_TOP} t USING (member, lev)")
SQL["surface_level_first"] = (
    f"WITH {PROFILE} SELECT member, iy, ix, time, lat, lon, lev, {r('salt', 6)} FROM prof WHERE lev_idx = 0")
LAYERS = PROFILE + """, layers AS (
  SELECT member, lev, COALESCE((up + lev) / 2, 0e0) AS z_lo,
    CASE WHEN down IS NOT NULL THEN (lev + down) / 2
         WHEN up IS NOT NULL THEN lev + (lev - (up + lev) / 2) ELSE lev END AS z_hi
  FROM (SELECT member, lev, lag(lev) OVER w AS up, lead(lev) OVER w AS down
        FROM (SELECT DISTINCT member, lev FROM prof) WINDOW w AS (PARTITION BY member ORDER BY lev)))"""
SQL["depth_bounds"] = f"WITH {LAYERS} SELECT member, lev, z_lo, z_hi FROM layers"
SQL["layer_overlap"] = (
    f"WITH {LAYERS} SELECT member, lev, z_lo, z_hi, "
    "greatest(least(z_hi, 300e0) - greatest(z_lo, 0e0), 0e0) AS dz FROM layers")
SQL["heat_content"] = f"""WITH {LAYERS} SELECT member, iy, ix, time, min(lat) AS lat, min(lon) AS lon,
  {rnd("""CASE WHEN count(temp) > 0 THEN sum(COALESCE(temp, 0) * greatest(least(z_hi, 300e0) - z_lo, 0e0))
    * (1025e0 * 3992e0) END / 1e6""", 3)} AS ohc
FROM prof JOIN layers USING (member, lev) GROUP BY 1, 2, 3, 4"""
SQL["heat_content_masked"] = f"""WITH {LAYERS}, thick AS (
  SELECT p.*, greatest(least(z_hi, 100e0) - z_lo, 0e0) AS dz,
         min(time) OVER (PARTITION BY member) AS t0
  FROM prof p JOIN layers USING (member, lev)),
deep AS (SELECT member, iy, ix, sum(CASE WHEN temp IS NOT NULL THEN dz ELSE 0 END) AS wet
  FROM thick WHERE time = t0 GROUP BY 1, 2, 3)
SELECT t.member, t.iy, t.ix, time, min(lat) AS lat, min(lon) AS lon,
  {rnd("""CASE WHEN count(temp) > 0 AND max(wet) >= 100 - 1e-3
    THEN sum(COALESCE(temp, 0) * dz) * (1025e0 * 3992e0) END / 1e6""", 3)} AS ohc
FROM thick t LEFT JOIN deep d ON d.member = t.member AND d.iy = t.iy AND d.ix = t.ix GROUP BY 1, 2, 3, 4"""


def mixed_layer(density: str) -> str:
    """Valid levels in order; the reference density from neighbouring levels; first crossing."""
    return f"""WITH {PROFILE}, v AS (
  SELECT member, iy, ix, time, lev AS z, {density} AS rho
  FROM (SELECT *, CAST(CAST(salt AS FLOAT) AS DOUBLE) AS s, CAST(CAST(temp AS FLOAT) AS DOUBLE) AS t
        FROM prof WHERE salt IS NOT NULL AND temp IS NOT NULL AND lev BETWEEN 0 AND 1000)),
n AS (SELECT *, lag(z) OVER w AS z0, lag(rho) OVER w AS r0, lead(z) OVER w AS z1, lead(rho) OVER w AS r1
  FROM v WINDOW w AS (PARTITION BY member, iy, ix, time ORDER BY z)),
ref AS (SELECT member, iy, ix, time, rho + (10e0 - z) * (r1 - rho) / (z1 - z) + 0.03e0 AS lim
  FROM n WHERE z < 10 AND z1 > 10),
hit AS (SELECT n.*, lim, row_number() OVER (PARTITION BY n.member, n.iy, n.ix, n.time ORDER BY z) AS rn
  FROM n JOIN ref ON ref.member = n.member AND ref.iy = n.iy AND ref.ix = n.ix AND ref.time = n.time
  WHERE rho >= lim),
cols AS (SELECT DISTINCT member, iy, ix, time, lat, lon FROM prof)
SELECT c.member, c.iy, c.ix, c.time, c.lat, c.lon,
  {rnd("CASE WHEN z0 IS NULL OR rho = r0 THEN z ELSE z0 - (r0 - lim) * (z - z0) / (rho - r0) END", 4)} AS mld
FROM cols c LEFT JOIN hit h ON h.member = c.member AND h.iy = c.iy AND h.ix = c.ix AND h.time = c.time AND rn = 1"""


def _sum_of_powers(rows, outer: str, inner: str) -> str:
    """Terms spelled out one by one, not nested."""
    terms = []
    for i, row in enumerate(rows):
        for j, c in enumerate(row):
            factors = [f"({c!r})".replace("'", "")] + [outer] * i + [inner] * j
            terms.append("*".join(factors))
    return " + ".join(t if "e" in t.split(")")[0] else t.replace(")", "e0)", 1) for t in terms)


_SA = f"(s * {SA_PER_SP!r}e0)"
_CT = "((" + _sum_of_powers(ENTHALPY, f"sqrt({SALT_SCALE!r}e0 * {_SA})", "(t * 0.025e0)") + f") / {HEAT_CAPACITY!r}e0)"
_SIGMA = "1e0 / (" + _sum_of_powers(
    VOLUME, f"({_CT} * 0.025e0)", f"sqrt({SALT_SCALE!r}e0 * {_SA} + {SALT_OFFSET!r}e0)") + ") - 1000e0"
SQL["mixed_layer_linear"] = mixed_layer("26e0 - 0.2e0 * (t - 10e0) + 0.8e0 * (s - 35e0)")
SQL["mixed_layer_teos10"] = mixed_layer(_SIGMA)


def merged(fill: dict[str, bool], where: str = "TRUE") -> str:
    def v(name: str) -> str:
        value = f"{name}.value"
        return r(f"COALESCE({value}, 0e0)" if fill.get(name) else value, 4, name)

    return f"""WITH {THREE_CUBES} SELECT tos.member, tos.time, tos.iy, tos.ix, tos.lat, tos.lon,
  {v('tos')}, {v('sos')}, {v('psl')}
FROM lcube tos JOIN qcube sos ON sos.member = tos.member AND sos.time = tos.time AND sos.iy = tos.iy AND sos.ix = tos.ix
JOIN ocube psl ON psl.member = tos.member AND psl.time = tos.time AND psl.iy = tos.iy AND psl.ix = tos.ix WHERE {where}"""


SQL["merge_inner"] = merged({})
SQL["merge_fill_ocean"] = merged({"tos": True, "sos": True})
SQL["merge_fill_all"] = merged({"tos": True, "sos": True, "psl": True})
SQL["merge_window"] = merged({}, "tos.time >= TIMESTAMP '1996-01-01' AND tos.time < TIMESTAMP '1999-01-01'")
SQL["field_difference"] = f"""WITH {WIND_MAX}, wmean AS (
  SELECT member, iy, ix, date_trunc('month', time) AS time, avg(value) AS value FROM wind GROUP BY 1, 2, 3, 4)
SELECT a.member, a.time, a.iy, a.ix, a.lat, a.lon, {r('b.value', 4, 'uas')}, {r('a.value', 4, 'uasmax')},
  {r('a.value - b.value', 4, 'difference')}
FROM wmax a JOIN wmean b ON a.member = b.member AND a.iy = b.iy AND a.ix = b.ix AND a.time = b.time"""
_KEYS = "member, iy, ix, time"
SQL["exact_align_check"] = f"""WITH {LINE_OBS}, {ORDER_OBS}
SELECT {_KEYS}, 'left' AS side FROM (SELECT {_KEYS} FROM lobs EXCEPT SELECT {_KEYS} FROM oobs)
UNION ALL SELECT {_KEYS}, 'right' FROM (SELECT {_KEYS} FROM oobs EXCEPT SELECT {_KEYS} FROM lobs)"""
SUPP = "supp AS (" + _cells("supplier", "s_suppkey", "s_acctbal") + ")"
_GRIDS = LINES + ", " + SUPP + f""", g1 AS (SELECT DISTINCT member, iy, ix, {LATLON} FROM lines),
g2 AS (SELECT member, iy, ix, -55e0 + iy * 10e0 + CASE WHEN s_acctbal > 8000 THEN 0.5e0 ELSE 1e-9 END AS lat2,
       -170e0 + ix * 20e0 + member % 4 * 3e0 AS lon2, s_acctbal FROM supp)"""
SQL["grid_check"] = (
    f"WITH {_GRIDS} SELECT member, iy, ix, lat, lon, lat2, lon2 FROM g1 FULL JOIN g2 USING (member, iy, ix) "
    "WHERE lat IS NULL OR lat2 IS NULL OR abs(lat - lat2) > 1e-8 + 1e-5 * abs(lat2)")
SQL["harmonised_coords"] = (
    f"WITH {_GRIDS} SELECT member, iy, ix, lat, lon, s_acctbal FROM g2 JOIN g1 USING (member, iy, ix)")
_OBS_OUT = f"member, iy, ix, time, lat, lon, {r('value')}"
SQL["union_time"] = f"WITH {LINE_OBS} SELECT {_OBS_OUT} FROM lobs"
SQL["union_incremental"] = f"""WITH {LINE_OBS}
SELECT {_OBS_OUT} FROM lobs WHERE time <= TIMESTAMP '1999-06-01'
UNION ALL SELECT {_OBS_OUT} FROM lobs WHERE time >= TIMESTAMP '1999-01-01' ORDER BY time"""
SQL["monotone_check"] = f"""WITH {ORDER_OBS} SELECT member, iy, ix, time, 2 AS copies FROM oobs
WHERE time BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-06-01'"""
SQL["time_intersection"] = (
    f"WITH {LINE_OBS}, {ORDER_OBS} SELECT member, time FROM lobs INTERSECT SELECT member, time FROM oobs")
SQL["common_period"] = (
    f"WITH {FIELDS} SELECT member, max(a) AS start, min(b) AS \"end\" FROM ("
    "SELECT member, var, min(time) AS a, max(time) AS b FROM fields GROUP BY 1, 2) GROUP BY 1")
SQL["coverage_check"] = f"""WITH {ORDER_OBS} SELECT member, iy, ix, min(time) AS first, max(time) AS last,
  CASE WHEN min(time) > TIMESTAMP '1995-02-01' THEN 'starts late' ELSE 'ends early' END AS problem
FROM oobs GROUP BY 1, 2, 3 HAVING min(time) > TIMESTAMP '1995-02-01' OR max(time) < TIMESTAMP '2001-07-01'"""
SQL["verify_periods"] = f"""WITH {LINE_OBS} SELECT * FROM (
  SELECT member, iy, ix, strftime(min(time), '%Y-%m') AS start, strftime(max(time), '%Y-%m') AS "end",
         count(DISTINCT time) AS months FROM lobs GROUP BY 1, 2, 3)
WHERE NOT (start = '1995-01' AND "end" = '2001-11' AND months = 83)"""
SQL["completeness"] = f"""WITH {ORDER_OBS} SELECT member, iy, ix, year(time) AS year, count(*) AS files
FROM oobs GROUP BY 1, 2, 3, 4 HAVING count(*) < 12"""
SQL["time_bounds"] = f"""WITH {FIELDS} SELECT var, member, min(time) AS start, max(time) AS "end",
  count(DISTINCT time) AS months FROM fields GROUP BY 1, 2"""


def corners(src: str) -> str:
    """Target points of every member with their quad found by arithmetic; ``weights`` has whole quads only."""
    pos = "((5 + 10 * tx - 190 - m % 4 * 3 + 360) % 360) / 20e0"
    return f"""gr AS MATERIALIZED (SELECT DISTINCT member, iy, ix FROM {src}),
tgt AS (SELECT *, (ix + 1) % 18 AS jx FROM (
  SELECT m AS member, CAST(ty AS INTEGER) AS ty, CAST(tx AS INTEGER) AS tx, -52.5e0 + 5e0 * ty AS tlat, 5e0 + 10e0 * tx AS tlon,
    CAST(floor((2.5e0 + 5e0 * ty) / 10) AS INTEGER) AS iy, CAST(floor({pos}) AS INTEGER) AS ix,
    (2.5e0 + 5e0 * ty) / 10 - floor((2.5e0 + 5e0 * ty) / 10) AS a, {pos} - floor({pos}) AS b
  FROM (SELECT DISTINCT member AS m FROM gr), range(22) y(ty), range(36) x(tx))),
wts AS (
  SELECT member, ty, tx, tlat, tlon, iy, ix, (1-a)*(1-b) AS w FROM tgt UNION ALL
  SELECT member, ty, tx, tlat, tlon, iy, jx, (1-a)*b FROM tgt UNION ALL
  SELECT member, ty, tx, tlat, tlon, iy + 1, ix, a*(1-b) FROM tgt UNION ALL
  SELECT member, ty, tx, tlat, tlon, iy + 1, jx, a*b FROM tgt),
whole AS (SELECT member, ty, tx FROM wts JOIN gr USING (member, iy, ix) GROUP BY 1, 2, 3 HAVING count(*) = 4),
weights AS MATERIALIZED (SELECT wts.* FROM wts JOIN whole USING (member, ty, tx))"""


def _weighted(strict: bool) -> str:
    return (
        "CASE WHEN count(*) = count(value) AND count(*) = 4 THEN sum(w * value) END" if strict else
        "CASE WHEN sum(CASE WHEN value IS NOT NULL THEN w ELSE 0 END) >= 0.5 - 1e-12 "
        "THEN sum(w * value) / sum(CASE WHEN value IS NOT NULL THEN w END) END")


def regridded(src: str, strict: bool = False, more: str = "") -> str:
    return f"""SELECT s.member, {more}s.time, g.ty AS iy, g.tx AS ix, g.tlat AS lat, g.tlon AS lon, {r('v', 3, 'value')}
FROM (SELECT DISTINCT member, time FROM {src}) s JOIN tgt g ON g.member = s.member
LEFT JOIN (SELECT member, time, ty, tx, {_weighted(strict)} AS v FROM {src} JOIN weights USING (member, iy, ix) GROUP BY 1, 2, 3, 4) f
  ON f.member = s.member AND f.time = s.time AND f.ty = g.ty AND f.tx = g.tx"""


SQL["regrid_weights"] = (
    f"WITH {LINE_OBS}, {corners('lobs')} SELECT member, ty, tx, tlat, tlon, iy, ix, {r('w', 9)} FROM weights")
SQL["regrid_bilinear"] = f"WITH {ORDER_CUBE}, {corners('ocube')} " + regridded("ocube")
SQL["regrid_strict"] = f"WITH {ORDER_CUBE}, {corners('ocube')} " + regridded("ocube", True)
SQL["anomaly_regridded"] = (
    f"WITH {LINE_CUBE}, {detrended('lcube')}, {anomalies('det')}, {corners('lcube')} " + regridded("anom"))
SQL["anomaly_job"] = (
    f"WITH {LINE_CUBE}, {detrended('lcube')}, {anomalies('det')}, {corners('lcube')} " + regridded("anom", more="'tos' AS var, "))
SQL["wind_maximum_job"] = (
    f"WITH {WIND_MAX}, {cube('wcube', 'wmax')}, sparse AS (SELECT * FROM wcube WHERE value IS NOT NULL), "
    f"{detrended('sparse')}, {anomalies('det')}, {corners('wmax')} " + regridded("anom", more="'uasmax' AS var, "))

_MANY = """o AS (SELECT o_orderkey % 3 AS model, CAST(o_orderkey // 3 % 4 AS INTEGER) AS iy,
    CAST(o_orderkey // 12 % [6, 8, 5][o_orderkey % 3 + 1] AS INTEGER) AS ix, date_trunc('year', o_orderdate) AS time, o_totalprice FROM orders),
obs AS MATERIALIZED (SELECT model, iy, ix, time, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS value FROM o GROUP BY 1, 2, 3, 4),
shape(model, nx, lon0, dlon, round) AS (VALUES (0, 6, -170e0, 60e0, TRUE), (1, 8, 10e0, 45e0, TRUE), (2, 5, 102e0, 20e0, FALSE)),
tgt AS (SELECT *, floor(y) AS iy, floor(x) AS ix, y - floor(y) AS a, x - floor(x) AS b FROM (
  SELECT s.*, CAST(ty AS INTEGER) AS ty, CAST(tx AS INTEGER) AS tx, -50e0 + 20e0 * ty AS tlat, 5e0 + 15e0 * tx AS tlon,
    (-50e0 + 20e0 * ty + 45e0) / 30e0 AS y, ((5e0 + 15e0 * tx - lon0 + 720e0) % 360e0) / dlon AS x
  FROM shape s, range(6) a(ty), range(24) b(tx))),
inside AS (SELECT *, CASE WHEN round THEN (ix + 1) % nx ELSE ix + 1 END AS jx FROM tgt WHERE y BETWEEN 0 AND 3 AND (round OR x <= nx - 1)),
weights AS (
  SELECT model, ty, tx, iy, ix, (1-a)*(1-b) AS w FROM inside UNION ALL SELECT model, ty, tx, iy, jx, (1-a)*b FROM inside UNION ALL
  SELECT model, ty, tx, iy + 1, ix, a*(1-b) FROM inside UNION ALL SELECT model, ty, tx, iy + 1, jx, a*b FROM inside)"""


def _many(strict: bool) -> str:
    return f"""SELECT t.model, t.time, g.ty AS iy, g.tx AS ix, g.tlat AS lat, g.tlon AS lon, {r('v', 3, 'value')}
FROM (SELECT DISTINCT model, time FROM obs) t JOIN tgt g ON g.model = t.model
LEFT JOIN (SELECT model, time, ty, tx, {_weighted(strict)} AS v FROM obs JOIN weights USING (model, iy, ix) GROUP BY 1, 2, 3, 4) f
  ON f.model = t.model AND f.time = t.time AND f.ty = g.ty AND f.tx = g.tx"""


SQL["regrid_many_grids"] = f"WITH {_MANY} {_many(False)}"
SQL["regrid_full_target"] = (
    f"WITH {_MANY} SELECT model, iy, ix, lat, lon, count(*) AS steps, count(value) AS present FROM ({_many(True)}) GROUP BY 1, 2, 3, 4, 5")

_SEAM = SUPP + """, raw AS (
  SELECT member, iy, ix, (ix * 20e0 + iy * 7e0 + 250e0 + s_acctbal / 10000e0) AS l FROM supp),
turn AS (SELECT member, iy, ix, l - 360e0 * floor(l / 360e0) AS l FROM raw),
grid AS (SELECT member, iy, ix, CASE WHEN l > 180 THEN l - 360 ELSE l END AS lon,
                CASE WHEN l > 180 OR l >= 0 THEN l END AS lon360 FROM turn)"""
SQL["lon_unwrap"] = f"""WITH {_SEAM}, st AS (
  SELECT *, lon360 - lag(lon360) OVER (PARTITION BY member, iy ORDER BY ix) AS step FROM grid),
fl AS (SELECT *, COALESCE(min(step) OVER (PARTITION BY member) < -180, FALSE) AS seam,
  sum(CASE WHEN step < -180 THEN 360e0 WHEN step > 180 THEN -360e0 ELSE 0e0 END)
    OVER (PARTITION BY member, iy ORDER BY ix) AS turns FROM st)
SELECT member, iy, ix, seam, {r('CASE WHEN seam THEN lon360 + turns ELSE lon END', 6, 'lon')} FROM fl"""
SQL["wrap_count"] = f"""WITH {_SEAM}, st AS (SELECT *,
  abs(lon360 - lag(lon360) OVER (PARTITION BY member, iy ORDER BY ix)) AS sx,
  abs(lon360 - lag(lon360) OVER (PARTITION BY member, ix ORDER BY iy)) AS sy FROM grid),
c AS (SELECT member, count(*) FILTER (sy > 180) AS wraps_iy, count(DISTINCT iy) AS size_iy,
  count(*) FILTER (sx > 180) AS wraps_ix, count(DISTINCT ix) AS size_ix FROM st GROUP BY 1)
SELECT *, CASE WHEN wraps_ix + size_ix * 1e-6 > wraps_iy + size_iy * 1e-6 THEN 'ix' ELSE 'iy' END AS lon_axis FROM c"""

SQL["field_quantiles"] = " UNION ALL ".join(
    f"SELECT l_returnflag, {p}e0 AS p, {r(f'quantile_cont(l_extendedprice, {p})', 4, 'quantile')} "
    "FROM lineitem GROUP BY 1"
    for p in (0.0, 0.02, 0.5, 0.98, 1.0))


def limits(src: str, keys: str, out: str = "lims") -> str:
    return f"""{out} AS (SELECT {keys}, COALESCE(nullif(greatest(
    abs(quantile_cont(value, 0.02)), abs(quantile_cont(value, 0.98))), 0), nullif(max(abs(value)), 0), 1e0) AS v
  FROM {src} GROUP BY {keys})"""


SQL["symmetric_limits"] = (
    f"WITH {LINE_CUBE}, {detrended('lcube')}, {anomalies('det')}, {limits('anom', 'member')} "
    f"SELECT member, {r('-v', 3, 'vmin')}, {r('v', 3, 'vmax')} FROM lims")
SQL["frame_sampling"] = (
    f"WITH {LINE_CUBE} SELECT member, time, t_idx FROM lobs_axis WHERE t_idx % 5 = 0 OR t_idx = n_time - 1")
SQL["frame_rows"] = f"""WITH {FIELDS}, ax AS (
  SELECT member, time, row_number() OVER (PARTITION BY member ORDER BY time) - 1 AS frame,
         count(*) OVER (PARTITION BY member) AS n
  FROM (SELECT DISTINCT member, time FROM fields)),
shown AS (SELECT f.*, frame FROM fields f JOIN ax USING (member, time) WHERE frame % 7 = 0 OR frame = n - 1),
{limits('shown', 'member, var')}
SELECT member, var, time, iy, ix, lat, lon, {r('value')}, frame, {r('-v', 4, 'vmin')}, {r('v', 4, 'vmax')},
  strftime(time, '%Y-%m-%d') AS label FROM shown JOIN lims USING (member, var)"""
SQL["plot_extent"] = f"""WITH {LINE_OBS} SELECT member, min(lon) AS lon_min, max(lon) AS lon_max,
  min(lat) AS lat_min, max(lat) AS lat_max FROM lobs GROUP BY 1"""
SQL["field_stats"] = (
    f"WITH {LINE_CUBE} SELECT member, {r('avg(value)', 3, 'mean')}, {r('stddev_pop(value)', 3, 'std')} "
    "FROM lcube GROUP BY 1")
SQL["zscore"] = f"""WITH {LINE_CUBE} SELECT {_CUBE_OUT},
  {r('(value - avg(value) OVER w) / greatest(stddev_pop(value) OVER w, 1e-12)', 6, 'value')}
FROM lcube WINDOW w AS (PARTITION BY member)"""

FILES = """files AS (SELECT *, concat_ws('/', model, member, 'monthly', name) AS path FROM (
  SELECT *, CASE o_orderpriority
      WHEN '1-URGENT' THEN kind || '.' || m || '-' || m || '.anom_1x2.nc'
      WHEN '2-HIGH' THEN kind || '.' || y || '-' || y || '.anom_1x2.nc'
      WHEN '3-MEDIUM' THEN concat_ws('_', kind, model, exp, member, 'gn_time.anom_1x2.nc')
      WHEN '4-NOT SPECIFIED' THEN kind || '.' || m || '-' || m || '.nc'
      ELSE 'x' || kind || '_' || y || '-' || y || '.nc' END AS name
  FROM (SELECT 'MODEL' || (o_custkey // 15) AS model, 'r' || (o_orderkey % 3 + 1) || 'i1p1f1' AS member,
      CASE WHEN o_orderstatus = 'F' THEN 'historical' ELSE 'ssp370' END AS exp,
      ['tos','ohc300','mlotst','sos','psl','uos','vos','uas','uasmax','vas'][o_orderkey % 10 + 1] AS kind,
      strftime(o_orderdate, '%Y%m') AS m, strftime(o_orderdate, '%Y') AS y, o_orderpriority, o_orderdate
    FROM orders)))"""
_KNOWN = "('tos','ohc300','mlotst','sos','psl','uos','vos','uas','uasmax','vas')"
_LEAD = "regexp_extract(name, '^([A-Za-z0-9]+)[._]', 1)"
SQL["var_from_name"] = f"""WITH {FILES} SELECT path, name,
  CASE WHEN {_LEAD} IN {_KNOWN} THEN {_LEAD} ELSE '-' END AS known, {_LEAD} AS leading,
  split_part(CASE WHEN name LIKE '%.nc' THEN name[:-4] ELSE name END, '_', 1) AS stem,
  name LIKE '%.anom\\_1x2.nc' ESCAPE '\\' AS anomaly FROM files"""


def preferred(where: str) -> str:
    return f"""WITH {FILES}, ranked AS (SELECT model, {_LEAD} AS var, path, NOT ends_with(name, '.anom_1x2.nc') AS is_raw,
  row_number() OVER (PARTITION BY model, {_LEAD} ORDER BY NOT ends_with(name, '.anom_1x2.nc'),
    NOT regexp_matches(name, '\\d{{6}}-\\d{{6}}'), NOT regexp_matches(name, '\\d{{4}}-\\d{{4}}'), name, path) AS rn
  FROM files WHERE {where}) SELECT model, var, path, is_raw FROM ranked WHERE rn = 1"""


SQL["file_preference"] = preferred(f"ends_with(name, '.anom_1x2.nc') AND {_LEAD} IN {_KNOWN}")
SQL["file_preference_raw"] = preferred("TRUE")
SQL["var_set_difference"] = f"""WITH {FILES}, held AS (SELECT model, member, list(DISTINCT kind) AS k FROM files GROUP BY 1, 2)
SELECT model, member, COALESCE(array_to_string(list_filter(
  ['tos','ohc300','mlotst','sos','psl','uos','vos','uas','uasmax','vas'], lambda v: NOT list_contains(k, v)), ','), '') AS missing
FROM held"""
_PAIRS = FILES + """, sides AS (SELECT model, member, kind AS var,
    min(CASE WHEN exp = 'historical' THEN concat_ws('_', kind, 'Omon', model, exp, member, 'gn_time.nc') END) AS h,
    min(CASE WHEN exp = 'ssp370' THEN concat_ws('_', kind, 'Omon', model, exp, member, 'gn_time.nc') END) AS s
  FROM files GROUP BY 1, 2, 3),
pairs AS (SELECT *, CASE WHEN model = 'MODEL7' THEN 'excluded' WHEN h IS NULL OR s IS NULL THEN 'missing'
    ELSE 'merged' END AS status FROM sides)"""
SQL["scenario_pairs"] = f"""WITH {_PAIRS} SELECT model, member, var, COALESCE(h, '-') AS historical,
  COALESCE(s, '-') AS ssp370, status,
  CASE WHEN status = 'merged' THEN replace(h, '_historical_', '_historical_ssp370_') ELSE '-' END AS out_name FROM pairs"""
SQL["scenario_counts"] = f"WITH {_PAIRS} SELECT status, count(*) AS series FROM pairs GROUP BY 1"
SQL["daily_name_parts"] = f"""WITH {FILES}, d AS (SELECT path, model, exp, member AS mem,
  CASE WHEN kind = 'tos' THEN 'r9i1p1f1' ELSE member END AS folder, o_orderpriority = '5-LOW' AS bad FROM files),
p AS (SELECT *, CASE WHEN bad THEN 'unexpected tail' WHEN mem <> folder THEN 'member folder mismatch' ELSE '-' END AS problem FROM d)
SELECT path, model, CASE WHEN problem = '-' THEN exp ELSE '-' END AS exp,
  CASE WHEN problem = '-' THEN mem ELSE '-' END AS member,
  CASE WHEN problem = '-' THEN 'gr1' ELSE '-' END AS grid, problem FROM p"""
SQL["period_files"] = f"""WITH {FILES} SELECT path, name, o_orderdate FROM files
WHERE regexp_matches(name, '(1996|1997|1998)(01|02|03|04|05|06|07|08|09|10|11|12)')"""
SQL["time_tags"] = """SELECT o_custkey, strftime(min(o_orderdate), '%Y%m') || '-' || strftime(max(o_orderdate), '%Y%m') AS span,
  strftime(min(o_orderdate), '%Y-%m') AS first_month, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day,
  CAST(day(last_day(max(o_orderdate))) AS INTEGER) AS days,
  CAST(date_trunc('month', max(o_orderdate)) AS TIMESTAMP) AS month FROM orders GROUP BY 1"""
SQL["config_overview"] = """SELECT 'configs/' || c_custkey || '.yaml' AS path,
  '| ' || c_name || ' | ' || lower(c_mktsegment) || '_run | ' || lower(n_name) || ' | first_' || c_nationkey
  || CASE WHEN c_acctbal > 0 THEN ', second_' || lower(c_mktsegment) ELSE '' END || ' | vars_' || c_custkey
  || ' | `outputs/' || c_custkey || '/' || lower(c_mktsegment) || '` | `configs/' || c_custkey || '.yaml` |' AS line
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

SQL["lon_normalise"] = f"""SELECT c_custkey, {r('CASE WHEN l < 0 THEN l + 360 ELSE l END', 6, 'lon_360')},
  {r('(l + 360) - 360 * floor((l + 360) / 360)', 6, 'lon_mod')}, {r('cos(radians(l / 5e0))', 9, 'weight')}
FROM (SELECT c_custkey, c_acctbal / 25e0 AS l FROM customer)"""
SQL["unit_conversions"] = f"""SELECT p_partkey,
  ['k', 'degrees kelvin', 'degc', 'kg kg^-1', 'cm'][k] AS units,
  {r('CASE WHEN k <= 2 THEN v - 273.15e0 ELSE v END', 4, 'celsius')},
  {r('CASE WHEN k = 1 THEN v - 273.15e0 ELSE v END', 4, 'celsius_strict')},
  {r('CASE WHEN k = 4 THEN v * 1000e0 ELSE v END', 4, 'salinity')},
  {r('CASE WHEN k = 5 THEN v / 100e0 ELSE v END', 4, 'metres')}
FROM (SELECT p_partkey, p_size % 5 + 1 AS k, p_retailprice AS v FROM part)"""
SQL["missing_values"] = f"""SELECT p_brand, count(*) AS n_rows,
  count(CASE WHEN p_size % 10 > 1 THEN 1 END) AS n_values,
  {r('max(CASE WHEN p_size % 10 > 1 THEN p_retailprice END)', 4, 'top')} FROM part GROUP BY 1"""

# ---- whole jobs ------------------------------------------------------------
SERIES = LINE_OBS + ", " + ORDER_OBS + """, ser AS (
  SELECT 'tos' AS var, member, iy, ix, time FROM lobs UNION ALL SELECT 'psl', member, iy, ix, time FROM oobs),
have AS (SELECT member, iy, ix, bool_or(var = 'tos') AS t, bool_or(var = 'psl') AS p FROM ser GROUP BY 1, 2, 3)"""
SQL["predictor_rejections"] = f"""WITH {SERIES}, shared AS (
  SELECT l.member, l.iy, l.ix, min(l.time) AS a, max(l.time) AS b FROM lobs l JOIN oobs o
    ON o.member = l.member AND o.iy = l.iy AND o.ix = l.ix AND o.time = l.time GROUP BY 1, 2, 3),
found AS (SELECT h.member, h.iy, h.ix, CASE
    WHEN NOT p THEN 'missing psl' WHEN NOT t THEN 'missing tos' WHEN a IS NULL THEN 'no common step'
    WHEN strftime(a, '%Y-%m') > '1995-02' THEN 'starts late'
    WHEN strftime(b, '%Y-%m') < '2001-06' THEN 'ends early' END AS problem
  FROM have h LEFT JOIN shared s ON s.member = h.member AND s.iy = h.iy AND s.ix = h.ix)
SELECT member, iy, ix, problem FROM found WHERE problem IS NOT NULL"""
SQL["predictor_table"] = f"""WITH {FIELDS}, shared AS (
  SELECT member, time FROM (SELECT DISTINCT member, time, var FROM fields) GROUP BY 1, 2 HAVING count(*) = 3),
spans AS (SELECT member, strftime(min(time), '%Y-%m') AS a, strftime(max(time), '%Y-%m') AS b FROM shared GROUP BY 1),
judged AS (SELECT m.member, CASE WHEN a IS NULL THEN 'no common step' WHEN a > '1995-03' THEN 'starts late'
  WHEN b < '2001-06' THEN 'ends early' END AS problem FROM (SELECT DISTINCT member FROM fields) m LEFT JOIN spans USING (member)),
wide AS (
  SELECT member, time, iy, ix, any_value(lat) AS lat, any_value(lon) AS lon,
    coalesce(max(CASE WHEN var = 'tos' THEN value END), 0e0) AS tos, coalesce(max(CASE WHEN var = 'sos' THEN value END), 0e0) AS sos,
    max(CASE WHEN var = 'psl' THEN value END) AS psl
  FROM fields WHERE time >= TIMESTAMP '1995-03-01' AND time < TIMESTAMP '2001-07-01'
    AND member IN (SELECT member FROM judged WHERE problem IS NULL)
  GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT var) = 3)
SELECT member, time, iy, ix, lat, lon, {r('tos')}, {r('sos')}, {r('psl')}, CAST(NULL AS VARCHAR) AS problem FROM wide
UNION ALL
SELECT member, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, problem FROM judged WHERE problem IS NOT NULL"""
_SINGLE = "CAST(CAST({0} AS FLOAT) AS DOUBLE)"
SQL["split_periods"] = f"""WITH {LINES}, {ORDERS}, zl AS (SELECT * REPLACE (0 AS member) FROM lines), zo AS (SELECT * REPLACE (0 AS member) FROM ord),
{obs('ztos', 'zl', 'l_extendedprice')}, {cube('tc', 'ztos')}, {obs('zsos', 'zl', 'l_quantity')}, {cube('sc', 'zsos')},
{obs('zpsl', 'zo', 'o_totalprice')}, {cube('pc', 'zpsl')},
cubes AS MATERIALIZED (SELECT * FROM tc UNION ALL SELECT * REPLACE (4 AS member) FROM sc UNION ALL SELECT * REPLACE (8 AS member) FROM pc),
{detrended('cubes')}, {anomalies('det')}, {corners('cubes')},
reg AS ({regridded("anom").replace(r('v', 3, 'value'), 'v AS value')}),
single AS MATERIALIZED (SELECT member, time, iy, ix, lat, lon, {_SINGLE.format('value')} AS value FROM reg),
wide AS (
  SELECT time, iy, ix, any_value(lat) AS lat, any_value(lon) AS lon, max(CASE WHEN member = 0 THEN value END) AS tos,
    max(CASE WHEN member = 4 THEN value END) AS sos, max(CASE WHEN member = 8 THEN value END) AS psl
  FROM single GROUP BY 1, 2, 3 HAVING count(*) = 3),
target AS (
  SELECT 'validation' AS split, time, {_SINGLE.format(
      "sum(cos(radians(lat)) * value) / nullif(sum(CASE WHEN value IS NOT NULL THEN cos(radians(lat)) END), 0)")} AS nino34
  FROM single WHERE member = 0 AND {BOX} AND time >= TIMESTAMP '1995-06-01' AND time < TIMESTAMP '1998-01-01' GROUP BY 2
  UNION ALL
  SELECT 'test', date_trunc('month', time), {_SINGLE.format(MEAN.format('o_totalprice'))}
  FROM ord WHERE time >= TIMESTAMP '1998-01-01' AND time < TIMESTAMP '2001-01-01' GROUP BY 2)
SELECT split, w.time, iy, ix, lat, lon, {r('tos', 1)}, {r('sos', 1)}, {r('psl', 1)}, {r('nino34', 1)}
FROM wide w JOIN target ON target.time = w.time"""
SQL["target_periods"] = f"""WITH {SERIES},
inp AS (SELECT member, iy, ix, min(time) AS a, max(time) AS b FROM oobs WHERE iy % 3 <> 1 GROUP BY 1, 2, 3),
com AS (SELECT member, iy, ix, max(a) AS a, min(b) AS b FROM (
    SELECT member, iy, ix, var, min(time) AS a, max(time) AS b FROM ser GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3)
SELECT h.member, h.iy, h.ix,
  strftime(COALESCE(i.a, CASE WHEN c.a <= c.b THEN c.a END), '%Y-%m') AS start,
  strftime(COALESCE(i.b, CASE WHEN c.a <= c.b THEN c.b END), '%Y-%m') AS "end",
  CASE WHEN i.a IS NOT NULL THEN 'input' WHEN c.a > c.b THEN 'tos_full_period'
       ELSE 'common_predictor_overlap;missing=' || CASE WHEN p THEN 'uas' ELSE 'psl,uas' END END AS period_source
FROM have h LEFT JOIN inp i ON i.member = h.member AND i.iy = h.iy AND i.ix = h.ix
JOIN com c ON c.member = h.member AND c.iy = h.iy AND c.ix = h.ix WHERE h.t"""
SQL["member_targets"] = f"""WITH {FIELDS}, span AS (SELECT member, max(a) AS a, min(b) AS b FROM (
    SELECT member, var, min(time) AS a, max(time) AS b FROM fields GROUP BY 1, 2) GROUP BY 1),
used AS (SELECT 'M' || member AS model, 'common_predictor_overlap' AS period_source, time, lat, lon, value
  FROM lcube JOIN span USING (member) WHERE member <> 1 AND time BETWEEN a AND b)
""" + area_mean("used", BOX, "model, period_source, time", "nino34")
_SCENARIOS = f"""{LINE_OBS}, {ORDER_OBS}, parts AS (
  SELECT 1 AS side, member AS m, iy, ix, ix AS r, time, lat, lon, value FROM lobs WHERE time < TIMESTAMP '1999-01-01'
  UNION ALL SELECT 2, member, iy, ix, ix + CASE WHEN iy % 5 = 4 THEN 100 ELSE 0 END, time, lat, lon, value FROM oobs
  WHERE time >= TIMESTAMP '1999-01-01')"""
SQL["scenario_union"] = f"""WITH {_SCENARIOS},
both_sides AS (SELECT m, iy, r FROM parts GROUP BY 1, 2, 3 HAVING count(DISTINCT side) = 2)
SELECT 'M' || iy AS model, 'r' || r || '_' || m AS member, 'tos' AS var, 'historical_ssp370' AS exp,
  iy, ix, time, lat, lon, {r('value', 7)} FROM parts JOIN both_sides USING (m, iy, r) WHERE iy <> 7"""
SQL["scenario_unpaired"] = f"""WITH {_SCENARIOS}, s AS (
  SELECT m, iy, r, count(DISTINCT side) AS n, min(side) AS side FROM parts GROUP BY 1, 2, 3)
SELECT 'M' || iy AS model, 'r' || r || '_' || m AS member, 'tos' AS var,
  CASE WHEN iy = 7 THEN 'excluded' WHEN side = 1 THEN 'no scenario' ELSE 'no historical period' END AS problem
FROM s WHERE iy = 7 OR n = 1"""
SQL["surface_salinity"] = (
    f"WITH {PROFILE} SELECT member, iy, ix, time, lat, lon, 'sos' AS var, {r('salt * 1000e0', 4, 'value')} "
    "FROM prof WHERE lev = 5e0 * (1e0 + member % 4 * 0.25e0)")
SQL["heat_content_kelvin"] = f"""WITH {LAYERS} SELECT member, iy, ix, time, min(lat) AS lat, min(lon) AS lon, 'ohc300' AS var,
  {rnd("""CASE WHEN count(temp) > 0 THEN sum(COALESCE(temp - 273.15e0, 0) * greatest(least(z_hi, 300e0) - z_lo, 0e0))
    * (1025e0 * 3992e0) END / 1e6""", 3)} AS value
FROM prof JOIN layers USING (member, lev) GROUP BY 1, 2, 3, 4"""
SQL["mixed_layer_paired"] = (
    f"SELECT member, iy, ix, time, lat, lon, 'mlotst' AS var, mld AS value FROM ({SQL['mixed_layer_teos10']})")
SQL["last_files"] = f"""WITH {FILES} SELECT split_part(name, '.', 1) AS var, max(name) AS path FROM files
WHERE name LIKE '%.%.nc' AND split_part(name, '.', 1) IN {_KNOWN} GROUP BY 1"""


def _best(where: str) -> str:
    return preferred(f"ends_with(name, '.anom_1x2.nc') AND {_LEAD} IN {_KNOWN} AND {where}")


SQL["file_map_override"] = f"""SELECT e.model, e.var, COALESCE(h.path, e.path) AS path, COALESCE(h.is_raw, e.is_raw) AS is_raw
FROM ({_best('TRUE')}) e LEFT JOIN ({_best("exp = 'historical'")}) h ON h.model = e.model AND h.var = e.var"""
SQL["file_kinds"] = """SELECT p_partkey,
  ['zip', 'netcdf', 'netcdf', 'netcdf', 'unknown', 'unknown'][p_size % 6 + 1] AS kind FROM part"""
