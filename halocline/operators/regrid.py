"""Bilinear interpolation to a regular grid through a sparse weights table.

Weights come from the source grid's own corner table, so regular and curvilinear
grids take the same path: each source quad looks up, by arithmetic, the target
points under its bounding box.  No pair of grids is ever crossed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from halocline.functions.numeric import ratio
from halocline.functions.position import shortest_step
from halocline.operators.merge import fingerprints
from halocline.operators.sizing import BROADCAST_ROWS, settle, small_side
from halocline.schema import CELL, TargetGrid

#: Source cells of a slice that one task takes.
BLOCK_CELLS = 8_192
CORNERS = ("00", "01", "10", "11")
#: Index of the made-up source cell that keeps targets without sources.
NOWHERE = -1


def _near(lon: Column, anchor: Column) -> Column:
    """``lon`` moved by whole turns next to ``anchor``."""
    return lon + 360e0 * F.round((anchor - lon) / 360e0)


def seams(grid: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, nx): the width of every grid whose last column is about one step short of its first, one turn on.

    Found from the grid's own longitudes, over its full rows; a grid that overlaps itself needs no closing.
    """
    keys = list(keys)
    at = lambda i: F.max(F.when(F.col("ix") == i, F.col("lon")))
    rows = grid.groupBy(*keys, "iy").agg(
        F.max("ix").alias("_last"), F.max_by("lon", "ix").alias("_end"), at(0).alias("_first"), at(1).alias("_second"))
    widest = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))  # a row for each grid row
    full = rows.withColumn("_nx", F.max("_last").over(widest) + 1).where("_last + 1 = _nx")
    step, gap = (F.avg(shortest_step(x)) for x in (F.col("_second") - F.col("_first"), F.col("_first") - F.col("_end")))
    found = full.groupBy(*keys).agg(F.max("_nx").alias("nx"), step.alias("_step"), gap.alias("_gap"))
    closes = (F.col("nx") > 2) & (F.col("_gap") * F.col("_step") > 0) & (F.abs("_gap") <= 1.5e0 * F.abs("_step"))
    return found.where(closes).select(*keys, "nx")


def _quads(grid: DataFrame, keys: list[str]) -> DataFrame:
    """Neighbouring corners side by side; the last column meets the first where the grid goes round."""
    on = keys or ["_one"]
    sized = grid if keys else grid.withColumn("_one", F.lit(1))
    closed = seams(grid, keys) if keys else seams(grid).withColumn("_one", F.lit(1))
    sized = sized.join(closed, on, "left")
    nxt = F.when(F.col("ix") + 1 == F.col("nx"), F.lit(0)).otherwise(F.col("ix") + 1)
    out = sized.select(*keys, "iy", "ix", nxt.alias("jx"), (F.col("iy") + 1).alias("jy"),
                       F.col("lat").alias("lat00"), F.col("lon").alias("lon00"))
    for corner, row, col in (("01", "iy", "jx"), ("10", "jy", "ix"), ("11", "jy", "jx")):
        side = grid.select(*keys, F.col("iy").alias(row), F.col("ix").alias(col),
                           F.col("lat").alias(f"lat{corner}"), F.col("lon").alias(f"lon{corner}"))
        out = out.join(side, [*keys, row, col])
    return out.withColumns({f"lon{c}": _near(F.col(f"lon{c}"), F.col("lon00")) for c in CORNERS[1:]})


def bilinear_weights(grid: DataFrame, target: TargetGrid = TargetGrid(), keys: Sequence[str] = ()) -> DataFrame:
    """(keys, ty, tx, tlat, tlon, iy, ix, w): up to four sources per target point.

    ``grid`` holds (keys, iy, ix, lat, lon), one row per corner; ``keys`` name the
    grid where there are several.  Each grid is closed round the globe if its own
    longitudes say so.  Every target has one row more, from the made-up cell NOWHERE
    with weight 0, so that targets outside every quad are not lost.
    """
    keys = list(keys)
    eps = F.lit(1e-9)
    # Joined to itself below: computed once, whatever it is derived from.
    grid = settle(grid)
    q = _quads(grid, keys)
    lats, lons = ([F.col(f"{a}{c}") for c in CORNERS] for a in ("lat", "lon"))
    q = q.withColumns({
        "_s": F.greatest(*lats) + eps, "_n": F.least(*lats) - eps,
        "_e": F.greatest(*lons) + eps, "_w": F.least(*lons) - eps,
    })
    t = target
    first_y = F.greatest(F.ceil((F.col("_n") - t.lat0) / t.dlat), F.lit(0))
    last_y = F.least(F.floor((F.col("_s") - t.lat0) / t.dlat), F.lit(t.nlat - 1))
    q = q.withColumn("_ty", _range(first_y, last_y)).withColumn("ty", F.explode("_ty")).drop("_ty")
    q = q.withColumn("_turn", F.explode(F.array(*[F.lit(d) for d in (-360e0, 0e0, 360e0)])))
    start = F.lit(t.lon0) + F.col("_turn")
    first_x = F.greatest(F.ceil((F.col("_w") - start) / t.dlon), F.lit(0))
    last_x = F.least(F.floor((F.col("_e") - start) / t.dlon), F.lit(t.nlon - 1))
    q = q.withColumn("_tx", _range(first_x, last_x)).withColumn("tx", F.explode("_tx")).drop("_tx")
    q = q.withColumns({
        "tlat": F.lit(t.lat0) + F.col("ty") * t.dlat,
        "tlon": F.lit(t.lon0) + F.col("tx") * t.dlon,
    })
    q = _invert(q, F.col("tlon") + F.col("_turn") - F.col("lon00"), F.col("tlat") - F.col("lat00"))
    inside = F.col("_a").between(-1e-9, 1 + 1e-9) & F.col("_b").between(-1e-9, 1 + 1e-9)
    # A point on a shared edge lies in several quads, all giving the same value.
    chosen = q.where(inside).groupBy(*keys, "ty", "tx").agg(
        F.min("tlat").alias("tlat"), F.min("tlon").alias("tlon"),
        F.min(F.struct("iy", "ix", "jy", "jx", "_a", "_b")).alias("_q"),
    )
    a = F.least(F.greatest(F.col("_q._a"), F.lit(0e0)), F.lit(1e0))
    b = F.least(F.greatest(F.col("_q._b"), F.lit(0e0)), F.lit(1e0))

    def corner(row: str, col: str, w: Column) -> Column:
        return F.struct(F.col(f"_q.{row}").alias("iy"), F.col(f"_q.{col}").alias("ix"), w.alias("w"))

    four = F.array(
        corner("iy", "ix", (1e0 - a) * (1e0 - b)), corner("iy", "jx", (1e0 - a) * b),
        corner("jy", "ix", a * (1e0 - b)), corner("jy", "jx", a * b),
    )
    inside = chosen.select(
        *keys, F.col("ty").cast("int").alias("ty"), F.col("tx").cast("int").alias("tx"),
        "tlat", "tlon", F.inline(four),
    ).where(F.col("w") > 0)
    every = (grid.select(*keys).distinct() if keys else grid.sparkSession.range(1)).select(
        *keys, F.explode(F.sequence(F.lit(0), F.lit(t.nlat * t.nlon - 1))).alias("_t"))
    ty, tx = F.expr(f"int(_t div {t.nlon})"), F.expr(f"int(_t % {t.nlon})")
    return inside.unionByName(every.select(
        *keys, ty.alias("ty"), tx.alias("tx"), (F.lit(t.lat0) + ty * t.dlat).alias("tlat"),
        (F.lit(t.lon0) + tx * t.dlon).alias("tlon"), F.lit(NOWHERE).alias("iy"), F.lit(NOWHERE).alias("ix"),
        F.lit(0e0).alias("w")))


def _range(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first.cast("int"), last.cast("int")))


def _invert(q: DataFrame, hx: Column, hy: Column) -> DataFrame:
    """Solve P = b*E + a*F + a*b*G for the fractions a (rows) and b (columns)."""
    keep = q.columns

    def c(axis: str, corner: str) -> Column:
        return F.col(f"{axis}{corner}") - F.col(f"{axis}00")

    ex, ey = c("lon", "01"), c("lat", "01")
    fx, fy = c("lon", "10"), c("lat", "10")
    gx, gy = c("lon", "11") - ex - fx, c("lat", "11") - ey - fy
    q = q.withColumns({
        "_hx": hx, "_hy": hy, "_ex": ex, "_ey": ey, "_fx": fx, "_fy": fy, "_gx": gx, "_gy": gy,
    })
    hx, hy, ex, ey, fx, fy, gx, gy = (F.col(n) for n in (
        "_hx", "_hy", "_ex", "_ey", "_fx", "_fy", "_gx", "_gy"))
    q = q.withColumns({
        "_k2": gx * fy - gy * fx,
        "_k1": ex * fy - ey * fx + hx * gy - hy * gx,
        "_k0": hx * ey - hy * ex,
    })
    k2, k1, k0 = F.col("_k2"), F.col("_k1"), F.col("_k0")
    root = F.sqrt(F.greatest(k1 * k1 - 4e0 * k0 * k2, F.lit(0e0)))
    # Numerically safe pair of roots; the second also covers k2 = 0.
    half = -0.5e0 * (k1 + F.when(k1 < 0, -root).otherwise(root))
    fits = lambda r: r.between(-1e-9, 1 + 1e-9)
    q = q.withColumns({"_r1": ratio(k0, half), "_r2": ratio(half, k2)})
    q = q.withColumn("_a0", F.when(fits(F.col("_r1")), F.col("_r1")).otherwise(F.col("_r2")))
    a = F.col("_a0")
    dx, dy = ex + gx * a, ey + gy * a
    b = F.when(F.abs(dx) >= F.abs(dy), ratio(hx - fx * a, dx)).otherwise(ratio(hy - fy * a, dy))
    # Emitted through a generator: a later filter on the fractions is then applied
    # to them as columns and not expanded, at every use, into all of the above.
    return q.select(*keep, F.inline(F.array(F.struct(a.alias("_a"), b.alias("_b")))))


def _in_common(weights: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(keys, _grid) and (_grid, weights): grids of equal weights hold them once, under one of their keys."""
    prints = fingerprints(weights, keys, [c for c in weights.columns if c not in keys], "_print")
    first = prints.groupBy("_print").agg(F.min(F.struct(*keys)).alias("_grid"))
    own = settle(prints.join(first, "_print").select(*keys, "_grid"))
    return own, settle(weights.join(small_side(own.where(F.struct(*keys) == F.col("_grid"))), keys).drop(*keys))


def apply_weights(
    df: DataFrame,
    weights: DataFrame,
    step: Sequence[str],
    value: str = "value",
    keys: Sequence[str] = (),
    *,
    missing: str = "renormalise",
    min_weight: float = 0.5,
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """Regrid every slice of ``step`` (dataset keys and time).

    The weights hold at most 5 rows per target point and grid.  Counted small they
    are broadcast, and source rows are exchanged by slice *before* they fan out to
    up to four targets each, so the weighted sums are taken where the rows already
    are.  Grids of equal weights, as the members of one model have, share one copy where
    the weights of all are too many.  A slice of more than ``block_cells`` source cells is cut into bands of whole grid rows
    that are exchanged apart; a target then adds up partial sums, of two bands at most, so tasks can
    outnumber slices.  Beyond the broadcast, source rows meet the weights by cell and the partial sums
    are exchanged.

    ``missing`` "renormalise": rescale over present corners when they carry at
    least ``min_weight``; "strict": any missing or absent corner gives NULL.
    Every slice returns every target, NULL outside the source grid.
    """
    weights = settle(weights)
    seen = weights.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.max("iy"), F.max("ix")).first()
    small, on, owners = seen[0] <= BROADCAST_ROWS, list(keys), None
    if not small and on:
        owned, common = _in_common(weights, on)
        fewer = common.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.max("iy"), F.max("ix")).first()
        if fewer[0] <= BROADCAST_ROWS:
            small, weights, seen, owners, on = True, common, fewer, small_side(owned), ["_grid"]
    band = max(1, block_cells // max((seen[2] or 0) + 1, 1))
    blocks = [F.expr(f"iy div {band}")] if small and band <= (seen[1] or 0) else []
    v = F.col(value)
    num = F.sum(F.col("w") * v)
    have = F.sum(F.when(v.isNotNull(), F.col("w")).otherwise(0e0))
    if missing == "strict":
        # The weights of a target add up to 1.
        result = F.when(have >= 1 - 1e-9, num)
    elif missing == "renormalise":
        result = F.when(have >= F.lit(float(min_weight)) - 1e-12, ratio(num, have))
    else:
        raise ValueError(f"missing must be 'renormalise' or 'strict', not {missing!r}")
    at = list(dict.fromkeys([*step, *keys]))
    slices = df.select(*dict.fromkeys([*at, *CELL, value]))
    slices = slices.unionByName(df.select(*at).distinct().select(
        *at, *[F.lit(NOWHERE).alias(c) for c in CELL], F.lit(None).cast(df.schema[value].dataType).alias(value)))
    dealt = slices.repartition(*step, *blocks) if small else slices
    if owners is not None:
        dealt = dealt.join(owners, list(keys))
    joined = dealt.join(F.broadcast(weights) if small else weights, [*on, *CELL])
    return (
        joined
        .groupBy(*step, "ty", "tx")
        .agg(F.min("tlat").alias("lat"), F.min("tlon").alias("lon"), result.alias(value))
        .withColumnsRenamed({"ty": "iy", "tx": "ix"})
    )


def grid_of(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The corner table of a field."""
    return df.groupBy(*keys, *CELL).agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))
