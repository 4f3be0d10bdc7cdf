"""Shared axes of a dataset: time positions, dense cubes, depth layers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from halocline.operators.sizing import need_keys, small_side
from halocline.schema import CELL


#: Parts into which a dataset's cells are dealt where they meet its time axis.
SALTS = 64


def _axis_arrays(df: DataFrame, keys: list[str], counted: Sequence[str] = ()) -> DataFrame:
    """(keys, _axis): the sorted distinct times of each dataset.

    Distinct first, so one task receives a dataset's time axis and never its rows.
    """
    steps = _counted(df, [*keys, "time"], counted) if counted else df.select(*keys, "time").distinct()
    return steps.groupBy(*keys).agg(F.array_sort(F.collect_list("time")).alias("_axis"))


def _counted(df: DataFrame, keys: list[str], values: Sequence[str], *extra: Column) -> DataFrame:
    """Distinct keys that still read ``values``.

    With the same columns in use everywhere, Spark runs the aggregate below once
    and reuses its exchange; pruned differently it would scan the source per use.
    """
    seen = [F.count(v).alias(f"_n{i}") for i, v in enumerate(values)]
    out = df.groupBy(*keys).agg(*extra, *seen)
    for i in range(len(values)):
        out = out.where(F.col(f"_n{i}") >= 0)
    return out.drop(*[f"_n{i}" for i in range(len(values))])


def time_axis(df: DataFrame, dataset: Sequence[str]) -> DataFrame:
    """(dataset keys, time, t_idx, n_time): position of each distinct time."""
    keys = need_keys(dataset)
    arrays = _axis_arrays(df, keys).withColumn("n_time", F.size("_axis"))
    return arrays.select(*keys, "n_time", F.posexplode("_axis").alias("t_idx", "time")).select(
        *keys, "time", "t_idx", "n_time")


def with_time_index(df: DataFrame, dataset: Sequence[str]) -> DataFrame:
    """Add t_idx and n_time: the position on the axis all cells of a dataset share."""
    keys = [*dataset, "time"]
    return df.join(small_side(time_axis(df, dataset)), keys)


def densify(
    df: DataFrame,
    dataset: Sequence[str],
    cell: Sequence[str] = CELL,
    values: Sequence[str] = ("value",),
    coords: Sequence[str] = ("lat", "lon"),
) -> DataFrame:
    """One row for every (cell, time) of each dataset, NULL where nothing was observed.

    ``df`` has at most one row per (dataset, cell, time), none with a NULL key.  The cube is built by
    exploding each dataset's time axis (at most one entry per step) over its cells;
    t_idx and n_time come along.
    """
    keys, at = need_keys(dataset), [*dataset, *cell, "time"]
    # Stated for all three uses, as the join would state it for one of them.
    df = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in at]))
    axis = _axis_arrays(df, keys, values)
    cells = _counted(df, [*keys, *cell], values, *[F.min(c).alias(c) for c in coords])
    # A dataset's cells are spread over SALTS parts, each with its own copy of the axis, so that
    # the largest dataset is not exploded to its cube in one task.
    salted = cells.withColumn("_salt", F.pmod(F.hash(*cell), F.lit(SALTS)))
    copies = axis.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    frame = salted.join(copies, [*keys, "_salt"]).select(
        *keys, *cell, *coords, F.size("_axis").alias("n_time"),
        F.posexplode("_axis").alias("t_idx", "time"))
    return frame.join(df.select(*at, *values), at, "left").select(
        *at, *coords, "t_idx", "n_time", *values
    )


def level_axis(df: DataFrame, dataset: Sequence[str], lev: str = "lev") -> DataFrame:
    """The distinct depths of each dataset with their layer edges.

    Edges lie midway between neighbours; the top edge is 0 and the last layer is
    mirrored about its midpoint.  A single level reaches from 0 to that level.
    """
    keys = need_keys(dataset)
    w = Window.partitionBy(*keys).orderBy(lev)
    z = F.col(lev)
    levels = df.select(*keys, lev).distinct().select(
        *keys, lev, F.lag(lev).over(w).alias("_up"), F.lead(lev).over(w).alias("_down"),
    )
    up_edge = (F.col("_up") + z) / 2e0
    lo = F.coalesce(up_edge, F.lit(0e0))
    hi = (
        F.when(F.col("_down").isNotNull(), (z + F.col("_down")) / 2e0)
        .when(F.col("_up").isNotNull(), z + (z - up_edge))
        .otherwise(z)
    )
    return levels.select(*keys, lev, lo.alias("z_lo"), hi.alias("z_hi"))
