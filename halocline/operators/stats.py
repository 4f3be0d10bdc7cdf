"""Distribution summaries, colour limits and frame data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from halocline.functions.calendar import day_label
from halocline.operators.merge import sampled_steps
from halocline.operators.sizing import BROADCAST_ROWS, need_keys, settle, small_side

# Rank error of the bracketing sketch is at most 1/accuracy of the group.
ACCURACY = 10_000
SPLITS = 1_024


def exact_quantiles(df: DataFrame, keys: Sequence[str], probs: Sequence[float],
                    value: str = "value", accuracy: int = ACCURACY) -> DataFrame:
    """Exact, linearly interpolated quantiles: (keys, p, quantile).

    The built-in ``percentile`` keeps all distinct values of a group in one task.
    Here a fixed-size sketch first brackets the wanted ranks; one more pass counts
    what lies below and keeps only the bracket, itself cut into slices of which
    only those holding the two ranks are ordered.  The sketch's rank error is
    bounded, so the bracket always holds them and the result is exact.  The ends of
    the range are the least and the greatest value and need no bracket, which with
    heavy tails would be one crowded slice.  ``df`` is read three times (once for the
    ends alone): pass a stored field rather than a long derivation.
    """
    keys = need_keys(keys)
    data = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    slack = 2.0 / accuracy
    asked = [float(p) for p in probs]
    inner = [p for p in asked if 0 < p < 1]
    lows = [max(p - slack, 0.0) for p in inner]
    highs = [min(p + slack, 1.0) for p in inner]

    def sketch(ps: Sequence[float]):
        return F.percentile_approx("_v", ps, accuracy) if ps else F.array().cast("array<double>")

    # A row for each group, read by the ends and by the brackets.
    base = settle(data.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        sketch(lows).alias("_lo"), sketch(highs).alias("_hi")))
    ends = [F.struct(F.lit(p).alias("p"), F.col("_min" if p == 0 else "_max").alias("quantile")) for p in asked if p in (0.0, 1.0)]
    outer = base.select(*keys, F.inline(F.array(*ends))) if ends else None
    if not inner:
        return outer
    # A group smaller than the sketch is bracketed by its own range.
    tiny = F.col("_n") < 4 * accuracy
    brackets = (
        base.select(*keys, "_n", "_min", "_max", F.posexplode(F.arrays_zip("_lo", "_hi")).alias("_i", "_b"))
        .select(
            *keys, "_n",
            F.element_at(F.array(*[F.lit(p) for p in inner]), F.col("_i") + 1).alias("p"),
            F.when(tiny, F.col("_min")).otherwise(F.col("_b._lo")).alias("_lo"),
            F.when(tiny, F.col("_max")).otherwise(F.col("_b._hi")).alias("_hi"),
        )
        .withColumn("_rank", F.col("p") * (F.col("_n") - 1))
        .withColumn("_k", F.floor("_rank"))
    )
    if brackets.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        brackets = F.broadcast(brackets)
    # Two rows per probability at most are emitted for any value, and those above
    # the bracket are dropped at once.
    hits = data.join(brackets, keys).where(F.col("_v") <= F.col("_hi"))
    width = F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0e0))
    part = F.coalesce(F.floor((F.col("_v") - F.col("_lo")) / width * SPLITS), F.lit(0))
    part = F.when(F.col("_v") < F.col("_lo"), F.lit(-1)).otherwise(part)
    group = [*keys, "p"]
    hits = hits.withColumn("_part", part)
    by_group = Window.partitionBy(*group).orderBy("_part")
    counts = (
        hits.groupBy(*group, "_part").agg(F.count("*").alias("_m"), F.min("_k").alias("_k"))
        .withColumn("_before", F.coalesce(
            F.sum("_m").over(by_group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )
    wanted = counts.where(
        (F.col("_before") <= F.col("_k") + 1) & (F.col("_before") + F.col("_m") > F.col("_k"))
    ).select(*group, "_part", "_before")
    in_part = (
        Window.partitionBy(*group, "_part").orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ordered = (
        hits.join(small_side(wanted), [*group, "_part"])
        .groupBy(*group, "_part", "_v")
        .agg(F.count("*").alias("_c"), F.min("_before").alias("_before"),
             F.min("_k").alias("_k"), F.min("_rank").alias("_rank"))
        .withColumn("_upto", F.col("_before") + F.sum("_c").over(in_part))
    )
    first = F.min(F.when(F.col("_upto") > F.col("_k"), F.col("_v")))
    second = F.min(F.when(F.col("_upto") > F.col("_k") + 1, F.col("_v")))
    frac = F.min("_rank") - F.min("_k")
    found = ordered.groupBy(*group).agg(
        (first + frac * (F.coalesce(second, first) - first)).alias("quantile"))
    return found.unionByName(outer) if outer is not None else found


def symmetric_limits(df: DataFrame, keys: Sequence[str], value: str = "value",
                     probs: tuple[float, float] = (0.02, 0.98)) -> DataFrame:
    """(keys, vmin, vmax): plus/minus the larger tail quantile.

    Falls back to the largest magnitude when that is 0, then to 1; a group without
    values gets 1.
    """
    keys = list(keys)
    extent = df.groupBy(*keys).agg(F.max(F.abs(value)).alias("_big"))
    tails = exact_quantiles(df, keys, probs, value).groupBy(*keys).agg(
        F.max(F.abs("quantile")).alias("_tail"))
    limit = F.coalesce(F.nullif("_tail", F.lit(0e0)), F.nullif("_big", F.lit(0e0)), F.lit(1e0))
    return extent.join(tails, keys, "left").select(*keys, (-limit).alias("vmin"), limit.alias("vmax"))


def field_stats(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Mean and population standard deviation of the present values."""
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def zscore(df: DataFrame, keys: Sequence[str], value: str = "value",
           stats: DataFrame | None = None, eps: float = 1e-12) -> DataFrame:
    """Standardise by the group's own statistics, or by those of another period."""
    keys = need_keys(keys)
    stats = field_stats(df, keys, value) if stats is None else stats
    joined = df.join(small_side(stats), keys)
    z = (F.col(value) - F.col("mean")) / F.greatest(F.col("std"), F.lit(eps))
    return joined.withColumn(value, z).drop("mean", "std")


def shared_limit(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One colour limit over several columns: their largest magnitude."""
    biggest = [F.max(F.abs(c)) for c in columns]
    return df.groupBy(*keys).agg(
        (F.greatest(*biggest) if len(biggest) > 1 else biggest[0]).alias("limit"))


def extent(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Corners of a plot."""
    return df.groupBy(*keys).agg(
        F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"),
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
    )


def frames(df: DataFrame, dataset: Sequence[str], every: int = 3, value: str = "value") -> DataFrame:
    """Rows of the sampled frames with their label and colour limits.

    ``df`` is long; limits are per dataset and ``var`` and come from the sampled
    steps only.
    """
    steps = small_side(sampled_steps(df, dataset, every))
    # Read by each pass of the quantiles and once more for output.
    shown = settle(df.drop("t_idx", "n_time").join(steps, [*dataset, "time"]))
    limits = symmetric_limits(shown, [*dataset, "var"], value)
    return (
        shown.join(small_side(limits), [*dataset, "var"])
        .withColumn("label", day_label("time"))
        .withColumnRenamed("t_idx", "frame")
    )
