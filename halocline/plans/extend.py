"""A field that grows by periods: its trend and climatology are kept as sums beside it.

    root/sums/period=<name>     sums of the period's months (operators.running)
    root/axis/period=<name>     its steps with their positions

The axis is written last, so a period whose writing broke off does not count, and writing it again
replaces what was left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from halocline.operators import running
from halocline.operators.checks import require_none
from halocline.schema import CELL
from halocline.sources.store import exists


def _kept(spark: SparkSession, root: str, part: str) -> DataFrame:
    return spark.read.option("basePath", f"{root.rstrip('/')}/{part}").parquet(f"{root.rstrip('/')}/{part}")


def kept_axis(spark: SparkSession, root: str) -> DataFrame | None:
    """(period, dataset, time, t_idx) of every step that is kept; None before the first period."""
    return _kept(spark, root, "axis") if exists(spark, f"{root.rstrip('/')}/axis") else None


def append_period(df: DataFrame, root: str, period: str, dataset: Sequence[str], value: str = "value",
                  cell: Sequence[str] = CELL) -> None:
    """Add the months of ``df`` (not densified: present rows suffice) to the sums under ``root``.

    A period must begin after the last step kept for its datasets; a period of the same name is replaced if
    it was the last.  Only ``df`` and the kept axis are read.
    """
    spark, keys = df.sparkSession, list(dataset)
    before = kept_axis(spark, root)
    steps = df.select(*keys, "time").distinct()
    arrays = steps.groupBy(*keys).agg(F.array_sort(F.collect_list("time")).alias("_axis"))
    if before is not None:
        held = before.where(F.col("period") != period).groupBy(*keys).agg(F.count("*").alias("_n"), F.max("time").alias("_last"))
        arrays = arrays.join(F.broadcast(held), keys, "left")
        require_none(arrays.where(F.col("_axis")[0] <= F.col("_last")).select(*keys, "_last"), f"{period} does not follow what is kept")
    else:
        arrays = arrays.withColumn("_n", F.lit(0))
    axis = arrays.select(*keys, F.coalesce("_n", F.lit(0)).alias("_n"), F.posexplode("_axis").alias("_k", "time")).select(
        *keys, "time", (F.col("_n") + F.col("_k")).cast("int").alias("t_idx"))
    indexed = df.drop("t_idx", "n_time").join(F.broadcast(axis), [*keys, "time"])
    base = root.rstrip("/")
    running.period_sums(indexed, keys, value, cell).write.mode("overwrite").parquet(f"{base}/sums/period={period}")
    axis.coalesce(1).write.mode("overwrite").parquet(f"{base}/axis/period={period}")


def kept_fit(spark: SparkSession, root: str, dataset: Sequence[str], cell: Sequence[str] = CELL) -> DataFrame:
    """Trend and climatology over all periods kept, from their sums alone."""
    axis = kept_axis(spark, root)
    if axis is None:
        raise FileNotFoundError(root)
    whole = _kept(spark, root, "sums").join(F.broadcast(axis.select("period").distinct()), "period", "left_semi")
    lengths = axis.groupBy(*dataset).agg(F.count("*").alias("n_time"))
    return running.fitted(running.merged_sums(whole, dataset, cell), lengths, dataset, cell)


def anomalies_since(df: DataFrame, root: str, dataset: Sequence[str], value: str = "value", cell: Sequence[str] = CELL) -> DataFrame:
    """Anomalies of the months in ``df``, all of which must be kept, against the trend and climatology of every kept period."""
    spark = df.sparkSession
    axis = kept_axis(spark, root)
    fit = kept_fit(spark, root, dataset, cell)
    indexed = df.drop("t_idx", "n_time").join(F.broadcast(axis.drop("period")), [*dataset, "time"])
    return running.anomalies(indexed, fit, dataset, value, cell)
