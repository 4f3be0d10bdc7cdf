"""Parquet storage of fields, with the attributes and history that go along."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from halocline.functions.calendar import within_months
from halocline.schema import canonical_coords, carry_attrs

ATTR_SCHEMA = "var string, key string, value string"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished dataset is there, on any file system Spark knows."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def write_field(df: DataFrame, path: str, partition_by: Sequence[str] = ("var",), *,
                overwrite: bool = False, values: Sequence[str] = ("value",)) -> bool:
    """Store values in single precision, once: an existing dataset is kept unless ``overwrite``.

    Rows are rebalanced by partition: a variable holding most rows is split over
    many tasks and small ones share a task, by their sizes at run time.  Spark's
    commit makes the result appear whole.  Returns whether anything was written.
    """
    spark = df.sparkSession
    if not overwrite and exists(spark, path):
        return False
    out = carry_attrs(df.withColumns({v: F.col(v).cast("float") for v in values if v in df.columns}), df)
    keys = [k for k in partition_by if k in out.columns]
    out = out.hint("rebalance", *keys) if keys else out.hint("rebalance")
    writer = out.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*keys) if keys else writer).parquet(path)
    return True


def read_field(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
               values: Sequence[str] = ("value",)) -> DataFrame:
    """Stored field with double-precision values, cut to a month window at the scan.

    Coordinates go by time, lat and lon, however the store spells them; attributes come along as column metadata.
    """
    df = canonical_coords(spark.read.parquet(path))
    if "time" in df.columns:
        df = df.where(within_months("time", start, end))
    return carry_attrs(df.withColumns({v: F.col(v).cast("double") for v in values if v in df.columns}), df)


def write_attrs(spark: SparkSession, path: str, attrs: Mapping[str, Mapping[str, str]]) -> None:
    """Sidecar (var, key, value) next to a dataset."""
    rows = [(var, k, str(v)) for var, items in attrs.items() for k, v in items.items()]
    spark.createDataFrame(rows, ATTR_SCHEMA).write.mode("overwrite").parquet(f"{path.rstrip('/')}_attrs")


def read_attrs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}_attrs")


def append_history(spark: SparkSession, path: str, message: str) -> None:
    """One more dated line; the newest reads first (see ``read_history``)."""
    stamp = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    line = spark.createDataFrame([(stamp, message)], "at string, message string")
    line.write.mode("append").parquet(f"{path.rstrip('/')}_history")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    h = spark.read.parquet(f"{path.rstrip('/')}_history")
    return h.orderBy(F.desc("at")).select(F.concat_ws(": ", "at", "message").alias("history"))
