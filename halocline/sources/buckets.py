"""Fields stored by cell: bucketed, so that per-cell windows and aggregates need no exchange.

Rows of a cell lie in one bucket file, found by a hash of (dataset, cell).  Detrending, climatology,
running sums and searches down a column of water then read their rows where they are.  The bucket
layout stands beside the field, and reading registers it with the session's catalog.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from halocline.functions.calendar import within_months
from halocline.schema import CELL, carry_attrs

SPEC = "columns array<string>, buckets int"


def _table(path: str) -> str:
    return "field_" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:16]


def write_bucketed(df: DataFrame, path: str, dataset: Sequence[str], *, cell: Sequence[str] = CELL, buckets: int | None = None,
                   values: Sequence[str] = ("value",)) -> None:
    """Store a field by cell, in ``buckets`` files (the session's shuffle partitions unless given), in single precision.

    One exchange, by the hash that reading relies on, so a task writes one file.  Where t_idx and n_time are columns they are
    kept, and later detrending need not look for the time axis.  An existing field is replaced.
    """
    spark = df.sparkSession
    columns = [*dataset, *cell]
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = carry_attrs(df.withColumns({v: F.col(v).cast("float") for v in values if v in df.columns}), df)
    spark.sql(f"DROP TABLE IF EXISTS {_table(path)}")
    (out.repartition(n, *columns).write.format("parquet").option("compression", "zstd").mode("overwrite")
     .bucketBy(n, *columns).sortBy(*columns).option("path", path).saveAsTable(_table(path)))
    spark.createDataFrame([(columns, n)], SPEC).write.mode("overwrite").parquet(f"{path.rstrip('/')}_buckets")


def read_bucketed(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
                  values: Sequence[str] = ("value",)) -> DataFrame:
    """A bucketed field with double-precision values, cut to a month window at the scan."""
    name = _table(path)
    if not spark.catalog.tableExists(name):
        spec = spark.read.schema(SPEC).parquet(f"{path.rstrip('/')}_buckets").first()
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        by = ", ".join(f"`{c}`" for c in spec["columns"])
        place = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                  f"INTO {spec['buckets']} BUCKETS LOCATION '{place}'")
    df = spark.table(name)
    if "time" in df.columns:
        df = df.where(within_months("time", start, end))
    return carry_attrs(df.withColumns({v: F.col(v).cast("double") for v in values if v in df.columns}), df)
