"""Append newly arrived monthly or daily fields to a store, each file once.

The batch jobs skip outputs that exist; here the stream's checkpoint remembers
which files were taken, so a rerun reads only new ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from halocline.functions.calendar import month_start


def append_arrivals(spark: SparkSession, folder: str, store: str, schema, *, name: str = "arrivals",
                    partition_by: Sequence[str] = ("var",), checkpoint: str | None = None) -> StreamingQuery:
    """Take all files not yet taken from ``folder`` (Parquet) into ``store``, then stop.

    What was taken is remembered beside the store unless ``checkpoint`` names another
    folder, so it outlives the application as the store's own log of batches does.
    """
    memory = checkpoint or f"{store.rstrip('/')}_arrivals"
    arriving = spark.readStream.schema(schema).parquet(folder)
    arriving = arriving.withColumn("time", month_start("time"))
    return (
        arriving.writeStream.format("parquet").option("path", store)
        .option("checkpointLocation", f"{memory.rstrip('/')}/{name}")
        .partitionBy(*partition_by).trigger(availableNow=True).start()
    )
