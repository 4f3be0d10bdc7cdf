"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "halocline", **conf: str) -> SparkSession:
    """A session with adaptive execution on and a UTC clock.

    On a cluster ``master`` stays None and the submit-time settings win.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """The checkpoint folder in force.

    The one the cluster names wins; a machine-local folder is made only for a
    local master.  None on a cluster that names no folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return current
    if not named:
        if not context.master.startswith("local"):
            return None
        named = tempfile.mkdtemp(prefix="halocline-ckpt-")
    context.setCheckpointDir(named)
    return named
