"""The extended validation and test splits from stored monthly fields, with verification."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from halocline.operators import checks, merge
from halocline.operators.sizing import settle
from halocline.plans.anomalies import anomaly_job
from halocline.plans.predictors import reanalysis_job
from halocline.plans.targets import index_of_field, index_series
from halocline.schema import VAR_ORDER, TargetGrid
from halocline.sources.store import read_field, write_field


@dataclass(frozen=True)
class Split:
    """An inclusive month window and the number of months it must hold."""

    name: str
    start: str
    end: str
    months: int


# Fixed windows of the extended splits.
VALIDATION = Split("validation", "1958-01", "1988-12", 372)
TEST = Split("test", "1990-01", "2025-12", 432)


def verify(df: DataFrame, split: Split, columns: Sequence[str]) -> None:
    """Columns, first month, last month and month count, or CheckFailed."""
    checks.require_columns(df, columns)
    tagged = df.withColumn("split", F.lit(split.name))
    checks.require_none(
        checks.wrong_period(tagged, ["split"], split.start, split.end, split.months),
        f"{split.name} has the wrong period")


def extend_raw(held: DataFrame, added: DataFrame) -> DataFrame:
    """Existing and new months as one series; a month in both is an error."""
    both = merge.union_in_time(held, added).drop("t_idx", "n_time")
    checks.require_none(checks.repeated_steps(both, ["var"]), "periods overlap")
    return both


def build_splits(
    spark: SparkSession,
    out_root: str,
    ocean_held: DataFrame,
    ocean_added: DataFrame,
    validation_atmosphere: DataFrame,
    test_ocean: DataFrame,
    test_atmosphere: DataFrame,
    test_index: DataFrame,
    *,
    variables: Sequence[str] = VAR_ORDER,
    target: TargetGrid = TargetGrid(),
    validation: Split = VALIDATION,
    test: Split = TEST,
    overwrite: bool = False,
    check: bool = True,
) -> dict[str, str]:
    """Write inputs and targets of both splits; returns their paths.

    The ocean fields are raw (the validation ones in two periods); the atmosphere
    and test-ocean fields are anomalies on the target grid.
    """
    paths = {k: f"{out_root.rstrip('/')}/{k}" for k in (
        "ocean_anomaly", "validation_input", "validation_target", "test_input", "test_target")}
    # Checked first and used several times: each field is computed once.
    raw = extend_raw(settle(ocean_held), settle(ocean_added))
    fields = (validation_atmosphere, test_ocean, test_atmosphere, test_index)
    once = {k: settle(df) for k, df in {id(df): df for df in fields}.items()}
    validation_atmosphere, test_ocean, test_atmosphere, test_index = (once[id(df)] for df in fields)
    write_field(anomaly_job(raw, ["var"], target), paths["ocean_anomaly"],
                overwrite=overwrite)
    ocean = read_field(spark, paths["ocean_anomaly"])

    for split, sea, air in (
        (validation, ocean, validation_atmosphere), (test, test_ocean, test_atmosphere),
    ):
        merged = reanalysis_job(sea, air, variables, start=split.start, end=split.end)
        write_field(merged, paths[f"{split.name}_input"], (), overwrite=overwrite, values=variables)
    write_field(
        index_of_field(ocean.where(F.col("var") == "tos"), (), validation.start, validation.end),
        paths["validation_target"], (), overwrite=overwrite, values=("nino34",))
    write_field(index_series(test_index, test.start, test.end), paths["test_target"], (),
                overwrite=overwrite, values=("nino34",))
    if check:
        for split in (validation, test):
            verify(spark.read.parquet(paths[f"{split.name}_input"]), split, variables)
            verify(spark.read.parquet(paths[f"{split.name}_target"]), split, ("nino34",))
    return paths
