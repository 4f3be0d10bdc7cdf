"""The merged predictor table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from halocline.operators import checks, merge
from halocline.operators.sizing import settle, small_side
from halocline.schema import CELL, VAR_ORDER


def rejected(df: DataFrame, dataset: Sequence[str], variables: Sequence[str] = VAR_ORDER,
             start: str | None = None, end: str | None = None) -> DataFrame:
    """(dataset, problem) of datasets that cannot be merged.

    A dataset fails alone: a missing variable, no common step, or a window its
    common steps do not cover.
    """
    keys, names = list(dataset), list(dict.fromkeys(variables))
    # All checks need only the steps of each variable: the field is read once for them.
    steps = settle(df.select(*keys, "var", "time").distinct())
    lacking = merge.missing_variables(steps, keys, names).select(*keys, "missing")
    incomplete = F.size("missing") > 0
    # Steps every variable has: what the merge will keep.
    shared = (
        steps.where(F.col("var").isin(*names))
        .groupBy(*keys, "time").agg(F.count("*").alias("_n")).where(F.col("_n") == len(names))
    )
    out = lacking.where(incomplete).select(
        *keys, F.concat(F.lit("missing "), F.array_join("missing", ",")).alias("problem"))
    out = out.unionByName(
        lacking.where(~incomplete).join(shared, keys, "left_anti")
        .select(*keys, F.lit("no common step").alias("problem")))
    if start is not None or end is not None:
        out = out.unionByName(checks.uncovered(shared, keys, start, end).select(*keys, "problem"))
    return out.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("problem")), "; ").alias("problem"))


def predictor_job(
    df: DataFrame,
    dataset: Sequence[str],
    variables: Sequence[str] = VAR_ORDER,
    *,
    fill: str = "none",
    start: str | None = None,
    end: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(merged table, rejected datasets).  ``dataset`` must not contain ``var``."""
    names = list(dict.fromkeys(variables))
    bad = rejected(df, dataset, names, start, end)
    good = df.join(small_side(bad.select(*dataset)), list(dataset), "left_anti") if dataset else df
    return merge.merge_fields(good, dataset, names, fill=fill, start=start, end=end), bad


def reanalysis_job(ocean: DataFrame, atmosphere: DataFrame, variables: Sequence[str] = VAR_ORDER, *,
                   fill: str = "none", start: str | None = None, end: str | None = None) -> DataFrame:
    """Ocean and atmosphere of one evaluation period; the window must be covered."""
    both = merge.union_in_time(*[
        d.select("var", "time", *CELL, "lat", "lon", "value") for d in (ocean, atmosphere)])
    tagged = both.withColumn("period", F.lit("reanalysis"))
    checks.require_none(
        rejected(tagged, ["period"], variables, start, end).select("problem"), "cannot merge")
    return merge.merge_fields(both, (), variables, fill=fill, start=start, end=end)
