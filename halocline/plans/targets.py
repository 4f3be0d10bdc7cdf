"""Niño3.4 targets and the period each of them covers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from halocline.functions.calendar import month_start, year_month
from halocline.operators import checks, merge, space
from halocline.operators.sizing import settle, small_side
from halocline.schema import CELL, EXCLUDED_MODELS, VAR_ORDER, main_variable

NOT_VALUES = frozenset({
    "path", "var", "time", "raw_time", "step", "n_steps", "t_idx", "n_time", "lev", "lev_idx", *CELL, "lat", "lon",
})


def index_series(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """A ready-made index: (time, nino34), whatever the value column is called.

    It must be a plain series, one value for each time.
    """
    values = [c for c in df.columns if c not in NOT_VALUES]
    col = main_variable(values, "nino34", "target")
    one = df.select(month_start("time").alias("time"), F.col(col).cast("double").alias("nino34"))
    one = checks.time_slice(one.withColumn("_one", F.lit(1)), ["_one"], start, end).drop("_one")
    checks.require_some(one, "the index has no steps")
    checks.require_none(checks.repeated_steps(one, (), ()), "the index is not a plain series")
    return one


def index_of_field(df: DataFrame, dataset: Sequence[str] = (), start: str | None = None,
                   end: str | None = None) -> DataFrame:
    """Index of a surface-temperature field over a window it must cover."""
    keys = list(dataset) or ["_one"]
    tagged = df if dataset else df.withColumn("_one", F.lit(1))
    sliced = checks.time_slice(tagged, keys, start, end)
    out = space.nino34(sliced, keys)
    checks.require_some(out, "no cell inside the index region")
    return out.drop("_one")


def target_periods(
    fields: DataFrame,
    dataset: Sequence[str],
    *,
    start: str | None = None,
    end: str | None = None,
    mode: str = "auto",
    inputs: DataFrame | None = None,
    predictors: Sequence[str] = VAR_ORDER,
    strict: bool = False,
) -> DataFrame:
    """(dataset, start, end, period_source) for every dataset.

    Explicit bounds win; then, as ``mode`` allows, the period of an existing merged
    input ("input", "auto"), the predictors' overlap ("common", "auto"), else the
    field's own.  With ``strict``, mode "input" without an input is an error.
    """
    if mode not in ("auto", "input", "common", "tos"):
        raise ValueError(f"unknown period mode {mode!r}")
    keys = list(dataset)
    every = fields.where(F.col("var") == "tos").select(*keys).distinct()
    none = F.lit(None).cast("string")
    if start is not None or end is not None:
        label = f"explicit:{start or 'auto'}~{end or 'auto'}"
        return every.withColumns({
            "start": F.lit(start) if start else none, "end": F.lit(end) if end else none,
            "period_source": F.lit(label)})

    out = every.withColumns({"start": none, "end": none, "period_source": none})

    def offer(periods: DataFrame) -> DataFrame:
        offered = periods.withColumnsRenamed({"start": "_a", "end": "_b", "period_source": "_s"})
        joined = out.join(offered, keys, "left")
        open_ = F.col("period_source").isNull() & F.col("_s").isNotNull()
        return joined.withColumns({
            "start": F.when(open_, F.col("_a")).otherwise(F.col("start")),
            "end": F.when(open_, F.col("_b")).otherwise(F.col("end")),
            "period_source": F.when(open_, F.col("_s")).otherwise(F.col("period_source")),
        }).drop("_a", "_b", "_s")

    if mode in ("input", "auto") and inputs is not None:
        held = inputs.groupBy(*keys).agg(F.min("time").alias("a"), F.max("time").alias("b"))
        out = offer(held.select(
            *keys, year_month("a").alias("start"), year_month("b").alias("end"),
            F.lit("input").alias("period_source")))
    if strict and mode == "input":
        checks.require_none(out.where(F.col("period_source").isNull()), "no merged input")
    if mode in ("common", "auto"):
        wanted = fields.where(F.col("var").isin(*predictors))
        span = merge.common_period(wanted, keys).where(F.col("start") <= F.col("end"))
        lacking = merge.missing_variables(wanted, keys, predictors)
        label = F.when(F.size("missing") > 0, F.concat(
            F.lit("common_predictor_overlap;missing="), F.array_join("missing", ","))
        ).otherwise(F.lit("common_predictor_overlap"))
        out = offer(span.join(lacking, keys).select(
            *keys, year_month("start").alias("start"), year_month("end").alias("end"),
            label.alias("period_source")))
        if mode == "common":
            checks.require_none(out.where(F.col("period_source").isNull()), "no common predictor period")
    return out.withColumn("period_source", F.coalesce("period_source", F.lit("tos_full_period")))


def cmip6_target_job(
    fields: DataFrame,
    dataset: Sequence[str] = ("exp", "model", "member"),
    *,
    experiments: Sequence[str] | None = None,
    exclude: Sequence[str] = EXCLUDED_MODELS,
    **period_options,
) -> tuple[DataFrame, DataFrame]:
    """(targets with their period source, datasets whose field does not cover the period)."""
    keys = list(dataset)
    kept = fields.where(~F.col("model").isin(*exclude)) if exclude else fields
    if experiments:
        kept = kept.where(F.col("exp").isin(*experiments))
    # Periods and spans need only the steps of each variable: the fields are read once for them.
    steps = settle(kept.select(*keys, "var", "time").distinct())
    periods = small_side(target_periods(steps, keys, **period_options))
    tos = kept.where(F.col("var") == "tos").join(periods, keys)
    month = year_month("time")
    spans = steps.where(F.col("var") == "tos").join(periods, keys).groupBy(*keys, "start", "end").agg(
        F.min(month).alias("first"), F.max(month).alias("last"))
    bad = small_side(spans.where((F.col("first") > F.col("start")) | (F.col("last") < F.col("end"))))
    inside = (
        (F.col("start").isNull() | (month >= F.col("start")))
        & (F.col("end").isNull() | (month <= F.col("end")))
    )
    used = tos.where(inside).join(bad.select(*keys), keys, "left_anti")
    return space.nino34(used, [*keys, "period_source"]), bad
