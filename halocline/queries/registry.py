"""One query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from halocline.functions import calendar as cal, names as N, numeric as num, position as pos
from halocline.functions.seawater import with_linear_sigma
from halocline.operators import axis, checks, merge, regrid, running, series, space, stats, vertical
from halocline.operators.sizing import settle
from halocline.queries import adapters as A
from halocline.queries.adapters import AT, COARSE, MEMBER
from halocline.plans import anomalies, columns, ingest, predictors, splits, targets
from halocline.schema import VAR_ORDER, clean_missing
from halocline.session import ensure_checkpoint_dir
from halocline.sources import catalog, configs, downloads, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
THREE = ("tos", "sos", "psl")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r(c: Column | str, digits: int = 4) -> Column:
    """Rounded for comparison.

    The two engines break exact ties differently, so values are first moved by 3%
    of a step; adding 0 turns -0.0 into 0.0.
    """
    value = F.col(c) if isinstance(c, str) else c
    return F.round(value + F.lit(float(f"0.0314159e-{digits}")), digits) + F.lit(0e0)


def rounded(df: DataFrame, *cols: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in cols})


# ---- area means and bands --------------------------------------------------
@query
def nino34_index(spark, sf):
    return rounded(space.nino34(A.line_cube(spark, sf), MEMBER), "nino34")


@query
def nino34_window(spark, sf):
    return rounded(
        space.nino34(A.line_cube(spark, sf), MEMBER, start="1996-03", end="2000-02"), "nino34")


@query
def nino34_of_anomaly(spark, sf):
    return rounded(space.nino34(series.anomaly(A.line_cube(spark, sf), MEMBER), MEMBER), "nino34", digits=3)


def _band(spark, sf):
    cube = A.line_cube(spark, sf).withColumn("lon", pos.lon_360(F.col("lon")))
    return space.hovmoller(cube, MEMBER, lat=(-25.0, 25.0), lon=(190.0, 300.0))


@query
def hovmoller(spark, sf):
    return rounded(_band(spark, sf), "value")


@query
def calendar_month_max(spark, sf):
    return rounded(series.by_calendar_month(_band(spark, sf), ["member", "lon"], "max"), "value")


@query
def calendar_month_mean(spark, sf):
    return rounded(series.by_calendar_month(_band(spark, sf), ["member", "lon"], "mean"), "value")


@query
def shared_colour_limit(spark, sf):
    band = _band(spark, sf)
    top = series.by_calendar_month(band, ["member", "lon"], "max")
    both = band.select("member", F.col("value").alias("raw"), F.lit(None).cast("double").alias("top"))
    both = both.unionByName(top.select("member", F.lit(None).cast("double").alias("raw"), F.col("value").alias("top")))
    return rounded(stats.shared_limit(both, MEMBER, ["raw", "top"]), "limit")


@query
def contour_levels(spark, sf):
    limits = stats.shared_limit(_band(spark, sf), MEMBER, ["value"])
    out = limits.select("member", F.posexplode(num.level_spacing(F.col("limit"))).alias("step", "level"))
    return rounded(out, "level")


# ---- series ----------------------------------------------------------------
@query
def monthly_max(spark, sf):
    return rounded(series.monthly(A.daily_wind(spark, sf), MEMBER, "max"), "value", digits=6)


@query
def climatology(spark, sf):
    return rounded(series.climatology(A.line_cube(spark, sf), MEMBER), "climatology")


@query
def monthly_anomaly(spark, sf):
    return rounded(series.month_anomaly(A.line_cube(spark, sf), MEMBER), "value")


@query
def quadratic_detrend(spark, sf):
    return rounded(series.quadratic_detrend(A.line_cube(spark, sf), MEMBER), "value", digits=3)


@query
def detrend_sparse_cells(spark, sf):
    """Not dense: positions come from the axis shared by all cells."""
    return rounded(series.quadratic_detrend(A.order_obs(spark, sf), MEMBER), "value", digits=3)


@query
def anomaly_full(spark, sf):
    return rounded(series.anomaly(A.line_cube(spark, sf), MEMBER), "value", digits=3)


@query
def anomaly_after_append(spark, sf):
    """The first four years, then the rest, summed apart; the whole field against the trend and climatology of both."""
    cube = A.line_cube(spark, sf)
    first = F.col("time") < F.lit("1996-01-01").cast("timestamp_ntz")
    parts = [running.period_sums(cube.where(part), MEMBER) for part in (first, ~first)]
    sums = running.merged_sums(parts[0].unionByName(parts[1]), MEMBER)
    lengths = cube.groupBy(*MEMBER).agg(F.max("n_time").alias("n_time"))
    out = running.anomalies(cube, running.fitted(sums, lengths, MEMBER), MEMBER)
    return rounded(out, "value", digits=3)


@query
def monmax_anomaly(spark, sf):
    top = axis.densify(series.monthly(A.daily_wind(spark, sf), MEMBER, "max"), MEMBER)
    return rounded(series.anomaly(top, MEMBER), "value")


@query
def time_index(spark, sf):
    return axis.time_axis(A.order_obs(spark, sf), MEMBER)


# ---- vertical --------------------------------------------------------------
@query
def surface_level_sorted(spark, sf):
    top = vertical.surface_level(A.profile(spark, sf), MEMBER, "temp", depths=A.depth_table(spark, sf))
    return rounded(top, "temp", digits=6)


@query
def surface_level_first(spark, sf):
    top = vertical.first_level(A.profile(spark, sf)).select(*AT, "lat", "lon", "lev", "salt")
    return rounded(top, "salt", digits=6)


@query
def depth_bounds(spark, sf):
    return axis.level_axis(A.depth_table(spark, sf), MEMBER)


@query
def layer_overlap(spark, sf):
    return vertical.layer_thickness(A.depth_table(spark, sf), MEMBER, zmax=300.0)


@query
def heat_content(spark, sf):
    out = vertical.heat_content(
        A.profile(spark, sf), MEMBER, "temp", depths=A.depth_table(spark, sf))
    return out.withColumn("ohc", r(F.col("ohc") / 1e6, 3))


@query
def heat_content_masked(spark, sf):
    out = vertical.heat_content(A.profile(spark, sf), MEMBER, "temp", zmax=100.0, mask_shallow=True)
    return out.withColumn("ohc", r(F.col("ohc") / 1e6, 3))


@query
def mixed_layer_linear(spark, sf):
    out = vertical.mixed_layer_depth(A.profile(spark, sf), MEMBER, density=with_linear_sigma)
    return rounded(out, "mld")


@query
def mixed_layer_teos10(spark, sf):
    return rounded(vertical.mixed_layer_depth(A.profile(spark, sf), MEMBER), "mld")


# ---- merge, union, sets ----------------------------------------------------
@query
def merge_inner(spark, sf):
    return rounded(merge.merge_fields(A.fields(spark, sf), MEMBER, THREE), *THREE)


@query
def merge_fill_ocean(spark, sf):
    return rounded(merge.merge_fields(A.fields(spark, sf), MEMBER, THREE, fill="ocean"), *THREE)


@query
def merge_fill_all(spark, sf):
    return rounded(merge.merge_fields(A.fields(spark, sf), MEMBER, THREE, fill="all"), *THREE)


@query
def merge_window(spark, sf):
    out = merge.merge_fields(A.fields(spark, sf), MEMBER, THREE, start="1996-01", end="1998-12")
    return rounded(out, *THREE)


@query
def field_difference(spark, sf):
    wind = A.daily_wind(spark, sf)
    pair = A.field(series.monthly(wind, MEMBER, "max"), "uasmax").unionByName(
        A.field(series.monthly(wind, MEMBER, "mean"), "uas"))
    wide = merge.merge_fields(pair, MEMBER, ("uas", "uasmax"))
    return rounded(merge.field_difference(wide, "uasmax", "uas"), "uas", "uasmax", "difference")


@query
def exact_align_check(spark, sf):
    return merge.unmatched_keys(A.line_obs(spark, sf), A.order_obs(spark, sf), AT)


def _grids(spark, sf):
    left = regrid.grid_of(A.line_obs(spark, sf), MEMBER)
    right = A.located(A.on_cells(A.table(spark, sf, "supplier"), "s_suppkey")).withColumn(
        "lat", F.col("lat") + F.when(F.col("s_acctbal") > 8000, 0.5e0).otherwise(1e-9))
    return left, right


@query
def grid_check(spark, sf):
    return merge.grid_mismatch(*_grids(spark, sf), MEMBER)


@query
def harmonised_coords(spark, sf):
    left, right = _grids(spark, sf)
    return merge.harmonise_coords(
        right.select("member", "iy", "ix", "lat", "lon", "s_acctbal"), left, MEMBER)


@query
def union_time(spark, sf):
    obs = A.line_obs(spark, sf)
    early = obs.where(cal.within_months("time", None, "1998-12"))
    late = obs.where(cal.within_months("time", "1999-01", None))
    return rounded(merge.union_in_time(early, late), "value")


@query
def union_incremental(spark, sf):
    """Overlapping periods: both copies of a repeated step stay."""
    obs = A.line_obs(spark, sf)
    held = obs.where(cal.within_months("time", None, "1999-06"))
    added = obs.where(cal.within_months("time", "1999-01", None))
    return rounded(merge.union_in_time(held, added, ordered=True), "value")


@query
def monotone_check(spark, sf):
    obs = A.order_obs(spark, sf)
    held = obs.where(cal.within_months("time", None, "1999-06"))
    added = obs.where(cal.within_months("time", "1999-01", None))
    return checks.repeated_steps(merge.union_in_time(held, added), MEMBER)


@query
def time_intersection(spark, sf):
    return merge.common_steps(A.line_obs(spark, sf), A.order_obs(spark, sf), MEMBER)


@query
def common_period(spark, sf):
    return merge.common_period(A.fields(spark, sf), MEMBER)


@query
def coverage_check(spark, sf):
    return checks.uncovered(A.order_obs(spark, sf), ["member", "iy", "ix"], "1995-02", "2001-07")


@query
def verify_periods(spark, sf):
    return checks.wrong_period(
        A.line_obs(spark, sf), ["member", "iy", "ix"], "1995-01", "2001-11", 83)


@query
def completeness(spark, sf):
    obs = A.order_obs(spark, sf).withColumn("year", F.year("time"))
    return checks.incomplete(obs, ["member", "iy", "ix", "year"])


@query
def time_bounds(spark, sf):
    return checks.time_bounds(A.fields(spark, sf), ["var", "member"])


# ---- regrid and seams ------------------------------------------------------
def _weights(cells):
    return regrid.bilinear_weights(regrid.grid_of(cells, MEMBER), COARSE, MEMBER)


@query
def regrid_weights(spark, sf):
    return rounded(_weights(A.line_cells(spark, sf)).where("w > 0"), "w", digits=9)


def _regridded_orders(spark, sf, **options):
    out = regrid.apply_weights(
        A.order_cube(spark, sf), _weights(A.order_cells(spark, sf)), ["member", "time"], keys=MEMBER, **options)
    return rounded(out, "value", digits=3)


@query
def regrid_bilinear(spark, sf):
    return _regridded_orders(spark, sf)


@query
def regrid_strict(spark, sf):
    return _regridded_orders(spark, sf, missing="strict")


@query
def anomaly_regridded(spark, sf):
    """Anomalies on the source grid first, then the target grid."""
    out = regrid.apply_weights(
        series.anomaly(A.line_cube(spark, sf), MEMBER), _weights(A.line_cells(spark, sf)),
        ["member", "time"], keys=MEMBER)
    return rounded(out, "value", digits=3)


def _many_grids(spark, sf, **options):
    cube = A.model_cube(spark, sf)
    weights = regrid.bilinear_weights(regrid.grid_of(cube, ["model"]), A.ROUND, ["model"])
    return rounded(regrid.apply_weights(cube, weights, ["model", "time"], keys=["model"], **options), "value", digits=3)


@query
def regrid_many_grids(spark, sf):
    """Three widths in one collection; one grid does not go round."""
    return _many_grids(spark, sf)


@query
def regrid_full_target(spark, sf):
    """Every target of every slice, with or without a value."""
    return _many_grids(spark, sf, missing="strict").groupBy("model", "iy", "ix", "lat", "lon").agg(
        F.count("*").alias("steps"), F.count("value").alias("present"))


@query
def anomaly_job(spark, sf):
    out = anomalies.anomaly_job(A.field(A.line_cube(spark, sf), "tos"), ["member", "var"], COARSE, grid_keys=["member", "var"])
    return rounded(out, "value", digits=3)


@query
def wind_maximum_job(spark, sf):
    daily = A.field(A.daily_wind(spark, sf), "uas")
    out = anomalies.wind_maximum_job(daily, ["member", "var"], COARSE, grid_keys=["member", "var"])
    return rounded(out, "value", digits=3)


def _seamed(spark, sf):
    grid = A.on_cells(A.table(spark, sf, "supplier"), "s_suppkey")
    lon = F.pmod(F.col("ix") * 20e0 + F.col("iy") * 7e0 + 250e0 + F.col("s_acctbal") / 10000e0, F.lit(360e0))
    return grid.select("member", "iy", "ix", F.when(lon > 180, lon - 360e0).otherwise(lon).alias("lon"))


@query
def lon_unwrap(spark, sf):
    return rounded(space.unwrap_longitude(_seamed(spark, sf), MEMBER), "lon", digits=6)


@query
def wrap_count(spark, sf):
    return space.wrap_scores(_seamed(spark, sf), MEMBER)


# ---- statistics and frames -------------------------------------------------
@query
def field_quantiles(spark, sf):
    """A coarse sketch, so that bracketing is at work on the small tables too."""
    out = stats.exact_quantiles(
        A.lines(spark, sf), ["l_returnflag"], (0.0, 0.02, 0.5, 0.98, 1.0), "l_extendedprice", accuracy=1000)
    return rounded(out, "quantile")


@query
def symmetric_limits(spark, sf):
    cube = settle(series.anomaly(A.line_cube(spark, sf), MEMBER).select("member", "value"))
    return rounded(stats.symmetric_limits(cube, MEMBER), "vmin", "vmax", digits=3)


@query
def frame_sampling(spark, sf):
    return merge.sampled_steps(A.line_obs(spark, sf), MEMBER, 5)


@query
def frame_rows(spark, sf):
    shown = stats.frames(A.fields(spark, sf), MEMBER, every=7)
    return rounded(shown, "value", "vmin", "vmax")


@query
def plot_extent(spark, sf):
    return stats.extent(A.line_obs(spark, sf), MEMBER)


@query
def field_stats(spark, sf):
    return rounded(stats.field_stats(A.line_cube(spark, sf), MEMBER), "mean", "std", digits=3)


@query
def zscore(spark, sf):
    return rounded(stats.zscore(A.line_cube(spark, sf), MEMBER), "value", digits=6)


# ---- files and configurations ----------------------------------------------
@query
def var_from_name(spark, sf):
    name = F.col("name")
    known, any_var = N.variable_of(name), N.variable_of(name, None)
    return A.files(spark, sf).select(
        "path", "name", F.coalesce(known, F.lit("-")).alias("known"),
        F.coalesce(any_var, F.lit("-")).alias("leading"),
        N.stem_variable(name).alias("stem"), N.is_anomaly(name).alias("anomaly"))


@query
def file_preference(spark, sf):
    return catalog.preferred_files(A.files(spark, sf), ["model"])


@query
def file_preference_raw(spark, sf):
    return catalog.preferred_files(A.files(spark, sf), ["model"], None, allow_raw=True)


@query
def var_set_difference(spark, sf):
    have = A.files(spark, sf).select("model", "member", F.col("kind").alias("var"))
    out = merge.missing_variables(have, ["model", "member"])
    return out.select("model", "member", F.array_join("missing", ",").alias("missing"))


def _scenario_files(spark, sf):
    return A.files(spark, sf).select(
        "model", "member", "exp", F.col("kind").alias("var"),
        F.concat(F.concat_ws("_", "kind", F.lit("Omon"), "model", "exp", "member"),
                 F.lit("_gn_time.nc")).alias("name"))


@query
def scenario_pairs(spark, sf):
    pairs = catalog.scenario_pairs(_scenario_files(spark, sf), exclude=("MODEL7",))
    return pairs.withColumns({c: F.coalesce(c, F.lit("-")) for c in ("historical", "ssp370", "out_name")})


@query
def scenario_counts(spark, sf):
    return catalog.status_counts(catalog.scenario_pairs(_scenario_files(spark, sf), exclude=("MODEL7",)))


@query
def daily_name_parts(spark, sf):
    listed = A.files(spark, sf)
    name = F.concat(F.concat_ws("_", F.lit("uas_day"), "model", "exp", "member"),
                    F.when(F.col("o_orderpriority") == "5-LOW", ".nc").otherwise("_gr1_time.nc"))
    folder = F.when(F.col("kind") == "tos", "r9i1p1f1").otherwise(F.col("member"))
    parts = N.daily_parts(name, F.col("model"), folder)
    out = listed.select("path", parts.alias("p")).select("path", "p.*")
    return out.withColumns({c: F.coalesce(c, F.lit("-")) for c in ("exp", "member", "grid", "problem")})


@query
def period_files(spark, sf):
    return catalog.period_files(A.files(spark, sf), 1996, 1998).select("path", "name", "o_orderdate")


@query
def time_tags(spark, sf):
    span = A.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    a, b = F.col("a"), F.col("b")
    return span.select(
        "o_custkey", cal.span_label(a, b).alias("span"), cal.year_month(a).alias("first_month"),
        cal.day_label(b).alias("last_day"), cal.days_in_month(b).alias("days"),
        cal.month_start(b).alias("month"))


@query
def config_overview(spark, sf):
    return configs.overview_rows(configs.parse_configs(A.config_texts(spark, sf)))


# ---- scalars ---------------------------------------------------------------
@query
def lon_normalise(spark, sf):
    lon = F.col("c_acctbal") / 25e0
    return A.table(spark, sf, "customer").select(
        "c_custkey", r(pos.lon_360(lon), 6).alias("lon_360"), r(pos.lon_modulo(lon), 6).alias("lon_mod"),
        r(pos.area_weight(lon / 5e0), 9).alias("weight"))


@query
def unit_conversions(spark, sf):
    units = F.element_at(
        F.array(*[F.lit(u) for u in ("K", " degrees  Kelvin ", "degC", "kg  kg**-1", "cm")]),
        F.expr("p_size % 5 + 1"))
    v = F.col("p_retailprice")
    return A.table(spark, sf, "part").withColumn("units", units).select(
        "p_partkey", num.normal_units(F.col("units")).alias("units"),
        r(num.celsius(v, F.col("units"))).alias("celsius"),
        r(num.celsius(v, F.col("units"), loose=False)).alias("celsius_strict"),
        r(num.salinity_g_per_kg(v, F.col("units"))).alias("salinity"),
        r(num.depth_metres(v, F.col("units"))).alias("metres"))


@query
def missing_values(spark, sf):
    v = (
        F.when(F.expr("p_size % 10 = 0"), F.lit(float("nan")))
        .when(F.expr("p_size % 10 = 1"), F.lit(1e20)).otherwise(F.col("p_retailprice"))
    )
    clean = clean_missing(A.table(spark, sf, "part").withColumn("value", v), "value")
    return clean.groupBy("p_brand").agg(
        F.count("*").alias("n_rows"), F.count("value").alias("n_values"),
        r(F.max("value")).alias("top"))


# ---- whole jobs ------------------------------------------------------------
CELL_KEYS = ["member", "iy", "ix"]


def _cell_series(spark, sf):
    """Every cell as a dataset of its own: tos from lines, psl from orders, only where observed."""
    return A.field(A.line_obs(spark, sf), "tos").unionByName(A.field(A.order_obs(spark, sf), "psl"))


@query
def predictor_rejections(spark, sf):
    return predictors.rejected(
        _cell_series(spark, sf), CELL_KEYS, ("tos", "psl"), "1995-02", "2001-06")


@query
def predictor_table(spark, sf):
    """The merged table of every member that covers the window, and a row for each one that does not."""
    table, bad = predictors.predictor_job(A.fields(spark, sf), MEMBER, THREE, fill="ocean", start="1995-03", end="2001-06")
    merged = rounded(table, *THREE).withColumn("problem", F.lit(None).cast("string"))
    return merged.unionByName(bad, allowMissingColumns=True)


@query
def split_periods(spark, sf):
    """Both extended splits, written and verified by the job: a row for each month and cell, with its target."""
    def cube(rows, amount, var):
        obs = A.located(rows.withColumn("member", F.lit(0)).groupBy("member", "iy", "ix", cal.month_start("time").alias("time")).agg(
            A.exact_mean(F.col(amount)).alias("value")))
        return A.field(axis.densify(obs, MEMBER), var).drop("member")

    rows, orders = A.lines(spark, sf), A.order_rows(spark, sf).withColumn("time", A.later("o_orderdate"))
    sea = cube(rows, "l_extendedprice", "tos").unionByName(cube(rows, "l_quantity", "sos"))
    air = anomalies.anomaly_job(cube(orders, "o_totalprice", "psl"), ["var"], COARSE)
    index = orders.groupBy(cal.month_start("time").alias("time")).agg(A.exact_mean(F.col("o_totalprice")).alias("nino34"))
    early = F.col("time") < F.lit("1997-01-01").cast("timestamp_ntz")
    paths = splits.build_splits(
        spark, f"{ensure_checkpoint_dir(spark)}/splits-{uuid.uuid4().hex[:12]}", sea.where(early), sea.where(~early), air,
        anomalies.anomaly_job(sea, ["var"], COARSE), air, index, variables=THREE, target=COARSE,
        validation=splits.Split("validation", "1995-06", "1997-12", 31), test=splits.Split("test", "1998-01", "2000-12", 36))
    parts = [
        store.read_field(spark, paths[f"{name}_input"], values=THREE).join(
            store.read_field(spark, paths[f"{name}_target"], values=("nino34",)).select("time", "nino34"), "time")
        .withColumn("split", F.lit(name)) for name in ("validation", "test")]
    out = parts[0].unionByName(parts[1]).select("split", "time", "iy", "ix", "lat", "lon", *THREE, "nino34")
    return rounded(out, *THREE, "nino34", digits=1)


@query
def target_periods(spark, sf):
    # inputs of some rows of cells belong to another dataset
    held = A.order_obs(spark, sf).withColumn("member", F.when(F.col("iy") % 3 == 1, -1).otherwise(F.col("member")))
    return targets.target_periods(
        _cell_series(spark, sf), CELL_KEYS, inputs=held, predictors=("tos", "psl", "uas"))


@query
def member_targets(spark, sf):
    """Index of every member but one over the period its variables share."""
    fields = A.fields(spark, sf).withColumn("model", F.concat(F.lit("M"), "member"))
    index, _ = targets.cmip6_target_job(
        fields, ["model"], exclude=("M1",), mode="common", predictors=THREE)
    return rounded(index, "nino34")


def _scenario_parts(spark, sf):
    def part(obs, exp):
        # some series have another name in the scenario, so neither side finds its partner
        other = F.when((F.col("iy") % 5 == 4) & (F.lit(exp) == "ssp370"), 100).otherwise(0)
        return A.field(obs, "tos").withColumns({
            "exp": F.lit(exp), "model": F.concat(F.lit("M"), "iy"),
            "member": F.concat_ws("_", F.concat(F.lit("r"), F.col("ix") + other), "member")})

    early = part(A.line_obs(spark, sf).where(cal.within_months("time", None, "1998-12")), "historical")
    late = part(A.order_obs(spark, sf).where(cal.within_months("time", "1999-01", None)), "ssp370")
    return early, late


@query
def scenario_union(spark, sf):
    return rounded(ingest.union_scenarios(*_scenario_parts(spark, sf), exclude=("M7",)), "value", digits=7)


@query
def scenario_unpaired(spark, sf):
    return ingest.unpaired_series(*_scenario_parts(spark, sf), exclude=("M7",))


def _column_field(spark, sf, value, var):
    return A.profile(spark, sf).select(
        F.lit(var).alias("var"), *AT, "lat", "lon", "lev", "lev_idx", F.col(value).alias("value"))


@query
def surface_salinity(spark, sf):
    out = columns.surface_job(_column_field(spark, sf, "salt", "salt"), MEMBER, units="kg kg**-1")
    return rounded(out, "value")


@query
def heat_content_kelvin(spark, sf):
    out = columns.heat_content_job(
        _column_field(spark, sf, "temp", "thetao"), MEMBER, " K ", depths=A.depth_table(spark, sf))
    return out.withColumn("value", r(F.col("value") / 1e6, 3))


@query
def mixed_layer_paired(spark, sf):
    out = columns.mixed_layer_job(
        _column_field(spark, sf, "temp", "thetao"), _column_field(spark, sf, "salt", "so"), MEMBER, check=False)
    return rounded(out, "value")


@query
def last_files(spark, sf):
    named = A.files(spark, sf).select(F.col("name").alias("path"), "name")
    return catalog.last_match(named, VAR_ORDER)


@query
def file_map_override(spark, sf):
    files = A.files(spark, sf)
    every = catalog.preferred_files(files, ["model"])
    ours = catalog.preferred_files(files.where(F.col("exp") == "historical"), ["model"])
    return catalog.later_wins(every, ours, ["model", "var"])


@query
def file_kinds(spark, sf):
    marks = ("504B0304AA", "43444601", "43444605FF", "894844460D0A1A0A00", "504B0102", "")
    head = F.unhex(F.element_at(F.array(*[F.lit(m) for m in marks]), F.expr("p_size % 6 + 1")))
    return A.table(spark, sf, "part").select("p_partkey", downloads.file_kind(head).alias("kind"))
