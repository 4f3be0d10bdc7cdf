"""Command line over the jobs: ``python -m halocline <command> ...``.

Inputs are NetCDF trees or stored fields (Parquet folders); outputs are Parquet.
An existing output is kept unless ``--overwrite`` is given.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from halocline.functions.calendar import month_start
from halocline.functions.names import csv_items
from halocline.functions.seawater import with_linear_sigma, with_sigma0
from halocline.operators import running, stats
from halocline.plans import anomalies, columns, extend, ingest, predictors, splits, targets
from halocline.schema import (
    DAILY_WIND_ALIASES, EXCLUDED_MODELS, QC_VAR_ORDER, SOURCE_ALIASES, VAR_ORDER, carry_attrs, plottable,
)
from halocline.session import get_session
from halocline.sources import catalog, configs
from halocline.sources.netcdf import read_netcdf, units_of, write_netcdf
from halocline.sources.store import append_history, read_field, write_attrs, write_field

GROUP = ("exp", "model", "member")


def _series_keys(df: DataFrame) -> list[str]:
    return [c for c in ("source", *GROUP) if c in df.columns]


def _grid_keys(df: DataFrame) -> list[str]:
    """Every model brings its own grids."""
    return [c for c in ("model", "var") if c in df.columns]


def _publish(spark: SparkSession, df: DataFrame, args: argparse.Namespace, note: str,
             values: Sequence[str] = ("value",), by: Sequence[str] = ("var",),
             attrs: dict[str, str] | None = None) -> None:
    if args.dry_run:
        df.explain("formatted")
        return
    if write_field(df, args.out, by, overwrite=args.overwrite, values=values):
        append_history(spark, args.out, note)
        write_attrs(spark, args.out, {v: {"derivation": note, **(attrs or {})} for v in values})
    else:
        print(f"kept existing {args.out}")
    if args.netcdf:
        _export(spark, args, note, values)


def _export(spark: SparkSession, args: argparse.Namespace, note: str, values: Sequence[str]) -> None:
    """The published field as NetCDF too: a file for each dataset, variable and ``--netcdf-span``."""
    df = read_field(spark, args.out, values=values)
    if not {"iy", "ix", "lat", "lon"} <= set(df.columns):
        raise SystemExit("--netcdf needs a field on a grid")
    keys = [c for c in ("source", *GROUP) if c in df.columns]
    if tuple(values) != ("value",):
        df = df.unpivot([*keys, "time", "iy", "ix", "lat", "lon"], list(values), "var", "value")
    write_netcdf(df, args.netcdf, [*keys, "var"], attrs={"history": note}, span=args.netcdf_span,
                 name="/".join(f"{{{c}}}" for c in keys) + ("/" if keys else "") + "{var}." + args.netcdf_tag.replace("{", "{{").replace("}", "}}") + ".{span}")


def _report(rows: DataFrame, tag: str) -> None:
    for row in rows.toLocalIterator():
        print(tag, row.asDict())


def _fields(spark: SparkSession, args: argparse.Namespace, variables: Sequence[str]) -> DataFrame:
    """Stored fields, and the preferred files of a tree."""
    parts = [read_field(spark, p) for p in args.fields]
    if args.root:
        chosen = ingest.choose_files(spark, args.root, variables, args.experiment, args.leaf, args.raw)
        _report(chosen.where("is_raw").select("path"), "[RAW]")
        parts.append(ingest.load_chosen(spark, chosen))
    if not parts:
        raise SystemExit("give --fields or --root")
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    return df


def _raw(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    wanted = csv_items(args.vars) or list(SOURCE_ALIASES[args.source])
    if args.source == "cmip6":
        return ingest.load_cmip6(spark, args.root, wanted, args.experiment)
    if args.source == "godas":
        found = catalog.last_match(catalog.list_files(spark, args.root), wanted)
        files = {r["var"]: r["path"] for r in found.collect()}  # one row per variable
    else:
        tag = {"oras5_tag": args.tag} if args.tag else {}
        files = {v: f for v, f in catalog.fixed_files(args.source, **tag).items() if v in wanted}
    return ingest.load_fixed(spark, args.source, args.root, files)


def anom(spark: SparkSession, args: argparse.Namespace) -> None:
    df = _raw(spark, args)
    keys = [*_series_keys(df), "var"]
    if args.keep and not args.dry_run:
        for name, step in anomalies.anomaly_steps(df, keys).items():
            write_field(step, f"{args.keep.rstrip('/')}/{name}", overwrite=args.overwrite)
    # a regridded field keeps what its values are, not the old coordinates' attributes
    out = carry_attrs(anomalies.anomaly_job(df, keys, grid_keys=_grid_keys(df)), df.select("value"))
    _publish(spark, out, args, "quadratic detrend, calendar-month anomaly, bilinear regrid")


def uasmax(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.source == "cmip6":
        if not args.dry_run:
            _report(ingest.daily_rejects(spark, args.root, args.experiment), "[SKIP]")
        daily = ingest.load_cmip6(spark, args.root, ("uas",), args.experiment, leaf="daily")
        for col, wanted in (("model", args.models), ("member", args.members)):
            if wanted:
                daily = daily.where(F.col(col).isin(*csv_items(wanted)))
    else:
        aliases = ",".join(DAILY_WIND_ALIASES[args.source])
        daily = read_netcdf(spark, args.root, aliases).withColumn("source", F.lit(args.source))
    daily = daily.withColumn("var", F.lit("uas"))
    out = anomalies.wind_maximum_job(
        daily, [*_series_keys(daily), "var"], grid_keys=_grid_keys(daily))
    _publish(spark, out, args, "monthly maximum of daily winds as anomaly")


def surface(spark: SparkSession, args: argparse.Namespace) -> None:
    df, keys = ingest.load_levels(spark, args.root, args.var, args.experiment)
    units = args.units if args.units is not None else F.col("units")
    out = columns.surface_job(df, [*keys, "var"], by_depth=not args.file_order, units=units)
    out = out.select(*keys, "var", "time", "iy", "ix", "lat", "lon", "value")
    out = carry_attrs(out, df, {"value": {"units": "g kg-1"}} if args.var == "salt" else None)
    _publish(spark, out, args, f"first vertical level of {args.var}", by=[*keys[1:2], "var"])


def ohc(spark: SparkSession, args: argparse.Namespace) -> None:
    df, keys = ingest.load_levels(spark, args.root, args.var, args.experiment)
    units = args.units if args.units is not None else F.col("units")
    out = columns.heat_content_job(
        df, [*keys, "var"], units, not args.keep_kelvin, zmax=args.zmax, rho0=args.rho0, cp0=args.cp0,
        mask_shallow=args.mask_shallow, shallow_eps=args.shallow_eps)
    out = carry_attrs(out, df, {"value": {"units": "J m-2", "long_name": f"heat content 0-{args.zmax:g} m"}}, derived=["value"])
    _publish(spark, out, args, f"heat content 0-{args.zmax:g} m of {args.var}", by=[*keys[1:2], "var"],
             attrs={"units": "J m-2", "rho0": str(args.rho0), "cp0": str(args.cp0)})


def mlotst(spark: SparkSession, args: argparse.Namespace) -> None:
    def one(path: str, var: str) -> DataFrame:
        return read_netcdf(spark, path, var).withColumns(
            {"time": month_start("time"), "source": F.lit(args.source_name)})

    warm = one(args.temp, args.temp_var)
    out = columns.mixed_layer_job(
        warm, one(args.salt, args.salt_var), ["source"],
        temp_units=args.temp_units or units_of(args.temp, args.temp_var), depth_units=args.depth_units, ref_depth=args.ref_depth,
        delta_sigma=args.delta_sigma, zmax=args.zmax,
        density=with_linear_sigma if args.linear else with_sigma0)
    out = carry_attrs(out, warm, {"value": {"units": "m", "long_name": "ocean mixed layer thickness"}}, derived=["value"])
    _publish(spark, out, args, "mixed-layer depth by density threshold",
             attrs={"units": "m", "ref_depth": str(args.ref_depth), "delta_sigma": str(args.delta_sigma)})


def scenarios(spark: SparkSession, args: argparse.Namespace) -> None:
    wanted = csv_items(args.vars) or list(SOURCE_ALIASES["cmip6"])
    both = [ingest.load_cmip6(spark, args.root, wanted, leaf=args.leaf).where(F.col("exp") == e)
            for e in ("historical", "ssp370")]
    if not args.dry_run:
        _report(ingest.unpaired_series(*both, exclude=csv_items(args.exclude)), "[WARN]")
    out = ingest.union_scenarios(*both, exclude=csv_items(args.exclude))
    _publish(spark, out, args, "historical and scenario periods joined", by=("model", "var"))


def inputs(spark: SparkSession, args: argparse.Namespace) -> None:
    variables = csv_items(args.vars) or list(VAR_ORDER)
    df = _fields(spark, args, variables)
    keys = [c for c in GROUP if c in df.columns]
    if keys:
        out, bad = predictors.predictor_job(
            df, keys, variables, fill=args.fill, start=args.start, end=args.end)
        _report(bad, "[FAIL]")
    else:
        out = predictors.reanalysis_job(
            df, df.limit(0), variables, fill=args.fill, start=args.start, end=args.end)
    _publish(spark, out, args, "merged " + ",".join(variables), variables, keys[:2])


def target(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.default_of:
        places = [f"{(args.root or '.').rstrip('/')}/{c}" for c in catalog.TARGET_CANDIDATES[args.default_of]]
        args.fields, args.root = [catalog.first_existing(None, places, f"{args.default_of} target")], None
    df = spark.read.parquet(*args.fields) if args.kind == "nino34" else _fields(spark, args, VAR_ORDER)
    if args.kind == "nino34":
        out = targets.index_series(df, args.start, args.end)
    elif "model" in df.columns:
        out, bad = targets.cmip6_target_job(
            df, experiments=csv_items(args.experiments) or None, exclude=csv_items(args.exclude),
            start=args.start, end=args.end, mode=args.period_mode,
            inputs=spark.read.parquet(args.inputs) if args.inputs else None)
        _report(bad, "[FAIL]")
    else:
        out = targets.index_of_field(df.where(F.col("var") == "tos"), (), args.start, args.end)
    _publish(spark, out, args, "area-weighted mean 5S-5N, 170W-120W", ("nino34",), (),
             {"long_name": "Niño3.4 index", "region": "5S-5N, 170W-120W", "source": ",".join([*args.fields, *filter(None, [args.root])])})


def split(spark: SparkSession, args: argparse.Namespace) -> None:
    """Both extended splits from stored fields, verified."""
    fields = [read_field(spark, p) for p in (
        args.ocean_held, args.ocean_added, args.validation_atmosphere, args.test_ocean, args.test_atmosphere)]
    if args.dry_run:
        splits.extend_raw(*fields[:2]).explain("formatted")
        return
    paths = splits.build_splits(
        spark, args.out, *fields, spark.read.parquet(args.test_index), overwrite=args.overwrite,
        **({"variables": csv_items(args.vars)} if args.vars else {}),
        **{n: splits.Split(n, *w) for n in ("validation", "test") if (w := _window(getattr(args, n)))})
    for name, path in paths.items():
        print(name, path)


def append(spark: SparkSession, args: argparse.Namespace) -> None:
    """Add a period's stored field to the sums under ``--state``; write the anomalies of its months."""
    df = read_field(spark, args.fields)
    keys = [*_series_keys(df), "var"]
    if args.dry_run:
        running.period_sums(df.withColumn("t_idx", F.lit(0)), keys).explain("formatted")
        return
    extend.append_period(df, args.state, args.period, keys)
    out = extend.anomalies_since(df, args.state, keys)
    _publish(spark, carry_attrs(out, df), args, f"anomaly against all periods up to {args.period}")


def _window(text: str | None) -> tuple[str, str, int] | None:
    """``start,end`` as months, and how many months that is."""
    if not text:
        return None
    start, end = csv_items(text)
    months = [int(m[:4]) * 12 + int(m[5:7]) for m in (start, end)]
    return start, end, months[1] - months[0] + 1


def qc(spark: SparkSession, args: argparse.Namespace) -> None:
    wide = spark.read.parquet(args.fields)
    names = plottable(
        [c for c in wide.columns if c in ("time", "lat", "lon") or c in QC_VAR_ORDER or c in csv_items(args.vars)],
        wanted=csv_items(args.vars) or None)
    long = wide.withColumn("dataset", F.lit(args.fields)).unpivot(
        ["dataset", "time", "iy", "ix", "lat", "lon"], names, "var", "value")
    long = long.withColumn("value", F.col("value").cast("double"))
    _publish(spark, stats.frames(long, ["dataset"], args.frame_step), args, "frames")


def overview(spark: SparkSession, args: argparse.Namespace) -> None:
    found = configs.read_configs(spark, f"{args.root.rstrip('/')}/configs/experiments/*/*.yaml", args.root)
    report = configs.overview(configs.parse_configs(found))
    if args.dry_run:
        report.explain("formatted")
        return
    report.write.mode("overwrite" if args.overwrite else "errorifexists").text(args.out)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="halocline", description=__doc__)
    parser.add_argument("--master", help="only for local runs")
    sub = parser.add_subparsers(dest="command", required=True)

    def command(fn, **names) -> argparse.ArgumentParser:
        p = sub.add_parser(fn.__name__)
        p.set_defaults(run=fn)
        p.add_argument("--out", required=True)
        p.add_argument("--overwrite", action="store_true")
        p.add_argument("--dry-run", action="store_true", help="show the plan, write nothing")
        p.add_argument("--netcdf", help="shared folder for NetCDF files of the result as well")
        p.add_argument("--netcdf-span", choices=("month", "year", "all"), default="year", help="what one file holds")
        p.add_argument("--netcdf-tag", default=fn.__name__, help="second part of the file names")
        for name, default in names.items():
            flag = "--" + name.replace("_", "-")
            if default is bool:
                p.add_argument(flag, action="store_true")
            elif default is str:
                p.add_argument(flag, required=True)
            else:
                p.add_argument(flag, default=default, type=type(default) if default is not None else str)
        return p

    p = command(anom, root=str, vars=None, tag=None, experiment=None, keep=None)
    p.add_argument("--source", required=True, choices=sorted(SOURCE_ALIASES))
    p = command(uasmax, root=str, experiment=None, models=None, members=None)
    p.add_argument("--source", required=True, choices=sorted(DAILY_WIND_ALIASES))
    command(surface, root=str, var=str, experiment=None, units=None, file_order=bool)
    command(ohc, root=str, var=str, experiment=None, units=None, keep_kelvin=bool, zmax=300.0, rho0=1025.0, cp0=3992.0,
            mask_shallow=bool, shallow_eps=1e-3)
    command(mlotst, temp=str, salt=str, temp_var=str, salt_var=str, temp_units=None, depth_units="m",
            source_name="custom", ref_depth=10.0, delta_sigma=0.03, zmax=1000.0, linear=bool)
    command(scenarios, root=str, vars=None, leaf="monthly", exclude=",".join(EXCLUDED_MODELS))
    p = command(inputs, vars=None, start=None, end=None, root=None, experiment=None, leaf="monthly", raw=bool)
    p.add_argument("--fields", nargs="+", default=[])
    p.add_argument("--fill", choices=("none", "ocean", "all"), default="none")
    p = command(target, start=None, end=None, inputs=None, experiments=None, root=None, experiment=None,
                leaf="monthly", raw=bool, exclude=",".join(EXCLUDED_MODELS))
    p.add_argument("--fields", nargs="+", default=[])
    p.add_argument("--kind", choices=("tos", "nino34"), default="tos")
    p.add_argument("--default-of", choices=sorted(catalog.TARGET_CANDIDATES), help="the stored anomalies under --root that this split uses")
    p.add_argument("--period-mode", choices=("auto", "input", "common", "tos"), default="auto")
    command(split, ocean_held=str, ocean_added=str, validation_atmosphere=str, test_ocean=str, test_atmosphere=str,
            test_index=str, vars=None, validation=None, test=None)
    command(append, fields=str, state=str, period=str)
    command(qc, fields=str, vars=None, frame_step=3)
    command(overview, root=str)
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    args.run(get_session(args.master), args)
