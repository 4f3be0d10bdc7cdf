"""Bring NetCDF files into the field store."""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from halocline.functions import names as N
from halocline.functions.calendar import month_start
from halocline.operators.merge import union_in_time
from halocline.operators.sizing import small_side
from halocline.schema import EXCLUDED_MODELS, SOURCE_ALIASES, shared_attrs
from halocline.sources import catalog
from halocline.sources.netcdf import file_attrs, read_netcdf

FIELD = ("var", "time", "iy", "ix", "lat", "lon", "value")
log = logging.getLogger(__name__)
POSITION = {"step": "t_idx", "n_steps": "n_time"}


def absent_inputs(root: str, files: Mapping[str, str]) -> dict[str, str]:
    """Variables whose file is not there, with the path looked for."""
    paths = {var: name if os.path.isabs(name) else os.path.join(root, name) for var, name in files.items()}
    return {var: path for var, path in paths.items() if not os.path.exists(path)}


def load_fixed(spark: SparkSession, source: str, root: str, files: Mapping[str, str],
               monthly: bool = True) -> DataFrame:
    """One variable per file, whatever it is called inside.

    Each file is a whole series, so its steps are the time positions.  Times snap to the month start unless ``monthly`` is off.
    Variables without a file are warned of (see ``absent_inputs``).
    """
    aliases = SOURCE_ALIASES.get(source, {})
    absent = absent_inputs(root, files)
    for var, path in absent.items():
        log.warning("%s has no input for %s: %s", source, var, path)
    parts = []
    for var, name in files.items():
        path = name if os.path.isabs(name) else os.path.join(root, name)
        if var in absent:
            continue
        raw = read_netcdf(spark, path, ",".join(aliases.get(var, (var,))))
        parts.append(raw.withColumn("var", F.lit(var)).withColumnsRenamed(POSITION))
    if not parts:
        raise FileNotFoundError(f"no input of {source} under {root}")
    df = shared_attrs(union_in_time(*parts), parts)
    if monthly:
        df = df.withColumn("time", month_start("time"))
    return df.select(F.lit(source).alias("source"), *FIELD, *POSITION.values())


def _paths_by(chosen: DataFrame, var: str) -> dict[str, list[str]]:
    """The listing is the file plan; its size is the number of files."""
    by_var: dict[str, list[str]] = {}
    for row in chosen.select(var, "path").toLocalIterator():
        by_var.setdefault(row[var], []).append(row["path"])
    return by_var


def _read_by_variable(spark: SparkSession, by_var: Mapping[str, Sequence[str]]) -> list[DataFrame]:
    return [
        read_netcdf(spark, sorted(paths), f"{var},").withColumn("var", F.lit(var))
        for var, paths in by_var.items()
    ]


def daily_problem() -> Column:
    """What a daily wind file's name has against its folders; NULL if nothing."""
    return N.daily_parts(F.col("name"), F.col("model"), F.col("member"))["problem"]


def daily_rejects(spark: SparkSession, root: str, experiment: str | None = None) -> DataFrame:
    """(path, problem) of daily files that ``load_cmip6`` leaves out."""
    listing = catalog.with_groups(catalog.list_files(spark, root), experiment, "daily")
    return listing.select("path", daily_problem().alias("problem")).where("problem is not null")


def choose_files(spark: SparkSession, root: str, variables: Sequence[str], experiment: str | None = None,
                 leaf: str = "monthly", allow_raw: bool = False, instead: DataFrame | None = None) -> DataFrame:
    """The best file of every dataset and variable in a tree: (exp, model, member, var, path, is_raw).

    Anomalies come before raw files, which count only if allowed; files of ``instead`` win.
    """
    keys = ["exp", "model", "member"]
    listing = catalog.with_groups(catalog.list_files(spark, root), experiment, leaf)
    best = catalog.preferred_files(listing, keys, variables, allow_raw)
    return catalog.later_wins(best, instead.select(best.columns), [*keys, "var"]) if instead is not None else best


def load_chosen(spark: SparkSession, chosen: DataFrame) -> DataFrame:
    """The fields of the files that ``choose_files`` found."""
    by_var = _paths_by(chosen, "var")
    if not by_var:
        raise FileNotFoundError("no file was chosen")
    named = chosen.select("path", "exp", "model", "member")
    parts = _read_by_variable(spark, by_var)
    df = shared_attrs(union_in_time(*parts), parts).join(small_side(named), "path")
    return df.withColumn("time", month_start("time")).select("exp", "model", "member", *FIELD)


def load_cmip6(spark: SparkSession, root: str, variables: Sequence[str], experiment: str | None = None,
               leaf: str = "monthly") -> DataFrame:
    """All models, members and variables of a CMIP6 tree in one DataFrame.

    The variable is the file stem up to the first underscore.  Daily files whose name disagrees with
    their folders are left out (see ``daily_rejects``).  File steps become
    time positions where every series is one file; otherwise the positions are
    left to be found on the joined axis.
    """
    listing = catalog.with_groups(catalog.list_files(spark, root), experiment, leaf)
    kept = listing.withColumn("var", F.split("name", "_")[0]).where(F.col("var").isin(*variables))
    if leaf == "daily":
        kept = kept.where(daily_problem().isNull())
    chosen = kept.select("path", "exp", "model", "member", F.col("var").alias("wanted"))
    by_var = _paths_by(chosen, "wanted")
    if not by_var:
        raise FileNotFoundError(f"no {leaf} files of {list(variables)} under {root}")
    parts = _read_by_variable(spark, by_var)
    # Dataset names come straight from the path: no join of the cube with the listing.
    bits = F.split("path", "/")
    named = shared_attrs(union_in_time(*parts), parts).withColumns({
        "member": F.element_at(bits, -3), "model": F.element_at(bits, -4),
        "exp": F.lit(experiment) if experiment else F.element_at(bits, -5),
    })
    if leaf == "monthly":
        named = named.withColumn("time", month_start("time"))
    series = chosen.groupBy("exp", "model", "member", "wanted").agg(F.count("*").alias("files"))
    whole = series.where(F.col("files") > 1).isEmpty()
    position = POSITION.values() if whole else ()
    return named.withColumnsRenamed(POSITION).select("exp", "model", "member", *FIELD, *position)


def load_levels(spark: SparkSession, root: str, var: str, experiment: str | None = None) -> tuple[DataFrame, list[str]]:
    """A depth-resolved variable with the unit of its file, and the columns that name its datasets.

    In a tree of ``[exp/]model/member/<leaf>/file`` every member is a dataset with its own depths;
    any other folder is one dataset.
    """
    listing = catalog.list_files(spark, root) if os.path.isdir(root) else None
    tree = catalog.with_groups(listing, experiment, leaf="") if listing is not None else None
    keys = [] if tree is None or tree.isEmpty() else ["exp", "model", "member"]
    df = read_netcdf(spark, root, var).withColumns({"var": F.lit(var), "time": month_start("time")})
    files = df.select("path").distinct()
    units = file_attrs(files).where((F.col("var") == var) & (F.col("key") == "units")).select("path", F.col("value").alias("units"))
    df = df.join(small_side(units), "path", "left").na.fill("", "units")
    if keys:
        df = df.join(small_side(tree.select("path", *keys)), "path")
    return df, keys


def unpaired_series(historical: DataFrame, scenario: DataFrame,
                    exclude: Sequence[str] = EXCLUDED_MODELS) -> DataFrame:
    """(model, member, var, problem) of series that ``union_scenarios`` leaves out."""
    keys = ["model", "member", "var"]
    sides = [df.select(*keys).distinct().withColumn("_side", F.lit(i)) for i, df in enumerate((historical, scenario))]
    both = sides[0].unionByName(sides[1]).groupBy(*keys).agg(F.sum(F.lit(1)).alias("_n"), F.min("_side").alias("_side"))
    problem = (
        F.when(F.col("model").isin(*exclude), "excluded")
        .when((F.col("_n") == 1) & (F.col("_side") == 0), "no scenario")
        .when(F.col("_n") == 1, "no historical period")
    )
    return both.withColumn("problem", problem).where("problem is not null").select(*keys, "problem")


def union_scenarios(historical: DataFrame, scenario: DataFrame,
                    exclude: Sequence[str] = EXCLUDED_MODELS) -> DataFrame:
    """Historical and scenario periods of every (model, member, var) that has both; ``unpaired_series`` names the rest."""
    keys = ["model", "member", "var"]
    held = [df.where(~F.col("model").isin(*exclude)) for df in (historical, scenario)]
    series = [df.select(*keys).distinct() for df in held]
    # One row per series; broadcast when counted small, so the cubes stay in place.
    both = small_side(series[0].intersect(series[1]))
    joined = union_in_time(*held).withColumn("exp", F.lit("historical_ssp370"))
    # Positions restart per period; they are recomputed on the joined axis.
    return joined.drop("t_idx", "n_time").join(both, keys, "left_semi")
