"""What file names say about their content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from halocline.schema import VAR_ORDER

# Fixed formats.
ANOMALY_SUFFIX = ".anom_1x2.nc"
MONTH_SPAN = r"\d{6}-\d{6}"
YEAR_SPAN = r"\d{4}-\d{4}"
DAILY_TAIL = r"^(.+)_(r\d+i\d+p\d+f\d+)_([^_]+)_time\.nc$"


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def variable_of(name: Column, known: Sequence[str] | None = VAR_ORDER) -> Column:
    """Leading alphanumeric run before '.' or '_'; NULL if absent or not in ``known``."""
    found = F.nullif(F.regexp_extract(name, r"^([A-Za-z0-9]+)[._]", 1), F.lit(""))
    return found if known is None else F.when(found.isin(*known), found)


def stem_variable(name: Column) -> Column:
    """Text before the first underscore of the stem."""
    return F.split(F.regexp_replace(name, r"\.[^.]*$", ""), "_")[0]


def is_anomaly(name: Column) -> Column:
    return F.endswith(name, F.lit(ANOMALY_SUFFIX))


def preference(name: Column) -> Column:
    """Ascending sort key: anomaly files, then month spans, then year spans, then name."""
    return F.struct(
        (~is_anomaly(name)).cast("int").alias("raw"),
        (~F.regexp_like(name, F.lit(MONTH_SPAN))).cast("int").alias("no_month_span"),
        (~F.regexp_like(name, F.lit(YEAR_SPAN))).cast("int").alias("no_year_span"),
        name.alias("name"),
    )


def scenario_union_name(historical: Column) -> Column:
    """Only the first mark is replaced."""
    at = F.locate("_historical_", historical)
    return F.when(
        at > 0,
        F.concat(F.substring(historical, F.lit(1), at - 1), F.lit("_historical_ssp370_"),
                 F.substring(historical, at + len("_historical_"), F.length(historical))),
    ).otherwise(historical)


def replace_prefix(name: Column, old: str, new: str) -> Column:
    return F.when(
        F.startswith(name, F.lit(old)),
        F.concat(F.lit(new), F.substring(name, F.lit(len(old) + 1), F.length(name))),
    ).otherwise(name)


def daily_parts(name: Column, model_dir: Column, member_dir: Column) -> Column:
    """Struct (model, exp, member, grid, problem) of a daily wind file name.

    ``problem`` is NULL when the name agrees with its folders.
    """
    prefix = F.concat(F.lit("uas_day_"), model_dir, F.lit("_"))
    tail = F.substring(name, F.length(prefix) + 1, F.length(name))
    part = [F.regexp_extract(tail, DAILY_TAIL, g) for g in (1, 2, 3)]
    problem = (
        F.when(~F.startswith(name, prefix), "model folder mismatch")
        .when(part[0] == "", "unexpected tail")
        .when(part[1] != member_dir, "member folder mismatch")
    )
    fine = problem.isNull()
    return F.struct(
        model_dir.alias("model"),
        F.when(fine, part[0]).alias("exp"),
        F.when(fine, part[1]).alias("member"),
        F.when(fine, part[2]).alias("grid"),
        problem.alias("problem"),
    )


def csv_items(text: str | None) -> list[str]:
    """Trimmed non-empty items, first occurrences in order."""
    return list(dict.fromkeys(p.strip() for p in (text or "").split(",") if p.strip()))


def contains_word(words: Column, word: Column) -> Column:
    """Whole-word membership in a space-separated list."""
    return F.array_contains(F.split(F.trim(words), r"\s+"), word)


def input_file(model: Column, exp: Column, member: Column) -> Column:
    return F.format_string("input_%s_%s_%s.nc", model, exp, member)


def target_file(model: Column, exp: Column, member: Column) -> Column:
    return F.format_string("target_%s_%s_%s.nc", model, exp, member)
