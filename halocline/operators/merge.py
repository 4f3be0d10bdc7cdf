"""Alignment of several variables, unions in time, set tests on axes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from halocline.functions.calendar import within_months
from halocline.functions.numeric import all_close
from halocline.operators.axis import time_axis
from halocline.operators.sizing import small_side
from halocline.schema import CELL, OCEAN_VARS, VAR_ORDER


def filled(value: Column, var: Column, mode: str = "none") -> Column:
    """Missing values as 0: "none", "ocean" (ocean variables only) or "all"."""
    if mode == "none":
        return value
    if mode == "ocean":
        return F.when(var.isin(*sorted(OCEAN_VARS)), F.coalesce(value, F.lit(0e0))).otherwise(value)
    if mode == "all":
        return F.coalesce(value, F.lit(0e0))
    raise ValueError(f"fill mode must be none, ocean or all, not {mode!r}")


def merge_fields(
    df: DataFrame,
    dataset: Sequence[str] = (),
    variables: Sequence[str] = VAR_ORDER,
    *,
    fill: str = "none",
    start: str | None = None,
    end: str | None = None,
    cell: Sequence[str] = CELL,
) -> DataFrame:
    """One column per variable at the (time, cell) positions all of them have.

    ``df`` is the union of the fields, told apart by ``var``.  Presence is decided
    by rows, not by values: NULL takes part.  One exchange whatever the number of
    variables, with map-side combining.
    """
    names = list(dict.fromkeys(variables))
    var = F.col("var")
    src = df.where(within_months("time", start, end) & var.isin(*names))
    src = src.withColumn("value", filled(F.col("value"), var, fill))
    at = [*dataset, "time", *cell]
    wide = src.groupBy(*at).agg(
        F.min("lat").alias("lat"), F.min("lon").alias("lon"),
        *[F.max(F.when(var == v, F.col("value"))).alias(v) for v in names],
        *[F.max(var == v).alias(f"_has_{v}") for v in names],
    )
    present = reduce(lambda a, b: a & b, [F.col(f"_has_{v}") for v in names])
    return wide.where(present).select(*at, "lat", "lon", *names)


def unmatched_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Positions held by only one side, with the side; empty means exact alignment."""
    both = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    return (
        both.groupBy(*keys).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
        .where(F.col("_l") != F.col("_r"))
        .select(*keys, F.when(F.col("_l") == 1, F.lit("left")).otherwise(F.lit("right")).alias("side"))
    )


def fingerprints(df: DataFrame, dataset: Sequence[str], columns: Sequence[str], tag: str = "print") -> DataFrame:
    """(dataset, tag): a hash of each dataset's rows as a multiset of ``columns``, whatever their order.

    Count, exclusive or and a sum of the row hashes; one aggregate that combines before its shuffle.
    """
    h = F.xxhash64(*columns)
    print_ = F.struct(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.shiftrightunsigned(h, 40)).alias("s"))
    return df.groupBy(*dataset).agg(print_.alias(tag))


def differing(left: DataFrame, right: DataFrame, dataset: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Datasets that are on one side only or whose rows differ in ``columns``; each side is read once."""
    keys = list(dataset)
    both = left.select(*keys, F.lit(0).alias("_side"), *[c for c in columns if c not in keys]).unionByName(
        right.select(*keys, F.lit(1).alias("_side"), *[c for c in columns if c not in keys]))
    prints = fingerprints(both, [*keys, "_side"], columns)
    uneven = (F.count("*") < 2) | (F.min("print") != F.max("print"))
    return prints.groupBy(*keys).agg(uneven.alias("_uneven")).where("_uneven").select(*keys)


def grid_mismatch(left: DataFrame, right: DataFrame, keys: Sequence[str] = (),
                  cell: Sequence[str] = CELL) -> DataFrame:
    """Cells whose coordinates differ by more than rounding, or that one grid lacks."""
    at = [*keys, *cell]
    a = left.groupBy(*at).agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))
    b = right.groupBy(*at).agg(F.min("lat").alias("lat2"), F.min("lon").alias("lon2"))
    same = all_close(F.col("lat"), F.col("lat2")) & all_close(F.col("lon"), F.col("lon2"))
    return a.join(b, at, "full").where(~same)


def harmonise_coords(other: DataFrame, reference: DataFrame, keys: Sequence[str] = (),
                     cell: Sequence[str] = CELL) -> DataFrame:
    """Give ``other`` the coordinates of ``reference``, matched by grid index.

    Check ``grid_mismatch`` first; the joined grid is one row per cell.
    """
    at = [*keys, *cell]
    ref = reference.groupBy(*at).agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))
    return other.drop("lat", "lon").join(small_side(ref), at)


def union_in_time(*parts: DataFrame, ordered: bool = False) -> DataFrame:
    """Periods one after another; repeated steps are kept (see ``repeated_steps``).

    ``ordered`` range-sorts by time, for a sink that needs file order.
    """
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.orderBy("time") if ordered else out


def field_difference(df: DataFrame, minuend: str, subtrahend: str, name: str = "difference") -> DataFrame:
    """Elementwise difference of two columns of a merged table."""
    return df.withColumn(name, F.col(minuend) - F.col(subtrahend))


def common_steps(left: DataFrame, right: DataFrame, dataset: Sequence[str]) -> DataFrame:
    """Times both sides have."""
    at = [*dataset, "time"]
    return left.select(*at).distinct().join(right.select(*at).distinct(), at, "left_semi")


def missing_variables(df: DataFrame, dataset: Sequence[str], wanted: Sequence[str] = VAR_ORDER) -> DataFrame:
    """Wanted variables each dataset lacks, as an ordered array."""
    have = df.groupBy(*dataset).agg(F.collect_set("var").alias("_have"))
    want = F.array(*[F.lit(v) for v in wanted])
    return have.select(*dataset, F.array_except(want, "_have").alias("missing"))


def common_period(df: DataFrame, dataset: Sequence[str]) -> DataFrame:
    """Latest start and earliest end over the variables of each dataset."""
    spans = df.groupBy(*dataset, "var").agg(F.min("time").alias("_a"), F.max("time").alias("_b"))
    return spans.groupBy(*dataset).agg(F.max("_a").alias("start"), F.min("_b").alias("end"))


def sampled_steps(df: DataFrame, dataset: Sequence[str], every: int) -> DataFrame:
    """(dataset, time, t_idx) of every ``every``-th step and always the last one."""
    axis = time_axis(df, dataset)
    keep = (F.col("t_idx") % every == 0) | (F.col("t_idx") == F.col("n_time") - 1)
    return axis.where(keep).select(*dataset, "time", "t_idx")
