"""What surrounds a download: request bodies, archive handling, completeness.

Fetching itself belongs to the archives' own clients and stays outside.
"""

from __future__ import annotations

import calendar
import os
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from halocline.functions.calendar import tidy_months

# ---- fixed values ----------------------------------------------------------
# Area of all requests: north, west, south, east.
AREA = [60, -180, -60, 180]
# Ocean reanalysis variables by kind.
OCEAN_2D = (
    "mixed_layer_depth_0_03", "ocean_heat_content_for_the_upper_300m",
    "sea_surface_salinity", "sea_surface_temperature",
)
OCEAN_3D = ("meridional_velocity", "zonal_velocity")
# ----------------------------------------------------------------------------


def monthly_request(var: str, years: Sequence[int], months: Sequence[int]) -> dict:
    return {
        "product_type": ["monthly_averaged_reanalysis"],
        "variable": [var],
        "year": [str(y) for y in years],
        "month": [f"{m:02d}" for m in tidy_months(months)],
        "time": ["00:00"],
        "data_format": "netcdf",
        "download_format": "unarchived",
        "area": AREA,
    }


def daily_request(var: str, year: int, month: int) -> dict:
    days = calendar.monthrange(year, month)[1]
    return {
        "product_type": "reanalysis",
        "variable": [var],
        "year": f"{year}",
        "month": [f"{month:02d}"],
        "day": [f"{d:02d}" for d in range(1, days + 1)],
        "daily_statistic": "daily_mean",
        "time_zone": "utc+00:00",
        "frequency": "3_hourly",
        "area": AREA,
    }


def ocean_request(var: str, year: int) -> dict:
    if var not in OCEAN_2D + OCEAN_3D:
        raise ValueError(f"unknown ocean variable: {var}")
    return {
        "product_type": ["consolidated"],
        "vertical_resolution": "single_level" if var in OCEAN_2D else "all_levels",
        "variable": [var],
        "year": [str(year)],
        "month": [f"{m:02d}" for m in range(1, 13)],
    }


def ocean_variables(kind: str = "all", wanted: Sequence[str] | None = None) -> list[str]:
    if wanted:
        bad = [v for v in wanted if v not in OCEAN_2D + OCEAN_3D]
        if bad:
            raise ValueError(f"unknown ocean variables: {', '.join(bad)}")
        return list(wanted)
    return list({"2d": OCEAN_2D, "3d": OCEAN_3D}.get(kind, OCEAN_2D + OCEAN_3D))


def monthly_name(var: str, years: Sequence[int], months: Sequence[int]) -> str:
    return f"ERA5_monthly_{var}_{years[0]}{months[0]:02d}_{years[-1]}{months[-1]:02d}"


def daily_name(var: str, month: str, with_variable: bool = True) -> str:
    return f"ERA5_daily_{var}_{month}.nc" if with_variable else f"ERA5_daily_{month}.nc"


def file_kind(head: Column) -> Column:
    """"zip", "netcdf" or "unknown" from the first bytes of a file."""
    start = F.hex(F.substring(head, 1, 8))

    def any_of(*marks: str) -> Column:
        found = F.lit(False)
        for m in marks:
            found = found | F.startswith(start, F.lit(m))
        return found

    return (
        F.when(any_of("504B0304", "504B0506", "504B0708"), "zip")
        .when(any_of("43444601", "43444602", "43444605", "894844460D0A1A0A"), "netcdf")
        .otherwise("unknown")
    )


def with_heads(listing: DataFrame, n: int = 16) -> DataFrame:
    """Add the first ``n`` bytes of each listed file, read by the tasks."""
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in listing.schema.fields])

    def heads(batches):
        for pdf in batches:
            def first(path: str) -> bytes:
                with open(path, "rb") as f:
                    return f.read(n)
            yield pdf.assign(head=[first(p) for p in pdf["path"]])

    return listing.mapInPandas(heads, f"{schema}, head binary")


def previews(listing: DataFrame, n: int = 400) -> DataFrame:
    """(path, preview): the start of each file as text, for files of unknown kind."""
    def texts(batches):
        for pdf in batches:
            yield pdf[["path"]].assign(
                preview=[bytes(h).decode("utf-8", "replace") for h in pdf["head"]])

    return with_heads(listing, n).mapInPandas(texts, "path string, preview string")


def extract_archives(listing: DataFrame, folder: str, only_one: bool = False) -> DataFrame:
    """Unpack the NetCDF members of each listed zip into a shared folder.

    Returns (path, files, problem); a broken archive is reported and left alone.
    Members are written aside and renamed, so a repeated attempt is harmless.
    """
    def unpack(path: str) -> tuple[list[str], str | None]:
        try:
            with zipfile.ZipFile(path) as z:
                bad = z.testzip()
                if bad is not None:
                    return [], f"corrupt member {bad}"
                members = [m for m in z.infolist() if not m.is_dir() and m.filename.lower().endswith(".nc")]
                if only_one and len(members) != 1:
                    return [], f"expected one NetCDF member, found {len(members)}"
                done = []
                for m in members:
                    target = os.path.join(folder, os.path.basename(m.filename))
                    temp = f"{target}.{uuid.uuid4().hex}.tmp"
                    with z.open(m) as src, open(temp, "wb") as dst:
                        while block := src.read(1 << 20):
                            dst.write(block)
                    os.replace(temp, target)
                    done.append(target)
                return done, None
        except zipfile.BadZipFile:
            return [], "not a zip archive"

    def each(batches):
        import pandas as pd
        for pdf in batches:
            got = [unpack(p) for p in pdf["path"]]
            yield pd.DataFrame({
                "path": pdf["path"], "files": [g[0] for g in got], "problem": [g[1] for g in got]})

    os.makedirs(folder, exist_ok=True)
    return listing.select("path").mapInPandas(each, "path string, files array<string>, problem string")


def incomplete_years(listing: DataFrame, keys: Sequence[str] = (), expected: int = 12) -> DataFrame:
    """Years (taken from a YYYYMM in the name) with fewer monthly files than expected."""
    year = F.regexp_extract("name", r"(\d{4})(?:0[1-9]|1[0-2])", 1)
    return (
        listing.withColumn("year", year).where(F.col("year") != "")
        .groupBy(*keys, "year").agg(F.count("*").alias("files")).where(F.col("files") < expected)
    )
