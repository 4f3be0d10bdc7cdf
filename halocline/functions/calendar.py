"""Month arithmetic on zone-free timestamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession, functions as F


def month_start(t: Column | str) -> Column:
    """First instant of the month.  Goes through DATE, so the session zone has no say."""
    return F.trunc(F.to_date(_col(t)), "month").cast("timestamp_ntz")


def yyyymm(t: Column | str) -> Column:
    return F.date_format(_col(t), "yyyyMM")


def year_month(t: Column | str) -> Column:
    return F.date_format(_col(t), "yyyy-MM")


def day_label(t: Column | str) -> Column:
    return F.date_format(_col(t), "yyyy-MM-dd")


def span_label(first: Column | str, last: Column | str) -> Column:
    return F.concat_ws("-", yyyymm(first), yyyymm(last))


def days_in_month(t: Column | str) -> Column:
    return F.dayofmonth(F.last_day(F.to_date(_col(t))))


def within_months(t: Column | str, start: str | None, end: str | None) -> Column:
    """Both ends inclusive, given as 'YYYY-MM'.  Plain comparisons on ``t``, so they
    reach the Parquet scan."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (_col(t) >= _month_literal(start))
    if end is not None:
        year, month = (int(p) for p in end.split("-")[:2])
        after = f"{year + month // 12:04d}-{month % 12 + 1:02d}"
        keep = keep & (_col(t) < _month_literal(after))
    return keep


def month_tokens(spark: SparkSession, start_year: int, end_year: int):
    """One 'YYYYMM' row per month of the years, both inclusive."""
    first, last = f"DATE'{start_year:04d}-01-01'", f"DATE'{end_year:04d}-12-01'"
    return spark.sql(
        f"SELECT date_format(m, 'yyyyMM') AS token "
        f"FROM (SELECT explode(sequence({first}, {last}, INTERVAL 1 MONTH)) AS m)"
    )


def tidy_months(months: Sequence[int]) -> list[int]:
    """Sorted and unique; a number outside 1..12 is an error."""
    bad = [m for m in months if not 1 <= m <= 12]
    if bad:
        raise ValueError(f"invalid month: {bad[0]}")
    return sorted(set(months))


def _month_literal(month: str) -> Column:
    return F.lit(f"{month}-01 00:00:00").cast("timestamp_ntz")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
