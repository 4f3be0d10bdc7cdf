"""Helpers of the tests on fields."""

from datetime import datetime

import numpy as np


def month(i: int, start: int = 2000) -> datetime:
    return datetime(start + i // 12, i % 12 + 1, 1)


def to_cube(df, value="value") -> np.ndarray:
    """Back to (time, y, x)."""
    pdf = df.select("time", "iy", "ix", value).toPandas()
    return pdf.pivot(index="time", columns=["iy", "ix"], values=value).sort_index(axis=1).to_numpy(float).reshape(
        pdf["time"].nunique(), pdf["iy"].nunique(), pdf["ix"].nunique())
