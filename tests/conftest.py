import sys
from pathlib import Path

import numpy as np
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from fields import month  # noqa: E402
from halocline.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    return session


FIELD = "var string, time timestamp_ntz, iy int, ix int, lat double, lon double, value double"


@pytest.fixture
def make_field(spark):
    """A field from a (time, y, x) array; NaN is missing."""
    def build(cube, lat=None, lon=None, var="tos", start=2000):
        nt, ny, nx = cube.shape
        lat = np.arange(ny, dtype=float) if lat is None else np.asarray(lat, dtype=float)
        lon = np.arange(nx, dtype=float) if lon is None else np.asarray(lon, dtype=float)
        rows = [
            (var, month(t, start), y, x, float(lat[y]), float(lon[x]),
             None if np.isnan(cube[t, y, x]) else float(cube[t, y, x]))
            for t in range(nt) for y in range(ny) for x in range(nx)
        ]
        return spark.createDataFrame(rows, FIELD)
    return build
