import numpy as np
import pytest
from fields import month, to_cube
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from halocline.operators import axis, series


def detrend_numpy(cube):
    nt = cube.shape[0]
    x = np.linspace(-1, 1, nt)
    out = np.full(cube.shape, np.nan)
    for y in range(cube.shape[1]):
        for z in range(cube.shape[2]):
            v = cube[:, y, z]
            ok = np.isfinite(v)
            if ok.sum() >= 3:
                out[ok, y, z] = (v - np.polyval(np.polyfit(x[ok], v[ok], 2), x))[ok]
    return out


def test_pure_quadratic_leaves_nothing(make_field):
    t = np.linspace(-1, 1, 30)
    cube = (3 + 2 * t - 5 * t**2)[:, None, None] * np.array([[1.0, 1e5]])
    assert np.abs(to_cube(series.quadratic_detrend(make_field(cube), ["var"]))).max() < 1e-8


def test_matches_least_squares_with_gaps(make_field):
    rng = np.random.default_rng(1)
    cube = rng.normal(size=(40, 3, 4)) * 1e3
    cube[rng.random(cube.shape) < 0.3] = np.nan
    got = to_cube(series.quadratic_detrend(make_field(cube), ["var"]))
    np.testing.assert_allclose(got, detrend_numpy(cube), atol=1e-8)


def test_fewer_than_three_values_blank_the_cell(make_field):
    cube = np.full((10, 1, 3), np.nan)
    cube[:2, 0, 0] = 1.0
    cube[[1, 4, 9], 0, 1] = [1.0, 5.0, 2.0]
    got = to_cube(series.quadratic_detrend(make_field(cube), ["var"]))
    assert np.isnan(got[:, 0, 0]).all() and np.isnan(got[:, 0, 2]).all()
    np.testing.assert_allclose(got[[1, 4, 9], 0, 1], 0, atol=1e-9)


def test_three_neighbours_on_a_long_axis(make_field):
    """Nearly dependent normal equations."""
    cube = np.full((600, 1, 1), np.nan)
    cube[100:103, 0, 0] = [10.0, 30.0, -20.0]
    got = to_cube(series.quadratic_detrend(make_field(cube, start=1950), ["var"]))
    assert np.nanmax(np.abs(got)) < 0.1


def test_positions_not_calendar_dates(spark, make_field):
    """A missing step takes no position, and cells share the dataset's axis."""
    cube = np.arange(24.0)[:, None, None] ** 2 * np.ones((1, 1, 2))
    df = make_field(cube)
    months = [month(i) for i in range(24) if i not in (5, 6, 7)]
    gap = df.where(df.time.isin(months))
    sparse = gap.where("not (ix = 1 and month(time) = 12)")
    got = series.quadratic_detrend(sparse, ["var"]).toPandas().sort_values(["ix", "time"])
    kept = np.array([i for i in range(24) if i not in (5, 6, 7)])
    x = np.linspace(-1, 1, len(kept))
    for ix in (0, 1):
        part = got[got.ix == ix]
        use = np.array([i for i, k in enumerate(kept) if not (ix == 1 and k % 12 == 11)])
        y = kept[use].astype(float) ** 2
        np.testing.assert_allclose(part.value, y - np.polyval(np.polyfit(x[use], y, 2), x[use]), atol=1e-8)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_detrend_property(make_field, seed):
    rng = np.random.default_rng(seed)
    cube = rng.normal(size=(rng.integers(1, 20), 2, 2))
    cube[rng.random(cube.shape) < 0.4] = np.nan
    got = to_cube(series.quadratic_detrend(make_field(cube), ["var"]))
    np.testing.assert_allclose(got, detrend_numpy(cube), atol=1e-7)


def test_anomaly_averages_to_zero(make_field):
    rng = np.random.default_rng(2)
    cube = rng.normal(size=(48, 2, 2)) + 10 * np.sin(np.arange(48) * np.pi / 6)[:, None, None]
    df = make_field(cube)
    got = to_cube(series.anomaly(df, ["var"]))
    np.testing.assert_allclose(got.reshape(4, 12, 2, 2).mean(axis=0), 0, atol=1e-10)
    two_steps = series.month_anomaly(series.quadratic_detrend(df, ["var"]), ["var"])
    np.testing.assert_allclose(got, to_cube(two_steps), atol=1e-12)


def test_anomaly_is_one_exchange_and_one_sort_on_an_indexed_cube(spark, make_field):
    df = axis.with_time_index(make_field(np.random.default_rng(3).normal(size=(24, 2, 2))), ["var"]).cache()
    df.count()
    plan = series.anomaly(df, ["var"])._jdf.queryExecution().sparkPlan().toString()
    executed = series.anomaly(df, ["var"])._jdf.queryExecution().executedPlan().toString()
    executed = executed.split("InMemoryRelation")[0]
    assert plan.count("Window [") == 2
    assert executed.count("Exchange hashpartitioning") == 1
    assert executed.count("Sort [") == 1


def test_monthly_max_is_signed(spark):
    rows = [("w", d, 0, 0, 0.0, 0.0, v) for d, v in [(month(0), -9.0), (month(0).replace(day=20), -2.0)]]
    df = spark.createDataFrame(rows, "var string, time timestamp_ntz, iy int, ix int, lat double, lon double, value double")
    assert series.monthly(df, ["var"], "max").collect()[0]["value"] == -2.0


def test_dense_cube_keeps_missing_rows(make_field):
    cube = np.ones((5, 2, 3))
    df = make_field(cube).where("not (ix = 2 and month(time) > 2)")
    dense = axis.densify(df, ["var"])
    assert dense.count() == 30 and dense.where("value is null").count() == 6
    assert dense.select("t_idx", "time").distinct().count() == 5


def test_repeated_runs_of_a_dataset_without_keys_are_refused(make_field):
    with pytest.raises(ValueError):
        axis.time_axis(make_field(np.ones((2, 1, 1))), [])


def test_appended_periods_are_the_whole(spark, make_field, tmp_path):
    """Sums of three periods give what the full job gives, and the fit reads no old month."""
    from halocline.operators.axis import with_time_index
    from halocline.plans import extend
    rng = np.random.default_rng(8)
    t = np.arange(75)
    cube = 1e3 + 0.3 * t[:, None, None] - 2e-3 * (t ** 2)[:, None, None] + rng.normal(size=(75, 3, 4))
    cube[rng.random(cube.shape) < 0.2] = np.nan
    cube[:, 0, 0] = np.nan
    cube[:73, 0, 1] = np.nan  # two values only
    field = make_field(cube)
    root = str(tmp_path / "kept")
    cuts = [month(0), month(30), month(61), month(75)]
    for name, low, high in zip("abc", cuts, cuts[1:]):
        part = field.where((F.col("time") >= F.lit(low)) & (F.col("time") < F.lit(high)))
        extend.append_period(part, root, name, ["var"])
        extend.append_period(part, root, name, ["var"])  # a repeated attempt changes nothing
    want = to_cube(series.anomaly(with_time_index(field, ["var"]), ["var"]))
    np.testing.assert_allclose(to_cube(extend.anomalies_since(field, root, ["var"])), want, rtol=0, atol=1e-9)
    last = field.where(F.col("time") >= F.lit(month(61)))
    np.testing.assert_allclose(to_cube(extend.anomalies_since(last, root, ["var"])), want[61:], rtol=0, atol=1e-9)
    assert all("/kept/" in p for p in extend.kept_fit(spark, root, ["var"]).inputFiles())
    with pytest.raises(Exception, match="does not follow"):
        extend.append_period(field.where(F.col("time") < F.lit(month(20))), root, "late", ["var"])
