import numpy as np
import pytest
from fields import to_cube
from pyspark.sql import functions as F

from halocline.functions.position import lon_360, lon_modulo
from halocline.operators import regrid, space
from halocline.schema import TargetGrid


@pytest.mark.parametrize("shift", [0, -360])
def test_nino34_box_and_weights(make_field, shift):
    lat, lon = np.array([-10, -5, 0, 5.0, 6]), np.array([180, 190, 215, 240, 241.0]) + shift
    lon = np.where(lon < -180, lon + 360, lon)
    cube = np.random.default_rng(0).normal(size=(3, 5, 5))
    cube[1, 2, 2] = np.nan
    cube[2] = np.nan
    got = space.nino34(make_field(cube, lat, lon)).orderBy("time").toPandas()["nino34"].to_numpy(float)
    part = cube[:, 1:4, 1:4]
    w = np.cos(np.radians(lat[1:4]))[None, :, None] * np.isfinite(part)
    want = [np.nansum(w[t] * np.nan_to_num(part[t])) / w[t].sum() for t in (0, 1)]
    np.testing.assert_allclose(got[:2], want)
    assert np.isnan(got[2])


def test_constant_has_that_mean(make_field):
    df = make_field(np.full((2, 3, 4), 7.25), [50, 60, 70], [0, 1, 2, 3])
    assert {round(r.value, 12) for r in space.weighted_mean(df, ["time"]).collect()} == {7.25}


def test_nino34_filter_reaches_the_scan(spark, make_field, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    make_field(np.ones((2, 3, 3))).write.parquet(str(tmp_path / "f"))
    plan = space.nino34(spark.read.parquet(str(tmp_path / "f")), start="2000-01", end="2000-02")
    text = plan._jdf.queryExecution().executedPlan().toString()
    pushed = text[text.index("PushedFilters"):]
    for part in ("GreaterThanOrEqual(lat", "GreaterThanOrEqual(time", "Or("):
        assert part in pushed
    assert "iy" not in text[text.index("ReadSchema"):]


def test_longitude_rules(spark):
    row = spark.range(1).select(*[f(F.lit(x)).alias(f"{f.__name__}{i}") for f in (lon_360, lon_modulo)
                                  for i, x in enumerate((-170.0, 0.0, 359.0))]).collect()[0]
    assert list(row) == [190.0, 0.0, 359.0, 190.0, 0.0, 359.0]


def unwrap_numpy(lon):
    lon = np.where(lon < 0, lon + 360, lon)
    return np.degrees(np.unwrap(np.radians(lon), axis=1)), np.diff(lon, axis=1).min() < -180


def grid_df(spark, lat, lon, key="g"):
    ny, nx = lon.shape
    rows = [(key, y, x, float(lat[y, x]), float(lon[y, x])) for y in range(ny) for x in range(nx)]
    return spark.createDataFrame(rows, "grid string, iy int, ix int, lat double, lon double")


def test_unwrap_matches_numpy(spark):
    rng = np.random.default_rng(4)
    lon = (np.linspace(60, 430, 30)[None, :] + rng.normal(size=(4, 30)) + 540) % 360 - 180
    want, seam = unwrap_numpy(lon)
    assert seam
    out = space.unwrap_longitude(grid_df(spark, lon * 0, lon), ["grid"]).toPandas()
    got = out.pivot(index="iy", columns="ix", values="lon").to_numpy()
    np.testing.assert_allclose(got, want, atol=1e-9)
    assert out["seam"].all()


def test_unwrap_leaves_a_grid_without_drop_alone(spark):
    lon = np.array([[-20.0, -10, -1], [10, 20, 30]])
    out = space.unwrap_longitude(grid_df(spark, lon * 0, lon), ["grid"]).toPandas()
    np.testing.assert_array_equal(out.pivot(index="iy", columns="ix", values="lon").to_numpy(), lon)
    assert not out["seam"].any()


def test_wrap_axis(spark):
    lon = np.tile((np.linspace(100, 500, 12) % 360)[:, None], (1, 3))
    row = space.wrap_scores(grid_df(spark, lon * 0, lon), ["grid"]).collect()[0]
    assert row.lon_axis == "iy" and row.wraps_iy == 3 and row.wraps_ix == 0


TARGET = TargetGrid(lat0=-8.0, dlat=2.0, nlat=9, lon0=0.0, dlon=5.0, nlon=72)


def regular(ny=5, nx=12):
    return np.meshgrid(np.linspace(-10, 10, ny), np.arange(nx) * 30.0 - 180, indexing="ij")


def apply(spark, lat, lon, values, target=TARGET, **kw):
    grid = grid_df(spark, lat, lon).drop("grid")
    rows = [(0, y, x, None if np.isnan(values[y, x]) else float(values[y, x]))
            for y in range(values.shape[0]) for x in range(values.shape[1])]
    df = spark.createDataFrame(rows, "time int, iy int, ix int, value double")
    w = regrid.bilinear_weights(grid, target)
    return regrid.apply_weights(df, w, ["time"], **kw).toPandas()


def test_plane_is_reproduced_including_nodes_and_edges(spark):
    lat, lon = regular()
    out = apply(spark, lat, lon, 2 * lat + 0.5 * lat * 0 + 1)
    assert len(out) == 9 * 72
    np.testing.assert_allclose(out["value"], 2 * out["lat"] + 1, atol=1e-9)


def test_against_direct_interpolation(spark):
    rng = np.random.default_rng(5)
    lat, lon = regular()
    v = rng.normal(size=lat.shape)
    out = apply(spark, lat, lon, v)
    j = np.clip(np.floor((out.lat + 10) / 5).astype(int), 0, 3)
    a = (out.lat + 10) / 5 - j
    pos = ((out.lon + 180) % 360) / 30
    i = np.floor(pos).astype(int) % 12
    b = pos - np.floor(pos)
    n = (i + 1) % 12
    want = (1 - a) * ((1 - b) * v[j, i] + b * v[j, n]) + a * ((1 - b) * v[j + 1, i] + b * v[j + 1, n])
    np.testing.assert_allclose(out["value"], want, atol=1e-9)


def test_regional_grid_returns_every_target(spark):
    lat, lon = np.meshgrid(np.linspace(-5, 5, 3), np.arange(5) * 30.0 + 90, indexing="ij")
    out = apply(spark, lat, lon, 2 * lat)
    inside = out.lat.between(-5, 5) & out.lon.between(90, 210)
    assert len(out) == 9 * 72 and (out["value"].notna() == inside).all()
    np.testing.assert_allclose(out["value"][inside], 2 * out["lat"][inside], atol=1e-9)


def test_each_grid_closes_its_own_seam(spark):
    """Widths 36 and 72 in one table, and a regional one, whose edge stays open."""
    rows = []
    for name, nx, step, start in (("a", 36, 10.0, -175.0), ("b", 72, 5.0, 2.5), ("c", 12, 10.0, 30.0)):
        for iy in range(3):
            for ix in range(nx):
                lon = start + ix * step
                rows.append((name, iy, ix, iy * 10.0 - 10, (lon + 180) % 360 - 180, 0, float(np.cos(np.radians(lon)))))
    df = spark.createDataFrame(rows, "model string, iy int, ix int, lat double, lon double, time int, value double")
    assert {r["model"]: r["nx"] for r in regrid.seams(df, ["model"]).collect()} == {"a": 36, "b": 72}
    target = TargetGrid(lat0=-5.0, dlat=5.0, nlat=3, lon0=0.0, dlon=1.0, nlon=360)
    w = regrid.bilinear_weights(regrid.grid_of(df, ["model"]), target, ["model"])
    out = regrid.apply_weights(df, w, ["model", "time"], keys=["model"]).toPandas()
    assert out.groupby("model").size().to_dict() == {"a": 1080, "b": 1080, "c": 1080}
    for name, most in (("a", 0.004), ("b", 0.001)):
        own = out[out.model == name]
        assert np.abs(own["value"] - np.cos(np.radians(own["lon"]))).max() < most
    own = out[out.model == "c"]
    assert (own["value"].notna() == own["lon"].between(30, 140)).all()


def test_absent_source_rows_lose_no_target(spark):
    lat, lon = regular()
    df = spark.createDataFrame([(0, 0, 0, 1.0), (1, 2, 3, None)], "time int, iy int, ix int, value double")
    out = regrid.apply_weights(df, regrid.bilinear_weights(grid_df(spark, lat, lon).drop("grid"), TARGET), ["time"])
    assert sorted(tuple(r) for r in out.groupBy("time").count().collect()) == [(0, 648), (1, 648)]


def test_curvilinear_plane(spark):
    """A rotated grid: bilinear in the quad, so a plane in (lat, lon) comes back exactly."""
    u, v = np.meshgrid(np.linspace(-25, 25, 26), np.linspace(-25, 25, 26), indexing="ij")
    angle = 0.4
    lat, lon = u * np.cos(angle) - v * np.sin(angle), 30 + u * np.sin(angle) + v * np.cos(angle)
    lat, lon = lat + 0.1 * np.sin(u), lon + 0.1 * np.cos(v)
    target = TargetGrid(lat0=-8, dlat=1.7, nlat=10, lon0=22.0, dlon=1.3, nlon=12)
    out = apply(spark, lat, lon, 3 * lat - lon, target)
    assert len(out) == 120
    np.testing.assert_allclose(out["value"], 3 * out["lat"] - out["lon"], atol=1e-8)


def test_missing_corner_policies(spark):
    lat, lon = np.meshgrid([0.0, 10], [0.0, 10], indexing="ij")
    v = np.array([[np.nan, 2.0], [4.0, 8.0]])
    target = TargetGrid(lat0=2, dlat=6, nlat=2, lon0=2, dlon=6, nlon=2)
    got = apply(spark, lat, lon, v, target).set_index(["iy", "ix"])["value"]
    assert np.isnan(got[0, 0])  # 64% of the weight is missing
    w = {(1, 1): (0.04, [0.16, 0.16, 0.64])}
    lost, rest = w[1, 1]
    assert got[1, 1] == pytest.approx(np.dot(rest, [2, 4, 8]) / (1 - lost))
    strict = apply(spark, lat, lon, v, target, missing="strict")["value"]
    assert strict.isna().all()


def test_missing_corner_without_weight_does_not_matter(spark):
    lat, lon = np.meshgrid([0.0, 10], [0.0, 10], indexing="ij")
    v = np.array([[np.nan, 2.0], [4.0, 8.0]])
    target = TargetGrid(lat0=10, dlat=1, nlat=1, lon0=5, dlon=1, nlon=1)
    assert apply(spark, lat, lon, v, target, missing="strict")["value"][0] == pytest.approx(6.0)


def test_an_absent_corner_is_a_missing_corner(spark):
    """The weights may cover cells some dataset does not have."""
    lat, lon = np.meshgrid([0.0, 10], [0.0, 10], indexing="ij")
    target = TargetGrid(lat0=6, dlat=1, nlat=1, lon0=6, dlon=1, nlon=1)
    w = regrid.bilinear_weights(grid_df(spark, lat, lon).drop("grid"), target)
    df = spark.createDataFrame([(0, 0, 1, 2.0), (0, 1, 0, 4.0), (0, 1, 1, 8.0)], "time int, iy int, ix int, value double")
    assert regrid.apply_weights(df, w, ["time"], missing="strict").collect()[0]["value"] is None
    got = regrid.apply_weights(df, w, ["time"]).collect()[0]["value"]
    assert got == pytest.approx((0.24 * 2 + 0.24 * 4 + 0.36 * 8) / 0.84)


@pytest.mark.parametrize("bound", [10, 10**6])
def test_regrid_plans_agree(spark, bound, monkeypatch):
    """The broadcast, and the shuffled join beyond its bound."""
    monkeypatch.setattr(regrid, "BROADCAST_ROWS", bound)
    lat, lon = regular()
    out = apply(spark, lat, lon, 3 * lat)
    assert len(out) == 9 * 72
    np.testing.assert_allclose(out["value"], 3 * out["lat"], atol=1e-9)


def test_equal_grids_share_their_weights(spark, monkeypatch, capsys):
    """Members on few grids exchange their source rows only, however many weights all of them have together."""
    lat, lon = np.arange(5) * 10.0 - 20, np.arange(8) * 20.0
    rng = np.random.default_rng(4)
    rows = [(m, t, y, x, float(lat[y]), float(lon[x] + (m % 2)), None if (m + t + y) % 7 == 0 else float(rng.normal()))
            for m in range(6) for t in range(3) for y in range(5) for x in range(8) if (m, y) != (5, 4)]
    field = spark.createDataFrame(rows + [(None, 0, 0, 0, 0.0, 0.0, 1.0)], "member int, time int, iy int, ix int, lat double, lon double, value double")
    weights = regrid.bilinear_weights(regrid.grid_of(field, ["member"]), TARGET, ["member"])
    at = ["member", "time", "iy", "ix"]
    want = regrid.apply_weights(field, weights, ["member", "time"], keys=["member"]).toPandas().sort_values(at)
    per_grid = [r["count"] for r in weights.groupBy("member").count().collect()]
    monkeypatch.setattr(regrid, "BROADCAST_ROWS", 3 * max(per_grid))  # six members, three grids
    plan = regrid.apply_weights(field, weights, ["member", "time"], keys=["member"])
    got = plan.toPandas().sort_values(at)
    for c in want.columns:
        np.testing.assert_allclose(want[c].to_numpy(float), got[c].to_numpy(float), rtol=1e-12)
    plan.explain()
    assert not [x for x in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in x and "ty" in x]


def test_regrid_exchanges_the_source_rows_only(spark, make_field):
    """The fan-out to targets happens after the exchange by slice."""
    df = make_field(np.ones((2, 3, 3)))
    w = regrid.bilinear_weights(regrid.grid_of(df), TargetGrid(0, 0.5, 4, 0, 0.5, 4))
    plan = regrid.apply_weights(df, w, ["var", "time"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    top = text[: text.index("BroadcastHashJoin")]
    assert "Exchange" not in top
    np.testing.assert_allclose(to_cube(plan), 1.0)


def test_a_slice_is_cut_in_bands(spark, make_field):
    """Few slices, many tasks, the same values: bands of whole rows add up to the slice."""
    rng = np.random.default_rng(4)
    cube = rng.normal(size=(2, 40, 30))
    cube[rng.random(cube.shape) < 0.1] = np.nan
    field = make_field(cube, lat=np.linspace(-58, 58, 40), lon=np.arange(30) * 12.0)
    target = TargetGrid(lat0=-50.0, dlat=2.5, nlat=41, lon0=1.0, dlon=5.0, nlon=72)
    weights = regrid.bilinear_weights(regrid.grid_of(field), target)
    whole = regrid.apply_weights(field, weights, ["var", "time"])
    cut = regrid.apply_weights(field, weights, ["var", "time"], block_cells=90)
    np.testing.assert_allclose(to_cube(cut), to_cube(whole), rtol=1e-12, atol=1e-12)
    plan = cut._jdf.queryExecution().toString()
    assert "div 3" in plan and "div" not in whole._jdf.queryExecution().toString()
