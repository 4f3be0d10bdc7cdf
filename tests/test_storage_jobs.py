import struct
from datetime import datetime, timedelta

import numpy as np
import pytest
from fields import month, to_cube
from pyspark.sql import functions as F

from halocline.operators import checks, merge
from halocline.plans import anomalies, ingest, predictors, splits, targets
from halocline.schema import TargetGrid, clean_missing
from halocline.sources import store
from halocline.sources.netcdf import decode_times, read_netcdf, write_classic, write_netcdf


def save(path, cube, var="tos", lat=None, lon=None, lev=None, start=2000, attrs=None, names=("time", "lat", "lon"),
         form="f4"):
    """A classic file from a (time, [lev], y, x) array."""
    path.parent.mkdir(parents=True, exist_ok=True)
    t, la, lo = names
    days = np.array([(month(i, start).replace(day=15) - datetime(1950, 1, 1)).days for i in range(cube.shape[0])], "f8")
    lat = np.arange(cube.shape[-2], dtype="f8") if lat is None else np.asarray(lat, "f8")
    lon = np.arange(cube.shape[-1], dtype="f8") if lon is None else np.asarray(lon, "f8")
    dims = {t: cube.shape[0], "y" if lat.ndim == 2 else la: cube.shape[-2], "x" if lon.ndim == 2 else lo: cube.shape[-1]}
    space = tuple(list(dims)[1:])
    variables = {
        t: ((t,), days, {"units": "days since 1950-01-01 00:00:00"}),
        la: (space if lat.ndim == 2 else (la,), lat, {}), lo: (space if lon.ndim == 2 else (lo,), lon, {}),
    }
    vdims = (t, *space)
    if lev is not None:
        dims["depth"] = len(lev)
        variables["depth"] = (("depth",), np.asarray(lev, "f8"), {"units": "m"})
        vdims = (t, "depth", *space)
    filled = np.where(np.isnan(cube), 1e20, cube).astype(form)
    variables[var] = (vdims, filled, {"_FillValue": np.float32(1e20), **(attrs or {})})
    write_classic(str(path), dims, variables, {})


def test_netcdf_three_dimensions(spark, tmp_path):
    cube = np.random.default_rng(0).normal(size=(30, 3, 4)).astype("f4")
    cube[2, 1, 1] = np.nan
    save(tmp_path / "tos.nc", cube, names=("time_counter", "latitude", "nav_lon"))
    df = read_netcdf(spark, str(tmp_path / "tos.nc"), "tos", chunkSteps=7)
    assert df.rdd.getNumPartitions() == 5
    np.testing.assert_array_equal(to_cube(df).astype("f4"), cube)
    row = df.where("step = 1 and iy = 2 and ix = 3").collect()[0]
    assert row["time"] == datetime(2000, 2, 15) and row["n_steps"] == 30 and row["lev"] is None
    assert (row["lat"], row["lon"]) == (2.0, 3.0)


def test_netcdf_depth_curvilinear_and_packing(spark, tmp_path):
    lat2, lon2 = np.meshgrid([10.0, 20], [1.0, 2, 3], indexing="ij")
    cube = np.arange(2 * 2 * 2 * 3, dtype=float).reshape(2, 2, 2, 3)
    save(tmp_path / "t.nc", cube, "thetao", lat2 + 0.5 * lon2, lon2, lev=[5.0, 15], names=("time", "nav_lat", "nav_lon"),
         attrs={"scale_factor": 2.0, "add_offset": 1.0})
    pdf = read_netcdf(spark, str(tmp_path), "thetao", decodeTimes=False).toPandas()
    assert len(pdf) == 24 and pdf["time"].isna().all() and pdf["raw_time"].notna().all()
    got = pdf.set_index(["step", "lev_idx", "iy", "ix"])
    assert got.loc[(1, 1, 1, 2), "value"] == 2 * cube[1, 1, 1, 2] + 1
    assert got.loc[(0, 1, 1, 2), "lev"] == 15.0 and got.loc[(0, 0, 1, 2), "lat"] == 21.5


def test_netcdf_record_layout(spark, tmp_path):
    """Unlimited time, CDF-1, two record variables interleaved with padding."""
    def name(s):
        return struct.pack(">i", len(s)) + s.encode() + b"\0" * (-len(s) % 4)
    none = struct.pack(">ii", 0, 0)
    dims = struct.pack(">ii", 10, 3) + name("time") + struct.pack(">i", 0) + name("lat") + struct.pack(">i", 1) + name("lon") + struct.pack(">i", 3)
    units = struct.pack(">ii", 12, 1) + name("units") + struct.pack(">ii", 2, 21) + b"days since 2000-01-01" + b"\0" * 3

    def var(n, ids, att, kind, size, begin):
        return name(n) + struct.pack(">i", len(ids)) + b"".join(struct.pack(">i", i) for i in ids) + att + struct.pack(">iii", kind, size, begin)

    def header(at):
        return (b"CDF\x01" + struct.pack(">i", 2) + dims + none + struct.pack(">ii", 11, 4)
                + var("lat", [1], none, 6, 8, at) + var("lon", [2], none, 5, 12, at + 8)
                + var("time", [0], units, 6, 8, at + 20) + var("psl", [0, 1, 2], none, 3, 8, at + 28))
    at = len(header(0))
    body = np.array([5.0], ">f8").tobytes() + np.array([1, 2, 3], ">f4").tobytes()
    for step in range(2):
        body += np.array([31.0 * step], ">f8").tobytes() + np.array([10 * step + i for i in range(3)], ">i2").tobytes() + b"\0\0"
    (tmp_path / "r.nc").write_bytes(header(at) + body)
    pdf = read_netcdf(spark, str(tmp_path / "r.nc"), "psl").toPandas().sort_values(["step", "ix"])
    assert pdf["value"].tolist() == [0, 1, 2, 10, 11, 12] and pdf["time"].iloc[-1] == datetime(2000, 2, 1)


def test_hdf5_needs_its_library(spark, tmp_path):
    (tmp_path / "h.nc").write_bytes(b"\x89HDF\r\n\x1a\n" + b"0" * 64)
    with pytest.raises(Exception, match="netCDF4|HDF5"):
        read_netcdf(spark, str(tmp_path / "h.nc"), "tos").count()


def test_calendars():
    assert decode_times(np.array([59.0]), "days since 2001-01-01", "noleap") == [datetime(2001, 3, 1)]
    assert decode_times(np.array([59.0]), "days since 2000-01-01", "365_day") == [datetime(2000, 3, 1)]
    assert decode_times(np.array([59.0]), "days since 2000-01-01") == [datetime(2000, 2, 29)]
    assert decode_times(np.array([59.0]), "days since 2001-01-01", "360_day") == [datetime(2001, 2, 28)]
    assert decode_times(np.array([720 * 24.0]), "hours since 1999-12-30 00:00:00", "360_day") == [datetime(2001, 12, 30)]
    with pytest.raises(ValueError):
        decode_times(np.array([1.0]), "months since 2000-01-01")


def test_netcdf_round_trip(spark, make_field, tmp_path):
    cube = np.random.default_rng(1).normal(size=(26, 3, 2)).astype("f4")
    cube[5, 2, 1] = np.nan
    write_netcdf(make_field(cube, lat=[-1, 0, 1], lon=[10, 20]), str(tmp_path), span="year")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["tos.2000.nc", "tos.2001.nc", "tos.2002.nc"]
    np.testing.assert_array_equal(to_cube(read_netcdf(spark, str(tmp_path), "tos")).astype("f4"), cube)
    write_netcdf(make_field(cube), str(tmp_path / "m"))
    assert len(list((tmp_path / "m").iterdir())) == 26


def test_fill_and_nan_become_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1e20,), (-1e20,), (3.0,), (None,)], "value double")
    assert [r[0] for r in clean_missing(df, "value").collect()] == [None, None, None, 3.0, None]


def test_store_skips_what_exists(spark, make_field, tmp_path):
    path = str(tmp_path / "f")
    assert store.write_field(make_field(np.ones((14, 1, 1))), path)
    assert not store.write_field(make_field(np.zeros((14, 1, 1))), path)
    assert store.read_field(spark, path, "2000-03", "2001-01").agg(F.sum("value"), F.count("*")).collect()[0][:] == (11.0, 11)
    assert spark.read.parquet(path).schema["value"].dataType.simpleString() == "float"
    assert store.write_field(make_field(np.zeros((14, 1, 1))), path, overwrite=True)
    store.append_history(spark, path, "first")
    store.append_history(spark, path, "second")
    assert len(store.read_history(spark, path).collect()) == 2
    store.write_attrs(spark, path, {"tos": {"units": "degC"}})
    assert store.read_attrs(spark, path).collect()[0]["value"] == "degC"


def test_headers(spark, tmp_path):
    from halocline.sources import catalog
    from halocline.sources.netcdf import file_attrs, units_of, variable_names
    save(tmp_path / "a.nc", np.ones((2, 2, 2)), "tos", attrs={"units": "K"})
    assert variable_names(str(tmp_path / "a.nc")) == ["time", "lat", "lon", "tos"]
    assert units_of(str(tmp_path), "tos") == "K" and units_of(str(tmp_path), "none") == ""
    got = {(r["var"], r["key"]): r["value"] for r in file_attrs(catalog.list_files(spark, str(tmp_path))).collect()}
    assert got["tos", "units"] == "K" and got["time", "units"].startswith("days since")


def test_fixed_source_ingest_uses_aliases(spark, tmp_path):
    save(tmp_path / "uwnd.10m.mon.mean.nc", np.ones((2, 2, 2)), "uwnd")
    save(tmp_path / "prmsl.mon.mean.nc", np.ones((2, 2, 2)), "odd_name")
    df = ingest.load_fixed(spark, "20crv2", str(tmp_path), {"uas": "uwnd.10m.mon.mean.nc", "psl": "prmsl.mon.mean.nc",
                                                            "vas": "absent.nc"})
    assert {r["var"] for r in df.select("var").distinct().collect()} == {"uas", "psl"}
    assert df.select("time").distinct().orderBy("time").collect()[0]["time"] == datetime(2000, 1, 1)


def test_cmip6_tree_to_predictors_and_targets(spark, tmp_path):
    rng = np.random.default_rng(3)
    lat, lon = [-10.0, -3, 3, 10], [180.0, 200, 220, 240]
    for exp, start in (("historical", 2000), ("ssp370", 2002)):
        for model, member in (("M1", "r1i1p1f1"), ("M2", "r1i1p1f1"), ("MRI-ESM2-0", "r1i1p1f1")):
            for var in ("tos", "psl"):
                if (model, var) == ("M2", "psl"):
                    continue
                save(tmp_path / exp / model / member / "monthly" / f"{var}_Omon_{model}_{exp}_{member}_gn_time.nc",
                     rng.normal(size=(24, 4, 4)), var, lat, lon, start=start)
    df = ingest.load_cmip6(spark, str(tmp_path), ("tos", "psl"))
    assert df.count() == 2 * 5 * 24 * 16
    joined = ingest.union_scenarios(df.where("exp = 'historical'"), df.where("exp = 'ssp370'"))
    assert {r["model"] for r in joined.select("model").distinct().collect()} == {"M1", "M2"}
    keys = ["exp", "model", "member"]
    target = TargetGrid(lat0=-9, dlat=3, nlat=7, lon0=180, dlon=10, nlon=7)
    anom = anomalies.anomaly_job(joined, [*keys, "var"], target)
    assert anom.count() == 48 * 3 * 49

    merged, bad = predictors.predictor_job(anom, keys, ("tos", "psl"), start="2000-06", end="2003-05")
    assert [(r["model"], r["problem"]) for r in bad.collect()] == [("M2", "missing psl")]
    assert merged.count() == 36 * 49 and {r["model"] for r in merged.select("model").distinct().collect()} == {"M1"}

    index, short = targets.cmip6_target_job(anom, predictors=("tos", "psl"))
    got = {(r["model"], r["period_source"]): r["n"] for r in index.groupBy("model", "period_source").agg(
        F.count("*").alias("n")).collect()}
    assert got == {("M1", "common_predictor_overlap"): 48,
                   ("M2", "common_predictor_overlap;missing=psl"): 48} and short.count() == 0
    _, short = targets.cmip6_target_job(anom, start="1999-01")
    assert short.count() == 2


def test_cmip6_series_in_several_files_is_one_axis(spark, tmp_path):
    cube = np.random.default_rng(2).normal(size=(24, 3, 3))
    folder = tmp_path / "h" / "M" / "r1i1p1f1" / "monthly"
    save(folder / "tos_a_200001.nc", cube[:12], start=2000)
    save(folder / "tos_a_200101.nc", cube[12:], start=2001)
    df = ingest.load_cmip6(spark, str(tmp_path), ("tos",))
    assert "t_idx" not in df.columns
    from halocline.operators import series
    got = to_cube(series.quadratic_detrend(df, ["exp", "model", "member", "var"]))
    x = np.linspace(-1, 1, 24)
    want = cube[:, 1, 1] - np.polyval(np.polyfit(x, cube[:, 1, 1].astype("f4"), 2), x)
    np.testing.assert_allclose(got[:, 1, 1], want, atol=1e-5)


def period_fields(make_field):
    a = make_field(np.ones((24, 1, 1)), var="tos").unionByName(make_field(np.ones((12, 1, 1)), var="psl", start=2001))
    return a.withColumn("model", F.lit("M"))


def test_period_policy(make_field):
    f = period_fields(make_field)
    def period(**kw):
        r = targets.target_periods(f, ["model"], predictors=("tos", "psl"), **kw).collect()[0]
        return r["start"], r["end"], r["period_source"]
    inputs = f.where("time >= '2000-05-01'")
    assert period(start="2000-02") == ("2000-02", None, "explicit:2000-02~auto")
    assert period(inputs=inputs) == ("2000-05", "2001-12", "input")
    assert period() == ("2001-01", "2001-12", "common_predictor_overlap")
    assert period(mode="common", inputs=inputs)[2] == "common_predictor_overlap"
    # mode "input" without an input falls through to the whole field unless strict
    assert period(mode="input") == (None, None, "tos_full_period")
    with pytest.raises(checks.CheckFailed):
        period(mode="input", strict=True)


def test_ready_index(spark):
    df = spark.createDataFrame([(month(i).replace(day=9), float(i)) for i in range(12)], "time timestamp_ntz, v double")
    out = targets.index_series(df, "2000-03", "2000-10")
    assert out.count() == 8 and out.columns == ["time", "nino34"]
    with pytest.raises(checks.CheckFailed):
        targets.index_series(df, "2000-03", "2001-10")


def test_index_must_be_plain(make_field):
    with pytest.raises(checks.CheckFailed):
        targets.index_series(make_field(np.ones((3, 1, 2))))
    assert targets.index_series(make_field(np.ones((3, 1, 1)))).count() == 3


def test_rejections(make_field):
    a = make_field(np.ones((24, 1, 1)), var="tos")
    b = make_field(np.ones((24, 1, 1)), var="psl", start=2001)
    def why(df, **kw):
        return [r["problem"] for r in predictors.rejected(df.withColumn("m", F.lit(1)), ["m"], ("tos", "psl"), **kw).collect()]
    assert why(a.unionByName(b)) == [] and why(a) == ["missing psl"]
    assert why(a.unionByName(b.where("year(time) = 2002"))) == ["no common step"]
    assert why(a.unionByName(b), start="2000-06") == ["starts late"]
    assert why(a.unionByName(b), start="2001-01", end="2002-01") == ["ends early"]


def counted(df):
    """The field and the number of its rows that have been computed so far."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def one(var):
        seen.add(1)
        return var

    return df.withColumn("var", F.udf(one, "string").asNondeterministic()("var")), seen


def test_jobs_read_their_fields_once_for_all_checks(make_field):
    """One pass for the checks or periods and one for the values."""
    both = make_field(np.ones((24, 1, 2)), lat=[0], lon=[200, 210]).unionByName(make_field(np.ones((24, 1, 2)), lat=[0], lon=[200, 210], var="psl"))
    field, seen = counted(both.withColumn("model", F.lit("m")))
    table, bad = predictors.predictor_job(field, ["model"], ("tos", "psl"), start="2000-02", end="2001-06")
    assert table.count() == 17 * 2 and bad.count() == 0 and seen.value <= 2 * 96
    field, seen = counted(both.withColumn("model", F.lit("m")))
    index, short = targets.cmip6_target_job(field, ["model"], mode="common", predictors=("tos", "psl"))
    assert index.count() == 24 and short.count() == 0 and seen.value <= 2 * 96


def test_splits_compute_their_fields_once(spark, make_field, tmp_path):
    lat, lon = [-4.0, 0, 4], [190.0, 210, 230]
    made = lambda n, start, var: counted(make_field(np.random.default_rng(1).normal(size=(n, 3, 3)), lat, lon, var=var, start=start))
    (held, a), (added, b), (air, c), (sea, d) = made(12, 2000, "tos"), made(12, 2001, "tos"), made(36, 2000, "psl"), made(12, 2002, "tos")
    index = spark.createDataFrame([(month(i, 2002), 1.0) for i in range(12)], "time timestamp_ntz, nino34 double")
    splits.build_splits(
        spark, str(tmp_path / "out"), held, added, air, sea, air, index, variables=("tos", "psl"),
        target=TargetGrid(lat0=-4, dlat=4, nlat=3, lon0=190, dlon=20, nlon=3),
        validation=splits.Split("validation", "2000-01", "2001-12", 24), test=splits.Split("test", "2002-01", "2002-12", 12))
    assert [x.value for x in (a, b, c, d)] == [12 * 9, 12 * 9, 36 * 9, 12 * 9]


def test_index_needs_cells_in_the_region(make_field):
    with pytest.raises(checks.CheckFailed):
        targets.index_of_field(make_field(np.ones((2, 2, 2)), lat=[50, 60]))


def test_wind_maximum(make_field, spark):
    base = make_field(np.random.default_rng(5).normal(size=(24, 3, 3)), var="uas")
    daily = base.unionByName(base.withColumns({"time": F.expr("time + interval 9 days"), "value": F.col("value") - 1}))
    target = TargetGrid(lat0=0.5, dlat=1, nlat=2, lon0=0.5, dlon=1, nlon=2)
    got = anomalies.wind_maximum_job(daily, ["var"], target)
    want = anomalies.anomaly_job(base, ["var"], target)
    assert got.select("var").distinct().collect()[0]["var"] == "uasmax"
    np.testing.assert_allclose(to_cube(got), to_cube(want), atol=1e-9)
    steps = anomalies.anomaly_steps(base, ["var"])
    assert steps["climatology"].count() == 12 * 9


def test_extended_splits(spark, make_field, tmp_path):
    rng = np.random.default_rng(7)
    lat, lon = np.array([-20.0, 0, 20]), np.array([180.0, 210, 240])
    target = TargetGrid(lat0=-4, dlat=4, nlat=3, lon0=190, dlon=20, nlon=3)
    tlat, tlon = [-4.0, 0, 4], [190.0, 210, 230]
    field = lambda n, start, var, where=(lat, lon): make_field(rng.normal(size=(n, 3, 3)), *where, var=var, start=start)
    val = splits.Split("validation", "2000-01", "2003-12", 48)
    test = splits.Split("test", "2005-01", "2006-12", 24)
    index = spark.createDataFrame([(month(i, 2004), 1.0) for i in range(40)], "time timestamp_ntz, nino34 double")
    kw = dict(variables=("tos", "psl"), target=target, validation=val, test=test)
    paths = splits.build_splits(
        spark, str(tmp_path / "out"), field(24, 2000, "tos"), field(24, 2002, "tos"),
        field(60, 2000, "psl", (tlat, tlon)), field(24, 2005, "tos", (tlat, tlon)),
        field(24, 2005, "psl", (tlat, tlon)), index, **kw)
    assert spark.read.parquet(paths["validation_input"]).count() == 48 * 9
    assert spark.read.parquet(paths["test_target"]).count() == 24
    with pytest.raises(checks.CheckFailed):
        splits.verify(spark.read.parquet(paths["test_input"]), val, ("tos",))
    with pytest.raises(checks.CheckFailed):
        splits.extend_raw(field(24, 2000, "tos"), field(24, 2001, "tos"))


def test_arrivals_are_taken_once(spark, make_field, tmp_path):
    from halocline.streaming.arrivals import append_arrivals
    drop, held = str(tmp_path / "drop"), str(tmp_path / "held")
    make_field(np.ones((3, 1, 1))).coalesce(1).write.parquet(drop)
    schema = spark.read.parquet(drop).schema
    for n, extra in ((3, None), (3, None), (5, 2)):
        if extra:
            make_field(np.ones((extra, 1, 1)), start=2001).coalesce(1).write.mode("append").parquet(drop)
        # another application has another checkpoint folder; what was taken is remembered beside the store
        spark.sparkContext.setCheckpointDir(str(tmp_path / f"application-{n}-{extra}"))
        append_arrivals(spark.newSession(), drop, held, schema).awaitTermination(60)
        assert spark.read.parquet(held).count() == n
    assert checks.repeated_steps(merge.union_in_time(spark.read.parquet(held)), ["var"]).count() == 0


def test_calendars():
    day = lambda n, units, calendar: decode_times(np.array([n]), units, calendar)[0]
    assert day(1.0, "days since 1582-10-04", "standard") == datetime(1582, 10, 15)
    assert day(1.0, "days since 1582-10-04", "proleptic_gregorian") == datetime(1582, 10, 5)
    assert day(59.0, "days since 1900-01-01", "julian") == datetime(1900, 2, 28)  # the 29th there
    assert day(60.0, "days since 1900-01-01", "julian") == datetime(1900, 3, 1)
    assert day(366.0, "days since 0000-01-01", "proleptic_gregorian") == datetime(1, 1, 1)
    assert day(366.0 + 31, "days since 0000-01-01", "julian") == datetime(1, 2, 1)
    assert day(365.0 + 31, "days since 0000-01-01", "noleap") == datetime(1, 2, 1)
    assert day(-1.0, "days since 1970-01-01", "standard") == datetime(1969, 12, 31)
    for n in range(0, 800_000, 9_973):
        assert day(float(n), "days since 0001-01-01", "proleptic_gregorian") == datetime(1, 1, 1) + timedelta(days=n)
    for calendar, units in (("lunar", "days since 2000-01-01"), ("standard", "days since 0000-01-01")):
        with pytest.raises(ValueError):
            day(1.0, units, calendar)


def column_file(path, depths, steps, value, units="K"):
    n = len(depths)
    cube = np.zeros((steps, n, 2, 2), "f4") + np.asarray(value, "f4")[None, :, None, None]
    write_classic(str(path), {"time": steps, "lev": n, "lat": 2, "lon": 2}, {
        "time": (("time",), np.arange(steps) * 31.0, {"units": "days since 2000-01-01"}),
        "lev": (("lev",), np.asarray(depths, "f8"), {"units": "m"}),
        "lat": (("lat",), np.array([0.0, 1.0]), {}), "lon": (("lon",), np.array([0.0, 1.0]), {}),
        "thetao": (("time", "lev", "lat", "lon"), cube, {"units": units})}, {})


def test_levels_of_a_tree_keep_their_own_depths(spark, tmp_path):
    from halocline.plans import columns, ingest
    for model, depths, value, units in (("A", [5.0, 300.0], [280.0, 280.0], "K"), ("B", [10.0, 20.0, 400.0], [7.0, 7.0, 7.0], "degC")):
        folder = tmp_path / "historical" / model / "r1" / "monthly"
        folder.mkdir(parents=True)
        column_file(folder / "thetao_x.nc", depths, 2, value, units)
    df, keys = ingest.load_levels(spark, str(tmp_path), "thetao")
    assert keys == ["exp", "model", "member"]
    top = columns.surface_job(df, [*keys, "var"])
    assert {r["model"]: r["count"] for r in top.groupBy("model").count().collect()} == {"A": 8, "B": 8}
    heat = columns.heat_content_job(df, [*keys, "var"], df["units"]).toPandas()
    got = heat.groupby("model")["value"].first()
    assert got["A"] == pytest.approx(300 * (280 - 273.15) * 1025 * 3992, rel=1e-5)
    assert got["B"] == pytest.approx(300 * 7 * 1025 * 3992, rel=1e-5)
    single, none = ingest.load_levels(spark, str(tmp_path / "historical" / "A" / "r1" / "monthly" / "thetao_x.nc"), "thetao")
    assert none == [] and single.count() == 16


def test_filters_reach_the_file(spark, tmp_path, monkeypatch):
    from halocline.sources import netcdf
    column_file(tmp_path / "a.nc", [5.0, 10.0, 20.0], 6, [1.0, 2.0, 3.0])
    steps = []
    read = netcdf.Classic.read
    monkeypatch.setattr(netcdf.Classic, "read", lambda self, name, step=None, levels=None: (name == "thetao" and steps.append((step, levels)), read(self, name, step, levels))[1])
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual
    reader = netcdf.FieldReader({"path": str(tmp_path / "a.nc"), "variable": "thetao"})
    pushed = [EqualTo(("lev_idx",), 0), GreaterThanOrEqual(("time",), datetime(2000, 4, 1))]
    assert list(reader.pushFilters(pushed)) == pushed  # Spark applies them again
    rows = sum(b.num_rows for part in reader.partitions() for b in reader.read(part))
    assert steps == [(3, (0, 1)), (4, (0, 1)), (5, (0, 1))] and rows == 3 * 4
    got = read_netcdf(spark, str(tmp_path / "a.nc"), "thetao").where("lev_idx = 0 and step = 2")
    assert got.count() == 4 and got.first()["value"] == 1.0


def test_absent_inputs_are_named(tmp_path, caplog, spark):
    from halocline.plans import ingest
    column_file(tmp_path / "here.nc", [5.0], 1, [1.0])
    assert list(ingest.absent_inputs(str(tmp_path), {"a": "here.nc", "b": "gone.nc"})) == ["b"]
    with pytest.raises(FileNotFoundError):
        ingest.load_fixed(spark, "era5", str(tmp_path), {"b": "gone.nc"})
    assert "gone.nc" in caplog.text


def test_bucketed_field_needs_no_exchange(spark, make_field, tmp_path):
    """Anomaly, climatology and sums of a field stored by cell run where the rows are; a new session reads it too."""
    from halocline.operators import axis, running, series
    from halocline.sources import buckets
    rng = np.random.default_rng(3)
    field = axis.with_time_index(make_field(rng.normal(size=(30, 3, 4)).astype("f4").astype(float)), ["var"])
    path = str(tmp_path / "by cell")
    buckets.write_bucketed(field, path, ["var"], buckets=3)
    assert len([p for p in (tmp_path / "by cell").iterdir() if p.suffix == ".parquet"]) <= 3
    for again in (False, True):
        if again:
            spark.sql(f"DROP TABLE {buckets._table(path)}")  # as if in another session
        kept = buckets.read_bucketed(spark, path)
        for out in (series.anomaly(kept, ["var"]), series.climatology(kept, ["var"]), running.period_sums(kept, ["var"])):
            assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        np.testing.assert_allclose(to_cube(series.anomaly(kept, ["var"])), to_cube(series.anomaly(field, ["var"])), atol=1e-12)
    assert buckets.read_bucketed(spark, path, "2000-02", "2000-03").count() == 2 * 12


def test_alignment_by_fingerprints(spark, make_field):
    a = make_field(np.zeros((3, 2, 2)))
    two = a.withColumn("model", F.lit("A")).unionByName(a.withColumn("model", F.lit("B")))
    columns = ["model", "time", "iy", "ix", "lat", "lon"]
    assert merge.differing(two, two.orderBy(F.desc("ix")).repartition(3), ["model"], columns).isEmpty()
    moved = two.withColumn("lat", F.when((F.col("model") == "B") & (F.col("iy") == 1), F.col("lat") + 1e-12).otherwise(F.col("lat")))
    assert [r.model for r in merge.differing(two, moved, ["model"], columns).collect()] == ["B"]
    assert [r.model for r in merge.differing(two, two.where("model = 'A' or ix = 0"), ["model"], columns).collect()] == ["B"]
    assert [r.model for r in merge.differing(two, two.where("model = 'A'"), ["model"], columns).collect()] == ["B"]
    twice = a.withColumn("model", F.lit("A")).unionByName(a.withColumn("model", F.lit("A")))
    assert not merge.differing(twice, two.where("model = 'A'"), ["model"], columns).isEmpty()
