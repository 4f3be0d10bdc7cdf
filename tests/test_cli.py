import numpy as np
from fields import month
from pyspark.sql import functions as F
from test_storage_jobs import save

from halocline.cli import main


def test_from_files_to_index(spark, tmp_path):
    """Anomalies of two sources, merged predictors, index, frames."""
    rng = np.random.default_rng(0)
    lat, lon = np.linspace(-10, 10, 6), np.linspace(180, 250, 8)
    raw = tmp_path / "raw"
    for var in ("tos", "sos"):
        save(raw / f"{var}.195801-197812.nc", rng.normal(size=(24, 6, 8)), var, lat, lon)
    save(raw / "msl.nc", rng.normal(size=(24, 6, 8)), "msl", lat, lon)
    save(raw / "psl.mon.195801-202512.nc", rng.normal(size=(24, 6, 8)), "msl", lat, lon)
    p = lambda n: str(tmp_path / n)
    main(["anom", "--source", "oras5", "--root", str(raw), "--out", p("sea"), "--keep", p("steps")])
    main(["anom", "--source", "era5", "--root", str(raw), "--out", p("air")])
    main(["anom", "--source", "era5", "--root", str(raw), "--out", p("air")])  # kept
    assert spark.read.parquet(p("steps") + "/climatology").count() == 2 * 12 * 48
    main(["inputs", "--fields", p("sea"), p("air"), "--vars", "tos,sos,psl", "--start", "2000-02",
          "--end", "2001-11", "--out", p("input")])
    merged = spark.read.parquet(p("input"))
    cells = merged.count() / 22
    assert cells == int(cells) and {"tos", "sos", "psl"} <= set(merged.columns)
    main(["target", "--fields", p("sea"), "--out", p("target"), "--start", "2000-01", "--end", "2001-12"])
    assert spark.read.parquet(p("target")).count() == 24
    main(["target", "--fields", p("target"), "--kind", "nino34", "--out", p("t2"), "--start", "2000-03", "--end", "2000-06"])
    assert spark.read.parquet(p("t2")).count() == 4
    main(["qc", "--fields", p("input"), "--out", p("qc"), "--frame-step", "10"])
    frames = spark.read.parquet(p("qc"))
    assert frames.select("frame").distinct().count() == 4 and frames.select("var").distinct().count() == 3


def test_columns_and_winds(spark, tmp_path):
    rng = np.random.default_rng(1)
    z = [5.0, 15, 40, 90]
    temp = 20 - 0.1 * np.array(z)[None, :, None, None] + 0.01 * rng.normal(size=(2, 4, 2, 2))
    save(tmp_path / "temp.nc", temp, "temp", lev=z)
    save(tmp_path / "salt.nc", 35 + 0 * temp, "salt", lev=z)
    p = lambda n: str(tmp_path / n)
    main(["surface", "--root", p("temp.nc"), "--var", "temp", "--out", p("nothing"), "--dry-run"])
    assert not (tmp_path / "nothing").exists()
    main(["surface", "--root", p("temp.nc"), "--var", "temp", "--out", p("surf")])
    main(["ohc", "--root", p("temp.nc"), "--var", "temp", "--out", p("ohc")])
    main(["mlotst", "--temp", p("temp.nc"), "--salt", p("salt.nc"), "--temp-var", "temp", "--salt-var", "salt",
          "--out", p("mld")])
    for name in ("surf", "ohc", "mld"):
        assert spark.read.parquet(p(name)).where("value is not null").count() == 8
    save(tmp_path / "wind" / "d.nc", rng.normal(size=(24, 6, 8)), "u10", np.linspace(-10, 10, 6), np.linspace(180, 250, 8))
    main(["uasmax", "--source", "era5", "--root", p("wind"), "--out", p("uasmax")])
    assert {r[0] for r in spark.read.parquet(p("uasmax")).select("var").distinct().collect()} == {"uasmax"}


def test_inputs_and_target_of_a_tree(spark, tmp_path, capsys):
    """Anomalies are preferred, raw files only where allowed, a dataset without a variable is reported."""
    rng = np.random.default_rng(2)
    lat, lon = [-3.0, 3], [200.0, 220]
    tree = tmp_path / "tree" / "historical"
    for model, names in (("A", ("tos_a.anom_1x2.nc", "tos_a.nc", "psl.200001-200112.anom_1x2.nc")), ("B", ("tos_b.anom_1x2.nc", "psl_b.nc"))):
        for name in names:
            shift = 0 if "anom" in name else 100
            save(tree / model / "r1" / "monthly" / name, shift + rng.normal(size=(24, 2, 2)), name[:3], lat, lon)
    p = lambda n: str(tmp_path / n)
    main(["inputs", "--root", p("tree"), "--vars", "tos,psl", "--out", p("strict")])
    assert "missing psl" in capsys.readouterr().out
    assert {r["model"] for r in spark.read.parquet(p("strict")).select("model").distinct().collect()} == {"A"}
    main(["inputs", "--root", p("tree"), "--vars", "tos,psl", "--raw", "--out", p("loose")])
    assert "psl_b.nc" in capsys.readouterr().out
    both = spark.read.parquet(p("loose"))
    assert both.count() == 2 * 24 * 4 and both.where("abs(tos) > 50").count() == 0 and both.where("psl > 50").count() == 96
    main(["target", "--root", p("tree"), "--raw", "--out", p("target"), "--period-mode", "tos"])
    assert spark.read.parquet(p("target")).count() == 48


def test_daily_names_are_checked_against_folders(spark, tmp_path, capsys):
    rng = np.random.default_rng(3)
    folder = tmp_path / "historical" / "M" / "r1i1p1f1" / "daily"
    lat, lon = np.linspace(-10, 10, 6), np.linspace(180, 250, 8)
    save(folder / "uas_day_M_historical_r1i1p1f1_gn_time.nc", rng.normal(size=(24, 6, 8)), "uas", lat, lon)
    save(folder / "uas_day_M_historical_r2i1p1f1_gn_time.nc", 50 + rng.normal(size=(24, 6, 8)), "uas", lat, lon)
    main(["uasmax", "--source", "cmip6", "--root", str(tmp_path), "--out", str(tmp_path / "out")])
    assert "member folder mismatch" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "out")).where("abs(value) > 20").count() == 0


def test_split_command(spark, tmp_path, make_field):
    rng = np.random.default_rng(4)
    lat, lon = [-8.0, 0, 8], [190.0, 210, 230]
    p = lambda n: str(tmp_path / n)
    from halocline.schema import TargetGrid
    t = TargetGrid()
    grid = [t.lat0 + i * t.dlat for i in (55, 56)], [t.lon0 + i * t.dlon for i in (100, 101)]
    for name, n, start, var, where in (("held", 24, 2000, "tos", (lat, lon)), ("added", 24, 2002, "tos", (lat, lon)), ("air", 60, 2000, "psl", None),
                                       ("sea", 24, 2005, "tos", grid), ("air2", 24, 2005, "psl", grid)):
        if where is None:
            df = make_field(rng.normal(size=(n, 1, 1)), var=var, start=start).withColumns({"iy": F.lit(60), "ix": F.lit(105)})
        else:
            df = make_field(rng.normal(size=(n, len(where[0]), len(where[1]))), *where, var=var, start=start)
        df.write.parquet(p(name))
    spark.createDataFrame([(month(i, 2004), 1.0) for i in range(40)], "time timestamp_ntz, nino34 double").write.parquet(p("index"))
    main(["split", "--ocean-held", p("held"), "--ocean-added", p("added"), "--validation-atmosphere", p("air"), "--test-ocean", p("sea"),
          "--test-atmosphere", p("air2"), "--test-index", p("index"), "--vars", "tos,psl", "--validation", "2000-01,2003-12",
          "--test", "2005-01,2006-12", "--out", p("out")])
    assert spark.read.parquet(p("out") + "/validation_input").count() == 48
    assert spark.read.parquet(p("out") + "/test_target").count() == 24


def test_overview_command(spark, tmp_path):
    d = tmp_path / "configs/experiments/a"
    d.mkdir(parents=True)
    (d / "a.yaml").write_text("experiment_name: a\n")
    main(["overview", "--root", str(tmp_path), "--out", str(tmp_path / "report")])
    lines = [r[0] for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert "| a |  |  |  |  | `` | `configs/experiments/a/a.yaml` |" in lines and month(0).year == 2000


def test_netcdf_export_with_attributes(spark, tmp_path):
    """Units and coordinate attributes of the input stand in the output; stale and foreign ones are gone."""
    from halocline.schema import column_attrs
    from halocline.sources.netcdf import open_file
    z = [5.0, 400.0]
    temp = np.full((14, 2, 2, 2), 10.0)
    save(tmp_path / "temp.nc", temp, "temp", lev=z, attrs={"units": "degC", "standard_name": "sea_water_temperature", "valid_min": 1.0})
    p = lambda n: str(tmp_path / n)
    main(["surface", "--root", p("temp.nc"), "--var", "temp", "--out", p("surf"), "--netcdf", p("nc")])
    meta = column_attrs(spark.read.parquet(p("surf")))["value"]
    assert meta["units"] == "degC" and "valid_min" not in meta
    name = spark.read.parquet(p("surf")).first()["var"]
    assert sorted(f.name for f in (tmp_path / "nc").iterdir()) == [f"{name}.surface.2000.nc", f"{name}.surface.2001.nc"]
    v = open_file(p(f"nc/{name}.surface.2001.nc")).variables
    assert v[name].shape == (2, 2, 2) and v[name].attrs["units"] == "degC" and "valid_min" not in v[name].attrs
    main(["ohc", "--root", p("temp.nc"), "--var", "temp", "--out", p("ohc"), "--netcdf", p("nc2"), "--netcdf-span", "all"])
    v = open_file(p("nc2/ohc300.ohc.all.nc")).variables["ohc300"]
    assert v.attrs["units"] == "J m-2" and "standard_name" not in v.attrs and len(v.shape) == 3


def test_append_periods(spark, make_field, tmp_path):
    """Two periods appended by command; the second one's anomalies are those of the whole field."""
    from fields import to_cube
    from halocline.operators import series
    from halocline.sources.store import read_field, write_field
    p = lambda n: str(tmp_path / n)
    cube = np.random.default_rng(5).normal(size=(40, 2, 3)).astype("f4").astype(float)
    field = make_field(cube)
    cut = F.lit(month(24)).cast("timestamp_ntz")
    write_field(field.where(F.col("time") < cut), p("a"))
    write_field(field.where(F.col("time") >= cut), p("b"))
    for name in "ab":
        main(["append", "--fields", p(name), "--state", p("state"), "--period", name, "--out", p("out-" + name)])
    want = to_cube(series.anomaly(field, ["var"]))[24:]
    np.testing.assert_allclose(to_cube(read_field(spark, p("out-b"))), want, atol=1e-6)
