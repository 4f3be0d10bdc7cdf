"""The NetCDF scan's plan and axes, and the sink's commit."""
import os
from datetime import datetime

import numpy as np
import pytest
from fields import to_cube
from pyspark.sql import functions as F
from test_storage_jobs import save

from halocline.schema import axis_score, best_axis, carry_attrs, column_attrs
from halocline.sources import netcdf
from halocline.sources.netcdf import FieldWriter, read_netcdf, time_extent, write_classic, write_netcdf


def odd_file(path, cube, order=("bar", "foo")):
    """Axes named ``foo``, ``bar``, ``when`` and ``down``, told only by their attributes."""
    nt, nz, ny, nx = cube.shape
    sizes = {"foo": nx, "bar": ny, "down": nz, "when": nt}
    dims = ("when", "down", *order)
    at = ["when", "down", "bar", "foo"]
    write_classic(str(path), sizes, {
        "foo": (("foo",), np.arange(nx, dtype="f8") * 10, {"units": "degrees_east"}),
        "bar": (("bar",), np.arange(ny, dtype="f8"), {"standard_name": "latitude", "long_name": "row"}),
        "down": (("down",), np.arange(nz, dtype="f8") + 5, {"axis": "Z", "units": "m"}),
        "when": (("when",), np.arange(nt, dtype="f8") * 31, {"units": "days since 2000-01-01"}),
        "heat": (dims, cube.transpose([at.index(d) for d in dims]).astype("f4"), {"units": "J"}),
    }, {})


@pytest.mark.parametrize("order", [("bar", "foo"), ("foo", "bar")])
def test_axes_told_by_attributes(spark, tmp_path, order):
    cube = np.arange(2 * 3 * 2 * 4, dtype=float).reshape(2, 3, 2, 4)
    odd_file(tmp_path / "odd.nc", cube, order)
    got = read_netcdf(spark, str(tmp_path / "odd.nc"), "heat").toPandas().set_index(["step", "lev_idx", "iy", "ix"])
    assert len(got) == cube.size and got["time"].notna().all()
    for at in ((0, 0, 0, 0), (1, 2, 1, 3), (0, 1, 1, 0)):
        row = got.loc[at]
        assert row["value"] == cube[at] and (row["lat"], row["lon"], row["lev"]) == (at[2], at[3] * 10, at[1] + 5)
    one = read_netcdf(spark, str(tmp_path / "odd.nc"), "heat").where("lev = 6 and step = 1")
    assert sorted(r.value for r in one.collect()) == cube[1, 1].ravel().tolist()


def test_axis_points():
    assert best_axis("lat", {"y": {"units": "m"}, "gphit": {"standard_name": "latitude"}}) == "gphit"
    assert best_axis("lat", {"latitude": {}, "b": {"standard_name": "latitude", "units": "degrees_north"}}) == "latitude"
    assert best_axis("time", {"a": {"units": "days since 1950-01-01"}, "b": {"axis": "T", "standard_name": "time"}}) == "b"
    assert best_axis("lev", {"k": {}}) is None and axis_score("lev", {"AXIS": "z", "long_name": "Depth"}) == 9


def test_the_driver_opens_no_file(tmp_path, monkeypatch):
    """Partitions come from the listing, or from an index that tasks made."""
    cube = np.zeros((24, 1, 2))
    for year in (2000, 2002):
        save(tmp_path / f"{year}.nc", cube, start=year)
    chunks = [c for y in (2000, 2002) for c in netcdf.chunks_of(str(tmp_path / f"{y}.nc"), "tos", "predictor", True, 12)[0]]
    monkeypatch.setattr(netcdf, "open_file", lambda path: pytest.fail("a header was opened"))
    assert len(netcdf.FieldReader({"path": str(tmp_path), "variable": "tos"}).partitions()) == 2
    reader = netcdf.FieldReader({"path": str(tmp_path), "chunks": netcdf.packed(chunks), "tasks": "100"})
    assert len(reader.partitions()) == 4
    reader = netcdf.FieldReader({"path": str(tmp_path), "chunks": netcdf.packed(chunks), "tasks": "2"})
    assert [len(t.chunks) for t in reader.partitions()] == [2, 2]
    from pyspark.sql.datasource import EqualTo, GreaterThan
    reader.bounds = {"time": [("ge", datetime(2003, 2, 1)), ("lt", datetime(2003, 3, 1))]}
    assert [c.path[-7:] for t in reader.partitions() for c in t.chunks] == ["2002.nc"]
    reader = netcdf.FieldReader({"path": str(tmp_path), "chunks": netcdf.packed(chunks)})
    list(reader.pushFilters([GreaterThan(("step",), 11), EqualTo(("lev_idx",), 0)]))
    assert [c.first for t in reader.partitions() for c in t.chunks] == [12, 12]


def test_one_month_is_one_task(spark, tmp_path):
    for year in range(2000, 2006):
        save(tmp_path / f"{year}.nc", np.full((12, 2, 2), float(year)), start=year)
    df = read_netcdf(spark, str(tmp_path), "tos", chunkSteps=6)
    assert df.rdd.getNumPartitions() == 12
    month = df.where("time >= timestamp_ntz'2003-07-01' and time < timestamp_ntz'2003-08-01'")
    assert month.rdd.getNumPartitions() == 1 and [r.value for r in month.collect()] == [2003.0] * 4
    assert df.where("lev_idx = 1").count() == 0


def test_a_file_without_index_is_cut_by_its_size(spark, tmp_path, monkeypatch):
    save(tmp_path / "a.nc", np.arange(20.0).reshape(5, 2, 2))
    reader = netcdf.FieldReader({"path": str(tmp_path / "a.nc"), "variable": "tos"})
    monkeypatch.setattr(netcdf, "TASK_ROWS", 50)
    parts = reader.partitions()
    values = [v for p in parts for b in reader.read(p) for v in b.column("value").to_pylist()]
    assert len(parts) > 2 and values == [float(i) for i in range(20)]


def test_extent_from_headers(spark, tmp_path):
    save(tmp_path / "a.nc", np.zeros((14, 1, 1)))
    save(tmp_path / "b.nc", np.zeros((3, 1, 1)), start=1990)
    got = {os.path.basename(r.path): r for r in time_extent(spark, str(tmp_path), "tos").collect()}
    assert got["a.nc"].first_time == datetime(2000, 1, 15) and got["a.nc"].last_time == datetime(2001, 2, 15)
    assert got["b.nc"].n_steps == 3


def test_attributes_shared_by_all_files_are_column_metadata(spark, tmp_path):
    save(tmp_path / "a.nc", np.zeros((1, 1, 1)), attrs={"units": "K", "valid_min": 1.0, "comment": "a"})
    save(tmp_path / "b.nc", np.zeros((1, 1, 1)), attrs={"units": "K", "valid_min": 1.0, "comment": "b"}, start=2001)
    df = read_netcdf(spark, str(tmp_path), "tos")
    meta = column_attrs(df)["value"]
    assert meta["units"] == "K" and "comment" not in meta and "valid_min" in meta
    out = carry_attrs(df.groupBy("time").agg(F.max("value").alias("value")), df, {"value": {"long_name": "largest"}})
    assert column_attrs(out)["value"] == {"units": "K", "long_name": "largest", "_FillValue": meta["_FillValue"]}
    assert "since" in column_attrs(out)["time"]["units"]


def test_sink_round_trip_with_levels_names_and_attributes(spark, tmp_path):
    cube = np.arange(2 * 3 * 2 * 4, dtype=float).reshape(2, 3, 2, 4)
    odd_file(tmp_path / "in.nc", cube)
    df = read_netcdf(spark, str(tmp_path / "in.nc"), "heat").withColumn("model", F.lit("M"))
    write_netcdf(df, str(tmp_path / "out"), ("model", "var"), span="all", name="{model}/{var}_{span}", attrs={"title": "t"})
    path = tmp_path / "out" / "M" / "heat_all.nc"
    nc = netcdf.open_file(str(path))
    assert nc.attrs["title"] == "t" and nc.variables["heat"].attrs["units"] == "J"
    assert nc.variables["lev"].attrs["axis"] == "Z" and nc.variables["lat"].attrs["standard_name"] == "latitude"
    back = read_netcdf(spark, str(path), "heat").select("time", "lev", "iy", "ix", "lat", "lon", "value")
    assert sorted(back.collect()) == sorted(df.select(*back.columns).collect())


def test_sink_keeps_curvilinear_positions(spark, tmp_path):
    lat2, lon2 = np.meshgrid([10.0, 20], [1.0, 2, 3], indexing="ij")
    save(tmp_path / "c.nc", np.arange(6.0).reshape(1, 2, 3), "sos", lat2 + 0.5 * lon2, lon2, names=("time", "nav_lat", "nav_lon"))
    df = read_netcdf(spark, str(tmp_path / "c.nc"), "sos")
    write_netcdf(df, str(tmp_path / "out"), span="year")
    back = read_netcdf(spark, str(tmp_path / "out"), "sos").select("iy", "ix", "lat", "lon", "value")
    assert sorted(back.collect()) == sorted(df.select(*back.columns).collect())


def test_a_failed_write_leaves_nothing(spark, make_field, tmp_path):
    """One task fails after others have written; the old file and nothing else is there."""
    folder = tmp_path / "out"
    write_netcdf(make_field(np.zeros((1, 1, 2))), str(folder), span="all")
    broken = make_field(np.ones((24, 1, 2))).withColumn(
        "value", F.when(F.col("time") == F.lit("2001-12-01").cast("timestamp_ntz"), F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        write_netcdf(broken, str(folder), span="month")
    assert [p.name for p in folder.iterdir()] == ["tos.all.nc"]
    assert to_cube(read_netcdf(spark, str(folder), "tos")).max() == 0


def test_commit_takes_only_the_attempts_that_count(make_field, tmp_path):
    writer = FieldWriter({"path": str(tmp_path / "o"), "span": "all"})
    batches = make_field(np.ones((2, 1, 2))).withColumn("span", F.lit("all")).toArrow().to_batches()
    lost, kept = writer.write(iter(batches)), writer.write(iter(batches))  # the first attempt's executor is gone
    assert lost.files[0][0] != kept.files[0][0] and not (tmp_path / "o" / "tos.all.nc").exists()
    writer.commit([kept, None])
    assert [p.name for p in (tmp_path / "o").iterdir()] == ["tos.all.nc"]
    twice = FieldWriter({"path": str(tmp_path / "o"), "span": "all"})
    with pytest.raises(ValueError, match="several tasks"):
        twice.commit([twice.write(iter(batches)), twice.write(iter(batches))])
    twice.abort([])
    assert [p.name for p in (tmp_path / "o").iterdir()] == ["tos.all.nc"]
