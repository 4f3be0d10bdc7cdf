import zipfile

import pytest
from pyspark.sql import functions as F

from halocline.functions import calendar as cal, names as N, numeric as num
from halocline.schema import (
    VAR_ORDER, canonical_coords, depth_column, find_time_column, main_variable, order_variables, plottable,
    resolve_alias, drop_spatial_bounds, drop_stale_attrs,
)
from halocline.sources import catalog, configs, downloads


def test_main_variable_rules_differ():
    assert main_variable(["TOS", "x"], "tos") == "TOS"
    assert main_variable(["a_tos_b", "time_bnds"], "tos") == "a_tos_b"
    assert main_variable(["x", "lat_bnds"], "tos") == "x"
    with pytest.raises(ValueError):
        main_variable(["x", "y"], "tos")
    # a sole column wins over a look-alike only in the target rule
    assert main_variable(["anything"], "tos", "target") == "anything"
    with pytest.raises(ValueError):
        main_variable(["x", "lat_bnds"], "tos", "target")
    assert main_variable(["x", "y"], "uas", "daily", {"x": 5, "y": 9}) == "y"
    assert main_variable(["x", "y"], "uas", "daily") == "x"
    assert main_variable(["x", "uas"], "uas", "daily", {"x": 5}) == "uas"


def test_aliases_fall_back_to_the_first_column():
    assert resolve_alias(["t", "u10"], ("uas", "u10")) == "u10"
    assert resolve_alias(["msl"], ("psl",)) == "msl"


def test_coordinates_by_name_then_attributes(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "valid_time int, latitude double, nav_lon double")
    assert canonical_coords(df).columns == ["time", "lat", "lon"]
    loud = spark.createDataFrame([(1, 2.0, 3.0)], "month int, LATITUDE double, LONGITUDE double")
    assert canonical_coords(loud).columns == ["time", "lat", "lon"]
    assert find_time_column(["when", "v"], {"when": {"units": "days since 1950-01-01"}}) == "when"
    assert find_time_column(["a"], {"a": {"axis": "t"}}) == "a"


def test_depth_rules():
    assert depth_column(["t", "olevel"]) == "olevel"
    assert depth_column(["t", "k"], {"k": {"units": "metres"}}) == "k"
    with pytest.raises(ValueError):
        depth_column(["t", "k"], {"k": {"units": "months"}})
    attrs = {"k": {"units": "months"}, "d": {"axis": "Z"}}
    assert depth_column(["k"], {"k": attrs["k"]}, "scored") == "k"
    assert depth_column(["k", "d"], attrs, "scored") == "d"


def test_column_helpers(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "v double, lat_bnds double, i_vertex double")
    assert drop_spatial_bounds(df).columns == ["v"]
    meta = df.withMetadata("v", {"valid_range": "0 1", "units": "m"})
    assert drop_stale_attrs(meta, "v").schema["v"].metadata == {"units": "m"}
    assert order_variables(["zz", "psl", "tos", "aa"]) == ["tos", "psl", "aa", "zz"]
    assert plottable(["time", "lat", "lon", "iy", "ix", "psl", "tos"]) == ["tos", "psl"]
    with pytest.raises(ValueError):
        plottable(["time", "lat", "lon"], wanted=["tos"])


def names(spark, *items):
    return spark.createDataFrame([(f"/d/{n}", n) for n in items], "path string, name string")


def test_preference_order(spark):
    df = names(spark, "tos.nc", "tos.195801-197812.nc", "tos.1980-2025.anom_1x2.nc", "tos.a.anom_1x2.nc",
               "tos.195801-198812.anom_1x2.nc", "tos.195801-197812.anom_1x2.nc", "zzz.anom_1x2.nc")
    ranked = [r["name"] for r in df.orderBy(N.preference(F.col("name"))).collect()]
    # the shorter period wins a tie by name
    assert ranked[:4] == ["tos.195801-197812.anom_1x2.nc", "tos.195801-198812.anom_1x2.nc",
                          "tos.1980-2025.anom_1x2.nc", "tos.a.anom_1x2.nc"]
    best = catalog.preferred_files(df, []).collect()
    assert [(r["var"], r["path"]) for r in best] == [("tos", "/d/tos.195801-197812.anom_1x2.nc")]
    raw = catalog.preferred_files(names(spark, "tos.1.nc", "tos.0.nc"), [], allow_raw=True).collect()[0]
    assert raw["path"] == "/d/tos.0.nc" and raw["is_raw"]
    assert catalog.preferred_files(names(spark, "tos.0.nc"), []).count() == 0


def test_name_functions(spark):
    row = names(spark, "uo_Omon_M_historical_r1i1p1f1_gn_time.nc").select(
        N.variable_of(F.col("name"), None).alias("a"), N.variable_of(F.col("name")).alias("b"),
        N.scenario_union_name(F.col("name")).alias("c"), N.replace_prefix(F.col("name"), "uo_", "uos_").alias("d"),
        N.contains_word(F.lit("A  MRI-ESM2-0"), F.lit("MRI-ESM2-0")).alias("e"),
        N.contains_word(F.lit("A MRI"), F.lit("MR")).alias("f"),
        N.target_file(F.lit("M"), F.lit("h"), F.lit("r1")).alias("g")).collect()[0]
    assert row["a"] == "uo" and row["b"] is None
    assert row["c"] == "uo_Omon_M_historical_ssp370_r1i1p1f1_gn_time.nc"
    assert row["d"].startswith("uos_Omon") and row["e"] and not row["f"] and row["g"] == "target_M_h_r1.nc"
    assert N.csv_items(" a, b,,a ") == ["a", "b"]


def test_daily_name(spark):
    def parts(name, model="M-1", member="r1i1p1f1"):
        return spark.range(1).select(N.daily_parts(F.lit(name), F.lit(model), F.lit(member)).alias("p")).collect()[0]["p"]
    ok = parts("uas_day_M-1_historical_ssp370_r1i1p1f1_gn_time.nc")
    assert (ok["exp"], ok["grid"], ok["problem"]) == ("historical_ssp370", "gn", None)
    assert parts("uas_day_X_h_r1i1p1f1_gn_time.nc")["problem"] == "model folder mismatch"
    assert parts("uas_day_M-1_h_r2i1p1f1_gn_time.nc")["problem"] == "member folder mismatch"
    assert parts("uas_day_M-1_h.nc")["problem"] == "unexpected tail"


def test_listing_groups(spark, tmp_path):
    def put(root, rel):
        p = tmp_path / root / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x")
    for rel in ("hist/M1/r1/monthly/tos_a.nc", "hist/M1/r1/monthly/notes.txt", "ssp/M2/r2/monthly/psl_b.nc",
                "hist/M1/r1/daily/uas_c.nc"):
        put("full", rel)
    put("short", "M1/r1/monthly/tos_a.nc")
    full = catalog.with_groups(catalog.list_files(spark, str(tmp_path / "full")))
    assert sorted((r["exp"], r["model"], r["member"]) for r in full.collect()) == [("hist", "M1", "r1"), ("ssp", "M2", "r2")]
    short = catalog.with_groups(catalog.list_files(spark, str(tmp_path / "short")), "only")
    assert [(r["exp"], r["model"]) for r in short.collect()] == [("only", "M1")]


def test_file_maps(spark):
    later = catalog.later_wins(
        spark.createDataFrame([("tos", "a"), ("sos", "b")], "var string, path string"),
        spark.createDataFrame([("tos", "c")], "var string, path string"), ["var"])
    assert {r["var"]: r["path"] for r in later.collect()} == {"tos": "c", "sos": "b"}
    last = catalog.last_match(names(spark, "tos.1.nc", "tos.2.nc", "tosx.9.nc", "tos.nc"), ["tos"])
    assert [r["path"] for r in last.collect()] == ["/d/tos.2.nc"]
    assert catalog.fixed_files("oras5", "x")["uos"] == "uos.x.nc"
    assert catalog.anomaly_name("soda", "uos", "SODA_uo.nc") == "uos.SODA_uo.anom_1x2.nc"
    assert catalog.anomaly_name("era5", "uas", "uas.mon.nc") == "uas.mon.anom_1x2.nc"


def test_period_files(spark):
    df = names(spark, *[f"v_{y}{m:02d}01.nc" for y in (1979, 1980) for m in range(1, 13)], "v_198101.nc")
    assert catalog.period_files(df, 1979, 1980).count() == 24
    with pytest.raises(FileNotFoundError):
        catalog.period_files(df, 1979, 1981)
    assert cal.month_tokens(spark, 1979, 1980).count() == 24
    assert downloads.incomplete_years(df).collect()[0]["year"] == "1981"


def test_calendar(spark):
    from datetime import datetime
    df = spark.createDataFrame([(datetime(2000, 2, 29, 23, 59),)], "t timestamp_ntz")
    row = df.select(cal.month_start("t").alias("m"), cal.days_in_month("t").alias("d"),
                    cal.within_months("t", "2000-02", "2000-02").alias("w"),
                    cal.within_months("t", "2000-03", None).alias("x")).collect()[0]
    assert row["m"] == datetime(2000, 2, 1) and row["d"] == 29 and row["w"] and not row["x"]
    assert df.select(cal.month_start("t")).schema[0].dataType.simpleString() == "timestamp_ntz"
    assert cal.tidy_months([3, 1, 3]) == [1, 3]
    with pytest.raises(ValueError):
        cal.tidy_months([13])


def test_level_spacing(spark):
    levels = spark.range(1).select(num.level_spacing(F.lit(10.0)).alias("l")).collect()[0]["l"]
    assert len(levels) == 21 and levels[0] == -10 and levels[10] == 0 and levels[-1] == 10


ONE = """experiment_name: run_a
run_name: run_a

model:
  name: net_a

data:
  cache_namespace: 10vars
  validation:
    - name: period_one
    - name: period_two

output:
  run_dir: outputs/run_a
"""
TWO = (
    ONE.replace("run_a", "run_b").replace("experiment_name: run_b", "experiment_name: 'run_b'")
    .replace("    - name: period_two\n", "").replace("net_a", '"net_b"  ')
)


def test_overview_report(spark, tmp_path):
    for name, text in (("b/two.yaml", TWO), ("a/one.yaml", ONE), ("a/skip.txt", ONE)):
        p = tmp_path / "configs" / "experiments" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    found = configs.read_configs(spark, str(tmp_path / "configs/experiments/*/*.yaml"), str(tmp_path))
    lines = [r["value"] for r in configs.overview(configs.parse_configs(found)).collect()]
    assert lines == [
        "# Experiment Overview", "",
        "Active experiment configs live under `configs/experiments/` and are run from the project root.", "",
        "| Experiment | Run | Model | Validation | Cache | Output | Config |",
        "| --- | --- | --- | --- | --- | --- | --- |",
        "| run_a | run_a | net_a | period_one, period_two | 10vars | `outputs/run_a` | `configs/experiments/a/one.yaml` |",
        "| run_b | run_b | net_b | period_one | 10vars | `outputs/run_b` | `configs/experiments/b/two.yaml` |",
        "",
        "Archived configs under `configs/archive/` are intentionally excluded from this table.",
    ]


def test_model_name_only_inside_its_block(spark):
    text = "name: x\n  name: before\nmodel:\n\n  name: inside\ndata:\n  name: after\n"
    row = configs.parse_configs(spark.createDataFrame([("p", text)], "path string, text string")).collect()[0]
    assert row["model_name"] == "inside" and row["run_dir"] == "" and row["validation"] == ""


def test_file_kinds_and_archives(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    with zipfile.ZipFile(src / "two.zip", "w") as z:
        z.writestr("x/a.nc", b"CDF\x01aaaa")
        z.writestr("b.nc", b"CDF\x02bbbb")
        z.writestr("readme.txt", b"no")
    (src / "broken.zip").write_bytes(b"PK\x03\x04oops")
    (src / "n.zip").write_bytes(b"\x89HDF\r\n\x1a\n")
    listing = catalog.list_files(spark, str(src), "*.zip")
    kinds = {r["name"]: r["k"] for r in downloads.with_heads(listing).select(
        "name", downloads.file_kind(F.col("head")).alias("k")).collect()}
    assert kinds == {"two.zip": "zip", "broken.zip": "zip", "n.zip": "netcdf"}
    got = {r["path"].split("/")[-1]: r for r in downloads.extract_archives(listing, str(out)).collect()}
    assert len(got["two.zip"]["files"]) == 2 and got["two.zip"]["problem"] is None
    assert got["broken.zip"]["problem"] and sorted(p.name for p in out.iterdir()) == ["a.nc", "b.nc"]
    assert downloads.previews(listing).where("path like '%broken%'").collect()[0]["preview"].startswith("PK")
    one = downloads.extract_archives(listing, str(out), only_one=True).where("path like '%two.zip'").collect()[0]
    assert "found 2" in one["problem"]


def test_requests():
    assert downloads.daily_request("u", 2000, 2)["day"][-1] == "29"
    assert downloads.monthly_request("u", [1999], [2, 1])["month"] == ["01", "02"]
    assert downloads.ocean_request("zonal_velocity", 1958)["vertical_resolution"] == "all_levels"
    assert len(downloads.ocean_variables()) == 6 and len(downloads.ocean_variables("2d")) == 4
    with pytest.raises(ValueError):
        downloads.ocean_variables(wanted=["x"])
    assert downloads.monthly_name("u", [1958, 1960], [1, 12]) == "ERA5_monthly_u_195801_196012"
    assert VAR_ORDER[0] == "tos" and len(VAR_ORDER) == 10


def test_first_existing_candidate(tmp_path):
    paths = [str(tmp_path / n) for n in ("a", "b", "c")]
    (tmp_path / "b").write_text("")
    (tmp_path / "c").write_text("")
    assert catalog.first_existing(None, paths, "target") == paths[1] and catalog.first_existing("x", paths, "target") == "x"
    with pytest.raises(FileNotFoundError, match="target not found; tried: .*a"):
        catalog.first_existing(None, paths[:1], "target")


def test_absent_months_are_named(spark):
    names = [f"x.{y}{m:02d}.nc" for y in (1980, 1981) for m in range(1, 13) if (y, m) not in ((1980, 3), (1981, 12))]
    listing = spark.createDataFrame([(n,) for n in names], "name string")
    with pytest.raises(FileNotFoundError, match="found 22; first months without one: 198003, 198112"):
        catalog.period_files(listing, 1980, 1981)
