import numpy as np
import pytest
from fields import month
from pyspark.sql import functions as F

from halocline.functions import seawater as sw
from halocline.operators import axis, checks, vertical
from halocline.plans import columns as C

SCHEMA = ("var string, time timestamp_ntz, iy int, ix int, lat double, lon double, lev double, lev_idx int, "
          "temp double, salt double, value double")


def profile(spark, z, columns, time=0):
    """One grid cell per column of (temp, salt) lists."""
    nul = lambda v: None if v is None or np.isnan(v) else float(v)
    rows = [
        ("t", month(time), 0, x, 0.0, float(x), float(z[k]), k, nul(t[k]), nul(s[k]), nul(t[k]))
        for x, (t, s) in enumerate(columns) for k in range(len(z))
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_published_check_values(spark):
    sa = [34.7118, 34.8915, 35.0256, 34.8472, 34.7366, 34.7324]
    ct = [28.8099, 28.4392, 22.7862, 10.2262, 6.8272, 4.3236]
    pt = [28.7832, 28.4209, 22.7850, 10.2305, 6.8292, 4.3245]
    df = spark.createDataFrame(list(zip(range(6), sa, ct, pt)), "i int, sa double, ct double, pt double")
    out = df.select("i", sw.sigma0(F.col("sa"), F.col("ct")).alias("s"),
                    sw.conservative_temperature(F.col("sa"), F.col("pt")).alias("c")).orderBy("i").toPandas()
    np.testing.assert_allclose(out["s"], [21.797900819337656, 22.052215404397316, 23.892985307893923,
                                          26.667608665972011, 27.107380455119710, 27.409748977090885], atol=1e-10)
    np.testing.assert_allclose(out["c"], [28.809923015982083, 28.439144260767169, 22.786246608464264,
                                          10.226165605435785, 6.827183417643142, 4.323565182322069], atol=1e-10)


def test_staged_density_equals_the_expressions(spark):
    df = spark.createDataFrame([(35.0, 20.0), (0.0, 5.0), (33.3, -1.0)], "s double, t double")
    staged = sw.with_sigma0(df, "s", "t", "rho").toPandas()["rho"]
    sa = sw.absolute_salinity(F.col("s"))
    direct = df.select(sw.sigma0(sa, sw.conservative_temperature(sa, F.col("t"))).alias("rho")).toPandas()["rho"]
    np.testing.assert_allclose(staged, direct, atol=1e-12)


def mld_numpy(z, rho, ref=10.0, delta=0.03):
    ok = np.isfinite(rho)
    z, rho = z[ok], rho[ok]
    if len(z) < 2 or ref <= z.min() or ref >= z.max():
        return np.nan
    d = rho - (np.interp(ref, z, rho) + delta)
    hit = np.where(d >= 0)[0]
    if not len(hit):
        return np.nan
    i = hit[0]
    if i == 0 or d[i] == d[i - 1]:
        return z[i]
    return z[i - 1] - d[i - 1] * (z[i] - z[i - 1]) / (d[i] - d[i - 1])


def raw_density(df, salinity, temperature, out):
    """Takes the salinity column as density itself."""
    return df.withColumn(out, F.col(salinity))


def test_mixed_layer_matches_direct_search(spark):
    rng = np.random.default_rng(6)
    z = np.array([5, 10, 15, 40, 90.0])
    cols = []
    for _ in range(150):
        rho = np.cumsum(rng.normal(0.02, 0.05, 5)).astype("f4").astype(float)
        rho[rng.random(5) < 0.3] = np.nan
        cols.append((np.zeros(5), rho))
    out = vertical.mixed_layer_depth(profile(spark, z, cols), ["var"], density=raw_density).toPandas()
    got = out.sort_values("ix")["mld"].to_numpy(float)
    want = np.array([mld_numpy(z, rho) for _, rho in cols])
    assert np.isfinite(want).sum() > 30 and np.isnan(want).sum() > 30
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_mixed_layer_search_starts_at_the_top(spark):
    z, rho = np.array([5, 20, 50.0]), np.array([30.0, 20.0, 21.0])
    out = vertical.mixed_layer_depth(profile(spark, z, [(rho * 0, rho)]), ["var"], density=raw_density)
    assert out.collect()[0]["mld"] == 5.0


def test_mixed_layer_needs_the_reference_inside(spark):
    for z in ([10.0, 20.0], [2.0, 10.0], [12.0, 20.0]):
        out = vertical.mixed_layer_depth(
            profile(spark, np.array(z), [([0, 0], [20.0, 25.0])]), ["var"], density=raw_density)
        assert out.collect()[0]["mld"] is None
    deep = profile(spark, np.array([5, 20, 1200.0]), [([0] * 3, [20.0, 20.0, 30.0])])
    assert vertical.mixed_layer_depth(deep, ["var"], density=raw_density).collect()[0]["mld"] is None


def test_mixed_layer_kelvin_and_centimetres(spark):
    z = np.array([5, 20, 60.0])
    t, s = np.array([20.0, 19.5, 10]), np.array([35.0, 35, 35])
    base = profile(spark, z, [(t, s)])
    temp = base.withColumn("value", F.col("temp") + 273.15).withColumn("lev", F.col("lev") * 100)
    salt = base.withColumn("value", F.col("salt")).withColumn("lev", F.col("lev") * 100)
    got = C.mixed_layer_job(
        temp.withColumn("d", F.lit(1)), salt.withColumn("d", F.lit(1)), ["d"], temp_units="K", depth_units="cm")
    want = vertical.mixed_layer_depth(base, ["var"]).collect()[0]["mld"]
    assert got.collect()[0]["value"] == pytest.approx(want, abs=1e-3)


def test_mixed_layer_refuses_misaligned_fields(spark):
    base = profile(spark, np.array([5.0, 20]), [([1, 1], [1, 1])]).withColumn("d", F.lit(1))
    with pytest.raises(checks.CheckFailed):
        C.mixed_layer_job(base, base.where("lev_idx = 0"), ["d"])


def test_edges(spark):
    df = spark.createDataFrame([("a", z) for z in (5.0, 15.0, 40.0)] + [("b", 7.0)], "var string, lev double")
    got = {(r["var"], r["lev"]): (r["z_lo"], r["z_hi"]) for r in axis.level_axis(df, ["var"]).collect()}
    assert got == {("a", 5.0): (0, 10), ("a", 15.0): (10, 27.5), ("a", 40.0): (27.5, 52.5), ("b", 7.0): (0, 7)}


def test_thickness_adds_up(spark):
    df = spark.createDataFrame([("a", z) for z in (5.0, 100.0, 250.0, 500.0)], "var string, lev double")
    assert vertical.layer_thickness(df, ["var"]).agg(F.sum("dz")).collect()[0][0] == 300.0


def test_heat_content_missing_layers(spark):
    z = np.array([50.0, 150, 250])
    cols = [([1.0, 2, 3], [0] * 3), ([1.0, None, 3], [0] * 3), ([None] * 3, [0] * 3)]
    df = profile(spark, z, cols)
    k = 1025.0 * 3992.0
    got = [r["ohc"] for r in vertical.heat_content(df, ["var"]).orderBy("ix").collect()]
    assert got[:2] == pytest.approx([600 * k, 400 * k]) and got[2] is None


def test_shallow_mask_looks_at_the_first_step_only(spark):
    z = np.array([50.0, 150, 250])
    first = profile(spark, z, [([1.0, 1, 1], [0] * 3), ([1.0, 1, None], [0] * 3)], 0)
    later = profile(spark, z, [([1.0, 1, None], [0] * 3), ([1.0, 1, 1], [0] * 3)], 1)
    out = vertical.heat_content(first.union(later), ["var"], mask_shallow=True).toPandas()
    assert out[out.ix == 0]["ohc"].notna().all() and out[out.ix == 1]["ohc"].isna().all()


def test_surface_keeps_a_missing_top(spark):
    z = np.array([30.0, 5.0])
    df = profile(spark, z, [([1.0, None], [0, 0])])
    assert vertical.surface_level(df, ["var"]).collect()[0]["value"] is None
    assert vertical.first_level(df).collect()[0]["value"] == 1.0


def test_surface_job_converts_salt(spark):
    df = profile(spark, np.array([5.0, 10]), [([0.035, 1], [0, 0])]).withColumn("var", F.lit("salt"))
    df = df.drop("temp", "salt")
    row = C.surface_job(df, ["var"], units=" KG/KG ").collect()[0]
    assert row["var"] == "sos" and row["value"] == pytest.approx(35.0)
    assert C.surface_job(df, ["var"], units="g/kg").collect()[0]["value"] == pytest.approx(0.035)


def test_heat_content_job_kelvin_rule(spark):
    df = profile(spark, np.array([150.0]), [([274.15], [0])])
    kelvin = C.heat_content_job(df, ["var"], "K").collect()[0]["value"]
    loose = C.heat_content_job(df, ["var"], "degrees kelvin").collect()[0]["value"]
    assert kelvin == pytest.approx(150 * 1025.0 * 3992.0) and loose > kelvin * 200


def test_auxiliary_columns_go_along(spark):
    df = profile(spark, [5.0, 15, 400], [([9, 8, 7], [34, 34.5, 36]), ([9, 8, 7], [34, 34.5, 36])]).withColumn(
        "basin", F.concat(F.lit("b"), F.col("ix")))
    outs = (
        vertical.surface_level(df, ["var"], "temp", carry=["basin"]),
        vertical.heat_content(df, ["var"], "temp", carry=["basin"]),
        vertical.mixed_layer_depth(df, ["var"], carry=["basin"]),
    )
    for out in outs:
        assert {(r["ix"], r["basin"]) for r in out.collect()} == {(0, "b0"), (1, "b1")}
