import numpy as np
import pytest
from fields import month
from pyspark.sql import functions as F

from halocline.operators import checks, merge, stats


def two(make_field, a, b, start_b=2000, **kw):
    return make_field(a, var="tos", **kw).unionByName(make_field(b, var="psl", start=start_b, **kw))


def test_merge_keeps_the_time_intersection_and_missing_values(make_field):
    a, b = np.ones((24, 1, 2)), np.full((24, 1, 2), 2.0)
    a[13, 0, 0] = np.nan
    out = merge.merge_fields(two(make_field, a, b, start_b=2001), (), ("tos", "psl"))
    assert out.count() == 24 and out.select("time").distinct().count() == 12
    assert out.columns == ["time", "iy", "ix", "lat", "lon", "tos", "psl"]
    assert out.where("tos is null").count() == 1


def test_merge_fill_modes(make_field):
    nan = np.full((1, 1, 1), np.nan)
    df = two(make_field, nan, nan)
    got = {m: merge.merge_fields(df, (), ("tos", "psl"), fill=m).select("tos", "psl").collect()[0]
           for m in ("none", "ocean", "all")}
    assert tuple(got["none"]) == (None, None)
    assert tuple(got["ocean"]) == (0.0, None)
    assert tuple(got["all"]) == (0.0, 0.0)
    with pytest.raises(ValueError):
        merge.merge_fields(df, (), ("tos",), fill="some")


def test_merge_joins_on_indices_not_on_noisy_coordinates(make_field):
    a = make_field(np.ones((1, 1, 2)), lon=[10, 20], var="tos")
    b = make_field(np.ones((1, 1, 2)), lon=[10 + 1e-9, 20], var="psl")
    assert merge.merge_fields(a.unionByName(b), (), ("tos", "psl")).count() == 2
    assert merge.grid_mismatch(a, b).count() == 0
    assert merge.grid_mismatch(a, b.withColumn("lat", F.col("lat") + 1)).count() == 2
    fixed = merge.harmonise_coords(b, a).orderBy("ix").collect()
    assert fixed[0]["lon"] == 10.0


def test_merge_is_one_exchange(make_field):
    df = two(make_field, np.ones((2, 1, 1)), np.ones((2, 1, 1)))
    plan = merge.merge_fields(df, (), ("tos", "psl"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_window_must_be_covered(make_field):
    df = make_field(np.ones((12, 1, 1)))
    assert checks.time_slice(df, ["var"], "2000-03", "2000-12").count() == 10
    for window in (("1999-12", "2000-05"), ("2000-01", "2001-01")):
        with pytest.raises(checks.CheckFailed):
            checks.time_slice(df, ["var"], *window)


def test_repeats_and_order(spark, make_field):
    a = make_field(np.ones((3, 1, 1)))
    assert checks.repeated_steps(merge.union_in_time(a, a), ["var"]).count() == 3
    assert checks.repeated_steps(a, ["var"]).count() == 0
    axis = spark.createDataFrame([("v", i, month(m)) for i, m in enumerate((0, 2, 2, 1))],
                                 "var string, t_idx int, time timestamp_ntz")
    assert sorted(r["t_idx"] for r in checks.unordered_steps(axis, ["var"]).collect()) == [2, 3]


def test_last_step_is_always_sampled(make_field):
    def picked(n, every):
        df = make_field(np.ones((n, 1, 1)))
        return sorted(r["t_idx"] for r in merge.sampled_steps(df, ["var"], every).collect())
    assert picked(8, 3) == [0, 3, 6, 7]
    assert picked(7, 3) == [0, 3, 6]


@pytest.mark.parametrize("n,accuracy", [(7, 10_000), (5_000, 200), (20_000, 1_000)])
def test_quantiles_are_exact(spark, n, accuracy):
    rng = np.random.default_rng(n)
    v = np.concatenate([rng.standard_cauchy(n), np.full(n // 3, 2.5)])  # heavy tails, one hot value
    df = spark.createDataFrame([("a", float(x)) for x in v], "var string, value double").repartition(5)
    probs = (0.0, 0.02, 0.37, 0.5, 0.98, 1.0)
    got = {r["p"]: r["quantile"] for r in stats.exact_quantiles(df, ["var"], probs, accuracy=accuracy).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(v, p), rel=1e-12, abs=1e-12)


def test_limits_fallbacks(spark):
    rows = [("zero", 0.0)] * 5 + [("none", None)] * 3 + [("spike", 0.0)] * 400 + [("spike", -7.0)]
    df = spark.createDataFrame(rows, "var string, value double")
    got = {r["var"]: (r["vmin"], r["vmax"]) for r in stats.symmetric_limits(df, ["var"]).collect()}
    assert got == {"zero": (-1, 1), "none": (-1, 1), "spike": (-7, 7)}


def test_limits_come_from_sampled_frames_only(make_field):
    cube = np.ones((7, 1, 1))
    cube[1] = 1000.0
    out = stats.frames(make_field(cube).withColumn("d", F.lit(1)), ["d"], every=3).toPandas()
    assert sorted(out["frame"]) == [0, 3, 6] and set(out["vmax"]) == {1.0}
    assert out.sort_values("frame")["label"].tolist()[0] == "2000-01-01"


def test_zscore_uses_population_std_and_a_floor(make_field):
    cube = np.array([1.0, 2, 4, 5])[:, None, None]
    out = stats.zscore(make_field(cube), ["var"]).toPandas().sort_values("time")["value"]
    np.testing.assert_allclose(out, (cube[:, 0, 0] - 3) / np.std(cube))
    flat = stats.zscore(make_field(cube * 0 + 3), ["var"]).toPandas()["value"]
    assert (flat == 0).all()


def test_zscore_with_other_statistics(make_field):
    train = stats.field_stats(make_field(np.array([0.0, 2])[:, None, None]), ["var"])
    out = stats.zscore(make_field(np.full((1, 1, 1), 3.0)), ["var"], stats=train).collect()
    assert out[0]["value"] == 2.0


def test_hot_cell_in_raw_rows(spark):
    """A third of all raw rows on one cell reduce map-side and give the right month."""
    from halocline.operators import series
    hot = spark.range(20_000).select(
        F.lit("v").alias("var"), F.lit(month(0)).cast("timestamp_ntz").alias("time"), F.lit(0).alias("iy"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("ix"),
        F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), F.col("id").cast("double").alias("value"))
    out = series.monthly(hot, ["var"], "max")
    assert out.where("ix = 0").collect()[0]["value"] == 19_998.0
    assert out._jdf.queryExecution().executedPlan().toString().count("partial_max") >= 1


def test_quantiles_with_heavy_tails(spark):
    """A few huge values stretch the range; the ends are exact and the inner ranks too."""
    rng = np.random.default_rng(6)
    v = np.concatenate([rng.normal(size=20_000), [1e12, -1e15, 3e14]])
    df = spark.createDataFrame([("g", float(x)) for x in v], "k string, value double")
    got = {r["p"]: r["quantile"] for r in stats.exact_quantiles(df, ["k"], (0.0, 0.001, 0.5, 0.999, 1.0), accuracy=1000).collect()}
    for p, q in got.items():
        assert q == pytest.approx(np.quantile(v, p), rel=1e-12)
    ends = stats.exact_quantiles(df, ["k"], (1.0,)).collect()
    assert [(r["p"], r["quantile"]) for r in ends] == [(1.0, 1e12 * 300)]
