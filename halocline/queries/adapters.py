"""The relational test tables read as gridded fields.

A supplier is a grid cell: suppliers are dealt to four ensemble members, and every
216 of a member fill a 12 x 18 grid (10 x 20 degrees), after which four more members
begin, so the number of cells grows with the data while each keeps about seven
observations a month.  The first cells lie at the equator.  Members differ in their time axis (later by a month each), in
their depths and in the longitudes of their grids.  Orders are placed on the same
cells by customer, fifteen customers to a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from halocline.functions.calendar import month_start
from halocline.operators.axis import densify
from halocline.schema import VAR_ORDER, TargetGrid

MEMBER = ["member"]
AT = ["member", "iy", "ix", "time"]
# Nodes of this grid never fall on source nodes.
COARSE = TargetGrid(lat0=-52.5, dlat=5.0, nlat=22, lon0=5.0, dlon=10.0, nlon=36)
DEPTHS = (5.0, 15.0, 40.0, 90.0, 160.0, 250.0, 400.0)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def on_cells(df: DataFrame, key: str) -> DataFrame:
    return df.withColumns({
        "member": F.expr(f"{key} % 4 + 4 * ({key} div 864)"),
        "iy": F.expr(f"int(({key} div 4 + 5) % 12)"),
        "ix": F.expr(f"int({key} div 48 % 18)"),
    })


def later(time: str) -> Column:
    """Members are months apart."""
    return F.expr(f"{time} + make_ym_interval(0, int(member % 4))")


def located(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "lat": F.lit(-55e0) + F.col("iy") * 10e0,
        "lon": F.lit(-170e0) + F.col("ix") * 20e0 + F.col("member") % 4 * 3e0,
    })


def exact_mean(amount: Column) -> Column:
    """Mean of two-decimal amounts, summed as whole cents: exact in any order."""
    return F.sum(F.round(amount * 100e0).cast("bigint")) / 100e0 / F.count(amount)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return on_cells(table(spark, sf, "lineitem"), "l_suppkey").withColumn("time", later("l_shipdate"))


def line_obs(spark: SparkSession, sf: str, amount: str = "l_extendedprice") -> DataFrame:
    """Monthly means per cell, only where observed."""
    return located(
        lines(spark, sf).groupBy("member", "iy", "ix", month_start("time").alias("time"))
        .agg(exact_mean(F.col(amount)).alias("value")))


def line_cells(spark: SparkSession, sf: str) -> DataFrame:
    return located(lines(spark, sf).select("member", "iy", "ix"))


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("_cell", F.expr("o_custkey div 15"))
    return on_cells(orders, "_cell")


def order_cells(spark: SparkSession, sf: str) -> DataFrame:
    return located(order_rows(spark, sf).select("member", "iy", "ix"))


def order_obs(spark: SparkSession, sf: str) -> DataFrame:
    return located(
        order_rows(spark, sf).groupBy(
            "member", "iy", "ix", month_start(later("o_orderdate")).alias("time"))
        .agg(exact_mean(F.col("o_totalprice")).alias("value")))


def line_cube(spark: SparkSession, sf: str, amount: str = "l_extendedprice") -> DataFrame:
    return densify(line_obs(spark, sf, amount), MEMBER)


def order_cube(spark: SparkSession, sf: str) -> DataFrame:
    return densify(order_obs(spark, sf), MEMBER)


def daily_wind(spark: SparkSession, sf: str) -> DataFrame:
    """Signed daily means per cell."""
    gust = F.round(F.col("l_extendedprice") * 100e0).cast("bigint") * (
        5 - F.round(F.col("l_discount") * 100e0).cast("bigint"))
    return located(
        lines(spark, sf).groupBy("member", "iy", "ix", F.col("time"))
        .agg((F.sum(gust) / 10000e0 / F.count("*")).alias("value")))


def field(df: DataFrame, var: str) -> DataFrame:
    return df.select(F.lit(var).alias("var"), *AT, "lat", "lon", "value")


def fields(spark: SparkSession, sf: str) -> DataFrame:
    """Three variables; psl covers fewer months than the others."""
    return (
        field(line_cube(spark, sf), "tos")
        .unionByName(field(line_cube(spark, sf, "l_quantity"), "sos"))
        .unionByName(field(order_cube(spark, sf), "psl"))
    )


def _depth() -> Column:
    depth = F.element_at(F.array(*[F.lit(d) for d in DEPTHS]), F.col("l_linenumber"))
    return depth * (1e0 + F.col("member") % 4 * 0.25e0)


def depth_table(spark: SparkSession, sf: str) -> DataFrame:
    """(member, lev) straight from the observations."""
    return lines(spark, sf).select("member", _depth().alias("lev")).distinct()


def profile(spark: SparkSession, sf: str) -> DataFrame:
    """Temperature and salinity columns with gaps, dense in time and depth."""
    obs = (
        lines(spark, sf)
        .groupBy("member", "iy", "ix", F.col("l_linenumber").alias("lev_idx"),
                 _depth().alias("lev"), month_start("time").alias("time"))
        .agg(exact_mean(F.col("l_quantity")).alias("_q"), exact_mean(F.col("l_discount")).alias("_d"))
    )
    obs = located(obs).select(
        *AT, "lat", "lon", (F.col("lev_idx") - 1).alias("lev_idx"), "lev",
        (28e0 - F.col("lev") * 0.06e0 + (F.col("_q") - 25e0) / 50e0).alias("temp"),
        (34e0 + F.col("lev") * 0.004e0 + (F.col("_d") - 0.05e0) * 4e0).alias("salt"),
    )
    return densify(obs, MEMBER, cell=("iy", "ix", "lev_idx"), values=("temp", "salt"),
                   coords=("lat", "lon", "lev"))


#: Width, first longitude and step of the grids of three models; the last one is regional.
MODEL_GRIDS = ((6, -170.0, 60.0), (8, 10.0, 45.0), (5, 102.0, 20.0))
ROUND = TargetGrid(lat0=-50.0, dlat=20.0, nlat=6, lon0=5.0, dlon=15.0, nlon=24)


def model_cube(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly means of orders as fields of three models, each on a grid of its own width."""
    def of_model(i: int) -> Column:
        return F.element_at(F.array(*[F.lit(g[i]) for g in MODEL_GRIDS]), F.expr("int(model + 1)"))

    rows = table(spark, sf, "orders").withColumn("model", F.expr("o_orderkey % 3"))
    rows = rows.withColumns({"iy": F.expr("int(o_orderkey div 3 % 4)"), "ix": F.expr("o_orderkey div 12") % of_model(0)})
    obs = rows.withColumn("ix", F.col("ix").cast("int")).groupBy(
        "model", "iy", "ix", F.date_trunc("year", "o_orderdate").cast("timestamp_ntz").alias("time")).agg(
            exact_mean(F.col("o_totalprice")).alias("value"))
    return densify(obs.withColumns({
        "lat": F.col("iy") * 30e0 - 45e0, "lon": of_model(1) + F.col("ix") * of_model(2)}), ["model"])


def files(spark: SparkSession, sf: str) -> DataFrame:
    """A file listing: every order names one file of some model, member and variable."""
    kinds = F.array(*[F.lit(v) for v in VAR_ORDER])
    base = table(spark, sf, "orders").select(
        F.concat(F.lit("MODEL"), F.expr("o_custkey div 15")).alias("model"),
        F.concat(F.lit("r"), F.expr("o_orderkey % 3 + 1"), F.lit("i1p1f1")).alias("member"),
        F.when(F.col("o_orderstatus") == "F", "historical").otherwise("ssp370").alias("exp"),
        F.element_at(kinds, F.expr("int(o_orderkey % 10 + 1)")).alias("kind"),
        F.date_format("o_orderdate", "yyyyMM").alias("_m"),
        F.date_format("o_orderdate", "yyyy").alias("_y"),
        "o_orderpriority", "o_orderdate",
    )
    kind, m, y = F.col("kind"), F.col("_m"), F.col("_y")
    p = F.col("o_orderpriority")
    return base.withColumn("name", (
        F.when(p == "1-URGENT", F.concat(kind, F.lit("."), m, F.lit("-"), m, F.lit(".anom_1x2.nc")))
        .when(p == "2-HIGH", F.concat(kind, F.lit("."), y, F.lit("-"), y, F.lit(".anom_1x2.nc")))
        .when(p == "3-MEDIUM", F.concat_ws("_", kind, "model", "exp", "member", F.lit("gn_time.anom_1x2.nc")))
        .when(p == "4-NOT SPECIFIED", F.concat(kind, F.lit("."), m, F.lit("-"), m, F.lit(".nc")))
        .otherwise(F.concat(F.lit("x"), kind, F.lit("_"), y, F.lit("-"), y, F.lit(".nc")))
    )).withColumn("path", F.concat_ws("/", "model", "member", F.lit("monthly"), "name"))


def config_texts(spark: SparkSession, sf: str) -> DataFrame:
    """One run configuration per customer: (path, text)."""
    cust = table(spark, sf, "customer").alias("c")
    nation = table(spark, sf, "nation")
    seg = F.lower("c_mktsegment")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("experiment_name: '"), "c_name", F.lit("'")),
        F.concat(F.lit('run_name: "'), seg, F.lit('_run"  ')),
        F.lit(""), F.lit("model:"), F.concat(F.lit("  name: "), F.lower("n_name")),
        F.lit(""), F.lit("data:"), F.concat(F.lit("  cache_namespace: vars_"), F.col("c_custkey")),
        F.lit("  name: not_the_model"), F.lit("  validation:"),
        F.concat(F.lit("    - name: first_"), F.col("c_nationkey")),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("    - name: second_"), seg)),
        F.lit(""), F.lit("output:"),
        F.concat(F.lit("  run_dir: outputs/"), F.col("c_custkey"), F.lit("/"), seg),
    )
    joined = cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.concat(F.lit("configs/"), F.col("c_custkey"), F.lit(".yaml")).alias("path"),
        text.alias("text"))
