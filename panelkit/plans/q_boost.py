"""Boosted trees of any depth, with one softmax model, whole tuning grids and attributions (ML-3, ML-5, ML-7, ML-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import calendar as cal
from panelkit.operators import boosting as bo
from panelkit.operators import evaluate as ev
from panelkit.operators import gradient as gr
from panelkit.plans.common import rounded, sig_sql
from panelkit.plans.registry import register, with_ctes
from panelkit.sources import testdata as td

X = ["load", "n_orders", "temp"]
#: The reference's grid in depths and column shares; its 100 and 200 rounds are 10 and 20 here, at the same settings otherwise.
GRID = {"rounds": (10, 20), "depths": (10, 15, 20, 25), "column_shares": (0.5, 0.6, 0.7, 0.8, 0.9)}

DAYS_SQL = """days AS (SELECT CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice) * 100) AS load, count(*) AS n_orders,
    abs(dayofyear(CAST(o_orderdate AS DATE)) - 190) + count(*) AS temp,
    CASE WHEN month(CAST(o_orderdate AS DATE)) IN (12, 1, 2) THEN 0 WHEN month(CAST(o_orderdate AS DATE)) IN (3, 4, 5) THEN 1
         WHEN month(CAST(o_orderdate AS DATE)) IN (6, 7, 8) THEN 2 ELSE 3 END AS season
  FROM orders GROUP BY CAST(o_orderdate AS DATE))"""


def days(spark: SparkSession, d: str) -> DataFrame:
    """One row a day: load in cents, orders, a stand-in for a temperature, season 0..3 and a fold of five."""
    day = F.to_date("o_orderdate")
    o = td.table(spark, d, "orders").groupBy(day.alias("date")).agg(
        F.round(F.sum("o_totalprice") * 100).alias("load"), F.count("*").alias("n_orders"))
    return o.withColumns({"temp": F.abs(F.dayofyear("date") - 190) + F.col("n_orders"),
                          "season": cal.season_code(F.month("date")) - 1,
                          "weekend": cal.weekend("date"), "fold": F.pmod(F.datediff("date", F.lit("1970-01-01")), F.lit(5))})


def sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    f = days(spark, d)
    return f.filter(F.year("date") < 2000), f.filter(F.year("date") >= 2000)


@register("ml3_deep_boosting")
def ml3_deep_boosting(spark: SparkSession, d: str) -> DataFrame:
    """50 rounds of trees of depth 50 on the daily load: errors of both sides, nodes and rows of the largest tree."""
    train, test = sides(spark, d)
    model = bo.fit_boosted(train, ["n_orders", "temp", "season", "weekend"], "load", [bo.Boost(rounds=50, depth=50, eta=0.3)])[0]
    scored = bo.predict(train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test"))), model)
    size = max((len(t[0].feature) for t in model.trees), default=0)
    return scored.groupBy("side").agg(F.sqrt(F.avg((F.col("load") - F.col("prediction")) ** 2)).alias("rmse"),
                                      F.count("*").alias("n")).withColumn("largest_tree", F.lit(size))


@register("ml5_softmax_boosting")
def ml5_softmax_boosting(spark: SparkSession, d: str) -> DataFrame:
    """Season from load as one model of four trees a round: confusion of the test side."""
    train, test = sides(spark, d)
    model = bo.fit_boosted(train, X, "season", [bo.Boost(rounds=20, depth=6, eta=0.1)], objective="softmax", classes=4)[0]
    p = bo.predict(test, model).select(F.col("season").alias("y"), F.col("prediction").cast("int").alias("p"))
    return ev.confusion(p, "y", "p")


# Cut points are the distinct 64-quantiles; a gradient is 1/4 less one for the own class, a Hessian 2 * 1/4 * 3/4.
@register("ml5_first_cuts", with_ctes(DAYS_SQL, """x AS (
  SELECT season, 0 AS f, CAST(load AS DOUBLE) AS v FROM days UNION ALL SELECT season, 1, n_orders FROM days UNION ALL SELECT season, 2, temp FROM days)""",
    """edges AS (SELECT DISTINCT f, v AS threshold FROM (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS r,
    count(*) OVER (PARTITION BY f) AS n FROM x) WHERE r IN (SELECT CAST(ceil(n * k / 64.0) AS BIGINT) FROM range(1, 65) t(k)))""",
    """sums AS (SELECT k.k, e.f, e.threshold, sum(CASE WHEN v <= threshold THEN 0.25::DOUBLE - CAST(season = k.k AS INTEGER) ELSE 0 END) AS gl,
    sum(CASE WHEN v <= threshold THEN 0.375::DOUBLE ELSE 0 END) AS hl, sum(CAST(v <= threshold AS INTEGER)) AS cl,
    sum(0.25::DOUBLE - CAST(season = k.k AS INTEGER)) AS g, sum(0.375::DOUBLE) AS h, count(*) AS c
  FROM x JOIN edges e USING (f), range(4) k(k) GROUP BY 1, 2, 3)""",
    """cuts AS (SELECT *, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain FROM sums
  WHERE hl >= 1 AND h - hl >= 1 AND cl < c)""",
    """best AS (SELECT * FROM cuts WHERE gain > 0.000001 QUALIFY row_number() OVER (PARTITION BY k ORDER BY gain DESC, f, threshold) = 1)""",
    body=f"""
SELECT CAST(k AS INTEGER) AS class, CASE f WHEN 0 THEN 'load' WHEN 1 THEN 'n_orders' ELSE 'temp' END AS feature, threshold,
  cl::DOUBLE AS n_left, (c - cl)::DOUBLE AS n_right, {sig_sql('-gl / (hl + 1)')} AS left_value,
  {sig_sql('-(g - gl) / (h - hl + 1)')} AS right_value FROM best"""))
def ml5_first_cuts(spark: SparkSession, d: str) -> DataFrame:
    """The root cut of each class of a softmax model's first round, on all days."""
    model = bo.fit_boosted(days(spark, d), X, "season", [bo.Boost(rounds=1, depth=1, eta=1.0)], objective="softmax", classes=4)[0]
    n = model.nodes(spark)
    root = n.filter("node = 0 and feature is not null").select("class", "feature", "threshold", "left")
    left = n.select(F.col("class"), F.col("node").alias("left"), F.col("cover").alias("n_left"), F.col("value").alias("left_value"))
    right = n.select(F.col("class"), (F.col("node") - 1).alias("left"), F.col("cover").alias("n_right"), F.col("value").alias("right_value"))
    out = root.join(left, ["class", "left"]).join(right, ["class", "left"]).drop("left")
    return rounded(out, sig_cols=["left_value", "right_value"])


@register("ml7_grid_shared_scans")
def ml7_grid_shared_scans(spark: SparkSession, d: str) -> DataFrame:
    """The grid of 40 settings by five folds on the daily load, all grown in the same scans."""
    return bo.tune_boosted(days(spark, d), ["n_orders", "temp", "season", "weekend"], "load", "fold", 5, **GRID)


@register("ml13_tree_attribution")
def ml13_tree_attribution(spark: SparkSession, d: str) -> DataFrame:
    """Per day of the test side what each feature adds to the predicted load (Shapley values of the trees)."""
    train, test = sides(spark, d)
    model = bo.fit_boosted(train, ["n_orders", "temp", "season", "weekend"], "load", [bo.Boost(rounds=10, depth=4)])[0]
    return bo.tree_attribution(test, model, ["date"])


@register("ml8_kernel_and_network")
def ml8_kernel_and_network(spark: SparkSession, d: str) -> DataFrame:
    """Support vectors and a neural network beside boosted trees on the daily load: metrics of the test side."""
    train, test = sides(spark, d)
    names = ["n_orders", "temp", "season", "weekend"]
    models = {"svr": gr.fit_svr(train, names, "load"), "network": gr.fit_network(train, names, "load")}
    scored = {k: m.predict(test) for k, m in models.items()}
    scored["boosted"] = bo.predict(test, bo.fit_boosted(train, names, "load", [bo.Boost(rounds=20, depth=4)])[0])
    out = None
    for name, p in scored.items():
        m = ev.regression_metrics(p, "load", "prediction").withColumn("model", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out
