"""Encoding (ENC), splits (SPL), evaluation (EVL) and models (ML)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import calendar as cal
from panelkit.functions import mathx
from panelkit.operators import evaluate as ev
from panelkit.operators import models as ml
from panelkit.operators import split as sp
from panelkit.operators import windows as win
from panelkit.plans.common import H, M, dense_panel, panel_ctes, round_dec, rounded, sig, sig_sql
from panelkit.plans.registry import register, with_ctes
from panelkit.sources import testdata as td

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@register("enc1_one_hot", "SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INTEGER) AS c_mktsegment_{s}" for s in SEGMENTS) + " FROM customer")
def enc1_one_hot(spark: SparkSession, d: str) -> DataFrame:
    c = td.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return sp.one_hot(c, {"c_mktsegment": SEGMENTS})


@register("enc2_min_max_constant", """
SELECT o_orderkey, round(CASE WHEN max(o_totalprice) OVER () = min(o_totalprice) OVER () THEN 0.0
  ELSE (o_totalprice - min(o_totalprice) OVER ()) / (max(o_totalprice) OVER () - min(o_totalprice) OVER ()) END, 4)
  AS o_totalprice, CAST(0.0 AS DOUBLE) AS ship_priority FROM orders""")
def enc2_min_max_constant(spark: SparkSession, d: str) -> DataFrame:
    """Min-max per column; a constant column maps to 0 (not Spark ML's 0.5)."""
    o = td.table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.lit(4.0).alias("ship_priority"))
    return rounded(mathx.min_max(o, ["o_totalprice", "ship_priority"]))


def model_frame(spark: SparkSession, d: str) -> DataFrame:
    """Monthly panel with leak-free features; target = this month's spend (in dollars)."""
    p = dense_panel(spark, d, M).select(H, M, (F.col("sales_value") / 100).alias("y"),
                                        (F.col("quantity")).alias("qty"))
    p = win.lag_col(p, H, M, "y", 1, out="lag1", default=0.0)
    p = win.lag_col(p, H, M, "y", 2, out="lag2", default=0.0)
    p = win.lag_col(p, H, M, "qty", 1, out="qty_lag1", default=0.0)
    p = win.expanding_stats(p, H, M, "y", stats=["mean"], prefix="hist")
    p = win.weighted_lag_mean(p, H, M, "y", 10, null_as_zero=True, out="wavg10")
    p = p.withColumn("month_of_year", ((F.col(M) - 1) % 12 + 1).cast("double"))
    s, c = cal.cyclic_month(F.col("month_of_year"))
    return p.withColumns({"month_sin": s, "month_cos": c}).drop("qty").dropna()


FEATURES = ["lag1", "lag2", "qty_lag1", "hist_mean", "wavg10", "month_sin", "month_cos"]


def train_test(spark: SparkSession, d: str):
    f = sp.split_ordered(model_frame(spark, d), [M, H], 0.8)
    return f.filter(F.col("split") == "train"), f.filter(F.col("split") == "test")


_MO = "(PARTITION BY household_key ORDER BY month_no)"
_DIAL = "(180.0 - 15.0 * 2 * ((month_no - 1) % 12 + 1)) / 180.0 * pi()"
MODEL_SQL = [*panel_ctes("month_no"), f"""model AS (SELECT * FROM (SELECT household_key, month_no, sales_value / 100 AS y,
  coalesce(lag(sales_value / 100) OVER {_MO}, 0.0) AS lag1, coalesce(lag(sales_value / 100, 2) OVER {_MO}, 0.0) AS lag2,
  coalesce(lag(quantity) OVER {_MO}, 0.0) AS qty_lag1,
  avg(sales_value / 100) OVER (PARTITION BY household_key ORDER BY month_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hist_mean,
  ({' + '.join(f'coalesce(lag(sales_value / 100, {k}) OVER {_MO}, 0.0) * {11 - k}.0' for k in range(1, 11))}) / 55.0 AS wavg10,
  sin({_DIAL}) AS month_sin, cos({_DIAL}) AS month_cos FROM dense) WHERE hist_mean IS NOT NULL)"""]


def sig_array(arr):
    """Elements to eight digits, without negative zeros."""
    return F.transform(arr, lambda x: sig(x) + F.lit(0.0))


@register("enc3_poly_features", with_ctes(*MODEL_SQL, body=f"""
SELECT household_key, month_no, 9 AS n_terms, list_transform([lag1, lag1 * lag1, lag1 * lag1 * lag1, qty_lag1, lag1 * qty_lag1,
    lag1 * lag1 * qty_lag1, qty_lag1 * qty_lag1, lag1 * qty_lag1 * qty_lag1, qty_lag1 * qty_lag1 * qty_lag1],
  lambda x: {sig_sql('x')}) AS poly FROM model"""))
def enc3_poly_features(spark: SparkSession, d: str) -> DataFrame:
    f = model_frame(spark, d)
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array(F.col("poly"))
    return sp.poly(f, ["lag1", "qty_lag1"], 3).select(H, M, F.size(arr).alias("n_terms"), sig_array(arr).alias("poly"))


@register("enc4_assemble_features", with_ctes(*MODEL_SQL, body="""
SELECT household_key, month_no, list_transform(list_transform([lag1, lag2, qty_lag1, hist_mean, wavg10, month_sin, month_cos],
  lambda x: round(x, 9)), lambda x: {SIG} + 0.0) AS features FROM model""".replace("{SIG}", sig_sql("x"))))
def enc4_assemble_features(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array(F.col("features"))
    return sp.assemble_features(model_frame(spark, d), FEATURES).select(
        H, M, sig_array(F.transform(arr, lambda x: round_dec(x, 9))).alias("features"))


@register("spl1_split_ordered", with_ctes(*panel_ctes("month_no"), body="""
SELECT household_key, month_no, CASE WHEN row_number() OVER (ORDER BY month_no, household_key)
  <= floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM dense"""))
def spl1_split_ordered(spark: SparkSession, d: str) -> DataFrame:
    """Temporal 80/20 split of the panel: first 80 % of rows in (month, household) order."""
    return sp.split_ordered(dense_panel(spark, d, M).select(H, M), [M, H], 0.8)


@register("spl2_split_time", """
SELECT o_orderkey, CASE WHEN o_orderdate <= TIMESTAMP '1999-01-01 00:00:00' THEN 'train' ELSE 'test' END AS split
FROM orders""")
def spl2_split_time(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return sp.split_time(o, "o_orderdate", F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")).drop("o_orderdate")


@register("spl3_split_random", """
SELECT o_orderkey, CASE WHEN substr(md5(concat(CAST(o_orderkey AS VARCHAR), '#42')), 1, 4) < 'd999'
  THEN 'train' ELSE 'test' END AS split FROM orders""")
def spl3_split_random(spark: SparkSession, d: str) -> DataFrame:
    return sp.split_random(td.table(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@register("spl4_split_by_group", """
SELECT o_orderkey, o_custkey, CASE WHEN substr(md5(concat(CAST(o_custkey AS VARCHAR), '#42')), 1, 4) < 'd999'
  THEN 'train' ELSE 'test' END AS split FROM orders""")
def spl4_split_by_group(spark: SparkSession, d: str) -> DataFrame:
    return sp.split_by_group(td.table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey")


# ---------------------------------------------------------------- evaluation on a naive forecast
NAIVE_SQL = panel_ctes("month_no") + ["""naive AS (
  SELECT household_key, month_no, sales_value / 100 AS y,
         coalesce(lag(sales_value) OVER (PARTITION BY household_key ORDER BY month_no), 0.0) / 100 AS p,
         CASE WHEN month_no <= 64 THEN 'train' ELSE 'test' END AS split FROM dense)"""]


def naive(spark: SparkSession, d: str) -> DataFrame:
    """Last month's spend as the forecast of this month's (dollars); months 1..64 train."""
    p = dense_panel(spark, d, M).select(H, M, (F.col("sales_value") / 100).alias("y"))
    p = win.lag_col(p, H, M, "y", 1, out="p", default=0.0)
    return p.withColumn("split", F.when(F.col(M) <= 64, "train").otherwise("test"))


def _metrics_sql(where: str = "") -> str:
    return (f"SELECT {sig_sql('avg((y - p) * (y - p))')} AS mse, {sig_sql('sqrt(avg((y - p) * (y - p)))')} AS rmse, "
            f"{sig_sql('avg(abs(y - p))')} AS mae, "
            f"{sig_sql('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))')} AS r2 FROM naive {where}")


@register("evl1_regression_metrics", with_ctes(*NAIVE_SQL, body=_metrics_sql()))
def evl1_regression_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ev.regression_metrics(naive(spark, d), "y", "p"), sig_cols=["mse", "rmse", "mae", "r2"])


@register("evl2_mape", with_ctes(*NAIVE_SQL, body=f"""
SELECT {sig_sql('avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100')} AS mape,
  count(*) FILTER (WHERE y = 0) AS n_excluded,
  {sig_sql('avg(abs(((y + 1) - (p + 1)) / (y + 1))) * 100')} AS mape_shift1 FROM naive"""))
def evl2_mape(spark: SparkSession, d: str) -> DataFrame:
    m = ev.mapes(naive(spark, d), "y", "p", {"mape": 0.0, "mape_shift1": 1.0})
    return rounded(m, sig_cols=["mape", "mape_shift1"])


@register("evl3_train_test_report", with_ctes(*NAIVE_SQL, """m AS (
  SELECT split, avg((y - p) * (y - p)) AS mse, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
    avg(abs(((y + 1) - (p + 1)) / (y + 1))) * 100 AS mape,
    1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM naive GROUP BY 1)""", body=f"""
SELECT metric, {sig_sql("max(value) FILTER (WHERE split = 'train')")} AS training,
  {sig_sql("max(value) FILTER (WHERE split = 'test')")} AS testing
FROM (UNPIVOT m ON mse, rmse, mae, mape, r2 INTO NAME metric VALUE value) GROUP BY 1"""))
def evl3_train_test_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ev.train_test_report(naive(spark, d), "y", "p"), sig_cols=["training", "testing"])


CLASS_SQL = """cls AS (
  SELECT day, CASE WHEN dayofweek(day) IN (0, 6) THEN 1 ELSE 0 END AS y,
         CASE WHEN load > avg(load) OVER () THEN 1 ELSE 0 END AS p
  FROM (SELECT CAST(ts AS DATE) AS day, sum(value) AS load FROM events GROUP BY 1))"""


def day_class(spark: SparkSession, d: str) -> DataFrame:
    """Weekend (actual) vs 'above-average daily load' (rule prediction) per day."""
    e = td.table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.sum("value").alias("load"))
    avg = e.agg(F.avg("load").alias("__a"))
    j = e.crossJoin(F.broadcast(avg))
    return j.select("day", cal.weekend("day").alias("y"), (F.col("load") > F.col("__a")).cast("int").alias("p"))


@register("evl4_confusion", with_ctes(CLASS_SQL, body="""
SELECT a.v AS y, b.v AS p, count(cls.y) AS n, round(count(cls.y) / nullif(sum(count(cls.y)) OVER (PARTITION BY a.v), 0), 4)
  AS share
FROM (SELECT y AS v FROM cls UNION SELECT p FROM cls) a CROSS JOIN (SELECT y AS v FROM cls UNION SELECT p FROM cls) b
LEFT JOIN cls ON cls.y = a.v AND cls.p = b.v GROUP BY 1, 2"""))
def evl4_confusion(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ev.confusion(day_class(spark, d), "y", "p"))


@register("evl5_precision_recall", with_ctes(CLASS_SQL, body="""
SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND p = 0) AS fn,
  round(count(*) FILTER (WHERE y = 1 AND p = 1) / nullif(count(*) FILTER (WHERE p = 1), 0), 4) AS precision,
  round(count(*) FILTER (WHERE y = 1 AND p = 1) / nullif(count(*) FILTER (WHERE y = 1), 0), 4) AS recall FROM cls"""))
def evl5_precision_recall(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ev.precision_recall(day_class(spark, d), "y", "p"))


@register("evl6_error_by_period", with_ctes(td.HOURLY_SQL, body="""
SELECT CAST(h.ts AS DATE) AS day, {ME} AS mean_error, {MAE} AS mean_abs_error
FROM hourly h JOIN hourly b ON b.ts = h.ts - INTERVAL 24 HOUR GROUP BY 1""".replace(
    "{ME}", sig_sql("avg(h.load - b.load)")).replace("{MAE}", sig_sql("avg(abs(h.load - b.load))"))))
def evl6_error_by_period(spark: SparkSession, d: str) -> DataFrame:
    """Residuals of the same-hour-yesterday forecast, averaged per day."""
    h = td.hourly_load(spark, d)
    prev = h.select((F.col("ts") + F.expr("INTERVAL 24 HOURS")).alias("ts"), F.col("load").alias("pred"))
    r = h.join(prev, "ts").withColumn("day", F.to_date("ts"))
    return rounded(ev.error_by_period(r, "load", "pred", "day"), sig_cols=["mean_error", "mean_abs_error"])


# ---------------------------------------------------------------- models (rows-only checks)
@register("ml1_simple_lr", with_ctes(td.LINES_SQL, body=f"""
SELECT {sig_sql('regr_slope(sales_value, quantity)')} AS slope,
  {sig_sql('regr_intercept(sales_value, quantity)')} AS intercept, {sig_sql('regr_r2(sales_value, quantity)')} AS r2
FROM lines"""))
def ml1_simple_lr(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ml.fit_simple_lr(td.lines(spark, d), "sales_value", "quantity"),
                   sig_cols=["slope", "intercept", "r2"])


@register("ml2_linear_poly")
def ml2_linear_poly(spark: SparkSession, d: str) -> DataFrame:
    tr, te = train_test(spark, d)
    m = ml.fit_linear(tr, FEATURES, "y", poly_degree=2)
    return ev.regression_metrics(m.transform(te), "y", "prediction")


@register("ml3_gbt_regressor")
def ml3_gbt_regressor(spark: SparkSession, d: str) -> DataFrame:
    tr, te = train_test(spark, d)
    m = ml.fit_gbt_regressor(tr, FEATURES, "y", max_iter=50)
    return ev.regression_metrics(m.transform(te), "y", "prediction")


def daily_energy(spark: SparkSession, d: str) -> DataFrame:
    """Daily load (sum of order totals) and mean order value with calendar labels. 'temp' is a periodic stand-in
    for a temperature: the day's distance from midwinter plus a load term, so it does not give the season away."""
    o = td.table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        (F.sum("o_totalprice") / 1000).alias("load"), F.count(F.lit(1)).alias("n_orders"))
    return o.withColumns({"weekend": cal.weekend("date").cast("double"),
                          "season": (cal.season_code(F.month("date")) - 1).cast("double"),
                          "temp": F.abs(F.dayofyear("date") - 190.0) + F.col("n_orders")})


@register("ml4_gbt_classifier")
def ml4_gbt_classifier(spark: SparkSession, d: str) -> DataFrame:
    df = daily_energy(spark, d)
    tr, te = df.filter(F.year("date") < 2000), df.filter(F.year("date") >= 2000)
    m = ml.fit_gbt_classifier(tr, ["load", "n_orders", "temp"], "weekend")
    p = m.transform(te).select(F.col("weekend").cast("int").alias("y"), F.col("prediction").cast("int").alias("p"))
    return ev.precision_recall(p, "y", "p")


@register("ml5_multiclass")
def ml5_multiclass(spark: SparkSession, d: str) -> DataFrame:
    df = daily_energy(spark, d)
    tr, te = df.filter(F.year("date") < 2000), df.filter(F.year("date") >= 2000)
    out = None
    for method in ("ovr_gbt", "forest"):
        m = ml.fit_multiclass(tr, ["load", "n_orders", "temp"], "season", method=method)
        p = m.transform(te).select(F.col("season").cast("int").alias("y"), F.col("prediction").cast("int").alias("p"))
        c = ev.confusion(p, "y", "p").select(F.lit(method).alias("method"), "y", "p", "n", "share")
        out = c if out is None else out.unionByName(c)
    return out


@register("ml6_random_forest")
def ml6_random_forest(spark: SparkSession, d: str) -> DataFrame:
    tr, te = train_test(spark, d)
    m = ml.fit_rf(tr, FEATURES, "y", num_trees=100, max_depth=4)
    return ev.regression_metrics(m.transform(te), "y", "prediction")


@register("ml7_grid_search_cv")
def ml7_grid_search_cv(spark: SparkSession, d: str) -> DataFrame:
    tr, te = train_test(spark, d)
    cv = ml.tune(tr, FEATURES, "y", {"maxIter": [5, 15], "maxDepth": [3, 5], "featureSubsetStrategy": ["all", "0.5"]},
                 folds=5)
    rows = [(str({p.name: v for p, v in pm.items()}), float(m)) for pm, m in zip(cv.getEstimatorParamMaps(),
                                                                              cv.avgMetrics)]
    return spark.createDataFrame(rows, "params string, cv_rmse double")


@register("ml8_compare_models")
def ml8_compare_models(spark: SparkSession, d: str) -> DataFrame:
    tr, te = train_test(spark, d)
    return ml.compare_models(tr, te, FEATURES, "y")


@register("ml9_kmeans")
def ml9_kmeans(spark: SparkSession, d: str) -> DataFrame:
    _, a = ml.fit_kmeans(daily_energy(spark, d), ["temp", "load"], k=4, seed=42)
    return a.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("load").alias("mean_load"))


@register("ml10_order_clusters")
def ml10_order_clusters(spark: SparkSession, d: str) -> DataFrame:
    _, a = ml.fit_kmeans(daily_energy(spark, d), ["temp", "load"], k=4, seed=42)
    return ml.order_clusters(a, "cluster", ["temp", "load"]).select("date", "cluster", "cluster_rank")


@register("jon11_cluster_label_lookup")
def jon11_cluster_label_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Cluster ids mapped to ordered display labels by a broadcast lookup (k rows)."""
    _, a = ml.fit_kmeans(daily_energy(spark, d), ["temp", "load"], k=4, seed=42)
    o = ml.order_clusters(a, "cluster", ["temp", "load"])
    labels = spark.createDataFrame([(1, "cold-low"), (2, "cold-high"), (3, "warm-low"), (4, "warm-high")],
                                   "cluster_rank int, label string")
    return o.join(F.broadcast(labels), "cluster_rank", "left").select("date", "cluster", "label")


@register("ml11_split_count_importance")
def ml11_split_count_importance(spark: SparkSession, d: str) -> DataFrame:
    from panelkit.plans.q_basic import scratch
    tr, _ = train_test(spark, d)
    m = ml.fit_gbt_regressor(tr, FEATURES, "y", max_iter=15)
    return ml.split_count_importance(m, FEATURES, scratch(spark, "ml11"))


@register("ml12_learning_curve")
def ml12_learning_curve(spark: SparkSession, d: str) -> DataFrame:
    tr, te = train_test(spark, d)
    m = ml.fit_gbt_regressor(tr, FEATURES, "y", max_iter=15)
    return ml.learning_curve(m, tr, te, "y")


@register("ml13_attribution")
def ml13_attribution(spark: SparkSession, d: str) -> DataFrame:
    tr, te = train_test(spark, d)
    lin = ml.fit_linear(tr, FEATURES, "y")
    coefs = dict(zip(FEATURES, lin.stages[-1].coefficients.toArray().tolist()))
    attr = ml.linear_attribution(te, coefs)
    glob = attr.agg(*[F.avg(F.abs(f"{c}_attr")).alias(c) for c in FEATURES]).unpivot(
        [], FEATURES, "feature", "mean_abs_attribution")
    perm = ml.permutation_importance(lin, te, FEATURES, "y", [H, M])
    return glob.join(perm.select("feature", "delta_rmse"), "feature", "left")


@register("evl7_scored")
def evl7_scored(spark: SparkSession, d: str) -> DataFrame:
    tr, te = train_test(spark, d)
    m = ml.fit_gbt_regressor(tr, FEATURES, "y", max_iter=15)
    return m.transform(te).select(H, M, "y", "prediction")
