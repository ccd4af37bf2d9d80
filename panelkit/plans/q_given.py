"""Models with given parameters, whose every value SQL can check (ML-2, ML-9, ML-10, ML-13, JON-11, EVL-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import mathx
from panelkit.operators import models as ml
from panelkit.plans.common import H, M, rounded, sig_sql
from panelkit.plans.q_boost import DAYS_SQL, days
from panelkit.plans.q_model import MODEL_SQL, model_frame
from panelkit.plans.registry import register, with_ctes

#: Centroids over (temp, load), both scaled to 0..1, and labels of the clusters in order of (mean temp, mean load).
CENTROIDS = ((0.2, 0.3), (0.8, 0.25), (0.25, 0.6), (0.7, 0.65))
LABELS = ("cold-low", "cold-high", "warm-low", "warm-high")
#: Weights of a linear model with given parameters.
WEIGHTS = {"lag1": 0.25, "lag2": -0.5, "qty_lag1": 2.0, "hist_mean": 0.75, "wavg10": 0.125}

_FAR = ", ".join(f"{{'d': (t - {a}) * (t - {a}) + (l - {b}) * (l - {b}), 'k': {k}}}" for k, (a, b) in enumerate(CENTROIDS))
CLUSTER_SQL = [DAYS_SQL, """unit AS (SELECT date, temp, load, 1.0::DOUBLE * (temp - min(temp) OVER ()) / (max(temp) OVER () - min(temp) OVER ()) AS t,
  (load - min(load) OVER ()) / (max(load) OVER () - min(load) OVER ()) AS l FROM days)""",
    f"near AS (SELECT *, CAST(list_min([{_FAR}]).k AS INTEGER) AS cluster FROM unit)",
    """ranks AS (SELECT cluster, CAST(row_number() OVER (ORDER BY avg(temp), avg(load), cluster) AS INTEGER) AS cluster_rank
  FROM near GROUP BY 1)"""]


def clusters(spark: SparkSession, d: str) -> DataFrame:
    scaled = mathx.min_max(days(spark, d), ["temp", "load"], suffix="_unit")
    return ml.assign_centroids(scaled, ["temp_unit", "load_unit"], CENTROIDS)


@register("ml9_assign_centroids", with_ctes(*CLUSTER_SQL, body="""
SELECT cluster, count(*) AS n, sum(load) AS total_load, min(date) AS first_day FROM near GROUP BY 1"""))
def ml9_assign_centroids(spark: SparkSession, d: str) -> DataFrame:
    """Days by the nearest of four given centroids on scaled temperature and load."""
    return clusters(spark, d).groupBy("cluster").agg(
        F.count("*").alias("n"), F.sum("load").alias("total_load"), F.min("date").alias("first_day"))


@register("ml10_order_given_labels", with_ctes(*CLUSTER_SQL, body="SELECT date, cluster, cluster_rank FROM near JOIN ranks USING (cluster)"))
def ml10_order_given_labels(spark: SparkSession, d: str) -> DataFrame:
    """Given cluster labels in order of mean temperature, then mean load."""
    return ml.order_clusters(clusters(spark, d), "cluster", ["temp", "load"]).select("date", "cluster", "cluster_rank")


@register("jon11_given_label_lookup", with_ctes(*CLUSTER_SQL, body=f"""
SELECT date, cluster, {list(LABELS)}[cluster_rank] AS label FROM near JOIN ranks USING (cluster)"""))
def jon11_given_label_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Given cluster labels mapped to ordered display labels (one row a cluster)."""
    o = ml.order_clusters(clusters(spark, d), "cluster", ["temp", "load"])
    names = spark.createDataFrame([(k + 1, x) for k, x in enumerate(LABELS)], "cluster_rank int, label string")
    return o.join(F.broadcast(names), "cluster_rank", "left").select("date", "cluster", "label")


@register("ml2_two_features", with_ctes(*MODEL_SQL, """s AS (SELECT avg(y) AS my, avg(lag1) AS m1, avg(hist_mean) AS m2, covar_pop(lag1, y) AS c1, covar_pop(hist_mean, y) AS c2,
  covar_pop(lag1, hist_mean) AS c12, var_pop(lag1) AS v1, var_pop(hist_mean) AS v2 FROM model)""",
    "b AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM s)", body=f"""
SELECT {sig_sql('b1', 6)} AS lag1, {sig_sql('b2', 6)} AS hist_mean, {sig_sql('my - b1 * m1 - b2 * m2', 6)} AS intercept FROM b"""))
def ml2_two_features(spark: SparkSession, d: str) -> DataFrame:
    """Least squares on two features: the fitted coefficients against their closed form."""
    from panelkit.plans.common import sig
    m = ml.fit_linear(model_frame(spark, d), ["lag1", "hist_mean"], "y").stages[-1]
    row = [*map(float, m.coefficients.toArray()), float(m.intercept)]
    names = ["lag1", "hist_mean", "intercept"]
    return spark.createDataFrame([row], ", ".join(f"{n} double" for n in names)).select(*[sig(n, 6).alias(n) for n in names])


_ATTR = ", ".join(f"round({w} * ({c} - avg({c}) OVER ()), 4) + 0.0 AS {c}_attr" for c, w in WEIGHTS.items())


@register("ml13_linear_attribution", with_ctes(*MODEL_SQL, body=f"SELECT household_key, month_no, {_ATTR} FROM model"))
def ml13_linear_attribution(spark: SparkSession, d: str) -> DataFrame:
    """What each feature adds to a linear prediction with given weights, row by row."""
    out = ml.linear_attribution(model_frame(spark, d), WEIGHTS).select(H, M, *[f"{c}_attr" for c in WEIGHTS])
    return rounded(out).withColumns({f"{c}_attr": F.col(f"{c}_attr") + F.lit(0.0) for c in WEIGHTS})


_SCORE = " + ".join(f"{w} * {c}" for c, w in WEIGHTS.items())


@register("evl7_scored_given_weights", with_ctes(*MODEL_SQL, body=f"""
SELECT household_key, month_no, round(y, 4) AS y, {sig_sql(_SCORE)} AS prediction FROM model"""))
def evl7_scored_given_weights(spark: SparkSession, d: str) -> DataFrame:
    """Real and predicted spend under a linear model with given weights."""
    p = sum((F.lit(w) * F.col(c) for c, w in list(WEIGHTS.items())[1:]), F.lit(WEIGHTS["lag1"]) * F.col("lag1"))
    out = model_frame(spark, d).select(H, M, "y", p.alias("prediction"))
    return rounded(out, sig_cols=["prediction"])
