"""Property tests."""

import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import evaluate as ev
from panelkit.operators import grid as grd
from panelkit.operators import models as ml
from panelkit.operators import split as sp
from panelkit.operators import windows as win
from panelkit.plans.common import H, M, dense_panel
from tests.conftest import SF_SMALL


def test_dense_panel_is_complete_grid(spark):
    p = dense_panel(spark, SF_SMALL, M)
    n_ent = p.select(H).distinct().count()
    n_per = p.agg(F.max(M)).first()[0]
    assert p.count() == n_ent * n_per == p.select(H, M).distinct().count()
    assert p.agg(F.min(M)).first()[0] == 1


def test_expanding_stats_do_not_leak(spark):
    """Stats at row t are unchanged when rows >= t change."""
    base = [("A", t, float(v)) for t, v in enumerate([5, 1, 7, 3, 9, 2], start=1)]
    changed = [(e, t, x if t < 4 else x * 100 + 1) for e, t, x in base]
    a = win.expanding_stats(spark.createDataFrame(base, "e string, t int, x double"), "e", "t", "x")
    b = win.expanding_stats(spark.createDataFrame(changed, "e string, t int, x double"), "e", "t", "x")
    cols = ["x_mean", "x_std", "x_var", "x_q25", "x_q50", "x_q75"]
    ra = {r["t"]: tuple(r[c] for c in cols) for r in a.collect()}
    rb = {r["t"]: tuple(r[c] for c in cols) for r in b.collect()}
    assert all(ra[t] == rb[t] for t in (1, 2, 3, 4))
    assert ra[5] != rb[5]


@pytest.mark.parametrize("n,parts", [(1, 8), (7, 8), (1000, 3), (5000, 16)])
def test_row_index_matches_sort(spark, n, parts):
    rnd = random.Random(n)
    data = [(rnd.randint(0, 20), i) for i in range(n)]
    df = spark.createDataFrame(data, "a int, b int").repartition(5)
    out = win.row_index(df, ["a", "b"], num_partitions=parts).collect()
    expect = {k: i + 1 for i, k in enumerate(sorted(data))}
    assert sorted(r["row_idx"] for r in out) == list(range(1, n + 1))
    assert all(expect[(r["a"], r["b"])] == r["row_idx"] for r in out)


def test_split_parts_disjoint_and_complete(spark):
    df = spark.range(103).withColumnRenamed("id", "k")
    out = sp.split_ordered(df, ["k"], 0.8)
    assert out.count() == 103
    assert out.filter("split = 'train'").count() == 82
    g = sp.split_by_group(spark.range(500).select((F.col("id") % 37).alias("g"), "id"), "g")
    assert g.groupBy("g").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0


def test_countdown_never_negative(spark):
    rnd = random.Random(3)
    data = [("A", t, None if rnd.random() < 0.6 else float(rnd.randint(0, 30))) for t in range(1, 200)]
    out = win.countdown_fill(spark.createDataFrame(data, "e string, t int, x double"), "e", "t", "x", step=7)
    assert out.filter(F.col("x") < 0).count() == 0


def test_interpolation_within_neighbours(spark):
    data = [("A", 1, 10.0), ("A", 2, None), ("A", 3, None), ("A", 4, 4.0), ("B", 1, None), ("B", 2, 3.0)]
    out = win.interpolate_linear(spark.createDataFrame(data, "e string, t int, x double"), "e", "t", "x")
    vals = {(r["e"], r["t"]): r["x"] for r in out.collect()}
    assert 4.0 <= vals[("A", 2)] <= 10.0 and 4.0 <= vals[("A", 3)] <= 10.0
    assert vals[("B", 1)] == 3.0


def test_weekday_shares_sum_to_one_or_zero(spark):
    from panelkit.plans.q_windows import win21_weekday_shares
    out = win21_weekday_shares(spark, SF_SMALL)
    s = out.select(sum(F.col(c) for c in out.columns if c.endswith("_share")).alias("s"))
    bad = s.filter((F.abs(F.col("s") - 1) > 1e-3) & (F.abs(F.col("s")) > 1e-9)).count()
    assert bad == 0


def test_learning_curve_last_round_matches_rmse(spark):
    rnd = random.Random(5)
    data = [(float(x), float(2 * x + rnd.random())) for x in range(200)]
    df = spark.createDataFrame(data, "x double, y double")
    m = ml.fit_gbt_regressor(df, ["x"], "y", max_iter=5, max_depth=3)
    lc = ml.learning_curve(m, df, df, "y").orderBy("round").collect()
    rmse = ev.regression_metrics(m.transform(df), "y", "prediction").first()["rmse"]
    assert abs(lc[-1]["train_rmse"] - rmse) < 1e-6 * max(1.0, rmse)


def test_grid_search_is_the_cross_validator_with_fits_shared_by_rounds(spark, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import GBTRegressor
    from pyspark.ml.tuning import CrossValidator
    rnd = random.Random(6)
    data = [(float(x % 17), float(x % 5), x % 17 * 2.0 + rnd.random() * 9) for x in range(300)]
    df = spark.createDataFrame(data, "a double, b double, y double").repartition(3).cache()
    fits, fit = [], GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, rows: fits.append(self.getMaxIter()) or fit(self, rows))
    grid = {"maxIter": [1, 4], "maxDepth": [2, 3], "featureSubsetStrategy": ["0.5"]}
    got = ml.tune(df, ["a", "b"], "y", grid, folds=3)
    assert sorted(fits[:-1]) == [4] * 6  # one fit a fold and depth, then the best setting on all rows
    gbt = GBTRegressor(featuresCol="features", labelCol="y", seed=42)
    pipe = Pipeline(stages=[ml._assembler(["a", "b"]), gbt])
    maps = got.getEstimatorParamMaps()
    want = CrossValidator(estimator=pipe, estimatorParamMaps=[{gbt.getParam(p.name): v for p, v in m.items()} for m in maps],
                          evaluator=RegressionEvaluator(labelCol="y", metricName="rmse"), numFolds=3, seed=42).fit(df)
    assert len(maps) == 4 and got.avgMetrics == pytest.approx(want.avgMetrics, rel=1e-9)
    assert got.stdMetrics == pytest.approx(want.stdMetrics, rel=1e-6)
    assert got.bestModel.stages[-1].toDebugString.split("\n")[1:] == want.bestModel.stages[-1].toDebugString.split("\n")[1:]


def test_group_split_hash_matches_threshold(spark):
    out = sp.split_random(spark.range(2000).withColumnRenamed("id", "k"), "k")
    share = out.filter("split = 'train'").count() / 2000
    assert 0.8 < share < 0.9


def test_hot_entity_results_match_brute_force(spark):
    """One entity holds a third of the rows: aggregate-based operators stay exact."""
    from panelkit.operators import aggregates as agg
    rnd = random.Random(11)
    data = [(0 if i % 3 == 0 else rnd.randint(1, 50), rnd.randint(1, 12), i, float(rnd.randint(0, 99)))
            for i in range(3000)]
    df = spark.createDataFrame(data, "e int, t int, k int, x double")
    first = {r["e"]: r["k"] for r in agg.first_per_key(df, ["e"], ["t", "k"], ["k"]).collect()}
    brute = {}
    for e, t, k, x in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        brute.setdefault(e, k)
    assert first == brute
    means = {r["e"]: r["x_group_mean"] for r in agg.group_mean_transform(df, ["e"], "x").select("e", "x_group_mean")
             .distinct().collect()}
    assert abs(means[0] - sum(x for e, _, _, x in data if e == 0) / sum(1 for r in data if r[0] == 0)) < 1e-9
    sparse = df.groupBy("e", "t").agg(F.sum("x").alias("x"))
    dense = grd.dense_panel(sparse, "e", "t", ["x"], start=1, end=12)
    assert dense.count() == 51 * 12 and dense.filter("e = 0").agg(F.sum("x")).first()[0] == sum(
        x for e, _, _, x in data if e == 0)


LEAK_FREE = {
    "last_period_amount": lambda df: win.last_period_amount(df, "e", "t", "x", out="f"),
    "last_trip_amount": lambda df: win.last_trip_amount(df, "e", "t", "x", out="f"),
    "weighted_lag_mean": lambda df: win.weighted_lag_mean(df, "e", "t", "x", 3, out="f"),
    "weighted_lag_mean_dense": lambda df: win.weighted_lag_mean(df, "e", "t", "x", 3, null_as_zero=True, out="f"),
    "lag_to_prevent_leakage": lambda df: win.lag_to_prevent_leakage(df, "e", "t", ["x"]).withColumnRenamed("x", "f"),
    "expanding_mean": lambda df: win.expanding_stats(df, "e", "t", "x", stats=["mean"]).withColumnRenamed(
        "x_mean", "f"),
    "gap_since_prev_lagged": lambda df: win.lag_col(df, "e", "t", "x", 1, out="f"),
}


@pytest.mark.parametrize("name", sorted(LEAK_FREE))
def test_history_features_do_not_leak(spark, name):
    """A feature at period t may only read periods < t: changing periods >= 5
    must leave periods <= 5 unchanged."""
    base = [("A", t, float(v)) for t, v in enumerate([4, 8, 15, 16, 23, 42, 7, 9], start=1)]
    fut = [(e, t, x if t < 5 else -x * 10 - 3) for e, t, x in base]
    f = LEAK_FREE[name]
    a = {r["t"]: r["f"] for r in f(spark.createDataFrame(base, "e string, t int, x double")).collect()}
    b = {r["t"]: r["f"] for r in f(spark.createDataFrame(fut, "e string, t int, x double")).collect()}
    assert all(a[t] == b[t] for t in range(1, 6)), (a, b)
