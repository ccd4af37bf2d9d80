"""Model fitting and inspection on Spark ML (ML-1..13).

Estimators are Spark ML's distributed ones (regression trees grow over binned blocks, see ``trees``);
nothing is collected to fit. Depth-50
boosting (the reference setting) is not possible in Spark ML (maxDepth <= 30),
so depths are parameters with Spark-feasible defaults.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import chain
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from panelkit.operators.trees import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from panelkit.operators.windows import row_index


def fit_simple_lr(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """ML-1: slope and intercept of y ~ x by least squares (SQL aggregates)."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                 F.regr_r2(y, x).alias("r2"))


def _assembler(cols: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error")


def fit_linear(train: DataFrame, features: Sequence[str], label: str, solver: str = "normal", poly_degree: int = 1):
    """ML-2: (polynomial) multiple linear regression as a Pipeline."""
    from pyspark.ml.feature import PolynomialExpansion
    stages = [_assembler(features, "raw")]
    if poly_degree > 1:
        stages.append(PolynomialExpansion(degree=poly_degree, inputCol="raw", outputCol="features"))
    else:
        stages[0].setOutputCol("features")
    stages.append(LinearRegression(featuresCol="features", labelCol=label, solver=solver))
    return Pipeline(stages=stages).fit(train)


def fit_gbt_regressor(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 15, max_depth: int = 5,
                      step_size: float = 0.7, subsample: float = 0.5, seed: int = 42):
    """ML-3: gradient-boosted regression trees."""
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth,
                       stepSize=step_size, subsamplingRate=subsample, seed=seed)
    return Pipeline(stages=[_assembler(features), gbt]).fit(train)


def fit_gbt_classifier(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 20, max_depth: int = 4,
                       seed: int = 42):
    """ML-4: boosted binary classification."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, seed=seed)
    return Pipeline(stages=[_assembler(features), gbt]).fit(train)


def fit_multiclass(train: DataFrame, features: Sequence[str], label: str, method: str = "ovr_gbt", seed: int = 42):
    """ML-5: multi-class model. Spark's GBT is binary, so one-vs-rest boosting, or a random forest."""
    if method == "ovr_gbt":
        est = OneVsRest(classifier=GBTClassifier(maxIter=10, maxDepth=4, seed=seed), featuresCol="features",
                        labelCol=label)
    else:
        est = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=50, seed=seed)
    return Pipeline(stages=[_assembler(features), est]).fit(train)


def fit_rf(train: DataFrame, features: Sequence[str], label: str, num_trees: int = 100, max_depth: int = 5,
           seed: int = 42):
    """ML-6: random forest regression."""
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                               seed=seed)
    return Pipeline(stages=[_assembler(features), rf]).fit(train)


def tune(train: DataFrame, features: Sequence[str], label: str, grid: dict[str, Sequence], folds: int = 5,
         seed: int = 42, parallelism: int = 4):
    """ML-7: k-fold cross-validated grid search over GBT parameters
    (``maxIter``, ``maxDepth``, ``featureSubsetStrategy``...), the result of Spark's ``CrossValidator``.

    Boosting with fewer rounds is the start of boosting with more, so settings that differ in ``maxIter`` only share
    one fit a fold, and each is judged after its own rounds."""
    gbt = GBTRegressor(featuresCol="features", labelCol=label, seed=seed)
    assembler = _assembler(features)
    pipe = Pipeline(stages=[assembler, gbt])
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(gbt.getParam(name), list(values))
    maps = b.build()
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps,
                        evaluator=RegressionEvaluator(labelCol=label, metricName="rmse"),
                        numFolds=folds, seed=seed, parallelism=parallelism)
    rounds = [m.get(gbt.maxIter, gbt.getMaxIter()) for m in maps]
    alike: dict[tuple, list[int]] = {}  # settings by all but maxIter
    for k, m in enumerate(maps):
        alike.setdefault(tuple(sorted((p.name, str(v)) for p, v in m.items() if p.name != "maxIter")), []).append(k)
    pool, metrics = ThreadPool(processes=min(parallelism, len(alike))), []
    try:
        for own, held in fold_splits(train, folds, seed):
            own.cache(), held.cache()
            fitted, judged = assembler.transform(own), assembler.transform(held)

            def judge(ks, fitted=fitted, judged=judged):
                most = max(ks, key=lambda k: rounds[k])
                losses = gbt.fit(fitted, maps[most]).evaluateEachIteration(judged, "squared")
                return [(k, math.sqrt(losses[rounds[k] - 1])) for k in ks]

            found = dict(chain(*pool.map(inheritable_thread_target(train.sparkSession)(judge), alike.values())))
            metrics.append([found[k] for k in range(len(maps))])
            own.unpersist(), held.unpersist()
    finally:
        pool.close()
    average, spread = np.mean(metrics, axis=0), np.std(metrics, axis=0)
    best = pipe.fit(train, maps[int(np.argmin(average))])
    return cv._copyValues(CrossValidatorModel(best, list(average), None, list(spread)))


def fold_splits(df: DataFrame, folds: int, seed: int) -> list[tuple[DataFrame, DataFrame]]:
    """(training, held out) rows of each fold, those of ``CrossValidator`` with this seed."""
    share, drawn = 1.0 / folds, df.select("*", F.rand(seed).alias("__rand"))
    parts = [(F.col("__rand") >= i * share) & (F.col("__rand") < (i + 1) * share) for i in range(folds)]
    return [(drawn.filter(~held), drawn.filter(held)) for held in parts]


MODEL_FAMILIES = ("linear", "tree", "forest", "gbt")


def compare_models(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                   families: Sequence[str] = MODEL_FAMILIES, scale: bool = True, seed: int = 42) -> DataFrame:
    """ML-8: scale -> model pipelines for several families; one row of test
    metrics per family (driver holds only the fitted models)."""
    from panelkit.operators.evaluate import regression_metrics
    est = {"linear": LinearRegression(featuresCol="features", labelCol=label),
           "tree": DecisionTreeRegressor(featuresCol="features", labelCol=label, maxDepth=5, seed=seed),
           "forest": RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=20, maxDepth=5, seed=seed),
           "gbt": GBTRegressor(featuresCol="features", labelCol=label, maxIter=15, maxDepth=5, stepSize=0.3,
                               seed=seed)}
    out = None
    for fam in families:
        stages = [_assembler(features, "raw" if scale else "features")]
        if scale:
            stages.append(StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True))
        stages.append(est[fam])
        pred = Pipeline(stages=stages).fit(train).transform(test)
        m = regression_metrics(pred, label, "prediction").withColumn("model", F.lit(fam))
        out = m if out is None else out.unionByName(m)
    return out


def fit_kmeans(df: DataFrame, cols: Sequence[str], k: int = 4, seed: int = 42, out: str = "cluster"):
    """ML-9: k-means on min-max scaled columns; returns (model, assigned frame)."""
    pipe = Pipeline(stages=[_assembler(cols, "raw"), MinMaxScaler(inputCol="raw", outputCol="features"),
                            KMeans(k=k, seed=seed, featuresCol="features", predictionCol=out)])
    model = pipe.fit(df)
    return model, model.transform(df).drop("raw", "features")


def assign_centroids(df: DataFrame, cols: Sequence[str], centroids: Sequence[Sequence[float]], out: str = "cluster") -> DataFrame:
    """ML-9 with given centroids: the number of the nearest one (ties: the smaller number); NULL where a column is."""
    def far(c):
        return sum(((F.col(x) - F.lit(float(v))) * (F.col(x) - F.lit(float(v))) for x, v in zip(cols, c)), F.lit(0.0))
    near = F.array_min(F.array(*[F.struct(far(c).alias("d"), F.lit(k).alias("k")) for k, c in enumerate(centroids)]))
    known = [F.col(x).isNotNull() for x in cols]
    return df.withColumn(out, F.when(reduce(lambda a, b: a & b, known), near["k"]))


def order_clusters(assigned: DataFrame, cluster: str, by: Sequence[str], out: str = "cluster_rank") -> DataFrame:
    """ML-10: stable labels: rank clusters by the means of ``by`` and map each row's
    cluster to its rank (k-row table, broadcast)."""
    means = assigned.groupBy(cluster).agg(*[F.avg(c).alias(f"__m_{c}") for c in by])
    ranked = means.withColumn(out, F.row_number().over(Window.orderBy(*[f"__m_{c}" for c in by], cluster)))
    return assigned.join(F.broadcast(ranked.select(cluster, out)), cluster, "left")


def split_count_importance(pipeline_model, features: Sequence[str], path: str) -> DataFrame:
    """ML-11: number of splits per feature across all trees, read from the saved
    model's node table (Spark ML writes trees as a parquet of nodes)."""
    model = pipeline_model.stages[-1]
    model.write().overwrite().save(path)
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    nodes = spark.read.parquet(f"{path}/data")
    idx = F.col("nodeData.split.featureIndex")
    counts = nodes.filter(idx >= 0).groupBy(idx.alias("feature_index")).agg(F.count(F.lit(1)).alias("n_splits"))
    names = spark.createDataFrame(list(enumerate(features)), "feature_index int, feature string")
    return names.join(counts, "feature_index", "left").fillna(0, subset=["n_splits"])


def learning_curve(gbt_pipeline_model, train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """ML-12: RMSE after each boosting round on train and test (loss computed by
    Spark over the data, one value per round)."""
    assembler, gbt = gbt_pipeline_model.stages[0], gbt_pipeline_model.stages[-1]
    spark = train.sparkSession
    tr = gbt.evaluateEachIteration(assembler.transform(train), "squared")
    te = gbt.evaluateEachIteration(assembler.transform(test), "squared")
    rows = [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(tr, te))]
    df = spark.createDataFrame(rows, "round int, train_mse double, test_mse double")
    return df.select("round", F.sqrt("train_mse").alias("train_rmse"), F.sqrt("test_mse").alias("test_rmse"))


def linear_attribution(df: DataFrame, coefs: dict[str, float]) -> DataFrame:
    """ML-13: per-row linear attribution coef * (x - mean(x)) as columns, plus the
    mean absolute attribution per feature as a global importance."""
    means = df.agg(*[F.avg(c).alias(f"__mu_{c}") for c in coefs])
    j = df.crossJoin(F.broadcast(means))
    return j.withColumns({f"{c}_attr": F.lit(w) * (F.col(c) - F.col(f"__mu_{c}")) for c, w in coefs.items()}).drop(
        *[f"__mu_{c}" for c in coefs])


def permutation_importance(pipeline_model, test: DataFrame, features: Sequence[str], label: str, key: Sequence[str],
                           seed: int = 42) -> DataFrame:
    """ML-13: RMSE increase when one feature column is permuted. The permutation
    is a join of the row index in key order with the row index in digest order,
    so it is a distributed reshuffle of one column, not a driver shuffle."""
    from panelkit.operators.evaluate import regression_metrics
    spark = test.sparkSession
    base = regression_metrics(pipeline_model.transform(test), label, "prediction").select("rmse")
    ordered = row_index(test, list(key), out="__i")
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(f"#{seed}")))
    shuffled = row_index(test.withColumn("__h", digest), ["__h", *key], out="__i")
    out = None
    for f in features:
        donor = shuffled.select("__i", F.col(f).alias("__perm"))
        perm = ordered.join(donor, "__i").withColumn(f, F.col("__perm")).drop("__perm", "__i")
        r = regression_metrics(pipeline_model.transform(perm), label, "prediction").select(
            F.lit(f).alias("feature"), F.col("rmse").alias("perm_rmse"))
        out = r if out is None else out.unionByName(r)
    return out.crossJoin(base).withColumn("delta_rmse", F.col("perm_rmse") - F.col("rmse"))
