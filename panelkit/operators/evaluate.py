"""Evaluation metrics (EVL-1..7) as single aggregates over (y, prediction) columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pair(y: str, p: str):
    """y and p where both are there, else NULL: every metric skips half-empty rows."""
    both = F.col(y).isNotNull() & F.col(p).isNotNull()
    return F.when(both, F.col(y)), F.when(both, F.col(p))


def _regression_aggs(y: str, p: str) -> dict:
    yy, pp = _pair(y, p)
    err = yy - pp
    mse = F.avg(err * err)
    return {"mse": mse, "rmse": F.sqrt(mse), "mae": F.avg(F.abs(err)),
            "r2": 1 - F.try_divide(F.sum(err * err), F.var_pop(yy) * F.count(yy))}


def _mape_agg(y: str, p: str, offset: float):
    yy, pp = (c + offset for c in _pair(y, p))
    return F.avg(F.when(yy != 0, F.abs(F.try_divide(yy - pp, yy)))) * 100


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """EVL-1: MSE, RMSE, MAE and R^2 over the rows that hold both values, in one aggregate (by optional groups)."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in _regression_aggs(y, p).items()])


def mape(df: DataFrame, y: str, p: str, offset: float = 0.0, by: Sequence[str] = ()) -> DataFrame:
    """EVL-2: mean(|(y - p) / (y + offset)|) * 100 with ``offset`` added to both y and p;
    rows with a zero denominator are excluded and counted."""
    return df.groupBy(*by).agg(_mape_agg(y, p, offset).alias("mape"),
                               F.count_if(_pair(y, p)[0] + offset == 0).alias("n_excluded"))


def mapes(df: DataFrame, y: str, p: str, offsets: dict[str, float]) -> DataFrame:
    """EVL-2 for several offsets in one pass: a column per name, and the rows with y = 0."""
    return df.agg(*[_mape_agg(y, p, o).alias(n) for n, o in offsets.items()],
                  F.count_if(_pair(y, p)[0] == 0).alias("n_excluded"))


def train_test_report(df: DataFrame, y: str, p: str, split: str = "split") -> DataFrame:
    """EVL-3: rows = metrics (MSE, RMSE, MAE, MAPE+1, R^2), columns = training, testing. One pass over the rows."""
    aggs = _regression_aggs(y, p) | {"mape": _mape_agg(y, p, 1.0)}
    m = df.groupBy(split).agg(*[c.alias(n) for n, c in aggs.items()])
    long = m.unpivot([split], ["mse", "rmse", "mae", "mape", "r2"], "metric", "value")
    return (long.groupBy("metric").agg(F.max(F.when(F.col(split) == "train", F.col("value"))).alias("training"),
                                       F.max(F.when(F.col(split) == "test", F.col("value"))).alias("testing")))


def confusion(df: DataFrame, y: str, p: str) -> DataFrame:
    """EVL-4: the full matrix: counts per (actual, predicted) pair of labels, 0 where a pair does not
    occur, and the share within each actual class (NULL for a class without rows)."""
    from pyspark.sql import Window
    c = df.groupBy(y, p).agg(F.count(F.lit(1)).alias("n"))
    labels = c.select(F.explode(F.array(y, p)).alias("__l")).distinct()  # one row per class
    grid = labels.select(F.col("__l").alias(y)).crossJoin(F.broadcast(labels.select(F.col("__l").alias(p))))
    full = (grid.alias("g").join(c.alias("c"), F.col(f"g.{y}").eqNullSafe(F.col(f"c.{y}"))
                                 & F.col(f"g.{p}").eqNullSafe(F.col(f"c.{p}")), "left")
            .select(F.col(f"g.{y}"), F.col(f"g.{p}"), F.coalesce("n", F.lit(0)).alias("n")))
    return full.withColumn("share", F.try_divide(F.col("n"), F.sum("n").over(Window.partitionBy(y))))


def precision_recall(df: DataFrame, y: str, p: str) -> DataFrame:
    """EVL-5: TP, FP, FN, precision and recall for a 0/1 label."""
    out = df.agg(F.count_if((F.col(y) == 1) & (F.col(p) == 1)).alias("tp"),
                 F.count_if((F.col(y) == 0) & (F.col(p) == 1)).alias("fp"),
                 F.count_if((F.col(y) == 1) & (F.col(p) == 0)).alias("fn"))
    return out.select("tp", "fp", "fn", F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                      F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def error_by_period(df: DataFrame, y: str, p: str, period: str) -> DataFrame:
    """EVL-6: mean error and mean absolute error per period."""
    err = F.col(y) - F.col(p)
    return df.groupBy(period).agg(F.avg(err).alias("mean_error"), F.avg(F.abs(err)).alias("mean_abs_error"))
