"""Group fairness metrics and reweighing (FAIR-1..3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def protected_flag(df: DataFrame, predicate: Column, out: str = "privileged") -> DataFrame:
    """FAIR-1: 1 for the privileged group, 0 otherwise."""
    return df.withColumn(out, F.when(predicate, 1).otherwise(0))


def mean_difference(df: DataFrame, group: str, label: str, weight: str | None = None) -> DataFrame:
    """FAIR-2: P(favourable | unprivileged) - P(favourable | privileged), optionally weighted.
    Rows without a label or weight are left out."""
    w = F.col(weight) if weight else F.lit(1.0)
    rate = lambda g: F.try_divide(F.sum(F.when(F.col(group) == g, w * F.col(label))),
                                  F.sum(F.when((F.col(group) == g) & F.col(label).isNotNull(), w)))
    return df.agg((rate(0) - rate(1)).alias("mean_difference"))


def reweigh_weights(df: DataFrame, group: str, label: str, out: str = "weight") -> DataFrame:
    """FAIR-3: w(g, y) = P(g) P(y) / P(g, y) (Kamiran & Calders); one row per (g, y)."""
    cells = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("n_gy"))
    tot = cells.agg(F.sum("n_gy").alias("n"))
    ng = cells.groupBy(group).agg(F.sum("n_gy").alias("n_g"))
    ny = cells.groupBy(label).agg(F.sum("n_gy").alias("n_y"))
    return (cells.join(ng, group).join(ny, label).crossJoin(F.broadcast(tot))
            .select(group, label, "n_gy", (F.col("n_g") * F.col("n_y") / (F.col("n") * F.col("n_gy"))).alias(out)))


def reweigh(df: DataFrame, group: str, label: str, out: str = "weight") -> DataFrame:
    """FAIR-3: attach the reweighing weight to every row (at most 4 cells: broadcast)."""
    w = reweigh_weights(df, group, label, out).select(group, label, out)
    return df.join(F.broadcast(w), [group, label], "left")
