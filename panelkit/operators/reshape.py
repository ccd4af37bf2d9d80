"""Top-k, pivot and unpivot (SRT-2/3, RSH-1..3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, k: int, ascending: bool, tie: Sequence[str]) -> DataFrame:
    """SRT-2: k rows with the smallest/largest ``by``, ties broken by ``tie`` (TakeOrderedAndProject)."""
    o = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(o, *tie).limit(k)


def top_categories(df: DataFrame, col: str, k: int, rank_col: str = "rank") -> DataFrame:
    """SRT-3: the k most frequent values (count desc, value asc) with their rank 1..k.
    The ranking runs on the per-value counts (one row per distinct value)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.col("n").desc(), F.col(col).asc()).limit(k)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(F.col("n").desc(), F.col(col).asc())))


def pivot_top_counts(df: DataFrame, entity: str, col: str, k: int, entities: DataFrame | None = None,
                     prefix: str | None = None) -> DataFrame:
    """RSH-1: per entity, rows in each of the top-k categories of ``col`` as columns
    ``{prefix}_top1..k`` (0 when none), one row per entity of ``entities``.

    The top-k table (k rows) is broadcast and matched by join; the pivot is a
    conditional aggregation, so no distinct-value list is collected to the driver.
    """
    p = prefix or col
    top = top_categories(df, col, k).select(col, "rank")
    hit = df.join(F.broadcast(top), col, "inner")
    wide = hit.groupBy(entity).agg(*[F.count(F.when(F.col("rank") == i, 1)).alias(f"{p}_top{i}")
                                     for i in range(1, k + 1)])
    base = entities if entities is not None else df.select(entity).distinct()
    cols = [f"{p}_top{i}" for i in range(1, k + 1)]
    return base.join(wide, entity, "left").fillna(0, subset=cols)


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "metric",
         value: str = "value") -> DataFrame:
    """RSH-2: wide -> long."""
    return df.unpivot(list(ids), list(cols), var, value)
