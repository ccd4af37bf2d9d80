"""Aggregations and profiles (AGG-1..17).

Every aggregate is a ``groupBy().agg()`` so Spark combines map-side before the
shuffle: a key holding a third of the rows still reaches the reducer as one
partial row per map task. Per-key "first/last row" uses ``max_by``/``min_by``
on a struct, again an aggregate, instead of sorting each group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators.scans import quantiles_by_class

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def period_fact(df: DataFrame, keys: Sequence[str], measures: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """AGG-1 / AGG-2: sum of measures per key; NULL keys dropped, all-NULL sums -> 0."""
    m = dict(measures) if isinstance(measures, Mapping) else {c: c for c in measures}
    keys = list(keys)
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return (df.where(cond).groupBy(*keys)
            .agg(*[F.coalesce(F.sum(src), F.lit(0.0)).alias(out) for out, src in m.items()]))


def rollup(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, F.Column]) -> DataFrame:
    """AGG-3: mixed aggregates per key given as {output: expression}."""
    return df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])


def group_means(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """AGG-4: mean of every (numeric) column per group, NULLs skipped."""
    cols = cols or numeric_columns(df, keys)
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def group_counts(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """AGG-5: rows per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def value_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """AGG-6: frequency of each value, most frequent first (ties by value)."""
    return group_counts(df, [col], out).orderBy(F.col(out).desc(), F.col(col).asc_nulls_last())


def distinct_per_group(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None,
                       approx: bool = False) -> DataFrame:
    """AGG-7: number of distinct non-NULL values per group (exact by default)."""
    agg = F.approx_count_distinct(col) if approx else F.countDistinct(col)
    return df.groupBy(*keys).agg(agg.alias(out or f"n_distinct_{col}"))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG-9: distinct rows (of ``cols``)."""
    return (df.select(*cols) if cols else df).distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                  last: bool = False) -> DataFrame:
    """AGG-10: the row with the smallest (``last``: largest) ordering per key.

    ``min_by``/``max_by`` over a struct of the order columns is an aggregate
    with map-side combining, so a hot key never lands whole in one sort.
    The order should be total (add a tie-break column).
    """
    ordkey = F.struct(*[F.col(o) for o in order])
    payload = F.struct(*[F.col(c) for c in cols])
    pick = (F.max_by if last else F.min_by)(payload, ordkey)
    return df.groupBy(*keys).agg(pick.alias("__row")).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in cols])


def group_mean_transform(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """AGG-12: per-group mean written back to every row.

    Aggregate (map-side combined) then join back, rather than a window over the
    group: a hot key would otherwise be sorted whole inside one task. The means
    table has one row per key.
    """
    means = df.groupBy(*keys).agg(F.avg(col).alias(out or f"{col}_group_mean"))
    return df.join(means, list(keys), "left")


def summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-11: one row with min, max, sample sd and mean of every column."""
    exprs = []
    for c in cols:
        exprs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"),
                  F.stddev_samp(c).alias(f"{c}_sd"), F.avg(c).alias(f"{c}_mean")]
    return df.agg(*exprs)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, sentinel=None) -> DataFrame:
    """AGG-13: NULL count (or count of ``sentinel`` matches) per column in one pass,
    returned long as (column, n)."""
    cols = list(cols or df.columns)
    if sentinel is None:
        exprs = [F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    else:
        exprs = [F.count_if(F.coalesce(F.col(c).cast("string") == F.lit(str(sentinel)), F.lit(False))).alias(c)
                 for c in cols]
    wide = df.agg(*exprs)
    return wide.unpivot([], cols, "column", "n").withColumn("n", F.col("n").cast("long"))


def shape(df: DataFrame) -> DataFrame:
    """AGG-14: (rows, columns) as a 1-row table."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def histogram(df: DataFrame, col: str, bins: int, out_bin: str = "bin", out_n: str = "n") -> DataFrame:
    """AGG-15: equal-width histogram over [min, max] with ``bins`` bins (last bin
    right-closed). Bounds are a broadcast 1-row aggregate; empty bins are kept."""
    spark = df.sparkSession
    vals = df.select(F.col(col).cast("double").alias("__x")).where(F.col("__x").isNotNull())
    b = vals.agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))
    width = (F.col("__hi") - F.col("__lo"))
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("__x") - F.col("__lo")) / width * bins), F.lit(bins - 1))).cast("int")
    counts = vals.crossJoin(F.broadcast(b)).select(idx.alias(out_bin)).groupBy(out_bin).agg(
        F.count(F.lit(1)).alias(out_n))
    edges = spark.range(bins).select(F.col("id").cast("int").alias(out_bin)).crossJoin(F.broadcast(b))
    edges = edges.select(out_bin,
                         (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col(out_bin) / bins).alias("lower"),
                         (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * (F.col(out_bin) + 1) / bins).alias("upper"))
    return (edges.join(counts, out_bin, "left")
            .select(out_bin, "lower", "upper", F.coalesce(F.col(out_n), F.lit(0)).cast("long").alias(out_n)))


def box_stats(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """AGG-17: min, q1, median, q3, max per class (exact, linear between ranks).

    Ranks are selected range by range (``quantiles_by_class``), so no task holds a class's rows or distinct values."""
    return quantiles_by_class(df, by, col, {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0})


def duplicate_report(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """CLEAN-1: keys (or full rows) that occur more than once, with their count."""
    keys = list(keys or df.columns)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
