"""Cleaning and data quality (CLEAN-1..10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_sentinels(df: DataFrame, spec: Mapping[str, Sequence]) -> DataFrame:
    """CLEAN-2: listed sentinel values -> NULL, per column."""
    return df.withColumns({c: F.when(F.col(c).isin(*vals), F.lit(None)).otherwise(F.col(c))
                           for c, vals in spec.items()})


def drop_keyless(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """CLEAN-3: drop rows with a NULL in any key column."""
    return df.dropna(how="any", subset=list(keys))


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Columns with at most one distinct non-NULL value: min == max (or all NULL),
    one aggregate pass with no distinct aggregation; the answer is one row."""
    cols = list(cols or df.columns)
    row = df.agg(*[(F.coalesce(F.min(c) == F.max(c), F.lit(True))).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def drop_constant(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """CLEAN-5: drop zero-variance columns."""
    return df.drop(*constant_columns(df, cols))


def sparse_columns(df: DataFrame, max_null_share: float, cols: Sequence[str] | None = None) -> list[str]:
    cols = list(cols or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    n = row["__n"] or 1
    return [c for c in cols if row[c] / n > max_null_share]


def drop_sparse(df: DataFrame, max_null_share: float = 0.5, cols: Sequence[str] | None = None) -> DataFrame:
    """CLEAN-6: drop columns whose NULL share exceeds ``max_null_share``."""
    return df.drop(*sparse_columns(df, max_null_share, cols))


def impute(df: DataFrame, spec: Mapping[str, object]) -> DataFrame:
    """CLEAN-7: NULL -> constant per column."""
    return df.fillna(dict(spec))


def drop_incomplete_periods(df: DataFrame, period: str, value: str, *, min_rows: int | None = None,
                            min_sum: float | None = None) -> DataFrame:
    """CLEAN-9: keep periods with at least ``min_rows`` rows and/or a sum >= ``min_sum``."""
    agg = df.groupBy(period).agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__s"))
    cond = F.lit(True)
    if min_rows is not None:
        cond = cond & (F.col("__n") >= min_rows)
    if min_sum is not None:
        cond = cond & (F.col("__s") >= min_sum)
    return df.join(agg.filter(cond).select(period), period, "left_semi")


def surrogate_rekey(dim: DataFrame, fact: DataFrame, key: str, by: Sequence[str], out: str = "new_id",
                    group_keys: Sequence[str] = (), measures: Sequence[str] = ()) -> DataFrame:
    """CLEAN-10: one deterministic surrogate id per ``by`` combination (dense id
    on the distinct dimension), the fact re-keyed and re-aggregated on it."""
    from panelkit.operators.windows import dense_group_id
    ids = dense_group_id(dim.select(key, *by), list(by), out=out).select(key, out)
    j = fact.join(ids, key, "left")
    if not group_keys:
        return j
    return j.groupBy(*group_keys, out).agg(*[F.sum(m).alias(m) for m in measures])
