"""Train/test splits (SPL-1..4) and encodings (ENC-1..4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.windows import row_index
from panelkit.session import cut_lineage


def split_ordered(df: DataFrame, order: Sequence[str], frac: float = 0.8, out: str = "split") -> DataFrame:
    """SPL-1: first floor(frac * n) rows in ``order`` (NULLs first, ties broken arbitrarily) are 'train', the rest 'test'.

    Rows are counted per value of the leading column; only the rows of the one value
    that holds the cut are numbered (``row_index``), all others are decided by comparing values."""
    lead, src = order[0], cut_lineage(df, "split")
    counts = src.groupBy(F.col(lead).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    upto = Window.orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)  # one row per leading value
    run = counts.withColumns({"__upto": F.sum("__c").over(upto), "__n": F.sum("__c").over(Window.partitionBy())})
    run = run.withColumn("__cut", F.floor(F.col("__n") * F.lit(frac)))
    edge = run.filter(F.col("__upto") > F.col("__cut")).orderBy("__upto").select(
        F.col("__v"), (F.col("__cut") - (F.col("__upto") - F.col("__c"))).alias("__take")).first()
    if edge is None:  # no row is left for the test side
        return src.withColumn(out, F.lit("train"))
    at, value = F.col(lead), F.lit(edge["__v"]).cast(df.schema[lead].dataType)
    same = at.eqNullSafe(value)
    first = F.lit(False) if edge["__v"] is None else F.coalesce(at < value, F.lit(True))
    rest = src.filter(~same).withColumn(out, F.when(first, "train").otherwise("test"))
    on = row_index(src.filter(same), order, out="__idx")
    on = on.withColumn(out, F.when(F.col("__idx") <= edge["__take"], "train").otherwise("test")).drop("__idx")
    return rest.unionByName(on)


def split_time(df: DataFrame, ts: str, cut, inclusive: bool = True, out: str = "split") -> DataFrame:
    """SPL-2: train <= cut (``inclusive``) or < cut, test after."""
    c = F.col(ts) <= F.lit(cut) if inclusive else F.col(ts) < F.lit(cut)
    return df.withColumn(out, F.when(c, "train").otherwise("test"))


def hash_fraction_key(key: str | Sequence[str], seed: int = 42) -> Column:
    """Stable per-key digest prefix (4 hex chars), identical in DuckDB's md5."""
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.substring(F.md5(F.concat(text, F.lit(f"#{seed}"))), 1, 4)


def split_random(df: DataFrame, key: str | Sequence[str], threshold: str = "d999", seed: int = 42,
                 out: str = "split") -> DataFrame:
    """SPL-3: keyed hash split, stable across runs and engines (threshold 'd999' ~ 0.85)."""
    return df.withColumn(out, F.when(hash_fraction_key(key, seed) < F.lit(threshold), "train").otherwise("test"))


def split_by_group(df: DataFrame, group: str, threshold: str = "d999", seed: int = 42,
                   out: str = "split") -> DataFrame:
    """SPL-4: hash split on the entity, so no entity is on both sides."""
    return split_random(df, group, threshold, seed, out)


def one_hot(df: DataFrame, levels: Mapping[str, Sequence]) -> DataFrame:
    """ENC-1: one 0/1 column per given level of each column, which is dropped. NULL and other values are 0 in
    every column."""
    out = df
    for c, values in levels.items():
        out = out.withColumns({f"{c}_{v}": F.col(c).eqNullSafe(F.lit(v)).cast("int") for v in values}).drop(c)
    return out


def one_hot_sparse(df: DataFrame, cols: Sequence[str], suffix: str = "_vec") -> DataFrame:
    """ENC-1 for any number of levels: a sparse 0/1 vector per column, levels in order of their text; NULL is
    a level of its own (the last)."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    cols = list(cols)
    idx = StringIndexer(inputCols=cols, outputCols=[f"__{c}" for c in cols], stringOrderType="alphabetAsc",
                        handleInvalid="keep").fit(df).transform(df)
    enc = OneHotEncoder(inputCols=[f"__{c}" for c in cols], outputCols=[f"{c}{suffix}" for c in cols], dropLast=False)
    return enc.fit(idx).transform(idx).drop(*[f"__{c}" for c in cols])


def assemble_features(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """ENC-4: dense feature vector (rows with NULL features must be dropped first)."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def poly(df: DataFrame, cols: Sequence[str], degree: int = 2, out: str = "poly") -> DataFrame:
    """ENC-3: polynomial expansion of the assembled features (no bias term; the
    model's intercept plays that role)."""
    from pyspark.ml.feature import PolynomialExpansion
    v = assemble_features(df, cols, out="__vec")
    return PolynomialExpansion(degree=degree, inputCol="__vec", outputCol=out).transform(v).drop("__vec")
