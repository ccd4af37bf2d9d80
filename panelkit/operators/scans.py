"""Fills, running statistics and quantiles over one long order, in two levels.

The rows are range-partitioned and sorted once, so the series lies in chunks of bounded size. Each chunk is summed
up in one row; the summaries (one per chunk) give what a chunk inherits from those before and after it, and windows
run inside the chunks. No task ever sees the whole series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import cut_lineage

CHUNK = "__p"


def ordered_chunks(df: DataFrame, order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """The rows in ranges of ``order`` with their chunk (``__p``) and place (``__id``), written once. NULLs come first; ties stand
    in any order, but in one."""
    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    return cut_lineage(ranged, "chunks").withColumn(CHUNK, F.shiftright("__id", 33))


def _inherited(placed: DataFrame, summary: dict[str, Column], fold, schema: str) -> DataFrame:
    """``placed`` with the columns of ``schema`` that ``fold`` makes of the chunk summaries, in order (one row a chunk)."""
    rows = placed.groupBy(CHUNK).agg(*[c.alias(n) for n, c in summary.items()]).collect()
    spark = placed.sparkSession
    carry = spark.createDataFrame(fold(sorted(rows, key=lambda r: r[CHUNK])), f"{CHUNK} long, {schema}")
    return placed.join(F.broadcast(carry), CHUNK)


def _inside(desc: bool = False) -> Window:
    key = F.col("__id").desc() if desc else F.col("__id")
    return Window.partitionBy(CHUNK).orderBy(key)


def ffill_ordered(df: DataFrame, order: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """WIN-8 without an entity: the last value that is not NULL up to the row, over the whole table."""
    kind = df.schema[col].dataType.simpleString()
    placed = ordered_chunks(df, order)
    held = F.col(col).isNotNull()

    def fold(rows):
        last, carry = None, []
        for r in rows:
            carry.append((r[CHUNK], last))
            last = r["last"] if r["last"] is not None else last
        return carry

    got = _inherited(placed, {"last": F.max_by(F.when(held, F.col(col)), F.when(held, F.col("__id")))}, fold, f"__before {kind}")
    own = F.last(col, ignorenulls=True).over(_inside().rowsBetween(Window.unboundedPreceding, 0))
    return got.withColumn(out or col, F.coalesce(own, "__before")).drop("__before", "__id", CHUNK)


def interpolate_ordered(df: DataFrame, order: Sequence[str], position: str, col: str, out: str | None = None) -> DataFrame:
    """WIN-24 with ``partition=None``: NULLs between observed values on the line between them over ``position``; before the
    first and after the last observed value that value holds."""
    placed = ordered_chunks(df.withColumn("__x", F.col(position).cast("double")).withColumn("__y", F.col(col).cast("double")), order)
    held = F.when(F.col("__y").isNotNull(), F.col("__id"))
    point = F.when(F.col("__y").isNotNull(), F.struct("__x", "__y"))

    def fold(rows):
        def pass_on(rows, which):
            at, out = (None, None), {}
            for r in rows:
                out[r[CHUNK]] = at
                at = tuple(r[which]) if r[which] is not None else at
            return out
        before, after = pass_on(rows, "last"), pass_on(rows[::-1], "first")
        return [(r[CHUNK], *before[r[CHUNK]], *after[r[CHUNK]]) for r in rows]

    got = _inherited(placed, {"first": F.min_by(point, held), "last": F.max_by(point, held)}, fold,
                     "__px double, __py double, __nx double, __ny double")
    back, on = (_inside(d).rowsBetween(Window.unboundedPreceding, 0) for d in (False, True))
    own = {"p": F.last(point, ignorenulls=True).over(back), "n": F.last(point, ignorenulls=True).over(on)}
    got = got.withColumn("__p0", own["p"]).withColumn("__n0", own["n"])
    px, py, nx, ny = (F.coalesce(F.col(f"__{s}0.__{a}"), f"__{s}{a}") for s in "pn" for a in "xy")
    line = py + (ny - py) * F.try_divide(F.col("__x") - px, nx - px)
    value = F.coalesce("__y", F.when(py.isNull(), ny).when(ny.isNull(), py).otherwise(line))
    return got.withColumn(out or col, value).drop("__px", "__py", "__nx", "__ny", "__p0", "__n0", "__x", "__y", "__id", CHUNK)


def running_stats_ordered(df: DataFrame, order: Sequence[str], col: str, prefix: str | None = None) -> DataFrame:
    """WIN-11/12 without an entity: count, mean and sample standard deviation of all earlier values that are not NULL.
    Chunks are merged by count, mean and squared deviations."""
    p = prefix or col
    placed = ordered_chunks(df.withColumn("__y", F.col(col).cast("double")), order)

    def merge(a, b):
        n = a[0] + b[0]
        if not n:
            return a
        d = b[1] - a[1]
        return n, a[1] + d * b[0] / n, a[2] + b[2] + d * d * a[0] * b[0] / n

    def fold(rows):
        state, carry = (0, 0.0, 0.0), []
        for r in rows:
            carry.append((r[CHUNK], *state))
            state = merge(state, (r["n"], r["mean"] or 0.0, (r["var"] or 0.0) * r["n"]))
        return carry

    got = _inherited(placed, {"n": F.count("__y"), "mean": F.avg("__y"), "var": F.var_pop("__y")}, fold,
                     "__n0 long, __m0 double, __s0 double")
    w = _inside().rowsBetween(Window.unboundedPreceding, -1)
    got = got.withColumns({"__n1": F.count("__y").over(w), "__m1": F.coalesce(F.avg("__y").over(w), F.lit(0.0)),
                           "__v1": F.coalesce(F.var_pop("__y").over(w), F.lit(0.0))})
    n, d = F.col("__n0") + F.col("__n1"), F.col("__m1") - F.col("__m0")
    mean = F.col("__m0") + F.try_divide(d * F.col("__n1"), n)
    square = F.col("__s0") + F.col("__v1") * F.col("__n1") + F.coalesce(F.try_divide(d * d * F.col("__n0") * F.col("__n1"), n), F.lit(0.0))
    return got.withColumns({f"{p}_n": n, f"{p}_mean": F.when(n > 0, mean),
                            f"{p}_std": F.when(n > 1, F.sqrt(square / (n - 1)))}).drop(
        "__n0", "__m0", "__s0", "__n1", "__m1", "__v1", "__y", "__id", CHUNK)


def quantiles_by_class(df: DataFrame, by: Sequence[str], col: str, quantiles: dict[str, float], chunks: int | None = None) -> DataFrame:
    """Exact quantiles per class (linear between ranks) by distributed selection.

    Values are counted per class, ranged by (class, value) and counted per range; a rank then names the one range that holds
    it, and only the rows of such ranges are numbered. A class of any size is spread over many ranges. NULL values do not
    count, a NULL class is a class."""
    spark, by = df.sparkSession, list(by)
    vals = (df.where(F.col(col).isNotNull()).groupBy(*by, F.col(col).cast("double").alias("__v")).agg(F.count("*").alias("__c"))
            .select(F.struct(*by).alias("__k") if by else F.struct(F.lit(0)).alias("__k"), "__v", "__c"))
    placed = ordered_chunks(vals, ["__k", "__v"], chunks)
    per = placed.groupBy("__k", CHUNK).agg(F.sum("__c").alias("__c"))
    own = Window.partitionBy("__k")
    per = cut_lineage(per.withColumns({"__upto": F.sum("__c").over(own.orderBy(CHUNK)), "__n": F.sum("__c").over(own)}), "ranges")
    asked = spark.createDataFrame([(k, float(q)) for k, q in quantiles.items()], "__name string, __q double")
    at = F.col("__q") * (F.col("__n") - 1)
    ranks = per.select("__k", "__n").distinct().crossJoin(F.broadcast(asked)).select(  # a row a class and quantile
        "__k", "__name", (at - F.floor(at)).alias("__part"), F.explode(F.array(
            F.struct(F.lit("lo").alias("side"), F.floor(at).alias("r")), F.struct(F.lit("hi").alias("side"), F.ceil(at).alias("r")))).alias("__t"))
    ranks = ranks.select("__k", "__name", "__part", "__t.side", "__t.r")
    start = F.col("__upto") - F.col("__c")
    need = ranks.join(per, "__k").filter((F.col("r") >= start) & (F.col("r") < F.col("__upto"))).select(
        "__k", CHUNK, "__name", "__part", "side", (F.col("r") - start).alias("r"))
    need = cut_lineage(need, "ranks")
    inside = placed.join(need.select("__k", CHUNK).distinct(), ["__k", CHUNK], "left_semi").withColumn(
        "__upto", F.sum("__c").over(Window.partitionBy("__k", CHUNK).orderBy("__v")))
    found = inside.join(need, ["__k", CHUNK]).filter((F.col("r") < F.col("__upto")) & (F.col("r") >= F.col("__upto") - F.col("__c")))
    lo, hi = (F.max(F.when(F.col("side") == s, F.col("__v"))) for s in ("lo", "hi"))
    one = found.groupBy("__k", "__name").agg((lo + (hi - lo) * F.max("__part")).alias("__x"))
    wide = one.groupBy("__k").agg(*[F.max(F.when(F.col("__name") == k, F.col("__x"))).alias(k) for k in quantiles])
    return wide.select(*[F.col(f"__k.{b}").alias(b) for b in by], *quantiles)


class RankTree:
    """Counts per rank in a binary indexed tree: adding a value and finding the k-th smallest take logarithmic time."""

    def __init__(self, size: int):
        self.counts, self.n = [0] * (size + 1), 0
        self.top = 1 << (size.bit_length() - 1) if size else 0

    def add(self, rank: int) -> None:
        self.n += 1
        k = rank + 1
        while k < len(self.counts):
            self.counts[k] += 1
            k += k & -k

    def smallest(self, k: int) -> int:
        """The rank of the k-th smallest value (from 0)."""
        at, step = 0, self.top
        while step:
            nxt = at + step
            if nxt < len(self.counts) and self.counts[nxt] <= k:
                at, k = nxt, k - self.counts[nxt]
            step >>= 1
        return at


def running_quantiles(values: Sequence[float | None], quantiles: Sequence[float], include_current: bool = False) -> list[list[float | None]]:
    """Per quantile the running one of the values before each place (linear between ranks, missing values do not count)."""
    known = [v is not None and v == v for v in values]
    levels = sorted({v for v, ok in zip(values, known) if ok})
    rank, tree = {v: k for k, v in enumerate(levels)}, RankTree(len(levels))
    out: list[list[float | None]] = [[] for _ in quantiles]
    for v, ok in zip(values, known):
        if include_current and ok:
            tree.add(rank[v])
        for o, q in zip(out, quantiles):
            if not tree.n:
                o.append(None)
                continue
            at = q * (tree.n - 1)
            lo = math.floor(at)
            a = levels[tree.smallest(lo)]
            b = levels[tree.smallest(lo + 1)] if at > lo else a
            # the form of Spark's exact percentile, so both give the same double
            o.append(a if b == a else (lo + 1 - at) * a + (at - lo) * b)
        if not include_current and ok:
            tree.add(rank[v])
    return out


def expanding_quantiles(df: DataFrame, entity: Sequence[str], order: Sequence[str], col: str, quantiles: dict[str, float],
                        include_current: bool = False) -> DataFrame:
    """WIN-14/16 for long series: the key columns, ``col`` and its running quantiles, exact, in n log n per entity instead
    of a sort of the frame for every row. An entity's series is one task's work, bounded by its periods."""
    entity, order = list(entity), list(order)
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{c}` {kind[c]}" for c in [*entity, *order, col]] + [f"`{q}` double" for q in quantiles])

    def run(series: pd.DataFrame) -> pd.DataFrame:
        series = series.sort_values(order, kind="stable")
        values = [None if pd.isna(v) else float(v) for v in series[col]]
        got = running_quantiles(values, list(quantiles.values()), include_current)
        return series.assign(**{q: pd.Series(x, index=series.index, dtype="float64") for q, x in zip(quantiles, got)})

    return df.select(*entity, *order, col).groupBy(*entity).applyInPandas(run, schema)
