"""Window features over an (entity, period) panel (WIN-1..26).

All features share ``Window.partitionBy(entity).orderBy(period)`` so Spark
evaluates them in one shuffle + sort. Expanding frames are growing frames
(``unboundedPreceding .. -1``), which Spark updates incrementally. Backward
looks (next non-null value) use the reversed order with a growing frame rather
than an ``unboundedFollowing`` frame, which Spark would recompute per row.

On a dense panel every entity partition holds exactly one row per period, so
the window work per entity is bounded however skewed the raw fact is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import cut_lineage

UP = Window.unboundedPreceding


def _w(entity: str | Sequence[str], order: str | Sequence[str], desc: bool = False):
    order = [order] if isinstance(order, str) else list(order)
    cols = [F.col(o).desc() if desc else F.col(o).asc() for o in order]
    ents = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*ents).orderBy(*cols)


def lag_col(df: DataFrame, entity, order, col: str, k: int = 1, out: str | None = None,
            default=None) -> DataFrame:
    """WIN-1: value k periods back inside the entity (``default`` replaces NULL)."""
    c = F.lag(col, k).over(_w(entity, order))
    if default is not None:
        c = F.coalesce(c, F.lit(default))
    return df.withColumn(out or f"{col}_lag{k}", c)


def lead_col(df: DataFrame, entity, order, col: str, k: int = 1, out: str | None = None) -> DataFrame:
    """WIN-2: value k periods ahead inside the entity."""
    return df.withColumn(out or f"{col}_lead{k}", F.lead(col, k).over(_w(entity, order)))


def gap_since_prev(df: DataFrame, entity, col: str, out: str | None = None) -> DataFrame:
    """WIN-3 / WIN-4: ``col - previous col`` inside the entity ordered by ``col``."""
    return df.withColumn(out or f"{col}_gap", F.col(col) - F.lag(col, 1).over(_w(entity, col)))


def max_gap_per_period(df: DataFrame, keys: Sequence[str], gap: str, out: str = "max_gap") -> DataFrame:
    """WIN-6: largest gap per group where a NULL gap (first visit) wins.

    Expressed as an aggregate (partial aggregation, skew-safe) instead of a
    per-group sort: NULL if the group holds a NULL gap, else max(gap).
    """
    return (df.groupBy(*keys)
            .agg(F.when(F.count(F.lit(1)) > F.count(gap), F.lit(None)).otherwise(F.max(gap)).alias(out)))


def ffill(df: DataFrame, entity, order, col: str, out: str | None = None) -> DataFrame:
    """WIN-8: last non-null value up to and including the current row."""
    w = _w(entity, order).rowsBetween(UP, 0)
    return df.withColumn(out or col, F.last(col, ignorenulls=True).over(w))


def prev_non_null(entity, order, col: str) -> Column:
    """Last non-null value strictly before the current row (WIN-9 form)."""
    return F.last(col, ignorenulls=True).over(_w(entity, order).rowsBetween(UP, -1))


def countdown_fill(df: DataFrame, entity, order: str, col: str, step: float = 1,
                   out: str | None = None) -> DataFrame:
    """WIN-7: fill a NULL with ``v - step * n`` where ``v`` is the next non-null value
    ``n`` periods ahead, when that is >= 0; trailing gaps stay NULL.

    The next non-null value and its period come from a growing frame over the
    reversed order (incremental), not an unboundedFollowing frame.
    """
    wr = _w(entity, order, desc=True).rowsBetween(UP, -1)
    nv = F.last(col, ignorenulls=True).over(wr)
    npd = F.last(F.when(F.col(col).isNotNull(), F.col(order)), ignorenulls=True).over(wr)
    tmp_v, tmp_p = f"__nv_{col}", f"__np_{col}"
    d = df.withColumn(tmp_v, nv).withColumn(tmp_p, npd)
    cand = F.col(tmp_v) - F.lit(step) * (F.col(tmp_p) - F.col(order))
    filled = F.coalesce(F.col(col), F.when(cand >= 0, cand))
    return d.withColumn(out or col, filled).drop(tmp_v, tmp_p)


def last_period_amount(df: DataFrame, entity, order, col: str, out: str | None = None) -> DataFrame:
    """WIN-10: amount in the previous period, NULL -> 0 (dense grid)."""
    return lag_col(df, entity, order, col, 1, out or f"{col}_last_period", default=0.0)


def last_trip_amount(df: DataFrame, entity, order, col: str, out: str | None = None) -> DataFrame:
    """WIN-9: amount of the last active period strictly before this one, inside the entity."""
    return df.withColumn(out or f"{col}_last_trip", prev_non_null(entity, order, col))


STATS = ("mean", "std", "var", "q25", "q50", "q75")


def expanding_stats(df: DataFrame, entity, order, col: str, stats: Sequence[str] = STATS,
                    prefix: str | None = None, include_current: bool = False,
                    approx_quantiles: bool = False) -> DataFrame:
    """WIN-11..14: mean, sample std, sample variance and linear-interpolated
    quartiles over all earlier periods of the entity (``include_current`` adds
    the current row, the ``as_of`` form).

    All statistics share one window so Spark evaluates them in one pass. The
    quartiles are exact (``percentile``); ``approx_quantiles`` switches to
    ``percentile_approx`` for very long series.
    """
    p = prefix or col
    w = _w(entity, order).rowsBetween(UP, 0 if include_current else -1)
    exprs = {}
    if "mean" in stats:
        exprs[f"{p}_mean"] = F.avg(col).over(w)
    if "std" in stats:
        exprs[f"{p}_std"] = F.stddev_samp(col).over(w)
    if "var" in stats:
        exprs[f"{p}_var"] = F.var_samp(col).over(w)
    qs = [(q, float(q[1:]) / 100) for q in stats if q.startswith("q")]
    qcol = f"__q_{p}"
    if qs:
        arr = F.array(*[F.lit(v) for _, v in qs])
        exprs[qcol] = (F.percentile_approx(col, arr, 10000) if approx_quantiles
                       else F.percentile(col, arr)).over(w)
    out = df.withColumns(exprs)
    if qs:
        out = out.withColumns({f"{p}_{q}": F.col(qcol)[i] for i, (q, _) in enumerate(qs)}).drop(qcol)
    return out


def weighted_lag_mean(df: DataFrame, entity, order, col: str, n: int = 10, null_as_zero: bool = False,
                      out: str | None = None, legacy_ninth_lag: bool = False) -> DataFrame:
    """WIN-17 / WIN-18: sum_k (n + 1 - k) * lag_k / (n (n + 1) / 2) for k = 1..n.

    NULL unless all n lags exist, or with ``null_as_zero`` missing lags count as 0.
    ``legacy_ninth_lag`` reproduces the variant that reads lag 9 in place of lag 10.
    """
    w = _w(entity, order)
    total = None
    for k in range(1, n + 1):
        src = 9 if (legacy_ninth_lag and k == 10) else k
        lag = F.lag(col, src).over(w)
        if null_as_zero:
            lag = F.coalesce(lag, F.lit(0.0))
        term = lag * F.lit(float(n + 1 - k))
        total = term if total is None else total + term
    return df.withColumn(out or f"{col}_wavg{n}", total / F.lit(n * (n + 1) / 2.0))


def weekday_shares(flags: DataFrame, entity, order, days: Sequence[str], include_current: bool = True,
                   suffix: str = "_share") -> DataFrame:
    """WIN-21: running count of active weeks per weekday divided by the row total.

    ``flags`` is a dense (entity, week) table with one 0/1 column per weekday.
    ``include_current=False`` gives the lagged (leak-free) form. Share = 0 when
    the total is 0.
    """
    w = _w(entity, order).rowsBetween(UP, 0 if include_current else -1)
    runs = {f"__run_{d}": F.coalesce(F.sum(d).over(w), F.lit(0)) for d in days}
    out = flags.withColumns(runs)
    total = sum((F.col(c) for c in runs), F.lit(0))
    out = out.withColumn("__tot", total)
    shares = {f"{d}{suffix}": F.coalesce(F.try_divide(F.col(f"__run_{d}").cast("double"), F.col("__tot")),
                                         F.lit(0.0)) for d in days}
    return out.withColumns(shares).drop(*runs, "__tot")


def lag_to_prevent_leakage(df: DataFrame, entity, order, cols: Sequence[str]) -> DataFrame:
    """WIN-23: replace same-period columns by their value one period earlier."""
    w = _w(entity, order)
    return df.withColumns({c: F.lag(c, 1).over(w) for c in cols})


def interpolate_linear(df: DataFrame, entity, order: str, col: str, out: str | None = None,
                       position: str | None = None) -> DataFrame:
    """WIN-24: linear interpolation of NULLs between the neighbouring observed
    values inside each entity; leading/trailing gaps take the nearest observed
    value. ``position`` (defaults to ``order``) is the numeric x axis.
    """
    pos = F.col(position or order).cast("double")
    wf = _w(entity, order).rowsBetween(UP, 0)
    wb = _w(entity, order, desc=True).rowsBetween(UP, 0)
    obs_pos = F.when(F.col(col).isNotNull(), pos)
    d = df.withColumns({
        "__pv": F.last(col, ignorenulls=True).over(wf),
        "__pp": F.last(obs_pos, ignorenulls=True).over(wf),
    }).withColumns({
        "__nv": F.last(col, ignorenulls=True).over(wb),
        "__np": F.last(obs_pos, ignorenulls=True).over(wb),
    })
    interp = F.col("__pv") + (F.col("__nv") - F.col("__pv")) * F.try_divide(pos - F.col("__pp"),
                                                                              F.col("__np") - F.col("__pp"))
    val = F.coalesce(F.col(col), F.when(F.col("__pv").isNull(), F.col("__nv"))
                     .when(F.col("__nv").isNull(), F.col("__pv")).otherwise(interp))
    return d.withColumn(out or col, val).drop("__pv", "__pp", "__nv", "__np")


def interpolate_daily_to_hours(hourly: DataFrame, ts: str, daily: DataFrame, day: str, value: str,
                               out: str | None = None) -> DataFrame:
    """WIN-24, energy form: a daily measure joined to hourly rows, with missing days
    ramped hour by hour between the last hour of the previous observed day and
    the first hour of the next one (linear in time); leading/trailing gaps hold
    the nearest observed value.

    The gap logic runs on the day dimension (one row per day of the hourly
    table: first/last hour and the day's value), which is bounded by the time
    span and broadcast to the hours; the hourly fact is never put through an
    ordered global window.
    """
    out = out or value
    days = hourly.groupBy(F.to_date(ts).alias("__d")).agg(F.min(ts).alias("__first"), F.max(ts).alias("__last"))
    dim = days.join(daily.select(F.col(day).alias("__d"), F.col(value).alias("__v")), "__d", "left")
    fwd = Window.orderBy("__d").rowsBetween(UP, -1)
    bwd = Window.orderBy(F.col("__d").desc()).rowsBetween(UP, -1)
    secs = lambda c: F.col(c).cast("timestamp").cast("double")
    dim = dim.select("__d", "__v",
                     F.last("__v", ignorenulls=True).over(fwd).alias("__pv"),
                     F.last(F.when(F.col("__v").isNotNull(), secs("__last")), ignorenulls=True).over(fwd).alias("__pt"),
                     F.last("__v", ignorenulls=True).over(bwd).alias("__nv"),
                     F.last(F.when(F.col("__v").isNotNull(), secs("__first")), ignorenulls=True).over(bwd)
                     .alias("__nt"))
    j = hourly.join(F.broadcast(dim), F.to_date(F.col(ts)) == F.col("__d"), "left")
    x = F.col(ts).cast("timestamp").cast("double")
    ramp = F.col("__pv") + (F.col("__nv") - F.col("__pv")) * (x - F.col("__pt")) / (F.col("__nt") - F.col("__pt"))
    val = F.coalesce(F.col("__v"), F.when(F.col("__pv").isNull(), F.col("__nv"))
                     .when(F.col("__nv").isNull(), F.col("__pv")).otherwise(ramp))
    return j.withColumn(out, val).drop("__d", "__v", "__pv", "__pt", "__nv", "__nt")


def row_index(df: DataFrame, order: Sequence[str], out: str = "row_idx", start: int = 1,
              num_partitions: int | None = None) -> DataFrame:
    """WIN-25 / SPL-1: global 1-based row index in a total order, without a
    single-partition window.

    The rows are range-partitioned and sorted once (Spark samples the bounds) and
    written to the shared folder together with their partition and place in it; every
    partition's offset is the running count of those before it (one row per
    partition). ``order`` should be unique; NULLs come first, ties are numbered arbitrarily but once.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # monotonically_increasing_id is (partition << 33) + place in the partition
    placed = cut_lineage(ranged.withColumn("__id", F.monotonically_increasing_id()), "ranged")
    placed = placed.withColumn("__p", F.shiftright("__id", 33))
    counts = placed.groupBy("__p").agg(F.count(F.lit(1)).alias("__c"))
    offsets = counts.select("__p", F.coalesce(F.sum("__c").over(Window.orderBy("__p").rowsBetween(UP, -1)),
                                              F.lit(0)).alias("__off"))
    place = F.col("__id") - F.shiftleft("__p", 33)
    return (placed.join(F.broadcast(offsets), "__p")  # one row per partition
            .withColumn(out, (F.col("__off") + place + start).cast("long")).drop("__p", "__id", "__off"))


def dense_group_id(df: DataFrame, cols: Sequence[str], out: str = "group_id") -> DataFrame:
    """WIN-26: dense 1-based id per distinct combination of ``cols`` (sorted, NULLs first and a group like
    others), numbered on the distinct dimension and joined back."""
    dim = row_index(df.select(*cols).distinct(), cols, out=out)
    dim = dim.select(*[F.col(c).alias(f"__{c}") for c in cols], out)
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(dim[f"__{c}"]) for c in cols])
    return df.join(dim, same, "left").drop(*[f"__{c}" for c in cols])
