"""Panel densification (GRD-1..5).

A grid is every (entity, period) pair. Entities come from the fact, periods
from a 1-row aggregate (``max(period)``) that is broadcast, so the grid is
produced where the entity list already lives and never passes the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import cut_lineage


def _bounds(rows: DataFrame, period: str, start: int | None, end: int | None) -> DataFrame:
    """One row (__lo, __hi): the asked bounds, widened so that no row lies outside."""
    lo, hi = F.min(period), F.max(period)
    return rows.agg((lo if start is None else F.least(lo, F.lit(start))).cast("int").alias("__lo"),
                    (hi if end is None else F.greatest(hi, F.lit(end))).cast("int").alias("__hi"))


def make_grid(fact: DataFrame, entity: str, period: str, start: int | None = 1,
              end: int | None = None) -> DataFrame:
    """GRD-1: entities x periods ``start..end`` (defaults: 1 and the largest period of the fact;
    ``start=None`` uses the smallest). Bounds widen to the periods of the fact, so none of its rows falls out."""
    src = cut_lineage(fact.select(entity, period).where(F.col(entity).isNotNull()))  # read for bounds and entities
    return (src.select(entity).distinct().crossJoin(F.broadcast(_bounds(src, period, start, end)))
            .select(entity, F.explode(F.sequence("__lo", "__hi")).alias(period)))


def dense_panel(fact: DataFrame, entity: str, period: str, measures: Sequence[str], start: int | None = 1,
                end: int | None = None, fill: float | None = 0) -> DataFrame:
    """GRD-1 + GRD-4 in one shuffle: the dense (entity, period) panel of a sparse fact.

    The sparse rows are sorted per entity; each row then expands to the periods up to the next
    row of its entity (the first row also to those before it), holding its measures
    on its own period and ``fill`` on the others. Only sparse rows cross the
    network, the work is linear in the dense rows, and these are generated
    hash-partitioned by entity, so a following entity window needs no exchange.
    Bounds widen to the periods of the fact, so no row falls out. The sparse fact is
    written once to the shared folder, for the bounds (a 1-row aggregate, a global barrier) and the expansion.
    """
    measures = list(measures)
    sparse = cut_lineage(fact.where(F.col(entity).isNotNull() & F.col(period).isNotNull())
                         .select(entity, period, *measures))
    # The dense rows are generated after this exchange, ~periods/active-share times
    # more rows than cross it: fix its width at the shuffle parallelism so AQE does
    # not coalesce it by the (small) sparse size. It is the window's own exchange.
    n = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = Window.partitionBy(entity).orderBy(period)
    s = (sparse.repartition(n, entity)
         .withColumns({"__prev": F.lag(period).over(w), "__next": F.lead(period).over(w)})
         .crossJoin(F.broadcast(_bounds(sparse, period, start, end))))
    first = F.when(F.col("__prev").isNull(), F.col("__lo")).otherwise(F.col(period)).cast("int")
    last = F.coalesce(F.col("__next") - 1, F.col("__hi")).cast("int")
    last = F.greatest(last, F.col(period).cast("int"))  # a repeated period stays on its own row
    types = {f.name: f.dataType for f in fact.schema.fields}
    g = s.select(entity, F.explode(F.sequence(first, last)).alias("__p"), F.col(period).alias("__at"), *measures)
    cols = []
    for m in measures:
        v = F.when(F.col("__p") == F.col("__at"), F.col(m))
        if fill is not None:
            v = F.coalesce(v, F.lit(fill).cast(types[m]))
        cols.append(v.alias(m))
    return g.select(entity, F.col("__p").cast(types[period]).alias(period), *cols)


def make_day_grid(fact: DataFrame, entity: str, day: str, week: str) -> DataFrame:
    """GRD-2: entities x days min..max, each day's week attached by a left join
    (NULL week when nobody was active that day)."""
    g = make_grid(fact, entity, day, start=None)
    day_week = fact.select(day, week).distinct()
    return g.join(day_week, day, "left").select(entity, day, week)


WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def make_weekday_grid(grid: DataFrame, weekday: str = "weekday",
                      values: Sequence[str] = WEEKDAYS) -> DataFrame:
    """GRD-3: grid x a fixed list of weekday labels (generated per row, no join)."""
    return grid.withColumn(weekday, F.explode(F.array(*[F.lit(v) for v in values])))


def densify(grid: DataFrame, fact: DataFrame, keys: Sequence[str], measures: Sequence[str] | None = None,
            fill: float | None = 0) -> DataFrame:
    """GRD-4 / GRD-5: left join the fact onto the grid; fill measures with ``fill``
    (``fill=None`` keeps gaps NULL)."""
    keys = list(keys)
    if measures is None:
        measures = [c for c in fact.columns if c not in keys]
    out = grid.join(fact.select(*keys, *measures), keys, "left")
    if fill is not None:
        out = out.select(*[c for c in grid.columns],
                         *[F.coalesce(F.col(m), F.lit(fill).cast(fact.schema[m].dataType)).alias(m)
                           for m in measures if m not in grid.columns])
    return out
