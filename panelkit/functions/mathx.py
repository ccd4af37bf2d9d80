"""Scaling helpers (MTH-1..4, ENC-2). Statistics come from a 1-row aggregate that
is broadcast onto the rows (a fixed-size side), never collected to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def min_max(df: DataFrame, cols: Sequence[str], lo: float = 0.0, hi: float = 1.0,
            suffix: str = "", constant_value: float = 0.0) -> DataFrame:
    """MTH-1 / ENC-2: (x - min) / (max - min) rescaled to [lo, hi]; a constant
    column maps to ``constant_value`` (0, unlike Spark ML's MinMaxScaler)."""
    stats = df.agg(*[F.min(c).alias(f"__mn_{c}") for c in cols], *[F.max(c).alias(f"__mx_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(stats))
    out = {}
    for c in cols:
        rng = F.col(f"__mx_{c}") - F.col(f"__mn_{c}")
        unit = F.when(rng == 0, F.lit(constant_value)).otherwise((F.col(c) - F.col(f"__mn_{c}")) / rng)
        out[f"{c}{suffix}"] = unit * F.lit(hi - lo) + F.lit(lo) if (lo, hi) != (0.0, 1.0) else unit
    return j.withColumns(out).drop(*[f"__mn_{c}" for c in cols], *[f"__mx_{c}" for c in cols])


def inv_min_max(col, mn, mx):
    """MTH-2: back from [0, 1] to units."""
    c = F.col(col) if isinstance(col, str) else col
    return c * (mx - mn) + mn


def standardize(df: DataFrame, cols: Sequence[str], population: bool = True, suffix: str = "") -> DataFrame:
    """MTH-4: z-score with the population (default) or sample standard deviation."""
    sd = F.stddev_pop if population else F.stddev_samp
    stats = df.agg(*[F.avg(c).alias(f"__mu_{c}") for c in cols], *[sd(c).alias(f"__sd_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(stats))
    out = {f"{c}{suffix}": F.try_divide(F.col(c) - F.col(f"__mu_{c}"), F.col(f"__sd_{c}")) for c in cols}
    return j.withColumns(out).drop(*[f"__mu_{c}" for c in cols], *[f"__sd_{c}" for c in cols])
