"""Shared building blocks for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators.aggregates import period_fact
from panelkit.operators.grid import dense_panel as grid_dense_panel
from panelkit.sources import testdata as td

H, M, W, DAY = "household_key", "month_no", "week_no", "day"
MEASURES = ("sales_value", "quantity", "discount")


def rounded(df: DataFrame, digits: int = 4, sig_cols=()) -> DataFrame:
    """Round every double column to ``digits`` decimals, and ``sig_cols`` to
    significant digits (oracle hygiene: summation order differs by engine).

    Rounds as ``round(x * 10^d) / 10^d`` (half away from zero on the scaled
    double), the same arithmetic as DuckDB's ``round(x, d)``, so exact ties
    such as 0.00655 round alike in both engines."""
    out = []
    for f in df.schema.fields:
        if f.name in sig_cols:
            out.append(sig(f.name).alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(round_dec(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def round_dec(c, digits: int = 4):
    scale = float(10 ** digits)
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * F.lit(scale)) / F.lit(scale)


def fact(spark: SparkSession, d: str, period: str) -> DataFrame:
    """Sparse (household, period) fact of the three measures (from per-order totals)."""
    return period_fact(td.order_lines(spark, d), [H, period], list(MEASURES))


def dense_panel(spark: SparkSession, d: str, period: str, fill: float | None = 0.0) -> DataFrame:
    """Dense (household, period) panel over periods 1..max, zero-filled (or NULL)."""
    return dense_panel_of(fact(spark, d, period), period, list(MEASURES), fill=fill)


def dense_panel_of(f: DataFrame, period: str, measures, fill: float | None = 0.0) -> DataFrame:
    return grid_dense_panel(f, H, period, measures, start=1, fill=fill)


def fact_sql(period: str) -> str:
    return f"""fact AS (
  SELECT household_key, {period}, sum(sales_value) AS sales_value, sum(quantity) AS quantity,
         sum(discount) AS discount
  FROM lines WHERE household_key IS NOT NULL AND {period} IS NOT NULL GROUP BY 1, 2)"""


def grid_sql(period: str) -> str:
    return f"""grid AS (
  SELECT e.household_key, CAST(t.p AS INTEGER) AS {period}
  FROM (SELECT DISTINCT household_key FROM fact) e,
       (SELECT max({period}) AS hi FROM fact) b,
       range(1, b.hi + 1) t(p))"""


def dense_sql(period: str, fill: bool = True) -> str:
    if fill:
        cols = ", ".join(f"coalesce(f.{m}, 0.0) AS {m}" for m in MEASURES)
    else:
        cols = ", ".join(f"f.{m}" for m in MEASURES)
    return f"""dense AS (
  SELECT g.household_key, g.{period}, {cols}
  FROM grid g LEFT JOIN fact f ON g.household_key = f.household_key AND g.{period} = f.{period})"""


def panel_ctes(period: str, fill: bool = True) -> list[str]:
    return [td.LINES_SQL, fact_sql(period), grid_sql(period), dense_sql(period, fill)]


def sig(c, digits: int = 8):
    """Round to ``digits`` significant digits (for variance-like outputs whose last
    bits depend on the engine's update formula). Only exact positive powers of
    ten are used, so Spark and DuckDB produce the same double. A 1e-12 relative
    nudge moves exact decimal ties (common for variances of integer data) off
    the tie, so two results 1 ulp apart round the same way."""
    c = F.col(c) if isinstance(c, str) else c
    c = c * F.lit(1.000000000001)
    e = F.floor(F.log10(F.abs(c))).cast("int")
    up = F.pow(F.lit(10.0), F.lit(digits - 1) - e)
    down = F.pow(F.lit(10.0), e - F.lit(digits - 1))
    return (F.when(c == 0, F.lit(0.0))
            .when(e >= digits - 1, F.round(c / down) * down)
            .otherwise(F.round(c * up) / up))


def sig_sql(x: str, digits: int = 8) -> str:
    x = f"(({x}) * 1.000000000001)"
    e = f"CAST(floor(log10(abs({x}))) AS INTEGER)"
    return (f"(CASE WHEN {x} = 0 THEN 0.0 WHEN {e} >= {digits - 1} "
            f"THEN round({x} / power(10.0, {e} - {digits - 1})) * power(10.0, {e} - {digits - 1}) "
            f"ELSE round({x} * power(10.0, {digits - 1} - {e})) / power(10.0, {digits - 1} - {e}) END)")
