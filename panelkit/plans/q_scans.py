"""Fills, running statistics and quantiles over one long order (WIN-8, 11, 14, 24 without an entity; AGG-17 on prices)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators import aggregates as agg
from panelkit.operators import scans as sc
from panelkit.plans.common import rounded, sig_sql
from panelkit.plans.registry import register, with_ctes
from panelkit.sources import testdata as td

GAPS_SQL = """gaps AS (SELECT o_orderkey, o_orderdate,
  CASE WHEN o_orderkey % 11 IN (0, 3, 4, 5, 9) THEN NULL ELSE o_totalprice END AS price FROM orders)"""


def gaps(spark: SparkSession, d: str) -> DataFrame:
    """Orders as one series whose price is missing in runs of up to three rows."""
    price = F.when(~(F.col("o_orderkey") % 11).isin(0, 3, 4, 5, 9), F.col("o_totalprice"))
    return td.table(spark, d, "orders").select("o_orderkey", "o_orderdate", price.alias("price"))


@register("win8_ffill_ordered", with_ctes(GAPS_SQL, body="""
SELECT o_orderkey, round(last_value(price IGNORE NULLS) OVER (ORDER BY o_orderdate, o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS price FROM gaps"""))
def win8_ffill_ordered(spark: SparkSession, d: str) -> DataFrame:
    """The last known price in order date, over all orders as one series."""
    return rounded(sc.ffill_ordered(gaps(spark, d), ["o_orderdate", "o_orderkey"], "price").drop("o_orderdate"))


@register("win24_interpolate_ordered", with_ctes(GAPS_SQL, """near AS (SELECT o_orderkey, price,
  last_value(price IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN price IS NOT NULL THEN o_orderkey END IGNORE NULLS) OVER b AS pp,
  first_value(price IGNORE NULLS) OVER a AS nv, first_value(CASE WHEN price IS NOT NULL THEN o_orderkey END IGNORE NULLS) OVER a AS np
  FROM gaps WINDOW b AS (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    a AS (ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""", body="""
SELECT o_orderkey, round(CASE WHEN price IS NOT NULL THEN price WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
  ELSE pv + (nv - pv) * ((o_orderkey - pp) / (np - pp)) END, 4) AS price FROM near"""))
def win24_interpolate_ordered(spark: SparkSession, d: str) -> DataFrame:
    """Missing prices on the line between the known ones over the order key, as one series."""
    return rounded(sc.interpolate_ordered(gaps(spark, d), ["o_orderkey"], "o_orderkey", "price").drop("o_orderdate"))


@register("win11_running_stats_ordered", with_ctes(GAPS_SQL, body=f"""
SELECT o_orderkey, count(price) OVER w AS price_n, {sig_sql('avg(price) OVER w')} AS price_mean,
  {sig_sql('stddev_samp(price) OVER w')} AS price_std
FROM gaps WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""))
def win11_running_stats_ordered(spark: SparkSession, d: str) -> DataFrame:
    """Count, mean and deviation of all earlier prices, over all orders as one series."""
    out = sc.running_stats_ordered(gaps(spark, d), ["o_orderdate", "o_orderkey"], "price")
    return rounded(out.select("o_orderkey", "price_n", "price_mean", "price_std"), sig_cols=["price_mean", "price_std"])


@register("agg17_box_stats_prices", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.0), 4) AS "min", round(quantile_cont(l_extendedprice, 0.25), 4) AS q1,
  round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.75), 4) AS q3,
  round(quantile_cont(l_extendedprice, 1.0), 4) AS "max" FROM lineitem GROUP BY 1""")
def agg17_box_stats_prices(spark: SparkSession, d: str) -> DataFrame:
    """Box statistics of nearly distinct values in three classes."""
    return rounded(agg.box_stats(td.table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice"))


@register("win14_hourly_quantiles", """
WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, round(sum(value), 2) AS load FROM events GROUP BY 1, 2)
SELECT event_type, hour, load, round(quantile_cont(load, 0.25) OVER w, 4) AS q25, round(quantile_cont(load, 0.5) OVER w, 4) AS q50,
  round(quantile_cont(load, 0.75) OVER w, 4) AS q75
FROM h WINDOW w AS (PARTITION BY event_type ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def win14_hourly_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Running quartiles of the hourly load of every event type, before the hour (rank trees)."""
    h = td.table(spark, d, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.round(F.sum("value"), 2).alias("load"))
    h = h.withColumn("hour", F.col("hour").cast("timestamp_ntz"))
    return rounded(sc.expanding_quantiles(h, ["event_type"], ["hour"], "load", {"q25": 0.25, "q50": 0.5, "q75": 0.75}))
