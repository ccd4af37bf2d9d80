"""Retail enrichment queries (ENR-1..6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators import aggregates as agg
from panelkit.operators import enrich as en
from panelkit.operators import joins as jn
from panelkit.plans.common import DAY, H, W, dense_panel_of, fact, fact_sql, grid_sql, rounded
from panelkit.plans.registry import register, with_ctes
from panelkit.sources import testdata as td


def coupon_activity(spark: SparkSession, d: str) -> DataFrame:
    """Coupon counts on the full household x week grid of the transactions.
    Sparse-sparse join of the weekly fact and the weekly coupon counts (both
    already hash-partitioned by (household, week)), then one densify."""
    cp = td.coupons(spark, d).withColumn(W, td.week_of_day(F.col(DAY)))
    per = en.coupon_counts(cp, H, W, "coupon_upc", "campaign")
    sparse = fact(spark, d, W).select(H, W).join(per, [H, W], "left")
    return dense_panel_of(sparse, W, ["num_coupons", "num_campaigns"], fill=0)


COUPON_SQL = [td.LINES_SQL, td.COUPONS_SQL, fact_sql("week_no"), grid_sql("week_no"), """promo AS (
  SELECT g.household_key, g.week_no, coalesce(c.nc, 0) AS num_coupons, coalesce(c.nk, 0) AS num_campaigns
  FROM grid g LEFT JOIN (SELECT household_key, CAST(floor((day - 1) / 7) + 1 AS INTEGER) AS week_no,
                                count(DISTINCT coupon_upc) AS nc, count(DISTINCT campaign) AS nk FROM coupons GROUP BY 1, 2) c
  ON g.household_key = c.household_key AND g.week_no = c.week_no)"""]


@register("enr1_coupon_activity", with_ctes(*COUPON_SQL, body="SELECT * FROM promo"))
def enr1_coupon_activity(spark: SparkSession, d: str) -> DataFrame:
    return coupon_activity(spark, d)


@register("enr2_active_campaigns", with_ctes(td.LINES_SQL, td.CAMPAIGNS_SQL, """dm AS (
  SELECT day, week_no, avg(sales_value) AS sales_value FROM lines GROUP BY 1, 2)""", """cd AS (
  SELECT campaign, unnest(generate_series(start_day, end_day)) AS day FROM campaigns)""", body="""
SELECT dm.week_no, count(DISTINCT cd.campaign) AS num_campaigns, round(avg(dm.sales_value), 4) AS sales_value
FROM dm LEFT JOIN cd ON dm.day = cd.day GROUP BY 1"""))
def enr2_active_campaigns(spark: SparkSession, d: str) -> DataFrame:
    """Campaign intervals expanded to days, matched to the daily mean spend, per week."""
    dm = td.lines(spark, d).groupBy(DAY, W).agg(F.avg("sales_value").alias("sales_value"))
    return rounded(en.active_campaigns(td.campaigns(spark, d), dm, "campaign", "start_day", "end_day", DAY, W,
                                       "sales_value"))


@register("enr3_price_index", with_ctes(td.LINES_SQL, fact_sql("week_no"), """st AS (
  SELECT min(abs(discount)) AS mn, max(abs(discount)) AS mx FROM fact)""", """wk AS (
  SELECT week_no, avg(0.0 + sales_value / ((abs(discount) - mn) / (mx - mn) + 1)) / 3 - 24 AS v
  FROM fact, st GROUP BY 1)""", """idx AS (
  SELECT week_no, round_even((v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()) * 22.0 + -9.0, 0) AS fuel_price_diff
  FROM wk)""", body="""
SELECT f.household_key, f.week_no,
  coalesce(lag(f.sales_value) OVER (PARTITION BY f.household_key ORDER BY f.week_no), 0.0) AS prev_amount,
  i.fuel_price_diff, f.sales_value, f.discount
FROM fact f LEFT JOIN idx i ON f.week_no = i.week_no"""))
def enr3_price_index(spark: SparkSession, d: str) -> DataFrame:
    return en.price_index(fact(spark, d, W).select(H, W, "sales_value", "discount"), H, W, "sales_value",
                          "discount")


@register("enr4_seasonal_profile", with_ctes(td.LINES_SQL, td.PRODUCTS_SQL, """s AS (
  SELECT l.day FROM lines l WHERE l.product_id IN (SELECT product_id FROM products WHERE contains(sub_commodity_desc, 'hot')))""",
                                              """b AS (SELECT min(day) AS lo, max(day) AS hi FROM s)""",
                                              """c AS (SELECT CAST(least(floor((day - lo) / (hi - lo) * 120), 119) AS INTEGER) AS bin,
  count(*) AS n FROM s, b GROUP BY 1)""", body="""
SELECT CAST(r.range AS INTEGER) AS bin, round(lo + (hi - lo) * r.range / 120, 4) AS lower,
  round(lo + (hi - lo) * (r.range + 1) / 120, 4) AS upper, coalesce(c.n, 0) AS n
FROM range(120) r CROSS JOIN b LEFT JOIN c ON c.bin = r.range"""))
def enr4_seasonal_profile(spark: SparkSession, d: str) -> DataFrame:
    """Products whose sub-commodity holds the season keyword 'hot', and the
    120-bin day histogram of their sales lines."""
    prods = td.products(spark, d).filter(F.col("sub_commodity_desc").contains("hot")).select("product_id")
    s = jn.keep_in(td.lines(spark, d).select("product_id", DAY), prods, "product_id")
    return rounded(agg.histogram(s, DAY, 120))


SUPPORT_SQL = """support AS (
  SELECT week_no, household_key, sum(quantity) / 7 AS time_spent_on_app, count(*) * CAST(0.37 AS DOUBLE) AS supporting
  FROM lines GROUP BY 1, 2)"""


def support(spark: SparkSession, d: str) -> DataFrame:
    """App time and bonus points per (week, household), derived from the lines."""
    return td.lines(spark, d).groupBy(W, H).agg((F.sum("quantity") / 7).alias("time_spent_on_app"),
                                                (F.count(F.lit(1)) * 0.37).alias("supporting"))


@register("enr5_rebuild_promotions", with_ctes(*COUPON_SQL, SUPPORT_SQL, body="""
SELECT p.week_no, p.household_key, p.num_coupons,
  round_even(lead(s.time_spent_on_app) OVER (PARTITION BY p.household_key ORDER BY p.week_no), 2) AS time_in_app,
  round_even(s.supporting, 5) AS weekly_bonus_points
FROM promo p LEFT JOIN support s ON p.week_no = s.week_no AND p.household_key = s.household_key"""))
def enr5_rebuild_promotions(spark: SparkSession, d: str) -> DataFrame:
    promo = coupon_activity(spark, d).select(H, W, "num_coupons")
    return en.rebuild_promotions(promo, support(spark, d), H, W)


CLUSTERS_SQL = """clusters AS (
  SELECT c_custkey AS household_key, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'mid'
         ELSE 'high' END AS cluster FROM customer)"""


def clusters(spark: SparkSession, d: str) -> DataFrame:
    c = td.table(spark, d, "customer")
    lab = F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") < 5000, "mid").otherwise("high")
    return c.select(F.col("c_custkey").alias(H), lab.alias("cluster"))


@register("enr6_add_clusters", with_ctes(td.LINES_SQL, fact_sql("week_no"), CLUSTERS_SQL, body="""
SELECT f.household_key, f.week_no, f.sales_value, c.cluster FROM fact f LEFT JOIN clusters c
ON f.household_key = c.household_key"""))
def enr6_add_clusters(spark: SparkSession, d: str) -> DataFrame:
    return jn.enrich(fact(spark, d, W).select(H, W, "sales_value"), clusters(spark, d), H)
