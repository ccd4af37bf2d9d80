"""Panel roles over the driver tables.

Each role has a Spark builder (``lines(spark, d)``) and the equivalent DuckDB
CTE text (``LINES_SQL``) so the oracle queries start from the same definition.

* household / entity  = ``o_custkey``
* DAY                 = days since 1994-12-31 of ``o_orderdate`` (1 = 1995-01-01)
* WEEK_NO             = floor((DAY - 1) / 7) + 1
* MONTH_NO            = (year - 1995) * 12 + month  (1..80)
* SALES_VALUE         = extended price net of discount, in whole cents; QUANTITY;
                        DISCOUNT = -(price x discount) in whole cents. Money is kept as
                        integer-valued doubles so sums are exact in any order.
* BASKET / PRODUCT    = ``l_orderkey`` / ``l_partkey``
* DEPARTMENT / COMMODITY = ``p_brand`` / ``p_type``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.sources.io import load_table

EPOCH = "1995-01-01"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A driver table, split into tasks by file and row group as Spark reads it."""
    return load_table(spark, d, name)


def day_number(ts_col) -> F.Column:
    return (F.datediff(F.to_date(ts_col), F.lit(EPOCH).cast("date")) + 1).cast("int")


def week_of_day(day_col) -> F.Column:
    return (F.floor((day_col - 1) / 7) + 1).cast("int")


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Transaction lines: one row per lineitem, keyed by household/basket/product/day."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    day = day_number(F.col("o_orderdate"))
    return j.select(
        F.col("o_custkey").alias("household_key"),
        F.col("l_orderkey").alias("basket_id"),
        F.col("l_partkey").alias("product_id"),
        day.alias("day"),
        week_of_day(day).alias("week_no"),
        ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")).cast("int").alias("month_no"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100).alias("sales_value"),
        F.col("l_quantity").alias("quantity"),
        (-F.round(F.col("l_extendedprice") * F.col("l_discount") * 100)).alias("discount"),
    )


def order_lines(spark: SparkSession, d: str) -> DataFrame:
    """Per-order (basket) totals joined to the order's household and date.

    Lineitem is aggregated per order before the join (map-side combine): the
    join then carries one row per order instead of one per line, and on a
    cluster the aggregation's exchange by order key is the sort-merge join's
    own exchange. Same sums as aggregating ``lines`` (money in integer cents).
    """
    li = table(spark, d, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum(F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100)).alias("sales_value"),
        F.sum("l_quantity").alias("quantity"),
        F.sum(-F.round(F.col("l_extendedprice") * F.col("l_discount") * 100)).alias("discount"))
    o = table(spark, d, "orders")
    j = per_order.join(o, per_order.l_orderkey == o.o_orderkey, "inner")
    day = day_number(F.col("o_orderdate"))
    return j.select(
        F.col("o_custkey").alias("household_key"), F.col("l_orderkey").alias("basket_id"), day.alias("day"),
        week_of_day(day).alias("week_no"),
        ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")).cast("int").alias("month_no"),
        "sales_value", "quantity", "discount")


LINES_SQL = """lines AS (
  SELECT o.o_custkey AS household_key, l.l_orderkey AS basket_id, l.l_partkey AS product_id,
         CAST(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) + 1 AS INTEGER) AS day,
         CAST(floor(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) / 7) + 1 AS INTEGER) AS week_no,
         CAST((year(o.o_orderdate) - 1995) * 12 + month(o.o_orderdate) AS INTEGER) AS month_no,
         CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(month(o.o_orderdate) AS INTEGER) AS month,
         round(l.l_extendedprice * (1 - l.l_discount) * 100) AS sales_value,
         l.l_quantity AS quantity,
         -round(l.l_extendedprice * l.l_discount * 100) AS discount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def products(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("department"),
                    F.col("p_type").alias("commodity_desc"), F.col("p_name").alias("sub_commodity_desc"))


PRODUCTS_SQL = """products AS (
  SELECT p_partkey AS product_id, p_brand AS department, p_type AS commodity_desc,
         p_name AS sub_commodity_desc FROM part)"""


def campaigns(spark: SparkSession, d: str) -> DataFrame:
    """Campaign intervals: each part is a campaign running [p_size, p_size + 13]."""
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("campaign"), F.col("p_size").alias("start_day"),
                    (F.col("p_size") + 13).alias("end_day"))


CAMPAIGNS_SQL = """campaigns AS (
  SELECT p_partkey AS campaign, p_size AS start_day, p_size + 13 AS end_day FROM part)"""


def coupons(spark: SparkSession, d: str) -> DataFrame:
    """Coupon redemptions: lines with a discount of at least 8 %, campaign = supplier."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    j = li.filter(F.col("l_discount") >= 0.08).join(o, li.l_orderkey == o.o_orderkey)
    return j.select(F.col("o_custkey").alias("household_key"), day_number(F.col("o_orderdate")).alias("day"),
                    F.col("l_partkey").alias("coupon_upc"), F.col("l_suppkey").alias("campaign"))


COUPONS_SQL = """coupons AS (
  SELECT o.o_custkey AS household_key,
         CAST(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) + 1 AS INTEGER) AS day,
         l.l_partkey AS coupon_upc, l.l_suppkey AS campaign
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_discount >= 0.08)"""


def hourly_load(spark: SparkSession, d: str) -> DataFrame:
    """Hourly 'load' series: sum of event values per hour."""
    e = table(spark, d, "events")
    return (e.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
            .agg(F.sum("value").alias("load")))


HOURLY_SQL = """hourly AS (
  SELECT date_trunc('hour', ts) AS ts, sum(value) AS load FROM events GROUP BY 1)"""


def daily_weather(spark: SparkSession, d: str) -> DataFrame:
    """Daily 'temperature': mean value of 'view' events per day; every fourth day of a month is not observed."""
    e = table(spark, d, "events").filter((F.col("event_type") == "view") & (F.dayofmonth("ts") % 4 != 0))
    return e.groupBy(F.to_date("ts").alias("date")).agg(F.avg("value").alias("temp"))


WEATHER_SQL = """weather AS (
  SELECT CAST(ts AS DATE) AS date, avg(value) AS temp FROM events
  WHERE event_type = 'view' AND day(ts) % 4 <> 0 GROUP BY 1)"""


def credit(spark: SparkSession, d: str) -> DataFrame:
    """Fairness table: labelled documents, favourable = quality, privileged = English."""
    lab = table(spark, d, "labels")
    doc = table(spark, d, "documents").select("doc_id", "lang")
    return lab.join(doc, "doc_id").select("doc_id", "lang", F.col("quality").alias("favourable"), "toxic")


CREDIT_SQL = """credit AS (
  SELECT l.doc_id, d.lang, l.quality AS favourable, l.toxic
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def demographics_raw(spark: SparkSession, d: str) -> DataFrame:
    """Demographic text fields derived from customer + nation (range texts, capped
    counts, composition text, status codes) for the text-to-value operators."""
    c = table(spark, d, "customer")
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    bal, seg, nk = F.col("c_acctbal"), F.col("c_mktsegment"), F.col("c_nationkey")
    age = (F.when(bal < 0, "19-24").when(bal < 2500, "25-34").when(bal < 5000, "35-44")
           .when(bal < 7500, "45-54").otherwise("65+"))
    income = (F.when(bal < 0, "Under 15K").when(bal < 2000, "15-24K").when(bal < 4000, "25-34K")
              .when(bal < 6000, "35-49K").when(bal < 8000, "50-74K").otherwise("75K+"))
    comp = (F.when(seg == "AUTOMOBILE", "2 Adults Kids").when(seg == "BUILDING", "Single Female")
            .when(seg == "FURNITURE", "1 Adult Kids").when(seg == "HOUSEHOLD", "2 Adults No Kids")
            .otherwise("Unknown"))
    size = F.when(nk % 5 == 4, "5+").otherwise(((nk % 5) + 1).cast("string"))
    kids = (F.when(nk % 4 == 0, "None/Unknown").when(nk % 4 == 3, "3+").otherwise((nk % 4).cast("string")))
    marital = F.when(F.col("n_regionkey") == 0, "A").when(F.col("n_regionkey") == 1, "B").otherwise("U")
    home = F.when(nk % 3 == 0, "Probable Owner").when(nk % 3 == 1, "Probable Renter").otherwise("Homeowner")
    return j.select(F.col("c_custkey").alias("household_key"), age.alias("age_desc"),
                    marital.alias("marital_status_code"), income.alias("income_desc"),
                    home.alias("homeowner_desc"), comp.alias("hh_comp_desc"),
                    size.alias("household_size_desc"), kids.alias("kid_category_desc"))


DEMOGRAPHICS_SQL = """demo AS (
  SELECT c.c_custkey AS household_key,
    CASE WHEN c_acctbal < 0 THEN '19-24' WHEN c_acctbal < 2500 THEN '25-34' WHEN c_acctbal < 5000 THEN '35-44'
         WHEN c_acctbal < 7500 THEN '45-54' ELSE '65+' END AS age_desc,
    CASE WHEN n.n_regionkey = 0 THEN 'A' WHEN n.n_regionkey = 1 THEN 'B' ELSE 'U' END AS marital_status_code,
    CASE WHEN c_acctbal < 0 THEN 'Under 15K' WHEN c_acctbal < 2000 THEN '15-24K' WHEN c_acctbal < 4000 THEN '25-34K'
         WHEN c_acctbal < 6000 THEN '35-49K' WHEN c_acctbal < 8000 THEN '50-74K' ELSE '75K+' END AS income_desc,
    CASE WHEN c_nationkey % 3 = 0 THEN 'Probable Owner' WHEN c_nationkey % 3 = 1 THEN 'Probable Renter'
         ELSE 'Homeowner' END AS homeowner_desc,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '2 Adults Kids' WHEN 'BUILDING' THEN 'Single Female'
         WHEN 'FURNITURE' THEN '1 Adult Kids' WHEN 'HOUSEHOLD' THEN '2 Adults No Kids' ELSE 'Unknown' END AS hh_comp_desc,
    CASE WHEN c_nationkey % 5 = 4 THEN '5+' ELSE CAST(c_nationkey % 5 + 1 AS VARCHAR) END AS household_size_desc,
    CASE WHEN c_nationkey % 4 = 0 THEN 'None/Unknown' WHEN c_nationkey % 4 = 3 THEN '3+'
         ELSE CAST(c_nationkey % 4 AS VARCHAR) END AS kid_category_desc
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def products_raw(spark: SparkSession, d: str) -> DataFrame:
    """Product dimension with blank departments (large sizes) and upper-case sub-commodities."""
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("product_id"),
                    F.when(F.col("p_size") > 45, F.lit(" ")).otherwise(F.col("p_brand")).alias("department"),
                    F.col("p_type").alias("commodity_desc"), F.upper("p_name").alias("sub_commodity_desc"))


PRODUCTS_RAW_SQL = """praw AS (
  SELECT p_partkey AS product_id, CASE WHEN p_size > 45 THEN ' ' ELSE p_brand END AS department,
         p_type AS commodity_desc, upper(p_name) AS sub_commodity_desc FROM part)"""


def promotions(spark: SparkSession, d: str) -> DataFrame:
    """Promotions per household and week: seconds in the app (view and click events, in hundredths) and bonus points (ten a
    purchase). The household is the event's user, the week follows from its number."""
    e = table(spark, d, "events")
    return e.groupBy(F.col("user_id").alias("household_key"), (F.col("event_id") % 344 + 1).cast("int").alias("week_no")).agg(
        F.sum(F.when(F.col("event_type").isin("view", "click"), F.round(F.col("value") * 100).cast("long")).otherwise(0)).alias("time_in_app"),
        F.sum(F.when(F.col("event_type") == "purchase", 10).otherwise(0)).cast("long").alias("bonus_points"))


PROMOTIONS_SQL = """promotions AS (
  SELECT user_id AS household_key, CAST(event_id % 344 + 1 AS INTEGER) AS week_no,
    sum(CASE WHEN event_type IN ('view', 'click') THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END) AS time_in_app,
    sum(CASE WHEN event_type = 'purchase' THEN 10 ELSE 0 END) AS bonus_points FROM events GROUP BY 1, 2)"""
