"""Aggregations (AGG), sort/top-k (SRT), set operations (SET), reshape (RSH), cleaning (CLEAN)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import mathx
from panelkit.functions import strings as fs
from panelkit.operators import aggregates as agg
from panelkit.operators import clean as cl
from panelkit.operators import joins as jn
from panelkit.operators import reshape as rs
from panelkit.plans.common import DAY, MEASURES, H, M, W, dense_panel, fact, panel_ctes, rounded, sig_sql
from panelkit.plans.registry import register, with_ctes
from panelkit.sources import testdata as td

SUMS = "sum(sales_value) AS sales_value, sum(quantity) AS quantity, sum(discount) AS discount"


@register("agg1_period_fact", with_ctes(td.LINES_SQL, body=f"SELECT household_key, week_no, {SUMS} FROM lines GROUP BY 1, 2"))
def agg1_period_fact(spark: SparkSession, d: str) -> DataFrame:
    return fact(spark, d, W)


@register("agg2_daily_fact", with_ctes(td.LINES_SQL, body=f"""
SELECT household_key, day, week_no, {SUMS} FROM lines GROUP BY 1, 2, 3"""))
def agg2_daily_fact(spark: SparkSession, d: str) -> DataFrame:
    return agg.period_fact(td.lines(spark, d), [H, DAY, W], list(MEASURES))


@register("agg3_daily_rollup", """
SELECT CAST(ts AS DATE) AS day, round(sum(value), 4) AS load, round(max(value), 4) AS temp,
  max(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END) AS weekend, count(*) AS n_events
FROM events GROUP BY 1""")
def agg3_daily_rollup(spark: SparkSession, d: str) -> DataFrame:
    e = td.table(spark, d, "events")
    return rounded(agg.rollup(e, [F.to_date("ts").alias("day")], {
        "load": F.sum("value"), "temp": F.max("value"),
        "weekend": F.max(F.dayofweek("ts").isin(1, 7).cast("int")), "n_events": F.count(F.lit(1))}))


@register("agg4_group_means", """
SELECT l_returnflag, l_linestatus, round(avg(l_orderkey), 4) AS l_orderkey, round(avg(l_partkey), 4) AS l_partkey,
  round(avg(l_suppkey), 4) AS l_suppkey, round(avg(l_linenumber), 4) AS l_linenumber,
  round(avg(l_quantity), 4) AS l_quantity, round(avg(l_extendedprice), 4) AS l_extendedprice,
  round(avg(l_discount), 4) AS l_discount, round(avg(l_tax), 4) AS l_tax
FROM lineitem GROUP BY 1, 2""")
def agg4_group_means(spark: SparkSession, d: str) -> DataFrame:
    li = td.table(spark, d, "lineitem")
    return rounded(agg.group_means(li, ["l_returnflag", "l_linestatus"]))


@register("agg5_group_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def agg5_group_counts(spark: SparkSession, d: str) -> DataFrame:
    return agg.group_counts(td.table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("agg6_value_counts", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def agg6_value_counts(spark: SparkSession, d: str) -> DataFrame:
    return agg.value_counts(td.table(spark, d, "customer"), "c_mktsegment")


@register("agg7_distinct_per_group", with_ctes(td.LINES_SQL, body="""
SELECT household_key, count(DISTINCT product_id) AS n_distinct_product_id FROM lines GROUP BY 1"""))
def agg7_distinct_per_group(spark: SparkSession, d: str) -> DataFrame:
    return agg.distinct_per_group(td.lines(spark, d), [H], "product_id")


@register("agg8_baskets_per_week", with_ctes(td.LINES_SQL, body="""
SELECT household_key, week_no, count(basket_id) AS n_baskets FROM
  (SELECT DISTINCT household_key, week_no, basket_id FROM lines) GROUP BY 1, 2"""))
def agg8_baskets_per_week(spark: SparkSession, d: str) -> DataFrame:
    b = td.lines(spark, d).select(H, W, "basket_id").dropDuplicates()
    return b.groupBy(H, W).agg(F.count("basket_id").alias("n_baskets"))


@register("agg9_distinct_rows", with_ctes(td.LINES_SQL, body="SELECT DISTINCT household_key, week_no FROM lines"))
def agg9_distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return agg.distinct_rows(td.lines(spark, d), [H, W])


@register("agg10_first_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def agg10_first_per_key(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders")
    return agg.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"])


@register("agg10_last_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def agg10_last_per_key(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders")
    return agg.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"],
                             last=True)


@register("agg11_summary", f"""
SELECT min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max,
  {sig_sql('stddev_samp(o_totalprice)')} AS o_totalprice_sd, round(avg(o_totalprice), 4) AS o_totalprice_mean
FROM orders""")
def agg11_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(agg.summary(td.table(spark, d, "orders"), ["o_totalprice"]), sig_cols=["o_totalprice_sd"])


@register("agg12_group_mean_transform", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_quantity, round(m.mq, 4) AS l_quantity_group_mean
FROM lineitem l JOIN (SELECT l_suppkey, avg(l_quantity) AS mq FROM lineitem GROUP BY 1) m ON l.l_suppkey = m.l_suppkey""")
def agg12_group_mean_transform(spark: SparkSession, d: str) -> DataFrame:
    li = td.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return rounded(agg.group_mean_transform(li, ["l_suppkey"], "l_quantity"))


@register("agg13_null_profile", with_ctes(*panel_ctes("month_no", fill=False), body="""
SELECT 'household_key' AS "column", CAST(count(*) FILTER (WHERE household_key IS NULL) AS BIGINT) AS n FROM dense
UNION ALL SELECT 'month_no', count(*) FILTER (WHERE month_no IS NULL) FROM dense
UNION ALL SELECT 'sales_value', count(*) FILTER (WHERE sales_value IS NULL) FROM dense
UNION ALL SELECT 'quantity', count(*) FILTER (WHERE quantity IS NULL) FROM dense
UNION ALL SELECT 'discount', count(*) FILTER (WHERE discount IS NULL) FROM dense"""))
def agg13_null_profile(spark: SparkSession, d: str) -> DataFrame:
    return agg.null_profile(dense_panel(spark, d, M, fill=None))


@register("agg13_sentinel_profile", """
SELECT 'l_discount' AS "column", CAST(count(*) FILTER (WHERE CAST(l_discount AS VARCHAR) = '0.0') AS BIGINT) AS n
FROM lineitem
UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE CAST(l_tax AS VARCHAR) = '0.0') FROM lineitem""")
def agg13_sentinel_profile(spark: SparkSession, d: str) -> DataFrame:
    li = td.table(spark, d, "lineitem")
    return agg.null_profile(li, ["l_discount", "l_tax"], sentinel="0.0")


@register("agg14_shape", "SELECT count(*) AS \"rows\", CAST(11 AS BIGINT) AS \"columns\" FROM lineitem")
def agg14_shape(spark: SparkSession, d: str) -> DataFrame:
    return agg.shape(td.table(spark, d, "lineitem"))


@register("agg15_histogram", """
WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT CAST(least(floor((l_extendedprice - lo) / (hi - lo) * 60), 59) AS INTEGER) AS bin, count(*) AS n
      FROM lineitem, b WHERE l_extendedprice IS NOT NULL GROUP BY 1)
SELECT CAST(r.range AS INTEGER) AS bin, round(lo + (hi - lo) * r.range / 60, 4) AS lower,
       round(lo + (hi - lo) * (r.range + 1) / 60, 4) AS upper, coalesce(c.n, 0) AS n
FROM range(60) r CROSS JOIN b LEFT JOIN c ON c.bin = r.range""")
def agg15_histogram(spark: SparkSession, d: str) -> DataFrame:
    return rounded(agg.histogram(td.table(spark, d, "lineitem"), "l_extendedprice", 60))


@register("agg16_corr", f"""
SELECT l_returnflag, {sig_sql('corr(l_quantity, l_extendedprice)')} AS corr FROM lineitem GROUP BY 1""")
def agg16_corr(spark: SparkSession, d: str) -> DataFrame:
    li = td.table(spark, d, "lineitem")
    return rounded(li.groupBy("l_returnflag").agg(F.corr("l_quantity", "l_extendedprice").alias("corr")),
                   sig_cols=["corr"])


@register("agg17_box_stats", """
SELECT l_returnflag, quantile_cont(l_quantity, 0.0) AS "min", quantile_cont(l_quantity, 0.25) AS q1,
  quantile_cont(l_quantity, 0.5) AS median, quantile_cont(l_quantity, 0.75) AS q3,
  quantile_cont(l_quantity, 1.0) AS "max" FROM lineitem GROUP BY 1""")
def agg17_box_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(agg.box_stats(td.table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity"))


# ---------------------------------------------------------------- sort / top-k
@register("srt1_multi_key_sort", """
SELECT o_orderpriority, o_totalprice, o_orderkey FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey""")
def srt1_multi_key_sort(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders").select("o_orderpriority", "o_totalprice", "o_orderkey")
    return o.orderBy("o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey")


DAY_ERR_SQL = """derr AS (
  SELECT CAST(e.ts AS DATE) AS day, avg(abs(e.value - m.mv)) AS mae FROM events e
  JOIN (SELECT event_type, avg(value) AS mv FROM events GROUP BY 1) m ON e.event_type = m.event_type GROUP BY 1)"""


def day_errors(spark: SparkSession, d: str) -> DataFrame:
    e = agg.group_mean_transform(td.table(spark, d, "events"), ["event_type"], "value", out="mv")
    return e.groupBy(F.to_date("ts").alias("day")).agg(F.avg(F.abs(F.col("value") - F.col("mv"))).alias("mae"))


@register("srt2_top_k", with_ctes(DAY_ERR_SQL, body="""
SELECT * FROM (SELECT 'best' AS which, day, round(mae, 4) AS mae FROM derr ORDER BY mae, day LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'worst', day, round(mae, 4) FROM derr ORDER BY mae DESC, day LIMIT 10)"""))
def srt2_top_k(spark: SparkSession, d: str) -> DataFrame:
    """Best and worst 10 days by mean absolute deviation from the event-type mean."""
    e = day_errors(spark, d)
    best = rs.top_k(e, "mae", 10, True, ["day"]).select(F.lit("best").alias("which"), "day", "mae")
    worst = rs.top_k(e, "mae", 10, False, ["day"]).select(F.lit("worst").alias("which"), "day", "mae")
    return rounded(best.unionByName(worst))


@register("srt3_top_categories", with_ctes(td.LINES_SQL, td.PRODUCTS_SQL, body="""
SELECT department, n, CAST(row_number() OVER (ORDER BY n DESC, department) AS INTEGER) AS rank FROM
  (SELECT p.department, count(*) AS n FROM lines l JOIN products p ON l.product_id = p.product_id GROUP BY 1)
ORDER BY n DESC, department LIMIT 5"""))
def srt3_top_categories(spark: SparkSession, d: str) -> DataFrame:
    ln = jn.enrich(td.lines(spark, d).select("product_id"), td.products(spark, d), "product_id", how="inner")
    return rs.top_categories(ln, "department", 5)


@register("srt4_head", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def srt4_head(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return o.orderBy("o_orderdate", "o_orderkey").limit(100)


# ---------------------------------------------------------------- set operations
@register("set1_union_all", """
SELECT l_orderkey AS k, l_quantity AS q, 'line' AS src FROM lineitem
UNION ALL SELECT o_orderkey, o_totalprice, 'order' FROM orders""")
def set1_union_all(spark: SparkSession, d: str) -> DataFrame:
    a = td.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("q"),
                                                F.lit("line").alias("src"))
    b = td.table(spark, d, "orders").select(F.lit("order").alias("src"), F.col("o_totalprice").alias("q"),
                                             F.col("o_orderkey").alias("k"))
    return jn.union_all([a, b])


@register("set2_dedupe", with_ctes(td.LINES_SQL, body="""
SELECT DISTINCT basket_id, product_id, day FROM (SELECT basket_id, product_id, day FROM lines
  UNION ALL SELECT basket_id, product_id, day FROM lines)"""))
def set2_dedupe(spark: SparkSession, d: str) -> DataFrame:
    ln = td.lines(spark, d).select("basket_id", "product_id", DAY)
    return jn.dedupe(ln.unionByName(ln))


# ---------------------------------------------------------------- reshape
TOP_DEPT_SQL = """top AS (SELECT department, row_number() OVER (ORDER BY n DESC, department) AS rank FROM
  (SELECT p.department, count(*) AS n FROM lines l JOIN products p ON l.product_id = p.product_id GROUP BY 1)
  ORDER BY n DESC, department LIMIT 5)"""


@register("rsh1_pivot_counts", with_ctes(td.LINES_SQL, td.PRODUCTS_SQL, TOP_DEPT_SQL, body="""
SELECT c.c_custkey AS household_key, """ + ", ".join(
    f"count(t.rank) FILTER (WHERE t.rank = {i}) AS department_top{i}" for i in range(1, 6)) + """
FROM customer c LEFT JOIN (lines l JOIN products p ON l.product_id = p.product_id
                           JOIN top t ON p.department = t.department) ON c.c_custkey = l.household_key
GROUP BY 1"""))
def rsh1_pivot_counts(spark: SparkSession, d: str) -> DataFrame:
    """Lines per top-5 department for every customer (0 when none, defect D19 fixed)."""
    ln = jn.enrich(td.lines(spark, d).select(H, "product_id"), td.products(spark, d), "product_id", how="inner")
    ents = td.table(spark, d, "customer").select(F.col("c_custkey").alias(H))
    return rs.pivot_top_counts(ln, H, "department", 5, entities=ents)


@register("rsh2_melt_residuals", with_ctes(td.HOURLY_SQL, """p AS (
  SELECT h.ts, h.load, a.load AS pred_prev_hour, b.load AS pred_prev_day FROM hourly h
  LEFT JOIN hourly a ON a.ts = h.ts - INTERVAL 1 HOUR LEFT JOIN hourly b ON b.ts = h.ts - INTERVAL 24 HOUR)""", body="""
SELECT ts, 'pred_prev_hour' AS metric, round(pred_prev_hour, 4) AS value, round(load - pred_prev_hour, 4) AS residual
FROM p UNION ALL
SELECT ts, 'pred_prev_day', round(pred_prev_day, 4), round(load - pred_prev_day, 4) FROM p"""))
def rsh2_melt_residuals(spark: SparkSession, d: str) -> DataFrame:
    """Two naive forecasts of hourly load (same hour yesterday, previous hour),
    unpivoted to (metric, value) with residuals. The forecasts are equi-joins on
    the shifted timestamp, not a global ordered window."""
    h = td.hourly_load(spark, d)
    prev_h = h.select((F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts"), F.col("load").alias("pred_prev_hour"))
    prev_d = h.select((F.col("ts") + F.expr("INTERVAL 24 HOURS")).alias("ts"), F.col("load").alias("pred_prev_day"))
    p = h.join(prev_h, "ts", "left").join(prev_d, "ts", "left")
    long = rs.melt(p, ["ts", "load"], ["pred_prev_hour", "pred_prev_day"])
    return rounded(long.withColumn("residual", F.col("load") - F.col("value")).drop("load"))


TOP_TYPE_SQL = """toptype AS (SELECT commodity_desc, row_number() OVER (ORDER BY n DESC, commodity_desc) AS rank FROM
  (SELECT p.commodity_desc, count(*) AS n FROM lines l JOIN products p ON l.product_id = p.product_id GROUP BY 1)
  ORDER BY n DESC, commodity_desc LIMIT 5)"""


def _rsh3_sql() -> str:
    dep = ", ".join(f"count(t.rank) FILTER (WHERE t.rank = {i}) AS department_top{i}" for i in range(1, 6))
    com = ", ".join(f"count(t.rank) FILTER (WHERE t.rank = {i}) AS commodity_desc_top{i}" for i in range(1, 6))
    cols = [f"department_top{i}" for i in range(1, 6)] + [f"commodity_desc_top{i}" for i in range(1, 6)]
    scaled = ", ".join(
        f"round(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.0 ELSE ({c} - min({c}) OVER ()) / "
        f"(max({c}) OVER () - min({c}) OVER ()) END, 4) AS {c}" for c in cols)
    return with_ctes(td.LINES_SQL, td.PRODUCTS_SQL, TOP_DEPT_SQL, TOP_TYPE_SQL, f"""a AS (
  SELECT c.c_custkey AS household_key, {dep} FROM customer c LEFT JOIN (lines l JOIN products p
    ON l.product_id = p.product_id JOIN top t ON p.department = t.department) ON c.c_custkey = l.household_key
  GROUP BY 1)""", f"""b AS (
  SELECT c.c_custkey AS household_key, {com} FROM customer c LEFT JOIN (lines l JOIN products p
    ON l.product_id = p.product_id JOIN toptype t ON p.commodity_desc = t.commodity_desc)
    ON c.c_custkey = l.household_key GROUP BY 1)""",
                     body=f"SELECT household_key, {scaled} FROM a JOIN b USING (household_key)")


@register("rsh3_category_profile", _rsh3_sql())
def rsh3_category_profile(spark: SparkSession, d: str) -> DataFrame:
    """Top-5 department and top-5 commodity counts per customer, min-max scaled per column."""
    ln = jn.enrich(td.lines(spark, d).select(H, "product_id"), td.products(spark, d), "product_id", how="inner")
    ents = td.table(spark, d, "customer").select(F.col("c_custkey").alias(H))
    a = rs.pivot_top_counts(ln, H, "department", 5, entities=ents)
    b = rs.pivot_top_counts(ln, H, "commodity_desc", 5, entities=ents)
    wide = a.join(b, H)
    cols = [c for c in wide.columns if c != H]
    return rounded(mathx.min_max(wide.select(H, *[F.col(c).cast("double") for c in cols]), cols))


# ---------------------------------------------------------------- cleaning
DIRTY_SQL = """dirty AS (
  SELECT CAST(c_custkey AS VARCHAR) AS household_key,
         CASE WHEN c_nationkey = 0 THEN '9999999' WHEN c_acctbal < 0 THEN '-$' || CAST(-c_acctbal AS VARCHAR)
              ELSE '$' || CAST(c_acctbal AS VARCHAR) END AS balance,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN ' ' ELSE c_mktsegment END AS segment,
         0 AS num_emails, CASE WHEN c_nationkey = 1 THEN c_name END AS prod_size
  FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), '$' || CAST(c_acctbal AS VARCHAR), c_mktsegment, 0, NULL
  FROM customer WHERE c_acctbal >= 0 AND c_nationkey <> 0 AND c_mktsegment <> 'MACHINERY' AND c_nationkey <> 1
  UNION ALL SELECT NULL, '$0', c_mktsegment, 0, NULL FROM customer)"""


def dirty_customers(spark: SparkSession, d: str) -> DataFrame:
    """Dirty copy of customer: money as text, sentinel '9999999', blank ' ', exact
    duplicate rows, key-less rows, a constant and a mostly-NULL column."""
    c = td.table(spark, d, "customer")
    bal = (F.when(F.col("c_nationkey") == 0, F.lit("9999999"))
           .when(F.col("c_acctbal") < 0, F.concat(F.lit("-$"), (-F.col("c_acctbal")).cast("string")))
           .otherwise(F.concat(F.lit("$"), F.col("c_acctbal").cast("string"))))
    base = c.select(F.col("c_custkey").cast("string").alias("household_key"), bal.alias("balance"),
                    F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(" ")).otherwise(F.col("c_mktsegment")).alias(
                        "segment"), F.lit(0).alias("num_emails"),
                    F.when(F.col("c_nationkey") == 1, F.col("c_name")).alias("prod_size"))
    dup = c.filter((F.col("c_acctbal") >= 0) & (F.col("c_nationkey") != 0) & (F.col("c_mktsegment") != "MACHINERY")
                   & (F.col("c_nationkey") != 1)).select(
        F.col("c_custkey").cast("string").alias("household_key"),
        F.concat(F.lit("$"), F.col("c_acctbal").cast("string")).alias("balance"), F.col("c_mktsegment").alias("segment"),
        F.lit(0).alias("num_emails"), F.lit(None).cast("string").alias("prod_size"))
    keyless = c.select(F.lit(None).cast("string").alias("household_key"), F.lit("$0").alias("balance"),
                       F.col("c_mktsegment").alias("segment"), F.lit(0).alias("num_emails"),
                       F.lit(None).cast("string").alias("prod_size"))
    return base.unionByName(dup).unionByName(keyless)


@register("clean1_dedupe", with_ctes(DIRTY_SQL, body="SELECT DISTINCT * FROM dirty"))
def clean1_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return jn.dedupe(dirty_customers(spark, d))


@register("clean1_duplicate_report", with_ctes(DIRTY_SQL, body="""
SELECT household_key, balance, count(*) AS n FROM dirty GROUP BY 1, 2 HAVING count(*) > 1"""))
def clean1_duplicate_report(spark: SparkSession, d: str) -> DataFrame:
    return agg.duplicate_report(dirty_customers(spark, d), ["household_key", "balance"])


@register("clean2_null_sentinels", with_ctes(DIRTY_SQL, body="""
SELECT household_key, CASE WHEN balance IN ('9999999') THEN NULL ELSE balance END AS balance,
       CASE WHEN segment IN (' ') THEN NULL ELSE segment END AS segment FROM dirty"""))
def clean2_null_sentinels(spark: SparkSession, d: str) -> DataFrame:
    df = dirty_customers(spark, d).select("household_key", "balance", "segment")
    return cl.null_sentinels(df, {"balance": ["9999999"], "segment": [" "]})


@register("clean3_drop_keyless", with_ctes(DIRTY_SQL, body="SELECT * FROM dirty WHERE household_key IS NOT NULL"))
def clean3_drop_keyless(spark: SparkSession, d: str) -> DataFrame:
    return cl.drop_keyless(dirty_customers(spark, d), ["household_key"])


@register("clean4_parse_money", with_ctes(DIRTY_SQL, body="""
SELECT household_key, TRY_CAST(replace(CASE WHEN balance = '9999999' THEN NULL ELSE balance END, '$', '') AS DOUBLE)
  AS balance FROM dirty"""))
def clean4_parse_money(spark: SparkSession, d: str) -> DataFrame:
    df = cl.null_sentinels(dirty_customers(spark, d), {"balance": ["9999999"]})
    return df.select("household_key", fs.parse_money("balance").alias("balance"))


@register("clean5_drop_constant", with_ctes(DIRTY_SQL, body="SELECT household_key, balance, segment, prod_size FROM dirty"))
def clean5_drop_constant(spark: SparkSession, d: str) -> DataFrame:
    return cl.drop_constant(dirty_customers(spark, d))


@register("clean6_drop_sparse", with_ctes(DIRTY_SQL, body="SELECT household_key, balance, segment, num_emails FROM dirty"))
def clean6_drop_sparse(spark: SparkSession, d: str) -> DataFrame:
    return cl.drop_sparse(dirty_customers(spark, d), 0.5)


@register("clean7_impute", with_ctes(DIRTY_SQL, body="""
SELECT coalesce(household_key, '') AS household_key, coalesce(prod_size, 'none') AS prod_size FROM dirty"""))
def clean7_impute(spark: SparkSession, d: str) -> DataFrame:
    df = dirty_customers(spark, d).select("household_key", "prod_size")
    return cl.impute(df, {"household_key": "", "prod_size": "none"})


@register("clean8_outlier_bounds", """
SELECT event_id, value FROM events WHERE value >= 5 AND value <= 95""")
def clean8_outlier_bounds(spark: SparkSession, d: str) -> DataFrame:
    return td.table(spark, d, "events").select("event_id", "value").filter(F.col("value").between(5, 95))


@register("clean9_incomplete_periods", with_ctes(td.HOURLY_SQL, body="""
SELECT ts, round(load, 4) AS load FROM (SELECT * FROM hourly WHERE day(ts) % 5 <> 0 OR hour(ts) <> 3)
QUALIFY count(*) OVER (PARTITION BY CAST(ts AS DATE)) >= 24 AND sum(load) OVER (PARTITION BY CAST(ts AS DATE)) >= 500"""))
def clean9_incomplete_periods(spark: SparkSession, d: str) -> DataFrame:
    """Keep days with all 24 hours and a daily total of at least 500; the input lacks an hour of every fifth day of a month."""
    h = td.hourly_load(spark, d).filter((F.dayofmonth("ts") % 5 != 0) | (F.hour("ts") != 3))
    h = h.withColumn("day", F.to_date("ts"))
    return rounded(cl.drop_incomplete_periods(h, "day", "load", min_rows=24, min_sum=500).drop("day"))


@register("clean10_surrogate_rekey", with_ctes(td.LINES_SQL, td.PRODUCTS_SQL, body="""
SELECT l.day, l.week_no, l.household_key, i.new_id, sum(l.sales_value) AS sales_value, sum(l.quantity) AS quantity
FROM lines l LEFT JOIN (SELECT product_id, dense_rank() OVER (ORDER BY department, commodity_desc) AS new_id
                        FROM products) i ON l.product_id = i.product_id GROUP BY 1, 2, 3, 4"""))
def clean10_surrogate_rekey(spark: SparkSession, d: str) -> DataFrame:
    """Products merged into one surrogate id per (department, commodity); lines re-keyed and re-aggregated."""
    return cl.surrogate_rekey(td.products(spark, d), td.lines(spark, d), "product_id",
                              ["department", "commodity_desc"], group_keys=[DAY, W, H],
                              measures=["sales_value", "quantity"])
