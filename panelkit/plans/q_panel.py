"""Flagship: customer x month spend panel with leak-free expanding features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.operators import windows as win
from panelkit.plans.common import H, M, dense_panel, panel_ctes, rounded, sig_sql
from panelkit.plans.registry import register, with_ctes

FLAGSHIP_SQL = with_ctes(*panel_ctes("month_no"), body="""
SELECT household_key, month_no, round(sales_value, 4) AS sales_value,
  round(coalesce(lag(sales_value) OVER w, 0.0), 4) AS sales_value_last_period,
  round(avg(sales_value) OVER wx, 4) AS sales_value_mean,
  {STD} AS sales_value_std,
  {VAR} AS sales_value_var,
  round(quantile_cont(sales_value, 0.25) OVER wx, 4) AS sales_value_q25,
  round(quantile_cont(sales_value, 0.5) OVER wx, 4) AS sales_value_q50,
  round(quantile_cont(sales_value, 0.75) OVER wx, 4) AS sales_value_q75
FROM dense
WINDOW w AS (PARTITION BY household_key ORDER BY month_no),
       wx AS (PARTITION BY household_key ORDER BY month_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""".format(
    STD=sig_sql("stddev_samp(sales_value) OVER wx"), VAR=sig_sql("var_samp(sales_value) OVER wx")))


def customer_month_spend(spark: SparkSession, d: str) -> DataFrame:
    """lineitem x orders -> monthly fact -> grid -> zero-filled panel -> last-period
    amount and expanding mean/std/var/quartiles before the current month."""
    p = dense_panel(spark, d, M).select(H, M, "sales_value")
    p = win.last_period_amount(p, H, M, "sales_value")
    p = win.expanding_stats(p, H, M, "sales_value")
    return rounded(p, sig_cols=("sales_value_std", "sales_value_var"))


register("customer_month_spend", FLAGSHIP_SQL)(customer_month_spend)


# ---------------------------------------------------------------- JON-9: the assembled feature table
from pyspark.sql import functions as F  # noqa: E402

from panelkit.functions import calendar as cal  # noqa: E402
from panelkit.functions import strings as fs  # noqa: E402
from panelkit.operators import joins as jn  # noqa: E402
from panelkit.operators import split as sp  # noqa: E402
from panelkit.plans.common import dense_panel_of  # noqa: E402
from panelkit.sources import testdata as td  # noqa: E402

_CAP = ("CASE WHEN {c} IN ('None/Unknown', 'Unknown') THEN 0 "
        "ELSE TRY_CAST(replace({c}, '+', '') AS INTEGER) END")

FEATURE_TABLE_SQL = with_ctes(*panel_ctes("month_no"), td.DEMOGRAPHICS_SQL, """vis AS (
  SELECT household_key, month_no, count(*) AS n_visits FROM (SELECT DISTINCT household_key, day, month_no FROM lines)
  GROUP BY 1, 2)""", """dm AS (
  SELECT household_key, hs AS household_size,
    CASE WHEN contains(hh_comp_desc, '2') THEN 2 WHEN regexp_matches(hh_comp_desc, '1|Single') THEN 1
         ELSE hs - kids END AS num_adults
  FROM (SELECT household_key, hh_comp_desc, {S} AS hs, {K} AS kids FROM demo))""".replace(
    "{S}", _CAP.format(c="household_size_desc")).replace("{K}", _CAP.format(c="kid_category_desc")), """feat AS (
  SELECT d.household_key, d.month_no, d.sales_value,
    coalesce(lag(d.sales_value) OVER w, 0.0) AS sales_value_last_period,
    coalesce(lag(d.quantity) OVER w, 0.0) AS quantity_last_period,
    avg(d.sales_value) OVER wx AS sales_value_mean,
    stddev_samp(d.sales_value) OVER wx AS sales_value_std,
    quantile_cont(d.sales_value, 0.5) OVER wx AS sales_value_q50,
    (""" + " + ".join(f"coalesce(lag(d.sales_value, {k}) OVER w, 0.0) * {11 - k}.0" for k in range(1, 11)) + """) / 55.0
      AS sales_value_wavg10,
    avg(coalesce(v.n_visits, 0)) OVER wx AS avg_visits
  FROM dense d LEFT JOIN vis v ON d.household_key = v.household_key AND d.month_no = v.month_no
  WINDOW w AS (PARTITION BY d.household_key ORDER BY d.month_no),
         wx AS (PARTITION BY d.household_key ORDER BY d.month_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
    body="""
SELECT f.household_key, f.month_no, round(f.sales_value, 4) AS sales_value,
  round(f.sales_value_last_period, 4) AS sales_value_last_period,
  round(f.quantity_last_period, 4) AS quantity_last_period, round(f.sales_value_mean, 4) AS sales_value_mean,
  {STD} AS sales_value_std, round(f.sales_value_q50, 4) AS sales_value_q50,
  round(f.sales_value_wavg10, 4) AS sales_value_wavg10, round(f.avg_visits, 4) AS avg_visits,
  CAST((f.month_no - 1) % 12 + 1 AS INTEGER) AS month_of_year,
  CASE WHEN (f.month_no - 1) % 12 + 1 IN (12, 1, 2) THEN 1 WHEN (f.month_no - 1) % 12 + 1 IN (3, 4, 5) THEN 2
       WHEN (f.month_no - 1) % 12 + 1 IN (6, 7, 8) THEN 3 ELSE 4 END AS season,
  dm.household_size, dm.num_adults, dm.household_size - dm.num_adults AS num_children,
  CASE WHEN row_number() OVER (ORDER BY f.month_no, f.household_key) <= floor(0.8 * count(*) OVER ())
       THEN 'train' ELSE 'test' END AS split
FROM feat f LEFT JOIN dm ON f.household_key = dm.household_key
WHERE f.sales_value_mean IS NOT NULL""".replace("{STD}", sig_sql("f.sales_value_std")))


def feature_table(spark: SparkSession, d: str) -> DataFrame:
    """JON-9: the model-ready household x month table.

    One sparse fact (spend, quantity, distinct visit days per household-month),
    one dense panel, all same-window features in one Window operator,
    demographics joined on explicit keys (never row position),
    calendar columns as expressions, leak-free by construction (every history
    feature ends one period before the row), first month dropped (no history),
    then the temporal 80/20 split.
    """
    sparse = td.lines(spark, d).groupBy(H, M).agg(F.sum("sales_value").alias("sales_value"),
                                                  F.sum("quantity").alias("quantity"),
                                                  F.countDistinct("day").alias("n_visits"))
    p = dense_panel_of(sparse, M, ["sales_value", "quantity", "n_visits"], fill=0)
    p = win.last_period_amount(p, H, M, "sales_value")
    p = win.last_period_amount(p, H, M, "quantity")
    p = win.expanding_stats(p, H, M, "sales_value", stats=["mean", "std", "q50"])
    p = win.weighted_lag_mean(p, H, M, "sales_value", 10, null_as_zero=True)
    p = win.expanding_stats(p, H, M, "n_visits", stats=["mean"], prefix="v").withColumnRenamed("v_mean", "avg_visits")
    moy = ((F.col(M) - 1) % 12 + 1).cast("int")
    p = p.withColumns({"month_of_year": moy, "season": cal.season_code(moy)})
    dm = td.demographics_raw(spark, d)
    hs, kids = fs.capped_int("household_size_desc"), fs.capped_int("kid_category_desc")
    dm = dm.select(H, hs.alias("household_size"),
                   fs.num_adults("hh_comp_desc", hs, kids).alias("num_adults"))
    dm = dm.withColumn("num_children", F.col("household_size") - F.col("num_adults"))
    p = jn.assemble(p.drop("quantity", "n_visits"), [(dm, [H])])
    p = p.filter(F.col("sales_value_mean").isNotNull())
    p = sp.split_ordered(p, [M, H], 0.8)
    return rounded(p, sig_cols=["sales_value_std"])


register("jon9_feature_table", FEATURE_TABLE_SQL)(feature_table)
