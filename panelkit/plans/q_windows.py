"""Grid (GRD-*) and window (WIN-*) queries over the household panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import calendar as cal
from panelkit.operators import aggregates as agg
from panelkit.operators import grid as grd
from panelkit.operators import windows as win
from panelkit.plans.common import (DAY, MEASURES, H, M, W, dense_panel, dense_panel_of, fact, fact_sql, grid_sql,
                                   panel_ctes, rounded, sig_sql)
from panelkit.plans.registry import register, with_ctes
from panelkit.sources import testdata as td

# ---------------------------------------------------------------- grids
@register("grd1_make_grid", with_ctes(td.LINES_SQL, fact_sql("month_no"), grid_sql("month_no"),
                                      body="SELECT household_key, month_no FROM grid"))
def grd1_make_grid(spark: SparkSession, d: str) -> DataFrame:
    return grd.make_grid(fact(spark, d, M), H, M, start=1)


EVENTS_DAY_SQL = """ev AS (
  SELECT user_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS day,
         CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) + 1 AS INTEGER) AS week_no,
         CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, value, event_type, ts
  FROM events)"""


def events_days(spark: SparkSession, d: str) -> DataFrame:
    e = td.table(spark, d, "events")
    day = (F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1).cast("int")
    return e.select("user_id", day.alias(DAY), td.week_of_day(day).alias(W),
                    F.dayofweek("ts").alias("dow"), "value", "event_type", "ts")


@register("grd2_day_grid", with_ctes(EVENTS_DAY_SQL, body="""
SELECT g.user_id, g.day, dw.week_no
FROM (SELECT u.user_id, CAST(t.p AS INTEGER) AS day
      FROM (SELECT DISTINCT user_id FROM ev) u, (SELECT min(day) lo, max(day) hi FROM ev) b, range(b.lo, b.hi + 1) t(p)) g
LEFT JOIN (SELECT DISTINCT day, week_no FROM ev) dw ON g.day = dw.day"""))
def grd2_day_grid(spark: SparkSession, d: str) -> DataFrame:
    return grd.make_day_grid(events_days(spark, d), "user_id", DAY, W)


@register("grd3_weekday_grid", with_ctes(EVENTS_DAY_SQL, body="""
SELECT u.user_id, CAST(t.p AS INTEGER) AS week_no, wd.weekday
FROM (SELECT DISTINCT user_id FROM ev) u, (SELECT max(week_no) hi FROM ev) b, range(1, b.hi + 1) t(p),
     (SELECT unnest(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']) AS weekday) wd"""))
def grd3_weekday_grid(spark: SparkSession, d: str) -> DataFrame:
    g = grd.make_grid(events_days(spark, d), "user_id", W, start=1)
    return grd.make_weekday_grid(g)


@register("grd4_densify", with_ctes(*panel_ctes("month_no"), body="SELECT * FROM dense"))
def grd4_densify(spark: SparkSession, d: str) -> DataFrame:
    return dense_panel(spark, d, M)


@register("grd5_densify_nulls", with_ctes(*panel_ctes("month_no", fill=False), body="SELECT * FROM dense"))
def grd5_densify_nulls(spark: SparkSession, d: str) -> DataFrame:
    return dense_panel(spark, d, M, fill=None)


# ---------------------------------------------------------------- lags
WM = "WINDOW w AS (PARTITION BY household_key ORDER BY month_no)"


@register("win1_lag", with_ctes(*panel_ctes("month_no"), body=f"""
SELECT household_key, month_no, sales_value, lag(sales_value, 1) OVER w AS sales_value_lag1,
       lag(sales_value, 2) OVER w AS sales_value_lag2 FROM dense {WM}"""))
def win1_lag(spark: SparkSession, d: str) -> DataFrame:
    p = dense_panel(spark, d, M).select(H, M, "sales_value")
    p = win.lag_col(p, H, M, "sales_value", 1)
    return win.lag_col(p, H, M, "sales_value", 2)


@register("win2_lead", with_ctes(*panel_ctes("month_no"), body=f"""
SELECT household_key, month_no, quantity, lead(quantity, 1) OVER w AS quantity_lead1 FROM dense {WM}"""))
def win2_lead(spark: SparkSession, d: str) -> DataFrame:
    p = dense_panel(spark, d, M).select(H, M, "quantity")
    return win.lead_col(p, H, M, "quantity", 1)


VISITS_SQL = "visits AS (SELECT DISTINCT household_key, day, week_no FROM lines)"
GAPS_SQL = """gaps AS (SELECT household_key, day, week_no,
  day - lag(day) OVER (PARTITION BY household_key ORDER BY day) AS day_gap FROM visits)"""


def visits(spark: SparkSession, d: str) -> DataFrame:
    return td.lines(spark, d).select(H, DAY, W).distinct()


def gaps(spark: SparkSession, d: str) -> DataFrame:
    return win.gap_since_prev(visits(spark, d), H, DAY, out="day_gap")


@register("win3_gap_since_prev", with_ctes(td.LINES_SQL, VISITS_SQL, GAPS_SQL, body="SELECT * FROM gaps"))
def win3_gap_since_prev(spark: SparkSession, d: str) -> DataFrame:
    return gaps(spark, d)


@register("win4_weeks_since_prev", with_ctes(td.LINES_SQL, body="""
SELECT household_key, week_no, week_no - lag(week_no) OVER (PARTITION BY household_key ORDER BY week_no) AS week_gap
FROM (SELECT DISTINCT household_key, week_no FROM lines)"""))
def win4_weeks_since_prev(spark: SparkSession, d: str) -> DataFrame:
    wk = td.lines(spark, d).select(H, W).distinct()
    return win.gap_since_prev(wk, H, W, out="week_gap")


def mean_gap_per_week(spark: SparkSession, d: str) -> DataFrame:
    return agg.group_means(gaps(spark, d), [H, W], ["day_gap"]).withColumnRenamed("day_gap", "mean_day_gap")


@register("win5_mean_gap_per_week", with_ctes(td.LINES_SQL, VISITS_SQL, GAPS_SQL, body="""
SELECT household_key, week_no, round(avg(day_gap), 4) AS mean_day_gap FROM gaps GROUP BY 1, 2"""))
def win5_mean_gap_per_week(spark: SparkSession, d: str) -> DataFrame:
    return rounded(mean_gap_per_week(spark, d))


@register("win6_max_gap_per_week", with_ctes(td.LINES_SQL, VISITS_SQL, GAPS_SQL, body="""
SELECT household_key, week_no, day_gap AS max_gap FROM (
  SELECT *, row_number() OVER (PARTITION BY household_key, week_no ORDER BY day_gap DESC NULLS FIRST) AS rn FROM gaps)
WHERE rn = 1"""))
def win6_max_gap_per_week(spark: SparkSession, d: str) -> DataFrame:
    return win.max_gap_per_period(gaps(spark, d), [H, W], "day_gap")


WEEK_GAP_SQL = [td.LINES_SQL, VISITS_SQL, GAPS_SQL, fact_sql("week_no"), grid_sql("week_no"), """wgap AS (
  SELECT g.household_key, g.week_no, m.mean_day_gap FROM grid g LEFT JOIN
  (SELECT household_key, week_no, avg(day_gap) AS mean_day_gap FROM gaps GROUP BY 1, 2) m
  ON g.household_key = m.household_key AND g.week_no = m.week_no)"""]


@register("win7_countdown_fill", with_ctes(*WEEK_GAP_SQL, body="""
SELECT household_key, week_no, round(coalesce(mean_day_gap, CASE WHEN nv - 7 * (np - week_no) >= 0
       THEN nv - 7 * (np - week_no) END), 4) AS mean_day_gap
FROM (SELECT *,
  first_value(mean_day_gap IGNORE NULLS) OVER wf AS nv,
  first_value(CASE WHEN mean_day_gap IS NOT NULL THEN week_no END IGNORE NULLS) OVER wf AS np
  FROM wgap WINDOW wf AS (PARTITION BY household_key ORDER BY week_no
                          ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""))
def win7_countdown_fill(spark: SparkSession, d: str) -> DataFrame:
    p = dense_panel_of(mean_gap_per_week(spark, d), W, ["mean_day_gap"], fill=None)
    return rounded(win.countdown_fill(p, H, W, "mean_day_gap", step=7))


@register("win8_ffill", with_ctes(*panel_ctes("month_no", fill=False), body=f"""
SELECT household_key, month_no, last_value(sales_value IGNORE NULLS) OVER
  (PARTITION BY household_key ORDER BY month_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sales_value
FROM dense"""))
def win8_ffill(spark: SparkSession, d: str) -> DataFrame:
    p = dense_panel(spark, d, M, fill=None).select(H, M, "sales_value")
    return win.ffill(p, H, M, "sales_value")


@register("win9_last_trip_amount", with_ctes(*panel_ctes("month_no", fill=False), body=f"""
SELECT household_key, month_no, sales_value, last_value(sales_value IGNORE NULLS) OVER
  (PARTITION BY household_key ORDER BY month_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sales_value_last_trip
FROM dense"""))
def win9_last_trip_amount(spark: SparkSession, d: str) -> DataFrame:
    p = dense_panel(spark, d, M, fill=None).select(H, M, "sales_value")
    return win.last_trip_amount(p, H, M, "sales_value")


@register("win10_last_period_amount", with_ctes(*panel_ctes("month_no"), body=f"""
SELECT household_key, month_no, coalesce(lag(quantity) OVER w, 0.0) AS quantity_last_period FROM dense {WM}"""))
def win10_last_period_amount(spark: SparkSession, d: str) -> DataFrame:
    p = dense_panel(spark, d, M).select(H, M, "quantity")
    return win.last_period_amount(p, H, M, "quantity").drop("quantity")


# ---------------------------------------------------------------- expanding statistics
WX = ("WINDOW wx AS (PARTITION BY household_key ORDER BY month_no "
      "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")


def _expanding(spark, d, col, stats, fill=0.0):
    p = dense_panel(spark, d, M, fill=fill).select(H, M, col)
    out = win.expanding_stats(p, H, M, col, stats=stats)
    sigcols = [c for c in out.columns if c.endswith("_std") or c.endswith("_var")]
    return rounded(out, sig_cols=sigcols)


@register("win11_expanding_mean", with_ctes(*panel_ctes("month_no"), body=f"""
SELECT household_key, month_no, quantity, round(avg(quantity) OVER wx, 4) AS quantity_mean FROM dense {WX}"""))
def win11_expanding_mean(spark: SparkSession, d: str) -> DataFrame:
    return _expanding(spark, d, "quantity", ["mean"])


@register("win12_expanding_std", with_ctes(*panel_ctes("month_no"), body=f"""
SELECT household_key, month_no, quantity, {sig_sql('stddev_samp(quantity) OVER wx')} AS quantity_std
FROM dense {WX}"""))
def win12_expanding_std(spark: SparkSession, d: str) -> DataFrame:
    return _expanding(spark, d, "quantity", ["std"])


@register("win13_expanding_var", with_ctes(*panel_ctes("month_no"), body=f"""
SELECT household_key, month_no, quantity, {sig_sql('var_samp(quantity) OVER wx')} AS quantity_var
FROM dense {WX}"""))
def win13_expanding_var(spark: SparkSession, d: str) -> DataFrame:
    return _expanding(spark, d, "quantity", ["var"])


@register("win14_expanding_quantiles", with_ctes(*panel_ctes("month_no"), body=f"""
SELECT household_key, month_no, sales_value,
  round(quantile_cont(sales_value, 0.25) OVER wx, 4) AS sales_value_q25,
  round(quantile_cont(sales_value, 0.5) OVER wx, 4) AS sales_value_q50,
  round(quantile_cont(sales_value, 0.75) OVER wx, 4) AS sales_value_q75 FROM dense {WX}"""))
def win14_expanding_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return _expanding(spark, d, "sales_value", ["q25", "q50", "q75"])


TRIP_STATS = ["mean", "std", "q50"]


@register("win15_trip_stats", with_ctes(td.LINES_SQL, fact_sql("month_no"), grid_sql("month_no"), f"""trip AS (
  SELECT household_key, month_no, avg(sales_value) OVER wx AS m, stddev_samp(sales_value) OVER wx AS s,
         quantile_cont(sales_value, 0.5) OVER wx AS q FROM fact {WX})""", body="""
SELECT household_key, month_no,
  round(last_value(m IGNORE NULLS) OVER wf, 4) AS sales_value_mean,
  {S} AS sales_value_std,
  round(last_value(q IGNORE NULLS) OVER wf, 4) AS sales_value_q50
FROM (SELECT g.household_key, g.month_no, t.m, t.s, t.q FROM grid g LEFT JOIN trip t
      ON g.household_key = t.household_key AND g.month_no = t.month_no)
WINDOW wf AS (PARTITION BY household_key ORDER BY month_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""".replace(
    "{S}", sig_sql("last_value(s IGNORE NULLS) OVER wf"))))
def win15_trip_stats(spark: SparkSession, d: str) -> DataFrame:
    """Stats over active months only, carried forward over the inactive months.

    Each active row's frame holds earlier active rows only, so the forward fill
    of NULL (first-trip) statistics keeps the last non-NULL value (pandas ffill)."""
    f = fact(spark, d, M).select(H, M, "sales_value")
    t = win.expanding_stats(f, H, M, "sales_value", stats=TRIP_STATS).drop("sales_value")
    p = dense_panel_of(t, M, ["sales_value_mean", "sales_value_std", "sales_value_q50"], fill=None)
    for c in ("sales_value_mean", "sales_value_std", "sales_value_q50"):
        p = win.ffill(p, H, M, c)
    return rounded(p, sig_cols=["sales_value_std"])


@register("win16_calendar_stats", with_ctes(*panel_ctes("week_no"), body="""
SELECT household_key, week_no, round(avg(quantity) OVER wx, 4) AS quantity_mean,
  {S} AS quantity_std, round(quantile_cont(quantity, 0.75) OVER wx, 4) AS quantity_q75
FROM dense WINDOW wx AS (PARTITION BY household_key ORDER BY week_no
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""".replace("{S}", sig_sql("stddev_samp(quantity) OVER wx"))))
def win16_calendar_stats(spark: SparkSession, d: str) -> DataFrame:
    """Dense weekly calendar (inactive weeks count as zero)."""
    p = dense_panel(spark, d, W).select(H, W, "quantity")
    out = win.expanding_stats(p, H, W, "quantity", stats=["mean", "std", "q75"]).drop("quantity")
    return rounded(out, sig_cols=["quantity_std"])


def _wsum_sql(col: str, order: str, zero: bool, n: int = 10) -> str:
    terms = []
    for k in range(1, n + 1):
        lag = f"lag({col}, {k}) OVER (PARTITION BY household_key ORDER BY {order})"
        if zero:
            lag = f"coalesce({lag}, 0.0)"
        terms.append(f"{lag} * {n + 1 - k}.0")
    return "(" + " + ".join(terms) + f") / {n * (n + 1) / 2}"


@register("win17_weighted_lag_mean", with_ctes(td.LINES_SQL, fact_sql("month_no"), body=f"""
SELECT household_key, month_no, round({_wsum_sql('sales_value', 'month_no', False)}, 4) AS sales_value_wavg10
FROM fact"""))
def win17_weighted_lag_mean(spark: SparkSession, d: str) -> DataFrame:
    """Over active months (trips): NULL until ten earlier trips exist."""
    f = fact(spark, d, M).select(H, M, "sales_value")
    return rounded(win.weighted_lag_mean(f, H, M, "sales_value", 10).drop("sales_value"))


@register("win18_weighted_lag_mean_dense", with_ctes(*panel_ctes("month_no"), body=f"""
SELECT household_key, month_no, round({_wsum_sql('sales_value', 'month_no', True)}, 4) AS sales_value_wavg10
FROM dense"""))
def win18_weighted_lag_mean_dense(spark: SparkSession, d: str) -> DataFrame:
    p = dense_panel(spark, d, M).select(H, M, "sales_value")
    return rounded(win.weighted_lag_mean(p, H, M, "sales_value", 10, null_as_zero=True).drop("sales_value"))


# ---------------------------------------------------------------- visit counts
def visits_per_week(spark: SparkSession, d: str) -> DataFrame:
    return agg.group_counts(visits(spark, d), [H, W], "n_visits")


@register("win19_avg_visits_per_week", with_ctes(td.LINES_SQL, VISITS_SQL, fact_sql("week_no"), grid_sql("week_no"),
                                                 body="""
SELECT household_key, week_no, round(avg(n_visits) OVER (PARTITION BY household_key ORDER BY week_no
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 4) AS avg_visits
FROM (SELECT g.household_key, g.week_no, coalesce(v.n, 0) AS n_visits FROM grid g LEFT JOIN
      (SELECT household_key, week_no, count(*) AS n FROM visits GROUP BY 1, 2) v
      ON g.household_key = v.household_key AND g.week_no = v.week_no)"""))
def win19_avg_visits_per_week(spark: SparkSession, d: str) -> DataFrame:
    p = dense_panel_of(visits_per_week(spark, d), W, ["n_visits"], fill=0)
    out = win.expanding_stats(p, H, W, "n_visits", stats=["mean"], prefix="v")
    return rounded(out.select(H, W, F.col("v_mean").alias("avg_visits")))


@register("win20_avg_visits_per_month", with_ctes(td.LINES_SQL, fact_sql("month_no"), grid_sql("month_no"), body="""
SELECT household_key, year, month, round(avg(n_visits) OVER (PARTITION BY household_key ORDER BY year, month
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 4) AS avg_visits
FROM (SELECT g.household_key, CAST(1995 + (g.month_no - 1) // 12 AS INTEGER) AS year,
             CAST((g.month_no - 1) % 12 + 1 AS INTEGER) AS month, coalesce(v.n, 0) AS n_visits
      FROM grid g LEFT JOIN (SELECT household_key, month_no, count(*) AS n
                             FROM (SELECT DISTINCT household_key, day, month_no FROM lines) GROUP BY 1, 2) v
      ON g.household_key = v.household_key AND g.month_no = v.month_no)"""))
def win20_avg_visits_per_month(spark: SparkSession, d: str) -> DataFrame:
    """Raw visit counts per month (not a running mean), ordered by (year, month)."""
    ln = td.lines(spark, d)
    cnt = agg.group_counts(ln.select(H, DAY, M).distinct(), [H, M], "n_visits")
    p = dense_panel_of(cnt, M, ["n_visits"], fill=0).withColumns({
        "year": (F.lit(1995) + F.floor((F.col(M) - 1) / 12)).cast("int"),
        "month": ((F.col(M) - 1) % 12 + 1).cast("int")})
    out = win.expanding_stats(p, H, ["year", "month"], "n_visits", stats=["mean"], prefix="v")
    return rounded(out.select(H, "year", "month", F.col("v_mean").alias("avg_visits")))


WD = cal.REL_WEEKDAYS


@register("win21_weekday_shares", with_ctes(td.LINES_SQL, fact_sql("week_no"), grid_sql("week_no"), """flags AS (
  SELECT household_key, week_no, """ + ", ".join(
    f"max(CASE WHEN day % 7 = {i} THEN 1 ELSE 0 END) AS {d}" for i, d in enumerate(WD)) + """
  FROM lines GROUP BY 1, 2)""", """runs AS (SELECT g.household_key, g.week_no, """ + ", ".join(
    f"sum(coalesce(f.{d}, 0)) OVER wr AS r_{d}" for d in WD) + """
  FROM grid g LEFT JOIN flags f ON g.household_key = f.household_key AND g.week_no = f.week_no
  WINDOW wr AS (PARTITION BY g.household_key ORDER BY g.week_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    body="SELECT household_key, week_no, " + ", ".join(
        f"round(coalesce(r_{d} / nullif(" + " + ".join(f"r_{x}" for x in WD) + f", 0), 0.0), 4) AS {d}_share"
        for d in WD) + " FROM runs"))
def win21_weekday_shares(spark: SparkSession, d: str) -> DataFrame:
    ln = td.lines(spark, d)
    wd = cal.relative_weekday(F.col(DAY))
    flags = ln.groupBy(H, W).agg(*[F.max(F.when(wd == x, 1).otherwise(0)).alias(x) for x in WD])
    p = dense_panel_of(flags, W, WD, fill=0)
    return rounded(win.weekday_shares(p, H, W, WD).drop(*WD))


HOURLY_SPLIT_SQL = """hs AS (
  SELECT ts, load, CAST(year(ts) AS INTEGER) AS year,
         CAST(floor((dayofyear(ts) - 1) / 7) + 1 AS INTEGER) AS week,
         CASE WHEN ts < TIMESTAMP '2024-01-20 00:00:00' THEN 'train' ELSE 'test' END AS split FROM hourly)"""


@register("win22_prev_period_mean", with_ctes(td.HOURLY_SQL, HOURLY_SPLIT_SQL, body="""
SELECT hs.ts, hs.split, round(hs.load, 4) AS load, round(pm.loadmean_prevweek, 4) AS loadmean_prevweek
FROM hs LEFT JOIN (SELECT year, week, split,
  lag(m) OVER (PARTITION BY split ORDER BY year, week) AS loadmean_prevweek
  FROM (SELECT year, week, split, avg(load) AS m FROM hs GROUP BY 1, 2, 3)) pm
ON hs.year = pm.year AND hs.week = pm.week AND hs.split = pm.split"""))
def win22_prev_period_mean(spark: SparkSession, d: str) -> DataFrame:
    """Mean load of the previous week inside the same split, joined back to hourly rows.
    The weekly table is one row per (year, week, split): small and bounded by time span."""
    h = td.hourly_load(spark, d).withColumns({
        "year": F.year("ts"), "week": cal.week_simple("ts"),
        "split": F.when(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), "train").otherwise("test")})
    wk = h.groupBy("year", "week", "split").agg(F.avg("load").alias("m"))
    wk = win.lag_col(wk, "split", ["year", "week"], "m", 1, out="loadmean_prevweek").drop("m")
    return rounded(h.join(wk, ["year", "week", "split"], "left").select("ts", "split", "load", "loadmean_prevweek"))


@register("win23_lag_to_prevent_leakage", with_ctes(*panel_ctes("month_no"), body=f"""
SELECT household_key, month_no, lag(sales_value) OVER w AS sales_value, lag(quantity) OVER w AS quantity,
       lag(discount) OVER w AS discount FROM dense {WM}"""))
def win23_lag_to_prevent_leakage(spark: SparkSession, d: str) -> DataFrame:
    return win.lag_to_prevent_leakage(dense_panel(spark, d, M), H, M, list(MEASURES))


@register("win24_interpolate_linear", with_ctes(*panel_ctes("month_no", fill=False), body="""
SELECT household_key, month_no, round(CASE WHEN sales_value IS NOT NULL THEN sales_value
  WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
  ELSE pv + (nv - pv) * (month_no - pp) / (np - pp) END, 4) AS sales_value
FROM (SELECT household_key, month_no, sales_value,
  last_value(sales_value IGNORE NULLS) OVER wb AS pv,
  last_value(CASE WHEN sales_value IS NOT NULL THEN month_no END IGNORE NULLS) OVER wb AS pp,
  first_value(sales_value IGNORE NULLS) OVER wa AS nv,
  first_value(CASE WHEN sales_value IS NOT NULL THEN month_no END IGNORE NULLS) OVER wa AS np
  FROM dense
  WINDOW wb AS (PARTITION BY household_key ORDER BY month_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wa AS (PARTITION BY household_key ORDER BY month_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""))
def win24_interpolate_linear(spark: SparkSession, d: str) -> DataFrame:
    p = dense_panel(spark, d, M, fill=None).select(H, M, "sales_value")
    return rounded(win.interpolate_linear(p, H, M, "sales_value"))


@register("win24_interpolate_daily_to_hours", with_ctes(td.HOURLY_SQL, td.WEATHER_SQL, """dim AS (
  SELECT d.day, d.first_h, d.last_h, w.temp FROM
    (SELECT CAST(ts AS DATE) AS day, min(ts) AS first_h, max(ts) AS last_h FROM hourly GROUP BY 1) d
  LEFT JOIN weather w ON w.date = d.day)""", """nb AS (
  SELECT day, temp,
    last_value(temp IGNORE NULLS) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pv,
    last_value(CASE WHEN temp IS NOT NULL THEN epoch(last_h) END IGNORE NULLS)
      OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pt,
    first_value(temp IGNORE NULLS) OVER (ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nv,
    first_value(CASE WHEN temp IS NOT NULL THEN epoch(first_h) END IGNORE NULLS)
      OVER (ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS np FROM dim)""", body="""
SELECT h.ts, round(h.load, 4) AS load, round(CASE WHEN nb.temp IS NOT NULL THEN nb.temp WHEN nb.pv IS NULL THEN nb.nv
  WHEN nb.nv IS NULL THEN nb.pv ELSE nb.pv + (nb.nv - nb.pv) * (epoch(h.ts) - nb.pt) / (nb.np - nb.pt) END, 4) AS temp
FROM hourly h LEFT JOIN nb ON CAST(h.ts AS DATE) = nb.day"""))
def win24_interpolate_daily_to_hours(spark: SparkSession, d: str) -> DataFrame:
    """Daily 'temperature' (mean of view events) carried onto the hourly load rows."""
    h = td.hourly_load(spark, d)
    return rounded(win.interpolate_daily_to_hours(h, "ts", td.daily_weather(spark, d), "date", "temp"))


@register("win25_row_index", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_idx FROM orders""")
def win25_row_index(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return win.row_index(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_idx")


@register("win26_dense_group_id", """
SELECT p_partkey, p_brand, p_type, dense_rank() OVER (ORDER BY p_brand, p_type) AS group_id FROM part""")
def win26_dense_group_id(spark: SparkSession, d: str) -> DataFrame:
    p = td.table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    return win.dense_group_id(p, ["p_brand", "p_type"])
