"""Calendar (CAL), text-to-value (STR) and scaling (MTH) queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import calendar as cal
from panelkit.functions import mathx
from panelkit.functions import strings as fs
from panelkit.plans.common import DAY, H, W, rounded
from panelkit.plans.registry import register, with_ctes
from panelkit.sources import testdata as td

@register("cal1_calendar_parts", with_ctes(td.HOURLY_SQL, body="""
SELECT ts, CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter, CAST(month(ts) AS INTEGER) AS month,
  CAST(dayofyear(ts) AS INTEGER) AS dayofyear, CAST(dayofmonth(ts) AS INTEGER) AS dayofmonth,
  CAST(dayofweek(ts) + 1 AS INTEGER) AS dayofweek, CAST(hour(ts) AS INTEGER) AS hour FROM hourly"""))
def cal1_calendar_parts(spark: SparkSession, d: str) -> DataFrame:
    return cal.calendar_parts(td.hourly_load(spark, d).select("ts"), "ts")


@register("cal2_week_simple", """
SELECT o_orderkey, CAST(floor((dayofyear(o_orderdate) - 1) / 7) + 1 AS INTEGER) AS weekofyear FROM orders""")
def cal2_week_simple(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders")
    return o.select("o_orderkey", cal.week_simple("o_orderdate").alias("weekofyear"))


HOLIDAYS_SQL = """hol AS (
  WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders),
  fixed AS (
    SELECT make_date(yr, 1, 1) AS d, 'New Year''s Day' AS holiday_name FROM y
    UNION ALL SELECT make_date(yr, 7, 4), 'Independence Day' FROM y
    UNION ALL SELECT make_date(yr, 11, 11), 'Veterans Day' FROM y
    UNION ALL SELECT make_date(yr, 12, 25), 'Christmas Day' FROM y),
  nth AS (
    SELECT yr, m, wd, n, name FROM y, (VALUES (1, 1, 3, 'Martin Luther King Jr. Day'), (2, 1, 3, 'Presidents Day'),
      (9, 1, 1, 'Labor Day'), (10, 1, 2, 'Columbus Day'), (11, 4, 4, 'Thanksgiving Day')) v(m, wd, n, name))
  SELECT CASE WHEN dayofweek(d) = 0 THEN d + 1 ELSE d END AS date, holiday_name FROM fixed
  UNION ALL SELECT CAST(make_date(yr, m, 1) + CAST(((wd - dayofweek(make_date(yr, m, 1)) + 7) % 7) + 7 * (n - 1) AS INTEGER)
                   AS DATE), name FROM nth
  UNION ALL SELECT CAST(last_day(make_date(yr, 5, 1)) - CAST((dayofweek(last_day(make_date(yr, 5, 1))) + 6) % 7 AS INTEGER)
                   AS DATE), 'Memorial Day' FROM y)"""


def holidays(spark: SparkSession, d: str) -> DataFrame:
    years = td.table(spark, d, "orders").select(F.year("o_orderdate").alias("year"))
    return cal.holiday_dim(spark, years)


@register("cal4_holiday_dim", with_ctes(HOLIDAYS_SQL, body="SELECT date, holiday_name FROM hol"))
def cal4_holiday_dim(spark: SparkSession, d: str) -> DataFrame:
    return holidays(spark, d)


@register("cal3_weekend_business_day", with_ctes(HOLIDAYS_SQL, body="""
SELECT o.o_orderkey, CASE WHEN dayofweek(o.o_orderdate) IN (0, 6) THEN 1 ELSE 0 END AS weekend,
  CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS holiday,
  CASE WHEN dayofweek(o.o_orderdate) NOT IN (0, 6) AND h.date IS NULL THEN 1 ELSE 0 END AS businessday
FROM orders o LEFT JOIN (SELECT DISTINCT date FROM hol) h ON CAST(o.o_orderdate AS DATE) = h.date"""))
def cal3_weekend_business_day(spark: SparkSession, d: str) -> DataFrame:
    """The holiday dimension is one row per holiday and year (bounded by the time span): broadcast."""
    hol = holidays(spark, d).select(F.col("date").alias("__d")).distinct().withColumn("__h", F.lit(1))
    o = td.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = o.join(F.broadcast(hol), F.to_date("o_orderdate") == F.col("__d"), "left")
    hflag = F.coalesce(F.col("__h"), F.lit(0))
    return j.select("o_orderkey", cal.weekend("o_orderdate").alias("weekend"), hflag.alias("holiday"),
                    cal.business_day("o_orderdate", hflag).alias("businessday"))


@register("cal5_season", """
SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 1 WHEN month(o_orderdate) IN (3, 4, 5) THEN 2
  WHEN month(o_orderdate) IN (6, 7, 8) THEN 3 WHEN month(o_orderdate) IN (9, 10, 11) THEN 4 ELSE 5 END AS season,
  CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring'
  WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season_name FROM orders""")
def cal5_season(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders")
    mname = F.date_format("o_orderdate", "MMMM")
    return o.select("o_orderkey", cal.season_code(F.month("o_orderdate")).alias("season"),
                    cal.season_name(mname).alias("season_name"))


# The sunrise equation step by step: days since 2000, mean anomaly, centre, ecliptic longitude, transit, declination, hour angle.
@register("cal6_daylight_flag", with_ctes(td.HOURLY_SQL, """a AS (SELECT ts, date_diff('day', DATE '2000-01-01', CAST(ts AS DATE)) AS n FROM hourly)""",
    """b AS (SELECT *, n + 75.0::DOUBLE / 360 AS j, fmod(357.5291::DOUBLE + 0.98560028::DOUBLE * (n + 75.0::DOUBLE / 360), 360) AS m FROM a)""",
    """c AS (SELECT *, radians(fmod(m + 1.9148 * sin(radians(m)) + 0.02 * sin(2 * radians(m)) + 0.0003 * sin(3 * radians(m)) + 282.9372, 360)) AS l FROM b)""",
    """e AS (SELECT *, j + 0.0053 * sin(radians(m)) - 0.0069 * sin(2 * l) AS transit, asin(sin(l) * sin(radians(23.4397))) AS decl FROM c)""",
    """f AS (SELECT ts, hour(ts) + minute(ts) / 60.0 + second(ts) / 3600.0 + 5.0 - (transit - n + 0.5) * 24 AS off,
    degrees(acos(greatest(-1, least(1, (sin(radians(-0.833)) - sin(radians(40.0)) * sin(decl)) / (cos(radians(40.0)) * cos(decl)))))) / 15 AS half FROM e)""",
    body="SELECT ts, CAST(off BETWEEN -half AND half AS INTEGER) AS daytime FROM f"))
def cal6_daylight_flag(spark: SparkSession, d: str) -> DataFrame:
    """Sunrise/sunset by the NOAA equation at lat 40, lon -75 (local = UTC-5), as
    column math per hourly row; property tests hold it to +-3 min of a published almanac value."""
    h = td.hourly_load(spark, d).select("ts")
    return h.withColumn("daytime", cal.daylight_flag("ts", 40.0, -75.0, -5.0))


REL_MONTH_SQL = ("CASE WHEN day % 340 < 10 THEN 'February' WHEN day % 340 < 40 THEN 'March' "
                 "WHEN day % 340 < 70 THEN 'April' WHEN day % 340 < 100 THEN 'May' WHEN day % 340 < 130 THEN 'June' "
                 "WHEN day % 340 < 160 THEN 'July' WHEN day % 340 < 190 THEN 'August' "
                 "WHEN day % 340 < 220 THEN 'September' WHEN day % 340 < 250 THEN 'October' "
                 "WHEN day % 340 < 280 THEN 'November' WHEN day % 340 < 310 THEN 'December' ELSE 'January' END")
REL_MONTH_NO_SQL = ("CAST(CASE WHEN day % 340 < 10 THEN 2 WHEN day % 340 < 310 THEN floor((day % 340 - 10) / 30) + 3 "
                    "ELSE 1 END AS INTEGER)")


@register("cal7_relative_month", with_ctes(td.LINES_SQL, body=f"""
SELECT DISTINCT day, {REL_MONTH_SQL} AS month_name, {REL_MONTH_NO_SQL} AS month_number FROM lines"""))
def cal7_relative_month(spark: SparkSession, d: str) -> DataFrame:
    days = td.lines(spark, d).select(DAY).distinct()
    return days.select(DAY, cal.relative_month(F.col(DAY)).alias("month_name"),
                       cal.relative_month_number(F.col(DAY)).alias("month_number"))


@register("cal8_relative_weekday", with_ctes(td.LINES_SQL, body="""
SELECT DISTINCT day, ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][day % 7 + 1] AS weekday,
  CAST(day % 7 + 1 AS INTEGER) AS weekday_number FROM lines"""))
def cal8_relative_weekday(spark: SparkSession, d: str) -> DataFrame:
    days = td.lines(spark, d).select(DAY).distinct()
    return days.select(DAY, cal.relative_weekday(F.col(DAY)).alias("weekday"),
                       cal.relative_weekday_number(F.col(DAY)).alias("weekday_number"))


@register("cal9_relative_year", with_ctes(td.LINES_SQL, body="""
SELECT DISTINCT week_no, CASE WHEN week_no <= 45 THEN 2017 WHEN week_no <= 93 THEN 2018 ELSE 2019 END AS year FROM lines"""))
def cal9_relative_year(spark: SparkSession, d: str) -> DataFrame:
    wk = td.lines(spark, d).select(W).distinct()
    return wk.select(W, cal.relative_year(F.col(W)).alias("year"))


@register("cal10_week_calendar", with_ctes(td.LINES_SQL, body=f"""
SELECT week_no, {REL_MONTH_SQL} AS month_name,
  CASE WHEN {REL_MONTH_SQL} IN ('December', 'January', 'February') THEN 'winter'
       WHEN {REL_MONTH_SQL} IN ('March', 'April', 'May') THEN 'spring'
       WHEN {REL_MONTH_SQL} IN ('June', 'July', 'August') THEN 'summer' ELSE 'fall' END AS season,
  CASE WHEN week_no <= 45 THEN 2017 WHEN week_no <= 93 THEN 2018 ELSE 2019 END AS year
FROM (SELECT week_no, min(day) AS day FROM lines GROUP BY 1)"""))
def cal10_week_calendar(spark: SparkSession, d: str) -> DataFrame:
    """Each week belongs to the month of its first observed day."""
    first = td.lines(spark, d).groupBy(W).agg(F.min(DAY).alias(DAY))
    mname = cal.relative_month(F.col(DAY))
    return first.select(W, mname.alias("month_name"), cal.season_name(mname).alias("season"),
                        cal.relative_year(F.col(W)).alias("year"))


@register("cal11_cyclic_month", """
SELECT DISTINCT CAST(month(o_orderdate) AS INTEGER) AS month,
  round(sin((180.0 - 15.0 * (month(o_orderdate) * 2)) / 180.0 * pi()), 4) AS month_sin,
  round(cos((180.0 - 15.0 * (month(o_orderdate) * 2)) / 180.0 * pi()), 4) AS month_cos FROM orders""")
def cal11_cyclic_month(spark: SparkSession, d: str) -> DataFrame:
    m = td.table(spark, d, "orders").select(F.month("o_orderdate").alias("month")).distinct()
    s, c = cal.cyclic_month(F.col("month"))
    return rounded(m.select("month", s.alias("month_sin"), c.alias("month_cos")))


@register("cal12_parse_dates", """
SELECT o_orderkey, make_date(CAST(year(o_orderdate) AS INTEGER), CAST(month(o_orderdate) AS INTEGER),
  CAST(day(o_orderdate) AS INTEGER)) AS order_day,
  make_date(2000 + CAST(strftime(o_orderdate, '%y') AS INTEGER), CAST(month(o_orderdate) AS INTEGER),
  CAST(day(o_orderdate) AS INTEGER)) AS parsed_mdy FROM orders""")
def cal12_parse_dates(spark: SparkSession, d: str) -> DataFrame:
    """Date from (y, m, d) parts, and 'MM/dd/yy' text parsed back (two-digit years -> 20yy)."""
    o = td.table(spark, d, "orders")
    text = F.date_format("o_orderdate", "MM/dd/yy")
    return o.select("o_orderkey", F.make_date(F.year("o_orderdate"), F.month("o_orderdate"),
                                              F.dayofmonth("o_orderdate")).alias("order_day"),
                    cal.parse_mdy(text).alias("parsed_mdy"))


# ---------------------------------------------------------------- text to values
def _mid_sql(col: str, scale: str = "") -> str:
    return (f"round_even(list_avg(list_transform(regexp_extract_all({col}, '(\\d+)', 1), lambda x: CAST(x AS DOUBLE)))"
            f"{scale}, 0)")


@register("str1_range_midpoint", with_ctes(td.DEMOGRAPHICS_SQL, body=f"""
SELECT household_key, {_mid_sql('age_desc')} AS age_mean, {_mid_sql('income_desc', ' * 1000')} AS income_mean
FROM demo"""))
def str1_range_midpoint(spark: SparkSession, d: str) -> DataFrame:
    dm = td.demographics_raw(spark, d)
    return dm.select(H, fs.range_midpoint("age_desc").alias("age_mean"),
                     fs.range_midpoint("income_desc", 1000).alias("income_mean"))


CAP_SQL = ("CASE WHEN {c} IN ('None/Unknown', 'Unknown') THEN 0 "
           "ELSE TRY_CAST(replace({c}, '+', '') AS INTEGER) END")


@register("str2_capped_int", with_ctes(td.DEMOGRAPHICS_SQL, body=f"""
SELECT household_key, {CAP_SQL.format(c='household_size_desc')} AS household_size,
  {CAP_SQL.format(c='kid_category_desc')} AS num_kids FROM demo"""))
def str2_capped_int(spark: SparkSession, d: str) -> DataFrame:
    dm = td.demographics_raw(spark, d)
    return dm.select(H, fs.capped_int("household_size_desc").alias("household_size"),
                     fs.capped_int("kid_category_desc").alias("num_kids"))


@register("str3_null_if", with_ctes(td.DEMOGRAPHICS_SQL, body="""
SELECT household_key, CASE WHEN hh_comp_desc IN ('Unknown') THEN NULL ELSE hh_comp_desc END AS hh_comp_desc FROM demo"""))
def str3_null_if(spark: SparkSession, d: str) -> DataFrame:
    dm = td.demographics_raw(spark, d)
    return dm.select(H, fs.null_if("hh_comp_desc", ["Unknown"]).alias("hh_comp_desc"))


@register("str4_household_structure", with_ctes(td.DEMOGRAPHICS_SQL, """s AS (
  SELECT household_key, hh_comp_desc, marital_status_code, homeowner_desc,
    {S} AS hs, {K} AS kids FROM demo)""".replace("{S}", CAP_SQL.format(c="household_size_desc")).replace(
    "{K}", CAP_SQL.format(c="kid_category_desc")), body="""
SELECT household_key, hs AS household_size, adults AS num_adults, hs - adults AS num_children,
  CASE WHEN marital_status_code = 'A' THEN 1 WHEN marital_status_code = 'B' THEN 0 WHEN hs > 1 THEN 1 ELSE 0 END
    AS marital_status,
  CASE WHEN homeowner_desc = 'Probable Owner' THEN 'Homeowner' WHEN homeowner_desc = 'Probable Renter' THEN 'Renter'
       ELSE homeowner_desc END AS homeowner
FROM (SELECT *, CASE WHEN contains(hh_comp_desc, '2') THEN 2 WHEN regexp_matches(hh_comp_desc, '1|Single') THEN 1
              ELSE hs - kids END AS adults FROM s)"""))
def str4_household_structure(spark: SparkSession, d: str) -> DataFrame:
    dm = td.demographics_raw(spark, d)
    hs, kids = fs.capped_int("household_size_desc"), fs.capped_int("kid_category_desc")
    dm = dm.withColumns({"hs": hs, "kids": kids})
    dm = dm.withColumn("num_adults", fs.num_adults("hh_comp_desc", "hs", "kids"))
    home = (F.when(F.col("homeowner_desc") == "Probable Owner", "Homeowner")
            .when(F.col("homeowner_desc") == "Probable Renter", "Renter").otherwise(F.col("homeowner_desc")))
    return dm.select(H, F.col("hs").alias("household_size"), "num_adults",
                     (F.col("hs") - F.col("num_adults")).alias("num_children"),
                     fs.marital_flag("marital_status_code", "hs").alias("marital_status"), home.alias("homeowner"))


@register("str5_clean_products", with_ctes(td.PRODUCTS_RAW_SQL, body="""
SELECT product_id,
  CASE WHEN contains(sub_commodity_desc, 'GEAR') THEN 'KIOSK-GAS' WHEN trim(department) = '' THEN 'OTHER'
       ELSE department END AS department,
  CASE WHEN contains(sub_commodity_desc, 'GEAR') THEN 'FUEL' WHEN trim(commodity_desc) = '' THEN 'OTHER'
       ELSE commodity_desc END AS commodity_desc FROM praw"""))
def str5_clean_products(spark: SparkSession, d: str) -> DataFrame:
    """Blank categories -> OTHER; the 'GEAR' sub-commodity plays the fuel override."""
    p = td.products_raw(spark, d)
    return p.select("product_id",
                    fs.clean_category("department", "sub_commodity_desc", "GEAR", "KIOSK-GAS").alias("department"),
                    fs.clean_category("commodity_desc", "sub_commodity_desc", "GEAR", "FUEL").alias("commodity_desc"))


@register("str6_strip_punct", """
SELECT c_custkey, regexp_replace(c_name || '.-' || c_mktsegment, '[!-/:-@\\[-`{-~]', '', 'g') AS name_clean FROM customer""")
def str6_strip_punct(spark: SparkSession, d: str) -> DataFrame:
    c = td.table(spark, d, "customer")
    return c.select("c_custkey", fs.strip_punct(F.concat("c_name", F.lit(".-"), "c_mktsegment")).alias("name_clean"))


@register("str7_string_builtins", """
SELECT c_custkey, substring(c_name, 1, 8) AS prefix, lower(c_mktsegment) AS seg_lower, upper(c_name) AS name_upper,
  concat_ws('|', c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS joined, string_split(c_name, '#')[2] AS name_num
FROM customer""")
def str7_string_builtins(spark: SparkSession, d: str) -> DataFrame:
    c = td.table(spark, d, "customer")
    return c.select("c_custkey", F.substring("c_name", 1, 8).alias("prefix"), F.lower("c_mktsegment").alias("seg_lower"),
                    F.upper("c_name").alias("name_upper"),
                    F.concat_ws("|", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("joined"),
                    F.split("c_name", "#").getItem(1).alias("name_num"))


# ---------------------------------------------------------------- scaling
MINMAX_SQL = """mm AS (SELECT c_custkey, c_acctbal, min(c_acctbal) OVER () AS lo, max(c_acctbal) OVER () AS hi FROM customer)"""


@register("mth1_min_max", with_ctes(MINMAX_SQL, body="""
SELECT c_custkey, round(CASE WHEN hi = lo THEN 0.0 ELSE (c_acctbal - lo) / (hi - lo) END, 4) AS acctbal_unit,
  round(CASE WHEN hi = lo THEN 0.0 ELSE (c_acctbal - lo) / (hi - lo) END * 22.0 + -9.0, 4) AS acctbal_scaled FROM mm"""))
def mth1_min_max(spark: SparkSession, d: str) -> DataFrame:
    c = td.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    a = mathx.min_max(c, ["c_acctbal"], suffix="_u")
    b = mathx.min_max(a, ["c_acctbal"], lo=-9.0, hi=13.0, suffix="_s")
    return rounded(b.select("c_custkey", F.col("c_acctbal_u").alias("acctbal_unit"),
                            F.col("c_acctbal_s").alias("acctbal_scaled")))


@register("mth2_inv_min_max", with_ctes(MINMAX_SQL, body="""
SELECT c_custkey, round(((c_acctbal - lo) / (hi - lo)) * (hi - lo) + lo, 4) AS acctbal_back FROM mm"""))
def mth2_inv_min_max(spark: SparkSession, d: str) -> DataFrame:
    c = td.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    st = c.agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"))
    u = mathx.min_max(c, ["c_acctbal"], suffix="_u").crossJoin(F.broadcast(st))
    return rounded(u.select("c_custkey", mathx.inv_min_max("c_acctbal_u", F.col("lo"), F.col("hi")).alias("acctbal_back")))


@register("mth3_trunc_cast", """
SELECT l_suppkey, CAST(trunc(avg(l_quantity) * 3.7) AS INTEGER) AS scaled_mean FROM lineitem GROUP BY 1""")
def mth3_trunc_cast(spark: SparkSession, d: str) -> DataFrame:
    """Truncating int cast (toward zero) of a scaled group mean."""
    li = td.table(spark, d, "lineitem")
    return li.groupBy("l_suppkey").agg((F.avg("l_quantity") * 3.7).cast("int").alias("scaled_mean"))


@register("mth4_standardize", """
SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 4) AS z
FROM orders""")
def mth4_standardize(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rounded(mathx.standardize(o, ["o_totalprice"], population=True, suffix="_z").select(
        "o_orderkey", F.col("o_totalprice_z").alias("z")))
