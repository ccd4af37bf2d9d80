"""Sources/sinks (SRC, SNK, SCN), projection and filters (PRJ, FLT), joins (JON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators import aggregates as agg
from panelkit.operators import joins as jn
from panelkit.operators.joins import sample_rows
from panelkit.plans.common import H, M, W, dense_panel, fact, fact_sql, panel_ctes, round_dec, rounded
from panelkit.plans.registry import register, with_ctes
from panelkit.session import scratch_path
from panelkit.sources import io, testdata as td
from pyspark.sql import types as T


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return scratch_path(spark, tag)


CUSTOMER_SCHEMA = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                                T.StructField("c_nationkey", T.IntegerType()),
                                T.StructField("c_acctbal", T.DoubleType()),
                                T.StructField("c_mktsegment", T.StringType())])


@register("src1_read_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src1_read_csv(spark: SparkSession, d: str) -> DataFrame:
    """Customer written as header CSV, read back with a declared schema."""
    path = scratch(spark, "src1")
    io.write_csv(td.table(spark, d, "customer"), path)
    return io.read_csv(spark, path, CUSTOMER_SCHEMA)


ORDERS_CSV = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_totalprice", T.DoubleType())])


@register("src2_read_many", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src2_read_many(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as several CSV files, read back in one globbed scan."""
    path = scratch(spark, "src2")
    io.write_csv(td.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").repartition(4), path)
    return io.read_many(spark, f"{path}/part-*.csv", ORDERS_CSV, source_col=None)


@register("src3_parquet_scan", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def src3_parquet_scan(spark: SparkSession, d: str) -> DataFrame:
    return io.load_table(spark, d, "nation")


NULLS_SCHEMA = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("n_orders", T.LongType()),
                             T.StructField("last_status", T.StringType())])


@register("snk1_write_csv_nulls", """
SELECT c.c_custkey, o.n_orders, o.last_status FROM customer c LEFT JOIN
  (SELECT o_custkey, count(*) AS n_orders, max(o_orderstatus) AS last_status FROM orders GROUP BY 1) o
ON c.c_custkey = o.o_custkey""")
def snk1_write_csv_nulls(spark: SparkSession, d: str) -> DataFrame:
    """NULLs survive a CSV round trip as empty fields."""
    o = td.table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                                               F.max("o_orderstatus").alias("last_status"))
    df = td.table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "n_orders", "last_status")
    path = scratch(spark, "snk1")
    io.write_csv(df, path, null_value="")
    return io.read_csv(spark, path, NULLS_SCHEMA, null_value="")


@register("scn1_preview", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""")
def scn1_preview(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(5).select("o_orderkey", "o_totalprice")


CATALOG_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                  "embeddings", "pages", "benchmark", "labels", "conversations")


@register("scn2_schema_catalog", """
SELECT CAST(ordinal_position AS INTEGER) AS position, """ + ", ".join(
    f"coalesce(max(CASE WHEN table_name = '{t}' THEN column_name END), '') AS {t}" for t in CATALOG_TABLES) + """
FROM information_schema.columns WHERE table_name IN (""" + ", ".join(f"'{t}'" for t in CATALOG_TABLES) + ") GROUP BY 1")
def scn2_schema_catalog(spark: SparkSession, d: str) -> DataFrame:
    """One column per table listing its column names, padded with ''."""
    rows = []
    for t in CATALOG_TABLES:
        for i, c in enumerate(td.table(spark, d, t).columns, start=1):
            rows.append((t, i, c))
    long = spark.createDataFrame(rows, "table_name string, position int, column_name string")
    wide = long.groupBy("position").pivot("table_name", list(CATALOG_TABLES)).agg(F.first("column_name"))
    return wide.fillna("", subset=list(CATALOG_TABLES))


@register("scn3_sample_rows", """
SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(concat(CAST(o_orderkey AS VARCHAR), '#42')), o_orderkey LIMIT 100""")
def scn3_sample_rows(spark: SparkSession, d: str) -> DataFrame:
    """Deterministic sample of n rows: order by a keyed digest (top-k, no driver sort)."""
    return sample_rows(td.table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", n=100)


@register("scn3_sample_fraction", """
SELECT o_orderkey, o_custkey FROM orders WHERE substr(md5(concat(CAST(o_orderkey AS VARCHAR), '#42')), 1, 8) < '40000000'""")
def scn3_sample_fraction(spark: SparkSession, d: str) -> DataFrame:
    """A quarter of the orders, the same ones on every run."""
    return sample_rows(td.table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", fraction=0.25)


# ---------------------------------------------------------------- projection
def front(df: DataFrame, cols) -> DataFrame:
    """PRJ-1: put ``cols`` first, then every other column in order."""
    return df.select(*cols, *[c for c in df.columns if c not in cols])


@register("prj1_select_front", """
SELECT l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_returnflag, l_linestatus FROM lineitem""")
def prj1_select_front(spark: SparkSession, d: str) -> DataFrame:
    return front(td.table(spark, d, "lineitem").drop("l_tax"), ["l_shipdate", "l_orderkey"])


def upper_names(df: DataFrame) -> DataFrame:
    """PRJ-2: upper-case every column name."""
    return df.toDF(*[c.upper() for c in df.columns])


@register("prj2_rename_upper", """
SELECT c_custkey AS C_CUSTKEY, c_name AS CUSTOMER_NAME, c_nationkey AS C_NATIONKEY, c_acctbal AS C_ACCTBAL,
       c_mktsegment AS C_MKTSEGMENT FROM customer""")
def prj2_rename_upper(spark: SparkSession, d: str) -> DataFrame:
    return upper_names(td.table(spark, d, "customer").withColumnsRenamed({"c_name": "customer_name"}))


def feature_columns(df: DataFrame, exclude=(), target: str | None = None) -> list[str]:
    """PRJ-3: all columns minus exclusions minus the target."""
    return [c for c in df.columns if c not in set(exclude) and c != target]


@register("prj3_feature_columns", with_ctes(*panel_ctes("month_no"), body="SELECT quantity, discount FROM dense"))
def prj3_feature_columns(spark: SparkSession, d: str) -> DataFrame:
    p = dense_panel(spark, d, M)
    return p.select(*feature_columns(p, exclude=[H, M], target="sales_value"))


@register("prj4_computed_columns", """
SELECT event_id, round((value - 32) * 5 / 9, 4) AS value_c, round(value / 1000, 4) AS value_k FROM events""")
def prj4_computed_columns(spark: SparkSession, d: str) -> DataFrame:
    """Unit changes: Fahrenheit -> Celsius and grams -> thousands."""
    e = td.table(spark, d, "events")
    return rounded(e.select("event_id", ((F.col("value") - 32) * 5 / 9).alias("value_c"),
                            (F.col("value") / 1000).alias("value_k")))


def recode(col, rules, default):
    """PRJ-5: ordered (predicate, value) rules with a default (CASE WHEN)."""
    out = None
    for pred, val in rules:
        out = F.when(pred, F.lit(val)) if out is None else out.when(pred, F.lit(val))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


@register("prj5_recode", """
SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'high' WHEN o_orderpriority LIKE '2%' THEN 'high'
  WHEN o_orderpriority LIKE '3%' THEN 'medium' ELSE 'low' END AS priority_class FROM orders""")
def prj5_recode(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("o_orderpriority")
    rules = [(p.startswith("1"), "high"), (p.startswith("2"), "high"), (p.startswith("3"), "medium")]
    return td.table(spark, d, "orders").select("o_orderkey", recode(p, rules, "low").alias("priority_class"))


def clamp_low(col, threshold: float, replacement: float):
    """PRJ-6: values <= threshold replaced by a constant."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c <= threshold, F.lit(replacement)).otherwise(c)


@register("prj6_clamp_low", """
SELECT o_orderkey, CASE WHEN o_totalprice <= 18750 THEN 18503.0 ELSE o_totalprice END AS o_totalprice FROM orders""")
def prj6_clamp_low(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders")
    return o.select("o_orderkey", clamp_low("o_totalprice", 18750, 18503.0).alias("o_totalprice"))


def round_cols(df: DataFrame, spec: dict[str, int]) -> DataFrame:
    """PRJ-7: half-even rounding of the given columns."""
    return df.withColumns({c: F.bround(c, n) for c, n in spec.items()})


@register("prj7_round_half_even", """
SELECT o_orderkey, round_even(o_totalprice, 0) AS o_totalprice, round_even(o_totalprice / 2, 0) AS half_price
FROM orders""")
def prj7_round_half_even(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders").select("o_orderkey", "o_totalprice",
                                            (F.col("o_totalprice") / 2).alias("half_price"))
    return round_cols(o, {"o_totalprice": 0, "half_price": 0})


def cast_cols(df: DataFrame, spec: dict[str, str], lenient: bool = False) -> DataFrame:
    """PRJ-8: cast columns; ``lenient`` uses try_cast (NULL instead of an ANSI error)."""
    return df.withColumns({c: (F.col(c).try_cast(t) if lenient else F.col(c).cast(t)) for c, t in spec.items()})


@register("prj8_cast_cols", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,
  TRY_CAST(l_returnflag AS INTEGER) AS l_returnflag FROM lineitem""")
def prj8_cast_cols(spark: SparkSession, d: str) -> DataFrame:
    li = td.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return cast_cols(cast_cols(li, {"l_quantity": "int"}), {"l_returnflag": "int"}, lenient=True)


# ---------------------------------------------------------------- filters
@register("flt1_range_filter", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_quantity >= 10 AND l_quantity <= 40 AND l_discount < 0.05""")
def flt1_range_filter(spark: SparkSession, d: str) -> DataFrame:
    li = td.table(spark, d, "lineitem")
    return (li.filter(F.col("l_quantity").between(10, 40)).filter(F.col("l_discount") < 0.05)
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))


def between_open(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """FLT-2: strict on both ends."""
    return df.filter((F.col(col) > F.lit(lo)) & (F.col(col) < F.lit(hi)))


@register("flt2_between_open", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate > TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1996-03-01 00:00:00'""")
def flt2_between_open(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    lo = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit("1996-03-01 00:00:00").cast("timestamp_ntz")
    return o.filter((F.col("o_orderdate") > lo) & (F.col("o_orderdate") < hi))


@register("flt2_point_lookup", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate = TIMESTAMP '1996-01-02 00:00:00'""")
def flt2_point_lookup(spark: SparkSession, d: str) -> DataFrame:
    """FLT-2 point form: rows at one instant of the time key (pushed to the scan)."""
    o = td.table(spark, d, "orders")
    return o.filter(F.col("o_orderdate") == F.lit("1996-01-02 00:00:00").cast("timestamp_ntz")).select(
        "o_orderkey", "o_totalprice")


SEG = "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'"


@register("flt3_keep_in", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN ({SEG})")
def flt3_keep_in(spark: SparkSession, d: str) -> DataFrame:
    keys = td.table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("o_custkey"))
    return jn.keep_in(td.table(spark, d, "orders").select("o_orderkey", "o_custkey"), keys, "o_custkey")


@register("flt3_drop_in", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN ({SEG})")
def flt3_drop_in(spark: SparkSession, d: str) -> DataFrame:
    keys = td.table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("o_custkey"))
    return jn.drop_in(td.table(spark, d, "orders").select("o_orderkey", "o_custkey"), keys, "o_custkey")


@register("flt4_text_predicates", """
SELECT p_partkey, p_name FROM part
WHERE contains(p_name, 'red') OR starts_with(p_name, 'small') OR regexp_matches(p_name, 'gear$') OR p_name = 'blue bolt'""")
def flt4_text_predicates(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_name")
    p = td.table(spark, d, "part").select("p_partkey", "p_name")
    return p.filter(n.contains("red") | n.startswith("small") | n.rlike("gear$") | (n == "blue bolt"))


@register("flt5_drop_incomplete", with_ctes(*panel_ctes("month_no", fill=False), body="""
SELECT * FROM dense WHERE sales_value IS NOT NULL AND quantity IS NOT NULL AND discount IS NOT NULL"""))
def flt5_drop_incomplete(spark: SparkSession, d: str) -> DataFrame:
    return dense_panel(spark, d, M, fill=None).dropna(how="any")


@register("flt6_drop_groups_containing", with_ctes(td.LINES_SQL, td.PRODUCTS_SQL, body="""
SELECT l.basket_id, l.product_id, l.day FROM lines l
WHERE l.basket_id NOT IN (SELECT l2.basket_id FROM lines l2 JOIN products p ON l2.product_id = p.product_id
                          WHERE p.commodity_desc = 'PROMO')"""))
def flt6_drop_groups_containing(spark: SparkSession, d: str) -> DataFrame:
    """Drop every line of a basket that holds a PROMO product (two-step anti join)."""
    ln = td.lines(spark, d).select("basket_id", "product_id", "day")
    promo = td.products(spark, d).filter(F.col("commodity_desc") == "PROMO").select("product_id")
    flagged = jn.keep_in(ln, promo, "product_id")
    bad = flagged.select("basket_id").distinct()
    return jn.drop_in(ln, bad, "basket_id")


# ---------------------------------------------------------------- joins
@register("jon1_enrich_left", with_ctes(td.LINES_SQL, td.PRODUCTS_SQL, body="""
SELECT l.basket_id, l.product_id, p.department, p.commodity_desc FROM lines l
LEFT JOIN products p ON l.product_id = p.product_id"""))
def jon1_enrich_left(spark: SparkSession, d: str) -> DataFrame:
    ln = td.lines(spark, d).select("basket_id", "product_id")
    prod = td.products(spark, d).select("product_id", "department", "commodity_desc")
    return jn.enrich(ln, prod, "product_id")


@register("jon2_composite_left", with_ctes(td.LINES_SQL, fact_sql("month_no"), body="""
SELECT f.household_key, f.month_no, round(f.sales_value, 4) AS sales_value, o.n_orders
FROM fact f LEFT JOIN (SELECT o_custkey, CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS m,
                              count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2) o
ON f.household_key = o.o_custkey AND f.month_no = o.m"""))
def jon2_composite_left(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders").filter(F.col("o_orderstatus") == "F")
    cnt = o.groupBy(F.col("o_custkey").alias(H),
                    ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")).cast("int").alias(M)).agg(
        F.count(F.lit(1)).alias("n_orders"))
    f = fact(spark, d, M).select(H, M, "sales_value")
    return rounded(jn.enrich(f, cnt, [H, M]))


@register("jon3_two_aggregates_one_pass", """
SELECT a.day, round(a.load, 4) AS load, round(b.peak, 4) AS peak FROM
  (SELECT CAST(ts AS DATE) AS day, sum(value) AS load FROM events GROUP BY 1) a
JOIN (SELECT CAST(ts AS DATE) AS day, max(value) AS peak FROM events GROUP BY 1) b ON a.day = b.day""")
def jon3_two_aggregates_one_pass(spark: SparkSession, d: str) -> DataFrame:
    """Two aggregates of one table joined on their key == one groupBy (one scan, one shuffle)."""
    e = td.table(spark, d, "events")
    return rounded(e.groupBy(F.to_date("ts").alias("day")).agg(F.sum("value").alias("load"),
                                                               F.max("value").alias("peak")))


@register("jon4_fill_to_grid", """
WITH ev AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events)
SELECT g.user_id, g.day, coalesce(c.n, 0) AS n_events FROM
  (SELECT u.user_id, CAST(t.d AS DATE) AS day FROM (SELECT DISTINCT user_id FROM ev) u,
   (SELECT min(day) lo, max(day) hi FROM ev) b, range(b.lo, b.hi + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)) g
LEFT JOIN (SELECT user_id, day, count(*) AS n FROM ev GROUP BY 1, 2) c ON g.user_id = c.user_id AND g.day = c.day""")
def jon4_fill_to_grid(spark: SparkSession, d: str) -> DataFrame:
    """Aggregate right-joined onto the full (user, day) grid, zero-filled."""
    e = td.table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"))
    cnt = agg.group_counts(e, ["user_id", "day"], "n_events")
    b = e.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    grid = e.select("user_id").distinct().crossJoin(F.broadcast(b)).select(
        "user_id", F.explode(F.sequence("lo", "hi")).alias("day"))
    return grid.join(cnt, ["user_id", "day"], "left").fillna(0, subset=["n_events"])


@register("jon5_outer_align", """
SELECT coalesce(a.hour, b.hour) AS hour, round(a.views, 4) AS views, round(b.clicks, 4) AS clicks FROM
  (SELECT date_trunc('hour', ts) AS hour, sum(value) AS views FROM events WHERE event_type = 'view' GROUP BY 1) a
FULL OUTER JOIN
  (SELECT date_trunc('hour', ts) AS hour, sum(value) AS clicks FROM events WHERE event_type = 'click' GROUP BY 1) b
ON a.hour = b.hour""")
def jon5_outer_align(spark: SparkSession, d: str) -> DataFrame:
    e = td.table(spark, d, "events")
    a = e.filter(F.col("event_type") == "view").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.sum("value").alias("views"))
    b = e.filter(F.col("event_type") == "click").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.sum("value").alias("clicks"))
    return rounded(jn.outer_align(a, b, "hour"))


@register("jon6_semi_anti", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount >= 0.1)
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def jon6_semi_anti(spark: SparkSession, d: str) -> DataFrame:
    o = td.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    hi = td.table(spark, d, "lineitem").filter(F.col("l_discount") >= 0.1).select(F.col("l_orderkey").alias("o_orderkey"))
    neg = td.table(spark, d, "customer").filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return jn.drop_in(jn.keep_in(o, hi, "o_orderkey"), neg, "o_custkey")


@register("jon7_cross_grid", """
SELECT c.c_custkey, m.m AS month_no FROM customer c,
  (SELECT DISTINCT CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS m FROM orders) m""")
def jon7_cross_grid(spark: SparkSession, d: str) -> DataFrame:
    """Entities x observed periods. The period side is bounded by the time span
    (one row per month), so it is the broadcast side of the cross product."""
    months = td.table(spark, d, "orders").select(
        ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")).cast("int").alias(M)).distinct()
    return td.table(spark, d, "customer").select("c_custkey").crossJoin(F.broadcast(months))


@register("jon8_expand_interval", with_ctes(td.CAMPAIGNS_SQL, body="""
SELECT d.day, count(*) AS n_campaigns FROM
  (SELECT DISTINCT CAST(day AS INTEGER) AS day FROM (SELECT unnest(generate_series(start_day, end_day)) AS day
   FROM campaigns)) d
JOIN campaigns c ON d.day BETWEEN c.start_day AND c.end_day GROUP BY 1"""))
def jon8_expand_interval(spark: SparkSession, d: str) -> DataFrame:
    """Intervals expanded to one row per day, then counted per day (no range join)."""
    days = jn.expand_interval(td.campaigns(spark, d), "start_day", "end_day", "day")
    return agg.group_counts(days, ["day"], "n_campaigns")


@register("jon10_align_on_keys", with_ctes(td.LINES_SQL, body="""
SELECT v.household_key, v.week_no, v.n_visits, g.mean_gap FROM
  (SELECT household_key, week_no, count(*) AS n_visits FROM (SELECT DISTINCT household_key, day, week_no FROM lines)
   GROUP BY 1, 2) v
LEFT JOIN (SELECT household_key, week_no, round(avg(gap), 4) AS mean_gap FROM
  (SELECT household_key, week_no, day - lag(day) OVER (PARTITION BY household_key ORDER BY day) AS gap
   FROM (SELECT DISTINCT household_key, day, week_no FROM lines)) GROUP BY 1, 2) g
ON v.household_key = g.household_key AND v.week_no = g.week_no"""))
def jon10_align_on_keys(spark: SparkSession, d: str) -> DataFrame:
    """Two feature tables aligned by (entity, period), never by row position."""
    from panelkit.operators import windows as win
    vis = td.lines(spark, d).select(H, "day", W).distinct()
    cnt = agg.group_counts(vis, [H, W], "n_visits")
    gp = win.gap_since_prev(vis, H, "day", out="gap")
    mg = gp.groupBy(H, W).agg(round_dec(F.avg("gap"), 4).alias("mean_gap"))
    return jn.assemble(cnt, [(mg, [H, W])])
