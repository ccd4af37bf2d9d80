"""Hand fixtures with literal answers (FIXTURES.md section 5)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelkit.functions import calendar as cal
from panelkit.functions import mathx
from panelkit.functions import strings as fs
from panelkit.operators import aggregates as agg
from panelkit.operators import evaluate as ev
from panelkit.operators import fairness as fr
from panelkit.operators import grid as grd
from panelkit.operators import joins as jn
from panelkit.operators import match as mt
from panelkit.operators import split as sp
from panelkit.operators import windows as win
from panelkit.plans.q_basic import clamp_low


def close(a, b, tol=1e-4):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, abs_tol=tol)


def series(spark, values, entity="A"):
    data = [(entity, i + 1, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "e string, t int, x double")


def col_by_t(df, c):
    return [r[c] for r in df.orderBy("t").collect()]


def test_win7_countdown_step7(spark):
    out = win.countdown_fill(series(spark, [2, None, None, 10.5, None, None]), "e", "t", "x", step=7)
    assert col_by_t(out, "x") == [2.0, None, 3.5, 10.5, None, None]


def test_win7_countdown_step1(spark):
    out = win.countdown_fill(series(spark, [None, None, None, 3, None, None]), "e", "t", "x", step=1)
    assert col_by_t(out, "x") == [0.0, 1.0, 2.0, 3.0, None, None]


def test_win3_win5_gaps(spark):
    v = spark.createDataFrame([("A", 3, 1), ("A", 5, 1), ("A", 24, 4), ("A", 26, 4)], "e string, day int, week int")
    g = win.gap_since_prev(v, "e", "day", out="gap")
    assert [r["gap"] for r in g.orderBy("day").collect()] == [None, 2, 19, 2]
    m = agg.group_means(g, ["e", "week"], ["gap"]).orderBy("week").collect()
    assert [r["gap"] for r in m] == [2.0, 10.5]


def test_win8_ffill(spark):
    assert col_by_t(win.ffill(series(spark, [10, None, 30]), "e", "t", "x"), "x") == [10.0, 10.0, 30.0]


def test_win9_last_trip_within_entity(spark):
    df = series(spark, [None, 5, None], "A").unionByName(series(spark, [7, None, None], "B"))
    out = win.last_trip_amount(df, "e", "t", "x", out="lt")
    got = {(r["e"], r["t"]): r["lt"] for r in out.collect()}
    assert [got[("A", t)] for t in (1, 2, 3)] == [None, None, 5.0]
    assert [got[("B", t)] for t in (1, 2, 3)] == [None, 7.0, 7.0]


def test_win11_14_expanding_stats(spark):
    out = win.expanding_stats(series(spark, [10, 30, 50, 99]), "e", "t", "x").orderBy("t").collect()
    last = out[3]
    assert close(last["x_mean"], 30) and close(last["x_std"], 20) and close(last["x_var"], 400)
    assert close(last["x_q25"], 20) and close(last["x_q50"], 30) and close(last["x_q75"], 40)
    assert all(out[0][f"x_{s}"] is None for s in ("mean", "std", "var", "q25", "q50", "q75"))
    assert out[1]["x_std"] is None and out[1]["x_var"] is None and close(out[1]["x_mean"], 10)


def test_win17_weighted_lag_mean(spark):
    out = win.weighted_lag_mean(series(spark, list(range(1, 11)) + [0]), "e", "t", "x", 10, out="w")
    vals = col_by_t(out, "w")
    assert all(v is None for v in vals[:10]) and close(vals[10], 7.0)


def test_win18_weighted_lag_mean_zeros(spark):
    out = win.weighted_lag_mean(series(spark, [5, 0, 1]), "e", "t", "x", 10, null_as_zero=True, out="w")
    assert close(col_by_t(out, "w")[2], 0.8182)


def test_win21_weekday_shares(spark):
    flags = spark.createDataFrame([("A", 1, 1, 1), ("A", 2, 1, 0), ("A", 3, 0, 0)], "e string, t int, Mon int, Wed int")
    z = spark.createDataFrame([("A", 0, 0, 0)], "e string, t int, Mon int, Wed int")
    out = win.weekday_shares(flags.unionByName(z), "e", "t", ["Mon", "Wed"]).orderBy("t").collect()
    assert (out[0]["Mon_share"], out[0]["Wed_share"]) == (0.0, 0.0)
    assert close(out[1]["Mon_share"], 0.5) and close(out[1]["Wed_share"], 0.5)
    assert close(out[2]["Mon_share"], 2 / 3) and close(out[2]["Wed_share"], 1 / 3)
    assert close(out[3]["Mon_share"], 2 / 3) and close(out[3]["Wed_share"], 1 / 3)


def test_win24_interpolate(spark):
    out = win.interpolate_linear(series(spark, [10, None, None, 40, None]), "e", "t", "x")
    assert [round(v, 6) for v in col_by_t(out, "x")] == [10, 20, 30, 40, 40]


def test_grd1_grid(spark):
    f = spark.createDataFrame([("A", 1, 1.0), ("B", 3, 2.0)], "e string, t int, x double")
    g = grd.make_grid(f, "e", "t")
    assert g.count() == 6 and g.distinct().count() == 6
    d = grd.dense_panel(f, "e", "t", ["x"], start=1)
    assert sorted(rows(d)) == [("A", 1, 1.0), ("A", 2, 0.0), ("A", 3, 0.0), ("B", 1, 0.0), ("B", 2, 0.0),
                               ("B", 3, 2.0)]


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_cal2_week_simple(spark):
    r = spark.range(1).select(cal.week_simple(F.lit("2016-01-01").cast("date")).alias("w"),
                              F.weekofyear(F.lit("2016-01-01").cast("date")).alias("iso")).first()
    assert (r["w"], r["iso"]) == (1, 53)


def test_cal7_cal8_cal9_relative_calendar(spark):
    df = spark.createDataFrame([(d,) for d in (9, 10, 39, 40, 339, 340)], "day int")
    assert [r[0] for r in df.select(cal.relative_month("day")).collect()] == [
        "February", "March", "March", "April", "January", "February"]
    df2 = spark.createDataFrame([(d,) for d in (9, 10, 39)], "day int")
    assert [r[0] for r in df2.select(cal.relative_weekday("day")).collect()] == ["Wednesday", "Thursday", "Friday"]
    w = spark.createDataFrame([(x,) for x in (45, 46, 93, 94)], "w int")
    assert [r[0] for r in w.select(cal.relative_year("w")).collect()] == [2017, 2018, 2018, 2019]


def test_cal4_holidays_2016(spark):
    years = spark.createDataFrame([(2016,)], "year int")
    got = {r["date"] for r in cal.holiday_dim(spark, years).collect()}
    expect = {dt.date(2016, m, d) for m, d in [(1, 1), (1, 18), (2, 15), (5, 30), (7, 4), (9, 5), (10, 10),
                                               (11, 11), (11, 24), (12, 26)]}
    assert got == expect


def test_cal6_sunrise_philadelphia(spark):
    rise, sets = cal.sunrise_sunset(F.lit("2016-06-21").cast("date"), 40.0, -75.0)
    r = spark.range(1).select((rise - 5).alias("r"), (sets - 5).alias("s")).first()
    # published almanac (Philadelphia area, EST = UTC-5): about 04:32 and 19:33
    assert abs(r["r"] - (4 + 32 / 60)) < 5 / 60 and abs(r["s"] - (19 + 33 / 60)) < 5 / 60


def test_str1_range_midpoint(spark):
    df = spark.createDataFrame([(s,) for s in ("45-54", "19-24", "65+", "35-46")], "s string")
    assert [r[0] for r in df.select(fs.range_midpoint("s")).collect()] == [50, 22, 65, 40]
    inc = spark.createDataFrame([("50-74K",), ("Under 15K",)], "s string")
    assert [r[0] for r in inc.select(fs.range_midpoint("s", 1000)).collect()] == [62000, 15000]


def test_prj6_clamp(spark):
    df = spark.createDataFrame([(18750.0,), (18751.0,)], "x double")
    assert [r[0] for r in df.select(clamp_low("x", 18750, 18503.0)).collect()] == [18503.0, 18751.0]


def test_clean4_money(spark):
    df = spark.createDataFrame([(s,) for s in ("$12.5", "-$3", "$0", "9999999")], "s string")
    out = df.select(fs.parse_money(fs.null_if("s", ["9999999"]))).collect()
    assert [r[0] for r in out] == [12.5, -3.0, 0.0, None]


def test_jon8_expand_interval(spark):
    c = spark.createDataFrame([(1, 3, 5), (2, 5, 6)], "campaign int, s int, e int")
    days = jn.expand_interval(c, "s", "e", "day")
    assert days.count() == 5
    per = {r["day"]: r["n"] for r in agg.group_counts(days, ["day"]).collect()}
    assert per[5] == 2


def test_enc2_constant_column(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert [r[0] for r in mathx.min_max(df, ["x"]).collect()] == [0.0, 0.0]


def test_spl1_ordered_split_11(spark):
    df = spark.range(11).withColumnRenamed("id", "k")
    out = sp.split_ordered(df, ["k"], 0.8)
    got = {r["k"]: r["split"] for r in out.collect()}
    assert sum(v == "train" for v in got.values()) == 8
    assert all(got[k] == "train" for k in range(8)) and all(got[k] == "test" for k in range(8, 11))


def test_evl2_mape(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 9.0)], "y double, p double")
    a = ev.mape(df, "y", "p", 1.0).first()
    assert close(a["mape"], 54.5455)
    b = ev.mape(df, "y", "p", 0.0).first()
    assert close(b["mape"], 10.0) and b["n_excluded"] == 1


def test_evl5_precision_recall(spark):
    data = [(1, 1)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(0, 0)] * 4
    r = ev.precision_recall(spark.createDataFrame(data, "y int, p int"), "y", "p").first()
    assert (r["tp"], r["fp"], r["fn"]) == (3, 1, 2) and close(r["precision"], 0.75) and close(r["recall"], 0.6)


def test_fair2_fair3(spark):
    data = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 2 + [(0, 0)] * 2
    df = spark.createDataFrame(data, "privileged int, favourable int")
    assert close(fr.mean_difference(df, "privileged", "favourable").first()[0], -0.25)
    w = {(r["privileged"], r["favourable"]): r["weight"]
         for r in fr.reweigh_weights(df, "privileged", "favourable").collect()}
    assert close(w[(1, 1)], 0.8889) and close(w[(1, 0)], 1.3333) and close(w[(0, 1)], 1.3333) and close(w[(0, 0)],
                                                                                                         0.6667)
    rw = fr.reweigh(df, "privileged", "favourable")
    assert abs(fr.mean_difference(rw, "privileged", "favourable", weight="weight").first()[0]) < 1e-12


def test_mat1_ratio(spark):
    assert mt.ratio("tskbti", "tskbis") == 83
    df = spark.createDataFrame([("TSKBTI", "TSKBIS")], "a string, b string")
    assert df.select(mt.similarity("a", "b")).first()[0] == 83


@pytest.mark.parametrize("a,b", [("kitten", "sitting"), ("", "abc"), ("abcdef", "azced"), ("aaaa", "aa")])
def test_mat1_lcs_against_dp(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            m[i][j] = m[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(m[i - 1][j], m[i][j - 1])
    assert mt.lcs_length(a, b) == m[len(a)][len(b)]


def test_txt1_trade_text(spark):
    df = spark.createDataFrame([(1, "1 mio TSKBTI 0% 01/23/25 $    XS2100270508")], "id long, text string")
    r = mt.extract_trade_fields(df, "text").first()
    assert (r["currency"], r["trade_date"], r["rates"]) == ("dollar", dt.date(2025, 1, 23), "1 0%")


def test_win24_daily_to_hours_ramps_missing_days(spark):
    hours = [(dt.datetime(2016, 2, 27) + dt.timedelta(hours=h),) for h in range(24 * 5)]
    hourly = spark.createDataFrame(hours, "ts timestamp_ntz")
    daily = spark.createDataFrame([(dt.date(2016, 2, 27), 10.0), (dt.date(2016, 3, 1), 40.0),
                                   (dt.date(2016, 3, 2), None)], "date date, temp double")
    out = {r["ts"]: r["temp"] for r in win.interpolate_daily_to_hours(hourly, "ts", daily, "date", "temp").collect()}
    assert out[dt.datetime(2016, 2, 27, 5)] == 10.0 and out[dt.datetime(2016, 3, 1, 7)] == 40.0
    # leap day 2016-02-29 12:00 lies 37 of 49 hours between 02-27 23:00 (10) and 03-01 00:00 (40)
    assert close(out[dt.datetime(2016, 2, 29, 12)], 10 + 30 * 37 / 49)
    assert out[dt.datetime(2016, 3, 2, 23)] == 40.0  # trailing gap holds the last value
