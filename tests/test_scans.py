"""Two-level scans against plain versions."""

import random

import numpy as np
import pandas as pd

from panelkit.operators import scans as sc
from panelkit.operators.aggregates import box_stats


def series(spark, seed, n=500, gaps=0.6):
    rng = random.Random(seed)
    rows = [(k * 3 + 1, None if rng.random() < gaps else rng.randrange(10**6) / 7) for k in range(n)]
    rows = rows if gaps < 1 else [(k, None) for k, _ in rows]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    return rows, spark.createDataFrame(shuffled, "x long, y double").repartition(5)


def by_x(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("x").collect()]


def test_fills_and_lines_over_chunks(spark):
    for seed, n, gaps in ((1, 500, 0.6), (2, 300, 0.985), (3, 40, 1.0), (4, 1, 0.0), (5, 60, 0.0)):
        rows, df = series(spark, seed, n, gaps)
        want = pd.Series([y for _, y in rows], index=[float(x) for x, _ in rows], dtype=float)
        got = pd.Series([v for _, v in by_x(sc.ffill_ordered(df, ["x"], "y"), "x", "y")], index=want.index, dtype=float)
        pd.testing.assert_series_equal(got, want.ffill())
        got = pd.Series([v for _, v in by_x(sc.interpolate_ordered(df, ["x"], "x", "y"), "x", "y")], index=want.index, dtype=float)
        pd.testing.assert_series_equal(got, want.interpolate(method="index", limit_direction="both") if want.notna().any() else want)


def test_running_statistics_merge_chunks(spark):
    rows, df = series(spark, 6, 400, 0.3)
    y = pd.Series([v for _, v in rows], dtype=float)
    out = sc.running_stats_ordered(df, ["x"], "y")
    got = pd.DataFrame(by_x(out, "y_n", "y_mean", "y_std"), columns=["n", "mean", "std"]).astype(float)
    before = y.shift(1).expanding(min_periods=1)
    np.testing.assert_array_equal(got["n"], before.count().fillna(0))
    np.testing.assert_allclose(got["mean"], before.mean(), rtol=1e-12)
    np.testing.assert_allclose(got["std"], before.std(), rtol=1e-10)


def test_no_window_spans_the_series(spark):
    _, df = series(spark, 7)
    for out in (sc.ffill_ordered(df, ["x"], "y"), sc.interpolate_ordered(df, ["x"], "x", "y"), sc.running_stats_ordered(df, ["x"], "y")):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert windows and all("__p" in line for line in windows)


def test_quantiles_of_a_hot_class_are_selected_range_by_range(spark):
    rng = random.Random(8)
    rows = [("hot", rng.random()) for _ in range(3000)] + [("b", float(rng.randrange(3))) for _ in range(200)]
    rows += [("one", 4.5), (None, 1.0), (None, 2.0), ("none", None), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {r.k: tuple(r)[1:] for r in box_stats(df, ["k"], "v").collect()}
    for k in {k for k, v in rows if v is not None}:
        want = np.quantile([v for c, v in rows if c == k and v is not None], [0, .25, .5, .75, 1])
        np.testing.assert_allclose(got[k], want, rtol=1e-12)
    assert "none" not in got
    per = sc.quantiles_by_class(df, ["k"], "v", {"q": 0.3}, chunks=50).collect()
    assert {r.k: round(r.q, 9) for r in per if r.k == "hot"} == {"hot": round(np.quantile([v for c, v in rows if c == "hot"], 0.3), 9)}
    assert box_stats(df.limit(0), ["k"], "v").count() == 0


def test_rank_tree_quantiles(spark):
    rng = random.Random(9)
    for n in (0, 1, 2, 300):
        values = [rng.choice([None, float("nan"), rng.randrange(20) / 3, rng.random()]) for _ in range(n)]
        for now in (False, True):
            got = sc.running_quantiles(values, [0.0, 0.25, 0.5, 1.0], now)
            for i in range(n):
                seen = [v for v in values[:i + now] if v is not None and v == v]
                for q, col in zip((0.0, 0.25, 0.5, 1.0), got):
                    assert (col[i] is None) if not seen else abs(col[i] - np.quantile(seen, q)) < 1e-12
    rows = [(e, k, rng.randrange(50) / 2) for e in "ab" for k in range(80)]
    df = spark.createDataFrame(rows, "e string, k int, v double").repartition(3)
    out = sc.expanding_quantiles(df, ["e"], ["k"], "v", {"q50": 0.5}).collect()
    assert len(out) == 160
    for r in out:
        seen = [v for e, k, v in rows if e == r.e and k < r.k]
        assert (r.q50 is None) if not seen else abs(r.q50 - np.median(seen)) < 1e-12
