"""NULLs, empty and short inputs, repeated keys and rows outside the asked range."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from panelkit.functions import strings as fs
from panelkit.operators import aggregates as agg
from panelkit.operators import enrich as en
from panelkit.operators import evaluate as ev
from panelkit.operators import fairness as fr
from panelkit.operators import grid, joins, split
from panelkit.operators import match as mt
from panelkit.operators import windows as win


def test_fair2_rows_without_label_are_left_out(spark):
    df = spark.createDataFrame([(0, 1.0), (0, None), (1, 1.0), (1, 0.0)], "g int, y double")
    assert fr.mean_difference(df, "g", "y").first()[0] == 0.5


def test_evl1_rows_without_prediction_are_left_out(spark):
    rows = [(1.0, 1.0), (2.0, 2.5), (3.0, 2.0), (10.0, None)]
    got = ev.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    want = ev.regression_metrics(spark.createDataFrame(rows[:3], "y double, p double"), "y", "p").first()
    assert got == want and got.r2 == pytest.approx(1 - 1.25 / 2)


def test_evl4_empty_cells_and_empty_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 2), (1, 0)], "y int, p int")
    got = {(r.y, r.p): (r.n, r.share) for r in ev.confusion(df, "y", "p").collect()}
    assert len(got) == 9 and got[(0, 0)] == (2, pytest.approx(2 / 3)) and got[(1, 1)] == (0, 0.0)
    assert got[(2, 0)] == (0, None)


def test_enc1_null_is_zero_everywhere_and_sparse_form_has_no_limit(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "k int, c string")
    got = {r.k: (r.c_a, r.c_b) for r in split.one_hot(df, {"c": ["a", "b"]}).collect()}
    assert got == {1: (1, 0), 2: (0, 0), 3: (0, 1)}
    many = spark.range(1500).select(F.col("id").cast("string").alias("c"))
    vec = split.one_hot_sparse(many, ["c"]).first().c_vec
    assert vec.size == 1501 and vec.numNonzeros() == 1


def test_mat2_empty_texts(spark):
    df = spark.createDataFrame([("", ""), ("", "abc"), ("abc", "abd")], "a string, b string")
    assert [r[0] for r in df.select(mt.levenshtein_score("a", "b")).collect()] == [100, 0, 67]


def test_mat3_short_tokens_and_repeated_keys(spark):
    tokens = spark.createDataFrame([("ab",), ("abcd",), ("é",), ("zzz",), ("",)], "t string")
    names = spark.createDataFrame([("xabcy", 1), ("abcx", 2), ("abcd", 2), ("né", 3), ("", 4)], "n string, k int")
    got = sorted((r.token, r.k) for r in mt.contains_match(tokens, names, "t", "n", ["k"]).collect())
    assert got == [("ab", 1), ("ab", 2), ("ab", 2), ("abcd", 2), ("é", 3)]


def test_str2_only_listed_texts_are_zero(spark):
    df = spark.createDataFrame([("3+",), ("2",), ("Unknown",), (None,), ("many",)], "c string")
    assert [r[0] for r in df.select(fs.capped_int("c")).collect()] == [3, 2, 0, None, None]


def test_enr5_rounds_half_even(spark):
    promo = spark.createDataFrame([(1, 1, 0), (1, 2, 0)], "h int, w int, num_coupons int")
    sup = spark.createDataFrame([(1, 2, 0.125, 0.5)], "h int, w int, time_spent_on_app double, supporting double")
    got = en.rebuild_promotions(promo, sup, "h", "w").orderBy("w").collect()
    assert got[0].time_in_app == 0.12


def test_dense_panel_keeps_rows_outside_the_bounds(spark):
    df = spark.createDataFrame([(1, -1, 5.0), (1, 3, 7.0), (2, 2, None), (None, 1, 1.0)], "e int, p int, v double")
    got = {(r.e, r.p): r.v for r in grid.dense_panel(df, "e", "p", ["v"]).collect()}
    assert len(got) == 10 and got[(1, -1)] == 5.0 and got[(1, 3)] == 7.0 and sum(got.values()) == 12.0
    assert {r.p for r in grid.make_grid(df, "e", "p", 1, 2).collect()} == set(range(-1, 4))
    kept = {(r.e, r.p): r.v for r in grid.dense_panel(df, "e", "p", ["v"], start=None, end=4, fill=None).collect()}
    assert len(kept) == 12 and kept[(2, 2)] is None and kept[(1, 3)] == 7.0


def test_ids_and_indexes_with_nulls_and_ties(spark):
    df = spark.createDataFrame([(None, 1), ("b", 1), (None, 1), ("b", 2), ("a", None)], "x string, y int").repartition(3)
    ids = {(r.x, r.y): r.group_id for r in win.dense_group_id(df, ["x", "y"]).collect()}
    assert ids == {(None, 1): 1, ("a", None): 2, ("b", 1): 3, ("b", 2): 4}
    idx = sorted(r.row_idx for r in win.row_index(df, ["x", "y"]).collect())
    assert idx == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("frac", [0.0, 0.3, 0.5, 0.99, 1.0])
def test_split_ordered_takes_exactly_the_first_rows(spark, frac):
    rows = [(None, 1), (None, 2), (1, 3), (1, 1), (1, 2), (1, 9), (2, 1), (3, 1), (3, 2)]
    got = split.split_ordered(spark.createDataFrame(rows, "m int, h int").repartition(3), ["m", "h"], frac).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    train = {(r.m, r.h) for r in got if r.split == "train"}
    assert len(got) == len(rows) and train == set(order[:int(len(rows) * frac)])


def test_split_ordered_empty(spark):
    assert split.split_ordered(spark.createDataFrame([], "m int, h int"), ["m", "h"]).count() == 0


def test_box_stats_match_percentile(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("c"), F.pow(F.col("id") % 17, F.lit(2.0)).alias("v"))
    q = F.percentile("v", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    want = {r.c: tuple(r.q) for r in df.groupBy("c").agg(q.alias("q")).collect()}
    got = {r.c: tuple(r)[1:] for r in agg.box_stats(df, ["c"], "v").collect()}
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def test_active_campaigns_weights_days_by_their_campaigns(spark):
    iv = spark.createDataFrame([("a", 1, 3), ("b", 3, 9)], "c string, s int, e int")
    days = spark.createDataFrame([(1, 1, 10.0), (3, 1, 40.0), (8, 2, 5.0), (20, 3, None)], "d int, p int, m double")
    got = {r.p: (r.num_campaigns, r.m) for r in en.active_campaigns(iv, days, "c", "s", "e", "d", "p", "m").collect()}
    assert got == {1: (2, 30.0), 2: (1, 5.0), 3: (0, None)}


def test_sample_rows_by_count_and_fraction(spark):
    df = spark.range(4000).withColumnRenamed("id", "k")
    assert joins.sample_rows(df, "k", n=7).count() == 7
    part = {r.k for r in joins.sample_rows(df, "k", fraction=0.25).collect()}
    assert 850 < len(part) < 1150 and part == {r.k for r in joins.sample_rows(df.repartition(5), "k", fraction=0.25).collect()}
    assert joins.sample_rows(df, "k", fraction=0.0).count() == 0


def test_similarity_runs_away_from_the_repository(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {repo!r})\n"
            "from panelkit.session import get_spark\nfrom panelkit.operators import match\n"
            f"s = get_spark('local[1]', extra={{'spark.sql.warehouse.dir': {str(tmp_path)!r}}})\n"
            "df = s.createDataFrame([('abcd', 'abxd')], 'a string, b string')\n"
            "print('RATIO', df.select(match.similarity('a', 'b')).first()[0])\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "RATIO 75" in out.stdout, out.stderr[-2000:]
