"""Operators of the fourth round: what must not grow with the table."""

import re

from pyspark.sql import functions as F

from panelkit.llm import exact_dedup
from panelkit.operators import enrich as en
from panelkit.operators import joins
from panelkit.plans import q_weekly
from tests.conftest import SF_SMALL


def test_days_of_campaigns_stay_off_the_driver(spark):
    iv = spark.range(1000).select(F.col("id").alias("c"), (F.col("id") % 50).alias("s"), (F.col("id") % 50 + 13).alias("e"))
    days = spark.range(10_000_000).select(F.col("id").alias("d"), F.floor(F.col("id") / 7).alias("p"), F.lit(1.0).alias("m"))
    plan = en.active_campaigns(iv, days, "c", "s", "e", "d", "p", "m")._jdf.queryExecution().executedPlan().toString()
    sent = re.findall(r"BroadcastExchange[^\n]*\n(?:[^\n]*(?:Project|Filter)[^\n]*\n)*([^\n]*)", plan)
    assert sent and not [x for x in sent if "Generate" in x]  # campaign days are sent as one row a day, if at all


def test_dedupe_deals_the_keys_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 50)
    df = spark.range(1000).select((F.col("id") % 400).alias("k"), F.when(F.col("id") % 400 < 390, F.lit("x")).alias("v"))
    out = joins.dedupe(df)
    assert out.rdd.getNumPartitions() == 20
    assert sorted((r.k, r.v) for r in out.collect()) == [(k, "x" if k < 390 else None) for k in range(400)]
    one = joins.dedupe(df, ["v"]).collect()
    assert {r.v for r in one} == {"x", None} and len(one) == 2


def test_texts_that_stay_are_not_shuffled(spark, tmp_path):
    rows = [(k, f"Text {k % 270} " + "w " * 40, f"l{k % 3}") for k in range(300)] + [(None, "Text 3 " + "w " * 40, "x"), (7, None, "y"), (7, None, "y")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    out = exact_dedup.drop_copies(docs)
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted([r for r in rows[:270]] + [(7, None, "y")], key=str)
    plan = out._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(k for k, x in enumerate(plan) if x.rstrip().endswith("Union"))
    column = plan[at + 1].index(":- ")
    end = next(k for k in range(at + 2, len(plan)) if plan[k][column:column + 3] in (":- ", "+- "))
    stays = "\n".join(plan[at + 1:end])
    assert "Scan parquet" in stays and "Exchange" not in stays  # what stays is read, not shuffled


def test_weekly_table_sends_no_large_table_and_shuffles_no_panel_by_week(spark):
    plan = q_weekly.weekly_features(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    last = [x for x in plan.split("\n") if "Exchange" in x or "SortMergeJoin" in x or "BroadcastHashJoin" in x]
    assert "SortMergeJoin" in last[0] and "household_key" in last[0]  # demographics
    assert "BroadcastHashJoin" in last[1] and "week_no" in last[1]  # campaigns a week
    assert not re.search(r"Exchange hashpartitioning\(week_no#\d+, \d+\)[^\n]*\n[^\n]*sales_mean", plan)
