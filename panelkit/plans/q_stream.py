"""Streaming form of AGG-1 over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.plans.common import rounded
from panelkit.plans.registry import register
from panelkit.streaming.period_fact import open_windows, run_event_fact
from panelkit.sources.io import load_table


@register("agg1_stream_event_fact", """
WITH w AS (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start, value FROM events)
SELECT user_id, window_start, window_start + INTERVAL 1 DAY AS window_end, round(sum(value), 4) AS value_sum,
       count(*) AS n_events
FROM w GROUP BY 1, 2""")
def agg1_stream_event_fact(spark: SparkSession, d: str) -> DataFrame:
    """Daily value sum and count per user: the windows a file stream with a 1-hour
    watermark has closed and emitted, and those still open from the events at hand."""
    sink = run_event_fact(spark, d, "1 day", "1 hour", glob="events.parquet")
    still = open_windows(load_table(spark, d, "events"), "user_id", "ts", "value", "1 day", "1 hour")
    out = spark.read.schema(still.schema).parquet(sink).unionByName(still).select("user_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                                          F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                                          "value_sum", "n_events")
    return rounded(out)
