"""AGG-1 as a Structured Streaming job.

Events are read as a file stream with a declared schema, bounded by a
watermark, aggregated into tumbling windows per entity and appended to a
parquet sink. Append mode emits a window once the watermark (max event time
minus the allowed delay) has passed its end, so the sink holds exactly the
closed windows; state for closed windows is dropped. The checkpoint and the
sink live under the shared checkpoint folder, so a restarted query resumes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.session import checkpoint_dir, scratch_path

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def windowed_fact(stream: DataFrame, entity: str, ts: str, value: str, window: str, delay: str) -> DataFrame:
    """Watermarks need a zoned timestamp: naive times are read as session-zone (UTC) wall time."""
    return (stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
            .groupBy(F.window(ts, window).alias("w"), F.col(entity))
            .agg(F.sum(value).alias("value_sum"), F.count(F.lit(1)).alias("n_events"))
            .select(entity, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "value_sum", "n_events"))


def run_event_fact(spark: SparkSession, source: str, window: str = "1 day", delay: str = "1 hour",
                   run_id: str | None = None, glob: str | None = None) -> str:
    """Run the stream over every file currently in the ``source`` folder (matching
    ``glob``), with the availableNow trigger, and return the sink path."""
    base = f"{checkpoint_dir(spark)}/stream-{run_id}" if run_id else scratch_path(spark, "stream")
    sink, ckpt = f"{base}/sink", f"{base}/checkpoint"
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.parquet(source)
    q = (windowed_fact(stream, "user_id", "ts", "value", window, delay)
         .writeStream.outputMode("append").format("parquet")
         .option("path", sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def open_windows(events: DataFrame, entity: str, ts: str, value: str, window: str, delay: str) -> DataFrame:
    """The windows the watermark has not closed yet, from the events at hand: what append mode holds back."""
    latest = events.agg(F.max(F.col(ts).cast("timestamp")).alias("__t"))
    w = windowed_fact_batch(events, entity, ts, value, window)
    late = F.col("window_end") > F.col("__t") - F.expr(f"INTERVAL {delay}")
    return w.crossJoin(F.broadcast(latest)).filter(late).drop("__t")  # one row


def windowed_fact_batch(events: DataFrame, entity: str, ts: str, value: str, window: str) -> DataFrame:
    return (events.groupBy(F.window(F.col(ts).cast("timestamp"), window).alias("w"), F.col(entity))
            .agg(F.sum(value).alias("value_sum"), F.count(F.lit(1)).alias("n_events"))
            .select(entity, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "value_sum", "n_events"))
