"""Sources and sinks (SRC-1..3, SNK-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *, header: bool = True,
             null_value: str = "", mode: str = "PERMISSIVE") -> DataFrame:
    """SRC-1: header CSV with a declared schema (no inference pass over the data).

    ``path`` may be any Hadoop file system URI, a directory or a glob.
    """
    return (spark.read.schema(schema)
            .option("header", header).option("nullValue", null_value).option("mode", mode)
            .csv(path))


def read_many(spark: SparkSession, pattern: str, schema: T.StructType,
              source_col: str | None = "source_file") -> DataFrame:
    """SRC-2: one scan over every file matching ``pattern`` (vertical append).

    Spark lists the files and splits them over tasks; the file name is kept as a
    lineage column when ``source_col`` is given.
    """
    df = read_csv(spark, pattern, schema)
    if source_col:
        df = df.withColumn(source_col, F.col("_metadata.file_name"))
    return df


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC-3: a driver parquet table (column pruning and filters reach the scan)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_csv(df: DataFrame, path: str, *, null_value: str = "", mode: str = "overwrite") -> None:
    """SNK-1: CSV with header, no index column, NULL written as empty."""
    df.write.mode(mode).option("header", True).option("nullValue", null_value).csv(path)


def write_parquet(df: DataFrame, path: str, *, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
