"""Joins (JON-1..11), membership filters (FLT-3, FLT-6) and set operations (SET-1..2).

Join strategies are Spark's own: ``spark.sql.autoBroadcastJoinThreshold`` and
adaptive execution decide from sizes whether a side is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def enrich(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """JON-1 / JON-2: left join a lookup table on one or more keys."""
    return fact.join(dim, on, how)


def keep_in(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """FLT-3 / JON-6: rows whose key is in ``keys`` (left semi join, never a collected list)."""
    return df.join(keys, on, "left_semi")


def drop_in(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """FLT-3 / JON-6: rows whose key is not in ``keys`` (left anti join)."""
    return df.join(keys, on, "left_anti")


def drop_groups_containing(df: DataFrame, group: str, predicate: F.Column) -> DataFrame:
    """FLT-6: drop every row of any group that has at least one row matching ``predicate``."""
    bad = df.where(predicate).select(group).distinct()
    return drop_in(df, bad, group)


def outer_align(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """JON-5: full outer join on a time key (two series side by side)."""
    return a.join(b, on, "full_outer")


def expand_interval(df: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """JON-8: one row per point of the closed interval [start, end] (no range join)."""
    return df.withColumn(out, F.explode(F.sequence(F.col(start), F.col(end))))


def assemble(base: DataFrame, parts: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """JON-9 / JON-10: left join feature tables onto the base on explicit keys,
    never on row position. Column names must be unique (no _x/_y suffixes)."""
    out = base
    for feat, keys in parts:
        clash = (set(feat.columns) - set(keys)) & set(out.columns)
        if clash:
            raise ValueError(f"duplicate feature columns {sorted(clash)}")
        out = out.join(feat, list(keys), "left")
    return out


def sample_rows(df: DataFrame, key: str, *, n: int | None = None, fraction: float | None = None,
                seed: int = 42) -> DataFrame:
    """SCN-3: a sample that is the same on every run: ``n`` rows with the smallest keyed digests (a top-k), or
    the rows whose digest lies in the first ``fraction`` of its range."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))
    if fraction is not None:
        return df.filter(F.substring(digest, 1, 8) < f"{min(int(fraction * 16 ** 8), 16 ** 8 - 1):08x}")
    return df.orderBy(digest, key).limit(n)


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """SET-1: union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


#: Rows that one task of ``dedupe`` holds, about.
TASK_ROWS = 1_000_000


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """SET-2 / CLEAN-1: drop exact duplicate rows (or duplicates on ``subset``).

    The rows are counted and dealt by their key to partitions of about ``TASK_ROWS``, so the keys that one task
    holds do not grow with the table."""
    keys = list(subset) if subset else df.columns
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
    return df.repartition(n, *[F.col(f"`{k}`") for k in keys]).dropDuplicates(keys)
