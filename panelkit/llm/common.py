"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import cut_lineage, discard
from panelkit.sources.io import load_table

#: Fixed value: the word pattern of the contracts (its complement: the six ASCII white-space characters).
WORD_GAP = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "documents")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other letter stays as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key() -> Column:
    """A distinct long per row. Stable only once written: use it below ``cut_lineage``."""
    return F.monotonically_increasing_id()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable over the pairs a, b), nodes that reach a smaller one only."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j, low = ends[:len(a)], ends[len(a):], np.arange(len(nodes))
    while len(i):
        x, y = low[i], low[j]
        apart = x != y
        i, j = i[apart], j[apart]
        np.minimum.at(low, np.maximum(x[apart], y[apart]), np.minimum(x[apart], y[apart]))
        while True:  # every node hangs on its root
            up = low[low]
            if np.array_equal(up, low):
                break
            low = up
    moved = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[moved], nodes[low[moved]]


def contract(edges: DataFrame, limit: int) -> DataFrame:
    """Edges (a, b) of each partition as stars: every node with the smallest one it reaches there. Works on ``limit``
    edges at a time, so a task's memory is bounded; stars never outnumber edges."""
    def run(batches):
        held, n = [], 0

        def stars():
            return least_labels(*(np.concatenate(x) for x in zip(*held)))

        def out(node, low):
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(low)], ["a", "b"])

        for batch in batches:
            held.append(tuple(batch.column(k).to_numpy() for k in (0, 1)))
            n += batch.num_rows
            if n >= limit:
                held = [stars()]
                n = len(held[0][0])
                if n > limit // 2:
                    yield out(*held[0])
                    held, n = [], 0
        if held:
            yield out(*stars())

    return edges.mapInArrow(run, "a long, b long")


def smallest_reachable(edges: DataFrame, limit: int = 1 << 20) -> DataFrame:
    """(node, component): the smallest node reachable over undirected ``edges`` (a, b). Nodes without edges are absent.

    Edges are dealt to partitions of about ``limit`` and contracted to stars there. While a node hangs on two roots, or on
    a node that hangs on another, a round of large star and small star follows: the larger neighbours of a
    node, then the smaller ones, go to the smallest of its neighbourhood, and the partitions contract again. The
    number of edges never grows and the depth shrinks geometrically. Each round is a written table, the one
    before it is deleted, and one row of counters reaches the driver. Hot nodes: the minimum is a map-side
    combined aggregate, and the join that brings it back can be split by skew.
    """
    raw = cut_lineage(_both_smaller_second(edges), "edges")
    n = raw.count()
    e = cut_lineage(contract(raw.repartition(max(1, -(-n // limit))), limit), "edges")
    discard(raw)
    while not _are_stars(e):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(low, "a").filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        before, e = e, cut_lineage(contract(small.filter("a <> b"), limit).distinct(), "edges")
        discard(before)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _are_stars(e: DataFrame) -> bool:
    """Whether every node hangs on one root that hangs on none."""
    ends = e.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.lit(1).alias("up")),
                                      F.struct(F.col("b").alias("v"), F.lit(None).cast("int").alias("up")))).alias("e"))
    ends = ends.select("e.*").groupBy("v").agg(F.count("up").alias("up"), F.count("*").alias("n"))
    return ends.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("n") > F.col("up")))).isEmpty()


def _both_smaller_second(edges: DataFrame) -> DataFrame:
    return (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .filter("a <> b").distinct())


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Rows go to Python in Arrow batches of about ``most`` bytes, unless the session says otherwise: 10,000 rows of whole texts
    are tens of MB, held several times over by both sides. No result depends on it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, str(2**31 - 1), str(2**63 - 1)):
        spark.conf.set(key, str(most))


def tidy(run):
    """A function for ``mapInArrow`` that gives its memory back to the system when it is through: Python workers live on, and what
    their allocators keep would count beside the next stage."""
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass
    return wrapped


def total(cols: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, cols)


def bloom_bits(keys: DataFrame, most_bits: int = 1 << 28) -> int:
    """Bits of a Bloom filter of the rows of ``keys``: about 16 a key, a power of two."""
    return min(most_bits, max(1 << 20, 1 << (16 * keys.count()).bit_length()))


class FixedBloom:
    """A Bloom filter over one key column of a written table, gathered by Spark as 32-bit words.

    Its bits grow with the keys (16 a key) up to ``most_bits``, so driver and executors hold ``most_bits / 8``
    bytes at most; when more keys come than it can tell apart, more rows pass, none is lost. It only
    spares a shuffle of rows that an exact join drops anyway.
    """

    def __init__(self, keys: DataFrame, key: str, most_bits: int = 1 << 28):
        self.bits = bloom_bits(keys, most_bits)
        m = F.pmod(F.xxhash64(F.col(key)), F.lit(self.bits))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("m") % 32).cast("int"))
        found = (keys.select(m.alias("m")).groupBy(F.shiftright("m", 5).alias("w")).agg(F.bit_or(one).alias("x"))
                 .toArrow())
        words = np.zeros(self.bits // 32, np.uint32)
        words[found["w"].to_numpy()] = found["x"].to_numpy().astype(np.uint32)
        self.shared = keys.sparkSession.sparkContext.broadcast(words)

    def mark(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.bits))

    @staticmethod
    def passes(words, m):
        """For marks m: whether the key may be among the keys (numpy, inside tasks)."""
        return (words[m >> 5] >> (m & 31).astype(np.uint32)) & np.uint32(1) == 1


def mark_possible(rows: DataFrame, keys: DataFrame, key: str, out: str = "may") -> DataFrame:
    """``rows`` and a boolean ``out``: false only where ``key`` is not among those of the written table ``keys``. A Bloom filter as
    ``FixedBloom``, by DataFrame functions only: its bitmaps of 4 KB (8,192 at most) are sent to the executors and
    looked up by a join, so rows stay where they are."""
    bits, in_map = bloom_bits(keys), 1 << 15  # bits in one result of bitmap_construct_agg
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(bits))
    # keys meet by bitmap before they are gathered: a task would make nearly all bitmaps otherwise
    spread = keys.select(place.alias("__m")).select("__m", F.shiftright("__m", 15).alias("__map")).repartition("__map")
    maps = spread.groupBy("__map").agg(F.bitmap_construct_agg(F.col("__m").bitwiseAND(in_map - 1)).alias("__bits"))
    at = F.col("__m").bitwiseAND(in_map - 1)
    byte = F.conv(F.hex(F.substring("__bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, at.bitwiseAND(7).cast("int")) == 1, F.lit(False))  # null: no key in this bitmap
    near = rows.withColumn("__m", place).withColumn("__map", F.shiftright("__m", 15))
    return near.join(F.broadcast(maps), "__map", "left").withColumn(out, found).drop("__map", "__m", "__bits")


def rows_that_stay(docs: DataFrame, both: Column, held: DataFrame) -> DataFrame:
    """``docs`` less the rows that go. ``both``: a key of a row's id and text; ``held`` (both, k): the keys of which rows go,
    with the number that stays (none, or one of rows that agree in id and text). Rows whose key a Bloom filter of those does
    not know stay where they are, so only about as many rows as go are shuffled with their texts."""
    held = cut_lineage(held, "held")
    rows = mark_possible(docs.select(F.struct("*").alias("row"), both.alias("both")), held, "both")
    near = rows.filter("may").join(held, "both", "left")
    one = near.filter("k > 0").groupBy("both").agg(F.first("row").alias("row"))
    return (rows.filter("not may").select("row.*").unionByName(near.filter("k is null").select("row.*"))
            .unionByName(one.select("row.*")))
