"""Exact deduplication by a tree-merge of sorted digest runs (DataFrame functions only).

A run is what one partition holds: one entry per digest, the verified survivor and the number of rows. In round k the runs
exchange by the bits of their number (binomial tree, ``2**fan_bits`` runs per merge): a task gets one range of digests of
all the runs of its group, each of them in order, brings them into one order and merges the neighbours that agree. The range narrows as
the groups grow, so a round has as many tasks as there are runs, until a single run, in order and spread over
the cluster by digest range, is left. Going back down, every (run, digest) entry learns the survivor, then every row
of the run.

A text held by a third of all rows has at most one entry per run at every level, and
its rows meet their answer split over all runs, so no task gathers them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import ascii_lower, row_key, rows_that_stay
from panelkit.session import cut_lineage

KEY = ["__d64", "__sha", "__len"]


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def tree_merge(runs: DataFrame, n_runs: int, fan_bits: int, largest: bool) -> DataFrame:
    """Merge the entries (__run, digest, __pick, __n) of ``n_runs`` runs into one run in order of digests.

    Entries are one text only if the short digest, the 256-bit digest and the byte length
    all agree (checked at every level, so a clash of the short digest never merges different texts)."""
    pick = F.max if largest else F.min
    bits = max(n_runs - 1, 0).bit_length()
    level = runs
    for low in range(0, max(bits, 1), fan_bits):
        merged = min(low + fan_bits, max(bits, 1))  # runs that agree above these bits meet, in 2**merged ranges of digests
        level = level.withColumns({"__run": F.shiftright("__run", merged) * (1 << merged),
                                   "__range": F.shiftrightunsigned("__d64", 64 - merged)})
        level = (level.repartition("__run", "__range").sortWithinPartitions("__run", "__range", *KEY)
                 .groupBy("__run", "__range", *KEY).agg(pick("__pick").alias("__pick"), F.sum("__n").alias("__n")))
    return level.drop("__run", "__range")


def exact_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", *, keep: str = "smallest",
                carry: list[str] | None = None, runs: int | None = None, fan_bits: int = 3) -> DataFrame:
    """One row per input row: ``carry`` columns, then keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The
    row with the smallest (or ``keep="largest"``) id stays; a null id loses to every
    other id; of rows that repeat an id, exactly one stays. ``carry`` defaults to the
    id column. Names of the results replace columns of the same name in ``carry``.
    Empty table: no rows. The partitions of ``docs`` are the runs, or ``runs`` partitions made of them.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    largest = keep == "largest"
    carry = [id_col] if carry is None else carry
    made = ["keep_id", "group_size", "kept", "text_sha256"]
    norm = normalised(F.col(text))
    rows = docs.select(
        F.struct(*[F.col(c) for c in carry if c not in made]).alias("__row"), F.col(id_col).alias("__id"),
        row_key().alias("__uid"), F.sha2(norm, 256).alias("__hex"), F.octet_length(norm).alias("__len"))
    rows = rows.withColumns({
        "__sha": F.unhex("__hex"), "__d64": F.xxhash64("__hex")}).drop("__hex")
    rows = rows.repartition(runs) if runs else rows
    rows = cut_lineage(rows.withColumn("__run", F.spark_partition_id()), "digests")
    n_runs = (rows.agg(F.max("__run")).first()[0] or 0) + 1
    # a null id sorts last in either direction; the row key breaks ties of repeated ids
    present = F.col("__id").isNotNull() if largest else F.col("__id").isNull()
    pick = F.struct(present.alias("p"), F.col("__id").alias("id"),
                    (-F.col("__uid") if largest else F.col("__uid")).alias("u"))
    first = (rows.withColumn("__pick", pick).groupBy("__run", *KEY)
             .agg((F.max if largest else F.min)("__pick").alias("__pick"), F.count("*").alias("__n")))
    entries = first.select("__run", *KEY)
    merged = tree_merge(first, n_runs, fan_bits, largest)
    answers = entries.join(merged, KEY)
    out = rows.join(answers, ["__run", *KEY])
    return out.select(
        "__row.*", F.col("__pick.id").alias("keep_id"), F.col("__n").alias("group_size"),
        (F.col("__uid") == F.abs("__pick.u")).alias("kept"), F.lower(F.hex("__sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id", *, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    # rows that agree in id and text are interchangeable: one of them stays, or none
    own = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    flags = [F.col(c).isNull().cast("int").cast("string") for c in (id_col, text)]
    both = F.md5(F.concat(*flags, F.length(own).cast("string"), F.lit(" "), own, F.coalesce(F.col(text), F.lit(""))))
    packed = docs.select(F.col(id_col).alias("i"), F.col(text).alias("t"), both.alias("both"))
    out = exact_dedup(packed, "t", "i", keep=keep, carry=["both"])
    held = out.groupBy("both").agg(F.count_if("kept").alias("k"), F.count("*").alias("n")).filter("k < n")
    return rows_that_stay(docs, both, held.select("both", "k"))
