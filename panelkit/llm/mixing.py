"""Mixing sources to target weights: hash-random order, prefix sums, exact cut.

Rows get a uniform hash key. A source's rows are ranged by key into fixed intervals
(the key is uniform, so equal intervals are an even range partition with no
sampling job), each interval sums its sizes, a running total over the
(source, interval) table gives every interval its offset, and a window inside the
interval gives every row the words before it. The source is cut where its budget
ends; a budget above the source's size takes whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.llm.common import WORD_GAP


def word_count(text: Column) -> Column:
    """Number of words; null has none. Runs of white space become one space, so the
    gaps left after trimming count the words."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), WORD_GAP, " "))
    return F.when(flat == "", F.lit(0).cast("long")).otherwise(
        (F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long"))


def source_targets(sizes: DataFrame, *, weights: list[float], share: float, cap: float) -> DataFrame:
    """Targets per source from (source, source_size).

    Sources in code-point order, null last, get ``weights`` in turn and split
    ``share`` of all words. A target stops at ``cap`` times its source; the excess goes to the
    others by weight until none is above. That fixed point is min(cap * size, level * weight) for
    one common level, found by ordering sources by cap * size / weight. The table has one row per source.
    """
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    s = sizes.withColumn("__k", F.row_number().over(order) - 1)
    s = s.withColumn("__w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                         (F.col("__k") % len(weights) + 1).cast("int")))
    s = s.withColumn("__cap", F.lit(float(cap)) * F.col("source_size"))
    by = W.orderBy((F.col("__cap") / F.col("__w")).asc(), "__k")
    s = s.withColumns({
        "__goal": F.lit(float(share)) * F.sum("source_size").over(W.partitionBy()),
        "__full": F.coalesce(F.sum("__cap").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
        "__open": F.sum("__w").over(by.rowsBetween(0, W.unboundedFollowing)),
    })
    s = s.withColumn("__level", (F.col("__goal") - F.col("__full")) / F.col("__open"))
    # the first source (in that order) whose cap is not reached fixes the level of all after it
    free = F.when(F.col("__level") * F.col("__w") <= F.col("__cap"), F.col("__level"))
    level = F.first(free, ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    s = s.withColumn("target", F.least(F.col("__cap"), F.coalesce(level * F.col("__w"), F.col("__cap"))))
    return s.select("source", "source_size", "target")


def mix_sources(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", source: str = "source",
                carry: list[str] | None = None, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
                cap: float = 2.0, intervals: int = 1024, seed: int = 0) -> DataFrame:
    """One row per input row: ``carry`` columns (the id by default), then size,
    source_size, target and taken: the words of the row that the mix holds, repeats counted.

    Null text has size 0; a null source is a source of its own. The order is a hash of
    (id, text, seed), so reruns and other partitionings agree; repeated rows are
    interchangeable. Each source's taken words sum to its target rounded to a whole
    word; the row at the cut is taken in part. Columns in ``carry`` may bear any name.
    Empty table: no rows.
    """
    carry = [id_col] if carry is None else carry
    key = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text), F.lit(seed)), 1)
    rows = docs.select(
        F.struct(*carry).alias("__row"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.col(id_col).alias("__id"), key.alias("__key"))
    rows = rows.withColumn("__part", F.shiftright(F.shiftright("__key", 31) * intervals, 32).cast("int"))
    # one long stands for the source, so the window and the join below share one shuffle of the rows
    rows = rows.withColumn("__sk", F.xxhash64("source", F.col("source").isNull()))
    per_part = rows.groupBy("source", "__sk", "__part").agg(F.sum("size").alias("__sum"))
    sizes = per_part.groupBy("source").agg(F.sum("__sum").alias("source_size"))
    before = W.partitionBy("__sk").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_part.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    targets = source_targets(sizes, weights=list(weights), share=share, cap=cap)
    plan = (offsets.join(targets, offsets["source"].eqNullSafe(targets["source"]))
            .select("__sk", "__part", "__before", "source_size", "target"))
    inside = (W.partitionBy("__sk", "__part").orderBy("__key", "__id", "size")
              .rowsBetween(W.unboundedPreceding, -1))
    r = rows.withColumn("__in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(plan, ["__sk", "__part"])
    goal = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    left = goal - epochs * F.col("source_size") - F.col("__before") - F.col("__in")
    taken = epochs * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), left))
    return r.select("__row.*", "size", "source_size", "target", taken.alias("taken"))


def mixed_rows(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself with the columns of ``docs``: a row per epoch that takes the
    document; the one document cut at its source's budget appears once more with
    the first words of its text that still fit."""
    text = kw.get("text", "text")
    packed = docs.withColumn("__all", F.struct(*docs.columns))
    m = mix_sources(packed, carry=["__all"], **kw)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(F.lit(0)).cast("int")
    m = m.select("__all", copies.alias("c"), rest.alias("r"))
    whole = m.filter("c > 0").select("__all", F.explode(F.array_repeat(F.lit(0), F.col("c"))).alias("r"))
    both = whole.unionByName(m.filter("r > 0").select("__all", "r"))
    kept = F.array_join(F.slice(F.split(F.ltrim(F.regexp_replace(f"__all.{text}", WORD_GAP, " ")), " "), 1,
                                F.greatest("r", F.lit(1))), " ")
    cut = F.when(F.col("r") > 0, kept).otherwise(F.col(f"__all.{text}"))
    return both.select(*[cut.alias(c) if c == text else F.col("__all")[c].alias(c) for c in docs.columns])
