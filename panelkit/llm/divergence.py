"""Source divergence audit: how far the term prices of sources differ, pair by pair.

Terms are counted by task, then by (lang, source, term). Each language keeps the terms that enough of its documents
hold and numbers them inside blocks of bounded size, so every source of the language is a list of short sorted
arrays of (term id, count), one a block. A pair task holds the arrays of two sources of one block: the ids of the
shorter array are sought in the longer one by galloping, which prices the overlap; the ids of one side and the
ids of neither follow without being looked at one by one. Both directions come out of one visit, and the sums over
blocks are the values. No task holds more of a source than a block, whatever its number of terms.

Prices and values are integers: price = 1 + floor(scale * (count + 1) / (N + V)), value = floor((p - q)^2 / q).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.llm.common import tidy
from panelkit.llm.codes import LOWER, encode, word_bounds
from panelkit.llm.textops import slices
from panelkit.session import cut_lineage

#: Fixed value: a price of 1 in the integers of the contract.
SCALE = 1_000_000_000


def not_a_term() -> np.ndarray:
    """Bytes outside terms: ASCII but the letters."""
    gap = np.ones(256, bool)
    gap[65:91] = gap[97:123] = gap[128:] = False
    return gap


def count_terms(docs: DataFrame, unit: int = 1 << 18) -> DataFrame:
    """(lang, source, term, n, docs) of rows (lang, source, text), summed within units of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps, held, n = not_a_term(), [], 0
        groups: dict[tuple[str, str], int] = {}

        def flush():
            t = pa.concat_tables(held).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
            lang, source = (pa.array(x, pa.string()) for x in zip(*groups))
            for part in t.to_batches(max_chunksize=50_000):
                own = part.column("group")
                yield pa.RecordBatch.from_arrays(
                    [lang.take(own), source.take(own), *(part.column(c) for c in ("term", "n_sum", "docs_sum"))],
                    ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for i, j, data, off in slices(batch.column(2)):
                gap = gaps[data]
                starts, ends = word_bounds(gap, off)
                if not len(starts):
                    continue
                words, code = encode(LOWER[data], gap, starts, ends)
                group = np.array([groups.setdefault(x, len(groups)) for x in names[i:j]])
                doc = np.searchsorted(off, starts, "right") - 1
                pair, times = np.unique(doc * len(words) + code, return_counts=True)  # one entry a document and term
                doc, code = pair // len(words), pair % len(words)
                key, place = np.unique(group[doc] * len(words) + code, return_inverse=True)
                total = np.zeros(len(key), np.int64)
                np.add.at(total, place, times)
                held.append(pa.table([pa.array((key // len(words)).astype(np.int32)),
                                      words.take(pa.array(key % len(words))).cast(pa.string()), pa.array(total),
                                      pa.array(np.bincount(place))], ["group", "term", "n", "docs"]))
                n += len(key)
                if n >= unit:
                    yield from flush()
                    held, n = [], 0
                    groups.clear()
        if held:
            yield from flush()

    return docs.select("lang", "source", "text").mapInArrow(
        tidy(run), "lang string, source string, term string, n long, docs long")


def price_sql(count: str, total: str, kept: str) -> Column:
    """The price of a count, exact beyond 64 bits."""
    return F.expr(f"1 + ((cast({count} as decimal(19,0)) + 1) * {SCALE}) div ({total} + {kept})")


def value_sql(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def price(count, total, kept):
    """The price of counts: long division by thousands, as a product may pass 64 bits."""
    base = total + kept
    whole, rest = (count + 1) // base, (count + 1) % base
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // base, rest % base
    return whole + 1


def value(p, q):
    return (p - q) * (p - q) // q


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in short, in long) of the ids that both sorted arrays hold. All ids of ``short`` gallop at once:
    from a lower bound the step doubles until it passes the id, then a binary search ends inside that step."""
    if not len(short) or not len(long):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(long)
    # an id stands at least as far in as its place among the ids of its own array that are not missing there; from the
    # left end of an even spread the steps stay short
    low = np.minimum(np.arange(len(short)) * (n // len(short)), n - 1)
    low[long[low] > short] = 0
    step, high = np.ones(len(short), np.int64), low.copy()
    go = np.flatnonzero(long[high] < short)
    while len(go):
        low[go] = high[go]
        high[go] = np.minimum(high[go] + step[go], n)
        step[go] *= 2
        go = go[high[go] < n]
        go = go[long[high[go]] < short[go]]
    while True:  # long[low] <= id, and nothing from high on is smaller
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        mid = (low[open_] + high[open_]) // 2
        less = long[mid] < short[open_]
        low[open_[less]] = mid[less] + 1
        high[open_[~less]] = mid[~less]
    at = np.flatnonzero(low < n)
    at = at[long[low[at]] == short[at]]
    return at, low[at]


def pair_values(tasks: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per pair task the sums over its block: the shorter array priced against the longer one, and back. ``tasks`` holds
    the arrays of all tasks end to end, their ids raised by a block a task, so one galloping run serves them all."""
    k = len(tasks["size"])
    (short, s_n, s_task), (long, l_n, l_task) = ((tasks[f"{x}_id"], tasks[f"{x}_n"], tasks[f"{x}_task"]) for x in "sl")
    s_total, l_total, v = tasks["s_total"], tasks["l_total"], tasks["v"]
    p, q = price(s_n, s_total[s_task], v[s_task]), price(l_n, l_total[l_task], v[l_task])
    none = np.zeros(k, np.int64)
    p0, q0 = price(none, s_total, v), price(none, l_total, v)
    i, j = gallop(short, long)
    only_s, only_l = np.ones(len(short), bool), np.ones(len(long), bool)
    only_s[i] = only_l[j] = False
    a, b = s_task[only_s], l_task[only_l]
    absent = tasks["size"] - np.bincount(s_task, minlength=k) - np.bincount(b, minlength=k)
    forth, back = absent * value(p0, q0), absent * value(q0, p0)
    for at, x, y in ((s_task[i], p[i], q[j]), (a, p[only_s], q0[a]), (b, p0[b], q[only_l])):
        np.add.at(forth, at, value(x, y))
        np.add.at(back, at, value(y, x))
    return forth, back


def price_pairs(pairs: DataFrame, block: int) -> DataFrame:
    """(lang, a, b, forth, back) of one block each."""
    step = max(1, (1 << 16) // block)  # pair tasks worked on at once

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                yield priced(batch.slice(at, step))

    def priced(batch):
        get = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
        tasks = {c: get[c].to_numpy().astype(np.int64) for c in ("s_total", "l_total", "size", "v")}
        for side in "sl":
            ids, n = get[f"{side}_ids"], get[f"{side}_ns"]
            task = np.repeat(np.arange(batch.num_rows), ids.value_lengths().to_numpy(zero_copy_only=False))
            tasks[f"{side}_id"] = ids.flatten().to_numpy().astype(np.int64) + task * (2 * block)
            tasks[f"{side}_n"], tasks[f"{side}_task"] = n.flatten().to_numpy().astype(np.int64), task
        x, y = pair_values(tasks)
        flip = get["flip"].to_numpy(zero_copy_only=False)
        return pa.RecordBatch.from_arrays(
            [get["lang"], get["a"], get["b"], pa.array(np.where(flip, y, x)), pa.array(np.where(flip, x, y))],
            ["lang", "a", "b", "forth", "back"])

    flip = F.size("a_ids") > F.size("b_ids")

    def side(name: str, first: str, second: str, column: str):
        return F.when(flip, F.col(second + column)).otherwise(F.col(first + column)).alias(name)

    ordered = pairs.select("lang", "a", "b", "size", "v", flip.alias("flip"), *(
        side(f"{s}_{to}", x, y, f"_{c}") for s, x, y in (("s", "a", "b"), ("l", "b", "a"))
        for to, c in (("ids", "ids"), ("ns", "n"), ("total", "total"))))
    return ordered.mapInArrow(tidy(run), "lang string, a string, b string, forth long, back long")


def source_divergence(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
                      least_docs: int = 3, top_terms: int = 200, block: int = 64) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` holds the divergence of a source from each other source
    of its language, all ranks; part ``term`` the terms that a source uses more than its language does, by value, to
    rank ``top_terms``.

    Null lang, source and text are ''. A term is a run of ASCII letters (lower-cased) and characters beyond ASCII;
    each language keeps those that at least ``least_docs`` of its rows hold (repeated rows count each). A group
    without kept terms takes part in pairs with its smoothed price; a language with one source has no pair rows, and
    one without kept terms has pair values of 0. Ties go by item in byte order. Other columns are not looked
    at. Empty table: no rows.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                         for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))
    groups = rows.select("lang", "source").distinct()
    # one exchange by (lang, term) serves the counts of the groups and those of the language
    counted = (count_terms(rows).repartition("lang", "term").groupBy("lang", "term", "source")
               .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    terms = (counted.groupBy("lang", "term")
             .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"),
                  F.collect_list(F.struct("source", "n")).alias("held"))  # one entry a source
             .filter(F.col("docs") >= least_docs))
    terms = cut_lineage(terms.drop("docs"), "terms")
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_total"))
    held = terms.select("lang", "term", "total", F.explode("held").alias("h")).select("lang", "term", "total", "h.*")
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    info = groups.join(langs, "lang", "left").join(sums, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
        F.coalesce("own", F.lit(0)).alias("own"))
    info = cut_lineage(info, "groups")  # one row a (lang, source)

    found = pair_part(terms, held, info, block).union(term_part(held, info, top_terms))
    return found.select("lang", "source", "part", "item", "value", "rank")


def term_part(held: DataFrame, info: DataFrame, top: int) -> DataFrame:
    best = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    priced = (held.join(info, ["lang", "source"])
              .withColumn("p", price_sql("n", "own", "v")).withColumn("q", price_sql("total", "lang_total", "v"))
              .filter("p > q"))
    return (priced.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                          value_sql("p", "q").alias("value"))
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top))


def pair_part(terms: DataFrame, held: DataFrame, info: DataFrame, block: int) -> DataFrame:
    blocks = info.select("lang", "v").distinct().withColumn("blocks", F.ceil(F.col("v") / block).cast("long"))
    numbered = (terms.join(blocks, "lang")
                .withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
                .withColumn("id", F.row_number().over(W.partitionBy("lang", "block").orderBy("term")))
                .select("lang", "block", "id", "held"))
    numbered = cut_lineage(numbered, "numbered")
    sizes = numbered.groupBy("lang", "block").agg(F.count("*").alias("size"))
    arrays = (numbered.select("lang", "block", "id", F.explode("held").alias("h"))
              .groupBy("lang", "block", F.col("h.source").alias("source"))
              .agg(F.array_sort(F.collect_list(F.struct("id", F.col("h.n").alias("n")))).alias("x")))
    empty = F.array().cast("array<struct<id:int,n:bigint>>")
    # a source without terms in a block still pairs there with its smoothed price
    grid = (sizes.join(info, "lang").join(arrays, ["lang", "block", "source"], "left")
            .select("lang", "block", "source", "size", "v", "own", F.coalesce("x", empty).alias("x")))
    widest = sizes.agg(F.max("size")).first()[0] or 1
    grid = cut_lineage(grid.select("lang", "block", "source", "size", "v", "own", F.col("x.id").alias("ids"),
                                   F.col("x.n").alias("n")), "arrays")
    a = grid.select("lang", "block", "size", "v", F.col("source").alias("a"), F.col("own").alias("a_total"),
                    F.col("ids").alias("a_ids"), F.col("n").alias("a_n"))
    b = grid.select("lang", "block", F.col("source").alias("b"), F.col("own").alias("b_total"),
                    F.col("ids").alias("b_ids"), F.col("n").alias("b_n"))
    both = a.join(b, ["lang", "block"]).filter("a < b")
    sums = price_pairs(both, widest).groupBy("lang", "a", "b").agg(F.sum("forth").alias("forth"), F.sum("back").alias("back"))
    # languages without kept terms have no block: their pairs come from the groups and are worth 0
    names = info.select("lang", F.col("source").alias("a")).join(
        info.select("lang", F.col("source").alias("b")), "lang").filter("a < b")
    sums = names.join(sums, ["lang", "a", "b"], "left").na.fill(0, ["forth", "back"])
    ways = sums.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("forth").alias("value")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("back").alias("value")))).alias("w"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return ways.select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "w.value").withColumn(
        "rank", F.row_number().over(order))
