"""Stupid-backoff language-model scores, computed relationally.

The units are characters. An n-gram of four characters is one long (16 bits a character), so
contexts and shorter suffixes are bit operations and every lower-order count table follows from the
table of the highest order by a sum. Tables are grouped by hash over the cluster; the
score of every distinct n-gram is a join of these tables; texts are exploded into their
distinct n-grams with counts, joined to the scores and summed per text.

``score_words`` scores words in the same way. Its tables grow with the corpus, so only n-grams that do not back
off are kept, each with what it gains over backing off; the rest of a score follows from the words alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import row_key
from panelkit.llm.textops import Hasher, U, mix, slices
from panelkit.session import cut_lineage

ORDER, BITS = 4, 16


def char_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, each after three zeros (its start), and where each text's run ends. Characters beyond
    the basic plane share the codes of the private-use range."""
    data = "".join("\0\0\0" + t for t in texts).encode("utf-32-le")
    cp = np.frombuffer(data, np.uint32)
    cp = np.where(cp > 0xFFFF, 0xE000 + cp % 0x1900, cp).astype(np.uint64)
    return cp, np.cumsum([len(t) + 3 for t in texts])


def text_grams(batch_col: pa.Array, size: int = 1 << 21):
    """Runs of texts: (first row, end row, n-gram of every character, end of each text in them)."""
    texts = [t or "" for t in batch_col.to_pylist()]
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + len(texts[j]) <= size):
            n += len(texts[j])
            j += 1
        cp, ends = char_codes(texts[i:j])
        g = np.zeros(len(cp), np.uint64)
        for k in range(ORDER):
            g[ORDER - 1:] |= cp[ORDER - 1 - k:len(cp) - k] << np.uint64(BITS * k)
        keep = np.ones(len(cp), bool)
        starts = np.concatenate([[0], ends[:-1]])
        for k in range(ORDER - 1):
            keep[starts + k] = False
        yield i, j, g[keep].view(np.int64), ends - (ORDER - 1) * np.arange(1, j - i + 1)
        i = j


def count_grams(docs: DataFrame, text: str) -> DataFrame:
    """(g, c): the count table of the highest order over all texts."""
    def run(batches):
        for batch in batches:
            for _, _, g, _ in text_grams(batch.column(0)):
                v, c = np.unique(g, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(c.astype(np.int64))], ["g", "c"])

    return docs.select(text).mapInArrow(run, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def suffix(g: Column, n: int) -> Column:
    return g.bitwiseAND(F.lit((1 << BITS * n) - 1))


def score_table(counts: DataFrame, backoff: float, min_count: int) -> DataFrame:
    """(g, logp): log of the stupid-backoff score of the last character of each distinct n-gram.

    A count below ``min_count`` (above order one) backs off: the score is ``backoff`` times that
    of the n-gram without its first character."""
    total = counts.agg(F.sum("c").alias("total"))
    tables = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = tables[n + 1].groupBy(suffix(F.col("g"), n).alias("g")).agg(F.sum("c").alias("c"))
    score = (tables[1].crossJoin(F.broadcast(total))  # one row
             .select("g", F.log(F.col("c") / F.col("total")).alias("logp")))
    for n in range(2, ORDER + 1):
        t = tables[n].withColumns({"ctx": F.shiftrightunsigned("g", BITS), "low": suffix(F.col("g"), n - 1)})
        ctx = t.groupBy("ctx").agg(F.sum("c").alias("of"))
        lower = score.select(F.col("g").alias("low"), F.col("logp").alias("less"))
        seen = F.when(F.col("c") >= min_count, F.log(F.col("c") / F.col("of")))
        score = (t.join(ctx, "ctx").join(lower, "low")
                 .select("g", F.coalesce(seen, F.col("less") + float(np.log(backoff))).alias("logp")))
    return score


def score_texts(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", backoff: float = 0.4,
                min_count: int = 2, broadcast_rows: int = 1_000_000) -> DataFrame:
    """One row per input row: ``id_col``, n_units (characters), log_score (sum of log scores) and
    mean_score (per character; null without characters).

    Counts come from all texts. Null and empty texts score 0 with no units. Repeated rows count and score
    as rows of their own. The score table goes to every task only when its counted rows stay within
    ``broadcast_rows`` (16 bytes each); else the exploded n-grams are shuffled to it by hash. Empty table: no rows.
    """
    rows = docs.select(row_key().alias("uid"), F.col(id_col).alias("id"), F.col(text).alias("text"))
    scores = cut_lineage(score_table(cut_lineage(count_grams(docs, text), "counts"), backoff, min_count), "scores")
    kind = dict(rows.dtypes)["id"]

    def run(batches):
        for batch in batches:
            for i, j, g, ends in text_grams(batch.column(2)):
                starts = np.concatenate([[0], ends[:-1]])
                own, gs, ns = [], [], []
                for k in range(j - i):
                    v, c = np.unique(g[starts[k]:ends[k]], return_counts=True)
                    if not len(v):  # a row without n-grams still gives a result
                        v, c = np.zeros(1, np.int64), np.zeros(1, np.int64)
                    own.append(np.full(len(v), k + i)), gs.append(v), ns.append(c)
                own = pa.array(np.concatenate(own))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), batch.column(1).take(own), pa.array(np.concatenate(gs)),
                     pa.array(np.concatenate(ns).astype(np.int32))], ["uid", "id", "g", "n"])

    grams = rows.mapInArrow(run, f"uid long, id {kind}, g long, n int")
    small = scores.count() <= broadcast_rows
    joined = grams.join(F.broadcast(scores) if small else scores, "g", "left")
    out = joined.groupBy("uid").agg(
        F.first("id").alias("id"), F.sum("n").alias("n_units"),
        F.sum(F.when(F.col("n") > 0, F.col("n") * F.col("logp")).otherwise(0.0)).alias("log_score"))
    return out.select(F.col("id").alias(id_col), "n_units", "log_score",
                      F.when(F.col("n_units") > 0, F.col("log_score") / F.col("n_units")).alias("mean_score"))


def word_lags(col: pa.Array, lags: list[int], hasher: Hasher) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray]]:
    """Runs of texts: (first row, end row, per lag the hash of the word that many places before each word, first word
    of each text in them and the end). Before a text's first word stands 0."""
    for i, j, data, off in slices(col):
        h, _, _, at = hasher.words(data, off)
        place = np.arange(len(h)) - np.repeat(at[:-1], np.diff(at))
        cols = []
        for lag in lags:
            w = np.zeros(len(h), U)
            w[lag:] = h[:len(h) - lag]
            w[place < lag] = 0
            cols.append(w)
        yield i, j, cols, at


def tuple_key(cols: list[np.ndarray]) -> np.ndarray:
    """One long for the words of an n-gram (its length is the table's)."""
    key = np.zeros(len(cols[0]), U)
    for w in cols:
        key = mix(key * U(0x9E3779B97F4A7C15) + w)
    return key


def count_words(rows: DataFrame, lags: list[int]) -> DataFrame:
    """(w<lag>..., c): how many words of all texts have these words at these lags, counted per run of texts first."""
    names = [f"w{k}" for k in lags]

    def run(batches):
        hasher = Hasher(False)
        for batch in batches:
            for _, _, cols, _ in word_lags(batch.column(0), lags, hasher):
                _, at, c = np.unique(tuple_key(cols), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(w[at].view(np.int64)) for w in cols),
                                                  pa.array(c.astype(np.int64))], [*names, "c"])

    schema = ", ".join(f"{x} long" for x in [*names, "c"])
    return rows.select("text").mapInArrow(run, schema).groupBy(*names).agg(F.sum("c").alias("c"))


def word_gains(rows: DataFrame, order: int, backoff: float, min_count: int, fits) -> list[DataFrame]:
    """Per order n a table (g, gain): of words the log score had all longer n-grams backed off, of longer n-grams
    that do not back off what they add to that."""
    less = float(np.log(backoff))
    seen = cut_lineage(count_words(rows, [0]), "words")
    total = seen.agg(F.sum("c").alias("total"))
    low = seen.crossJoin(F.broadcast(total)).select("w0", "c", F.log(F.col("c") / F.col("total")).alias("p"))  # one row
    out = [low.select("w0", (F.col("p") + (order - 1) * less).alias("gain"))]
    low = low.filter(F.col("c") >= min_count).select("w0", "p")
    for n in range(2, order + 1):
        words = [f"w{k}" for k in range(n - 1, -1, -1)]
        of = cut_lineage(count_words(rows, list(range(n - 1, 0, -1))).withColumnRenamed("c", "of"), "contexts")
        # an n-gram that does not back off has a shorter one that does not either
        t = (count_words(rows, list(range(n - 1, -1, -1))).filter(F.col("c") >= min_count)
             .join(fits(of), words[:-1]).join(fits(low), words[1:]))
        p = F.log(F.col("c") / F.col("of"))
        t = cut_lineage(t.select(*words, p.alias("p"), (p - F.col("p") - less).alias("gain")), "gains")
        out.append(t.select(*words, "gain"))
        low = t.select(*words, "p")
    return out


def score_words(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", order: int = 2, backoff: float = 0.4,
                min_count: int = 2, broadcast_rows: int = 1_000_000) -> DataFrame:
    """One row per input row as ``score_texts`` gives it, but the units are words (runs between the six ASCII
    white-space characters, case kept) and n-grams have ``order`` words.

    Counts come from all texts; n-grams are counted per run of texts, then summed by hash. Words are compared by 64-bit
    hashes. Null, empty and white texts score 0 with no units. Repeated rows count and score as rows of their own.
    A table goes to every task only when it stays within ``broadcast_rows``; else rows are shuffled to it by
    hash, each text's distinct n-grams with their counts. Empty table: no rows.
    """
    if order < 1 or min_count < 1:
        raise ValueError("order and min_count start at 1")
    rows = cut_lineage(docs.select(row_key().alias("uid"), F.col(id_col).alias("id"),
                                   F.coalesce(F.col(text), F.lit("")).alias("text")), "texts")

    def fits(t: DataFrame) -> DataFrame:
        return F.broadcast(t) if t.count() <= broadcast_rows else t

    def grams(n: int) -> DataFrame:
        lags, names = list(range(n - 1, -1, -1)), [f"w{k}" for k in range(n - 1, -1, -1)]

        def run(batches):
            hasher = Hasher(False)
            for batch in batches:
                for i, j, cols, at in word_lags(batch.column(1), lags, hasher):
                    own = np.repeat(np.arange(j - i), np.diff(at))
                    key = tuple_key(cols)
                    by = np.lexsort((key, own))
                    own, key = own[by], key[by]
                    new = np.ones(len(by), bool)
                    new[1:] = (own[1:] != own[:-1]) | (key[1:] != key[:-1])
                    at = np.flatnonzero(new)
                    c = np.diff(np.append(at, len(by))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(own[at] + i)), *(pa.array(w[by][at].view(np.int64)) for w in cols),
                         pa.array(c)], ["uid", *names, "n"])

        return rows.select("uid", "text").mapInArrow(run, ", ".join(f"{x} long" for x in ["uid", *names]) + ", n int")

    parts = []
    for n, t in enumerate(word_gains(rows, order, backoff, min_count, fits), 1):
        key = F.xxhash64(*[f"w{k}" for k in range(n - 1, -1, -1)]).alias("g")
        found = grams(n).select("uid", key, "n").join(fits(t.select(key, "gain")), "g")
        parts.append(found.groupBy("uid").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("gain")).alias("s"))
                     .select("uid", (F.col("n") if n == 1 else F.lit(0)).cast("long").alias("n"), "s"))
    scored = reduce(DataFrame.unionByName, parts).groupBy("uid").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out = rows.select("uid", "id").join(scored, "uid", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).alias("n_units"),
                      F.coalesce("s", F.lit(0.0)).alias("log_score"), (F.col("s") / F.col("n")).alias("mean_score"))
