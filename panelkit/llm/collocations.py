"""Phrase collocations from the counts of longest windows only.

Every word opens one window of ``longest`` words: its lead columns, padded with null at the end of its piece. Equal
windows are counted once, and one Spark ROLLUP over (lang, w1, .., wn) sums them to every shorter prefix, so the
counts of all phrase lengths, of single words and of the language come out of one grouping instead of an
explosion per length.

A window is also padded from the first word on with which its start cannot reach the least count. Starts are counted by
hash into a fixed number of counters beforehand, those of two words first, then the longer ones that hold no rare
pair; a start in a counter below the least count is too rare itself. A phrase with the least count has only starts with
it, so no such phrase loses a window; when a corpus fills the counters, more windows stay longer and the result is
the same.

Scores are integers: floor(1000 * a * n / (l * r)) in decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.llm.codes import LOWER, byte_class, encode, word_bounds
from panelkit.llm.common import tidy
from panelkit.llm.textops import Hasher, U, mix, slices
from panelkit.session import cut_lineage

#: Fixed values of the contract: what ends a piece, and what stands between the words of one.
BREAKS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"
#: Bytes of texts a task codes at a time.
SLICE = 1 << 20


class Pieces:
    """Cuts texts into coded words; one a task."""

    def __init__(self):
        self.breaks = byte_class(BREAKS)
        self.gaps = self.breaks | byte_class(BLANKS)
        self.hasher = Hasher(lower=False)

    def words(self, data: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words, per word its code, its text, and whether the next word follows in the same piece."""
        data = LOWER[data]
        gap = self.gaps[data]
        starts, ends = word_bounds(gap, off)
        words, code = encode(data, gap, starts, ends)
        text = np.searchsorted(off, starts, "right") - 1
        piece = np.cumsum(self.breaks[data])[starts] if len(starts) else starts
        on = np.zeros(len(starts), bool)
        on[:-1] = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
        return words, code, text, on

    def hashes(self, words: pa.Array) -> np.ndarray:
        """64 bits a distinct word."""
        if not len(words):
            return np.zeros(0, U)
        off = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)[off[0]:off[-1]]
        off = off - off[0]
        sums = np.zeros(len(data) + 1, U)
        np.cumsum(self.hasher.value[data] * self.hasher.power(0x9E3779B97F4A7C15, len(data)), out=sums[1:])
        back = self.hasher.power(pow(0x9E3779B97F4A7C15, -1, 1 << 64), len(data) + 1)
        return mix((sums[off[1:]] - sums[off[:-1]]) * back[off[:-1]] + np.diff(off).astype(U))


def lang_hashes(langs: pa.Array, pieces: Pieces) -> np.ndarray:
    """64 bits per row for its language."""
    coded = langs.dictionary_encode()
    own = pieces.hashes(coded.dictionary.cast(pa.large_utf8()))
    return own[coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)]


def starts(own: np.ndarray, lang: np.ndarray, on: np.ndarray, longest: int, bits: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For k = 2 .. ``longest``: (k, places, hashes) of the starts of k words that stay in their piece and, as far as ``bits``
    are known (for two words, for more words), are frequent enough by them; each is the one before and a word."""
    at, h = np.arange(len(own)), mix(own ^ lang)
    pairs = None
    for k in range(2, longest + 1):
        go = on[np.minimum(at + k - 2, len(on) - 1)] if len(on) else on
        if pairs is not None:  # the last two words of the longer start
            go = go & pairs[np.minimum(at + k - 2, len(on) - 1)]
        at, h = at[go], h[go]
        h = mix(h * U(0xD6E8FEB86659FD93) + own[at + k - 1])
        if len(bits) > (k > 2):
            ok = is_marked(bits[k > 2], h)
            if k == 2:
                pairs = np.zeros(len(own), bool)
                pairs[at[ok]] = True
            at, h = at[ok], h[ok]
        yield k, at, h


def marks(h: np.ndarray, counters: int) -> np.ndarray:
    return (h & U(counters - 1)).astype(np.int32)


def is_marked(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    m = marks(h, 32 * len(bits))
    return (bits[m >> 5] >> (m & 31).astype(np.uint32)) & np.uint32(1) == 1


def frequent_starts(docs: DataFrame, least: int, counters: int, longest: int, bits: list[np.ndarray], unit: int = 1 << 21) -> np.ndarray:
    """One bit per counter: whether the starts of two words (with no ``bits`` yet), or those of three to ``longest`` words, that it
    stands for together reach ``least``. Counters are summed by Spark; ``counters / 8`` bytes reach the driver at
    most, whatever the corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        pieces, known, held, n = Pieces(), shared.value, [], 0

        def flush():
            mark, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(mark), pa.array(times)], ["mark", "n"])

        for batch in batches:
            langs = lang_hashes(batch.column(0), pieces)
            for i, _, data, off in slices(batch.column(1), SLICE):
                words, code, text, on = pieces.words(data, off)
                for k, _, h in starts(pieces.hashes(words)[code], langs[i + text], on, longest if known else 2, known):
                    if k > 2 or not known:
                        held.append(marks(h, counters))
                        n += len(h)
                if n >= unit:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("mark") % 32))
    found = (docs.mapInArrow(tidy(run), "mark int, n long").groupBy("mark").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= least)
             .groupBy(F.shiftright("mark", 5).alias("place")).agg(F.bit_or(one).alias("bits")).toArrow())
    shared.unpersist()
    out = np.zeros(max(1, counters // 32), np.uint32)
    out[found["place"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out


def longest_windows(docs: DataFrame, longest: int, bits: list[np.ndarray]) -> DataFrame:
    """(lang, w1, .., wn, c): the distinct windows of a slice of texts, padded with null, and how often they come."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    names = [f"w{k}" for k in range(1, longest + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = Pieces(), shared.value
        for batch in batches:
            by = batch.column(0).dictionary_encode()
            lang, langs = by.indices.to_numpy(zero_copy_only=False).astype(np.int64), lang_hashes(batch.column(0), pieces)
            for i, _, data, off in slices(batch.column(1), SLICE):
                words, code, text, on = pieces.words(data, off)
                if not len(code):
                    continue
                # lead columns: the code k words on where the window goes on so far, else null (-1)
                lead = np.full((longest + 1, len(code)), -1, np.int64)
                lead[0], lead[1] = lang[i + text], code
                for k, at, _ in starts(pieces.hashes(words)[code], langs[i + text], on, longest, known):
                    lead[k, at] = code[at + k - 1]
                # a window is the number of its lead and of the window it prolongs, so equal windows get equal numbers
                number = np.zeros(len(code), np.int64)
                for k in range(longest + 1):
                    number = np.unique(number * (len(words) + len(by.dictionary) + 1) + lead[k] + 1, return_inverse=True)[1]
                _, first, times = np.unique(number, return_index=True, return_counts=True)
                for s in range(0, len(first), 50_000):
                    part = lead[:, first[s:s + 50_000]]
                    cols = [by.dictionary.take(pa.array(part[0])).cast(pa.string())]
                    cols += [words.take(pa.array(c, mask=c < 0)).cast(pa.string()) for c in part[1:]]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(times[s:s + 50_000])], ["lang", *names, "c"])

    schema = ", ".join(["lang string", *(f"{w} string" for w in names), "c long"])
    return docs.mapInArrow(tidy(run), schema)


def phrase_counts(docs: DataFrame, longest: int, least: int, counters: int) -> DataFrame:
    """(lang, words, f): phrases of 1 to ``longest`` words that come ``least`` times, and per language its words
    altogether (no words: an empty array)."""
    names = [f"w{k}" for k in range(1, longest + 1)]
    bits: list[np.ndarray] = []
    for _ in range(min(2, longest - 1)):
        bits.append(frequent_starts(docs, least, counters, longest, bits))
    windows = longest_windows(docs, longest, bits).groupBy("lang", *names).agg(F.sum("c").alias("c"))
    rolled = windows.rollup("lang", *names).agg(F.sum("c").alias("f"), F.grouping_id().alias("g"))
    # the grouping id has a bit for each column summed away, the last ones first; a length is their complement
    rolled = rolled.filter(F.col("g") < (1 << longest)).withColumn("k", longest - F.bit_count("g"))
    # a prefix that ends in padding repeats the shorter one
    last = F.array(*names)[F.col("k") - 1]
    whole = F.when(F.col("k") > 0, (F.col("f") >= least) & last.isNotNull()).otherwise(F.lit(True))
    return rolled.filter(whole).select("lang", F.slice(F.array(*names), 1, F.col("k")).alias("words"), "f")


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = 5, least: int = 100,
                 covered_percent: int = 100, top: int = 2000, counters: int = 1 << 27) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's phrases of 2 to ``longest`` words by score.

    Texts (A-Z lower-cased) are split into pieces at ``BREAKS`` and into words at ``BLANKS``; null text is empty, null
    lang is ``und``. a counts all places of the phrase, overlapping ones too. A phrase is cut after its first k
    words into parts that come l and r times; the cut with the lowest floor(1000 a n / (l r)) counts, the
    smallest k in ties. A phrase goes when a longer one that holds it comes at least ``covered_percent`` % as often.
    Ranks: score, then a descending, then the phrase in byte order, to ``top`` a language. Repeated rows count each;
    other columns are not looked at. Empty table: no rows.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    counted = cut_lineage(phrase_counts(rows, longest, least, counters), "phrases")
    # one row a language, copied per salt: most phrases may be of one language
    totals = counted.filter(F.size("words") == 0).select(
        "lang", F.col("f").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(63))).alias("salt"))
    phrases = counted.filter(F.size("words") > 0)
    long = phrases.filter(F.size("words") > 1).select("lang", "words", F.col("f").alias("a"))

    cuts = long.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumn("head", F.slice("words", 1, F.col("k"))).withColumn(
        "tail", F.slice("words", F.col("k") + 1, F.lit(longest)))
    heads = phrases.select("lang", F.col("words").alias("head"), F.col("f").alias("l"))
    tails = phrases.select("lang", F.col("words").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    cuts = cuts.withColumn("salt", F.pmod(F.hash("words"), F.lit(64))).join(totals, ["lang", "salt"])
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0)))"
                   " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = F.min_by(F.struct("l", "r", "n", "score"), F.struct("score", "k")).alias("best")
    scored = cuts.withColumn("score", score).groupBy("lang", "words", "a").agg(best).select("lang", "words", "a", "best.*")

    inner = long.select("lang", F.col("a").alias("outer"), F.size("words").alias("size"), "words").select(
        "lang", "outer", "size", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k")
    ).where("size > 2").select("lang", "outer", "k", "words", F.explode(
        F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)).alias("at")).select(
        "lang", "outer", F.slice("words", F.col("at"), F.col("k")).alias("words"))
    most = inner.groupBy("lang", "words").agg(F.max("outer").alias("outer"))
    stay = scored.join(most, ["lang", "words"], "left").filter(
        F.coalesce(F.col("outer") * 100 < F.col("a") * covered_percent, F.lit(True)))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (stay.withColumn("phrase", F.array_join("words", " ")).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
