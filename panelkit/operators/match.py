"""Fuzzy matching (MAT-1..3) and trade-text field extraction (TXT-1).

Candidate pairs come from an equi-join on a blocking key and length, so a token only meets
the reference entries of its own block that can still beat its first try; there is no cross product. The
similarity ratio is a bit-parallel fold in the JVM. Contains-matching streams names through automata of tokens.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence length of two texts (plain Python)."""
    row = [0] * (len(a) + 1)
    for y in b:
        before = 0
        for j, x in enumerate(a):
            kept = row[j + 1]
            row[j + 1] = before + 1 if x == y else max(kept, row[j])
            before = kept
    return row[-1]


def ratio(a: str | None, b: str | None) -> int | None:
    """MAT-1 of two texts, what ``similarity`` computes over columns."""
    if a is None or b is None:
        return None
    n = len(a) + len(b)
    return int(round(200.0 * lcs_length(a, b) / n)) if n else 100


#: Letters to a bigint of the row state; one bit more takes the carry.
WORD_BITS = 62


def _bits(n: Column) -> Column:
    """A bigint with the lowest n bits set."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int")) - 1


def lcs_column(a: Column, b: Column) -> Column:
    """Longest common subsequence length of two non-null texts, bit-parallel in the JVM.

    The row of the dynamic programme is a bit per letter of ``a``, ``WORD_BITS`` to a bigint; a letter of ``b`` updates
    all of them with one addition per bigint, whose carry goes on to the next. A zero bit is a step of the row."""
    letters = F.filter(F.split(a, ""), lambda c: c != "")
    words = F.greatest(F.ceil(F.length(a) / WORD_BITS).cast("int"), F.lit(1))
    index = F.sequence(F.lit(0), words - 1)
    full = F.lit((1 << WORD_BITS) - 1)

    def mask(of, c):
        """Places of letter c in the ``of``-th part of a."""
        part = F.slice(of["letters"], of["w"] * WORD_BITS + 1, WORD_BITS)
        return F.aggregate(F.transform(part, lambda x, i: F.when(x == c, F.call_function(
            "shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(x))

    # masks once per distinct letter of b that a holds: letter -> bigint per part
    masks = F.map_from_entries(F.transform(F.array_intersect(letters, F.split(b, "")), lambda c: F.struct(
        c, F.transform(index, lambda w: mask({"letters": letters, "w": w}, c)))))
    state = F.transform(index, lambda w: full)

    def step(row, m):
        def add(acc, x):
            u = x["v"].bitwiseAND(x["m"])
            total = x["v"] + u + acc["carry"]
            new = total.bitwiseAND(full).bitwiseOR(x["v"] - u)
            return F.struct(F.concat(acc["out"], F.array(new)).alias("out"), F.shiftright(total, WORD_BITS).alias("carry"))
        start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("long").alias("carry"))
        pairs = F.zip_with(row, m, lambda v, x: F.struct(v.alias("v"), x.alias("m")))
        return F.aggregate(pairs, start, add)["out"]

    rows = F.filter(F.transform(F.split(b, ""), lambda c: F.try_element_at(masks, c)), lambda m: m.isNotNull())
    last = F.aggregate(rows, state, step)
    # bits beyond the length of a never change, so zeros are counted over whole bigints
    return words * WORD_BITS - F.aggregate(F.transform(last, lambda v: F.bit_count(v)), F.lit(0), lambda n, x: n + x)


def similarity(a, b, lower: bool = True) -> Column:
    """MAT-1: 0..100 = round-half-even(200 * LCS / (len a + len b)); two empty texts are equal, null gives null."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    if lower:
        a, b = F.lower(a), F.lower(b)
    n = F.length(a) + F.length(b)
    return F.when(n == 0, F.lit(100)).when(a.isNotNull() & b.isNotNull(), F.bround(
        F.lit(200.0) * lcs_column(a, b) / n).cast("int"))


def levenshtein_score(a, b) -> Column:
    """0..100 score from the built-in edit distance (JVM-side); two empty texts are equal."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    longest = F.greatest(F.length(a), F.length(b))
    share = F.when(longest == 0, F.lit(0.0)).otherwise(F.try_divide(F.levenshtein(a, b), longest))
    return F.round(F.lit(100.0) * (F.lit(1.0) - share)).cast("int")


def _length_bound(la: Column, lb: Column, score: str) -> Column:
    """The best score two texts of these lengths can reach."""
    share = F.least(la, lb) / F.greatest(la, lb, F.lit(1)) if score == "levenshtein" else 2 * F.least(la, lb) / F.greatest(la + lb, F.lit(1))
    return F.round(F.lit(100.0) * share).cast("int")


def best_match(left: DataFrame, right: DataFrame, lkey: str, rkey: str, block: int = 3,
               score: str = "levenshtein") -> DataFrame:
    """MAT-2: per distinct left token, the best-scoring right entry among those sharing the
    first ``block`` letters (case-insensitive); ties go to the smallest right
    entry. Keeping the best is an aggregate (min_by), not a per-group sort.

    Tokens of blocks without entries leave before anything is shuffled. A token's first try is one entry of the nearest length;
    its score bounds the lengths that can still win, and only entries of these lengths are joined and scored."""
    token = left.select(F.col(lkey).alias("token"), F.substring(F.lower(lkey), 1, block).alias("__blk"))
    rb = right.select(F.col(rkey).alias("candidate"), F.substring(F.lower(rkey), 1, block).alias("__blk"),
                      F.length(F.lower(rkey)).alias("__len")).distinct()
    lengths = rb.groupBy("__blk", "__len").agg(F.min("candidate").alias("__first"))
    token = token.join(lengths.select("__blk").distinct(), "__blk", "left_semi").distinct()

    def scored(of: DataFrame, candidate: str) -> Column:
        a, b = F.lower("token"), F.lower(candidate)
        return levenshtein_score(a, b) if score == "levenshtein" else similarity(a, b, lower=False)

    own = F.length(F.lower("token"))
    tries = token.join(lengths, "__blk")
    near = tries.groupBy("token", "__blk").agg(
        F.min_by("__first", F.struct(F.abs(F.col("__len") - own), F.col("__len"))).alias("__try"),
        F.collect_list("__len").alias("__lens"))  # one entry a length of the block's entries
    near = near.withColumn("__least", scored(near, "__try"))
    able = F.filter("__lens", lambda n: _length_bound(own, n, score) >= F.col("__least"))
    pairs = near.select("token", "__blk", F.explode(able).alias("__len")).join(rb, ["__blk", "__len"])
    pairs = pairs.withColumn("score", scored(pairs, "candidate"))
    best = pairs.groupBy("token").agg(
        F.min_by(F.struct("candidate", "score"), F.struct((-F.col("score")).alias("s"), F.col("candidate"))).alias("b"))
    return best.select("token", F.col("b.candidate").alias("best_match"), F.col("b.score").alias("score"),
                       F.concat(F.col("b.score").cast("string"), F.lit("%")).alias("score_text"))


def contains_match(tokens: DataFrame, names: DataFrame, tkey: str, nkey: str, keep: list[str],
                   shard: int = 100_000, stream: int = 1_000_000) -> DataFrame:
    """MAT-3: (token, ``keep``) pairs where the name contains the token, case-insensitive.

    Distinct tokens are dealt by hash to automata of about ``shard`` tokens (Aho-Corasick), and the distinct names pass each
    automaton in streams of about ``stream``; a name is read once per automaton, however many tokens it
    holds and however short they are. Names that share ``keep`` are matched each; the empty token and null match nothing."""
    from panelkit.operators.shards import n_parts
    t = tokens.select(F.lower(F.col(tkey)).alias("token")).filter(F.length("token") > 0).distinct()
    own = names.select(*keep, F.lower(F.col(nkey)).alias("__name")).filter("__name is not null")
    distinct = own.select("__name").distinct()
    automata, streams = n_parts(t, shard), n_parts(distinct, stream)

    def dealt(df: DataFrame, col: str, n: int, name: str) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64(col), F.lit(n)).cast("int"))

    def every(df: DataFrame, n: int, name: str) -> DataFrame:
        return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    a = every(dealt(t, "token", automata, "__a"), streams, "__s")
    b = every(dealt(distinct, "__name", streams, "__s"), automata, "__a")

    def search(words: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        import ahocorasick
        found_name, found = [], []
        if len(words) and len(texts):
            automaton = ahocorasick.Automaton()
            for w in words["token"]:
                automaton.add_word(w, w)
            automaton.make_automaton()
            for name in texts["__name"]:
                hits = {w for _, w in automaton.iter(name)}
                found.extend(hits)
                found_name.extend([name] * len(hits))
        return pd.DataFrame({"__name": pd.Series(found_name, dtype=object), "token": pd.Series(found, dtype=object)})

    hits = a.groupBy("__a", "__s").cogroup(b.groupBy("__a", "__s")).applyInPandas(search, "__name string, token string")
    return hits.join(own, "__name").select("token", *keep)


# Fractions that count as rates, and what names a currency.
FRACTIONS = ["½", "⅓", "¼", "⅕", "⅙", "⅐", "⅛", "⅑", "⅔", "⅖", "²⁄₇", "²⁄₉"]
CURRENCY_MARKS = {"dollar": ["$", "usd"], "euro": ["€", "eur"], "yen": ["¥", "yen"]}


def _currency(t: Column) -> Column:
    """The first currency of the table one of whose marks the token holds."""
    out = F.lit(None).cast("string")
    for name, marks in reversed(CURRENCY_MARKS.items()):
        out = F.when(reduce(lambda a, b: a | b, [t.contains(m) for m in marks]), F.lit(name)).otherwise(out)
    return out


#: A token that starts with month/day/year, two digits each.
DATE_TOKEN = "^(0[1-9]|1[0-2])/(0[1-9]|[12][0-9]|3[01])/[0-9]{2}"


def _date(t: Column) -> Column:
    """The date of this century that a date token starts with; NULL when the month has no such day."""
    return F.try_to_date(F.concat(F.lit("20"), F.substring(t, 7, 2), F.lit("-"), F.substring(t, 1, 2), F.lit("-"),
                                  F.substring(t, 4, 2)), "yyyy-MM-dd")


def _is_rate(t: Column) -> Column:
    """Digits with at most one point and one percent sign, or a listed fraction."""
    count = lambda c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
    digits = F.translate(t, ".%", "")
    return (digits.rlike("^[0-9]+$") & (count(".") <= 1) & (count("%") <= 1)) | t.isin(*FRACTIONS)


def extract_trade_fields(df: DataFrame, text: str) -> DataFrame:
    """TXT-1: split on single spaces; currency of the first token naming one; the
    first month/day/year token as a date (20yy); rate and fraction tokens joined by
    spaces. Works on the token array with higher-order functions, no explode."""
    toks = F.split(F.col(text), " ")
    cur = F.get(F.filter(F.transform(toks, _currency), lambda x: x.isNotNull()), 0)
    dated = F.filter(F.filter(toks, lambda t: t.contains("/")), lambda t: t.rlike(DATE_TOKEN))
    date = F.get(F.transform(F.slice(dated, 1, 1), _date), 0)  # one expression, so the tokens are looked at once
    rates = F.array_join(F.filter(toks, _is_rate), " ")
    return df.withColumns({"currency": cur, "trade_date": date, "rates": rates})
