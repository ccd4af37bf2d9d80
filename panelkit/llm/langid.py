"""Language identification by cross-parsing entropy.

Per language a suffix automaton of a bounded labelled sample accepts every substring of the
sample. A text is parsed into phrases: from each point the longest match in the
automaton, then the next phrase. The language whose automaton needs the fewest phrases per
character explains the text best (the phrase rate estimates the cross entropy) and wins.

Every letter of the samples is a symbol of its own. Automata are dense transition tables over the most
frequent symbols and sorted transitions over the others, so all pieces of a batch of texts step through
all automata together, one character at a time, in numpy.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.llm.common import small_batches, tidy

UNDETERMINED = "und"
GAP, OTHER = 0, 1
NONE = 0xFFFF
#: Symbols with a column in the dense tables; it bounds memory only, no result depends on it.
DENSE = 64


def held_out(id_col) -> "F.Column":
    """A quarter of the rows never teaches: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fold(c: str) -> str:
    """Lower case where that is one character."""
    low = c.lower()
    return low if len(low) == 1 else c


class Alphabet:
    """Code points to symbols: 0 everything that is no letter, 1 letters not in the samples, then the samples' letters (lower
    case), frequent ones first."""

    def __init__(self, samples: list[str]):
        seen = Counter(map(fold, "".join(samples)))
        letters = sorted((c for c in seen if c.isalpha()), key=lambda c: (-seen[c], c))
        code = {c: k + 2 for k, c in enumerate(letters)}
        self.size = len(letters) + 2
        self.table = np.zeros(0x110000, np.min_scalar_type(self.size))
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                self.table[cp] = code.get(fold(c), OTHER)


def encode(table: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, runs of gaps as one and none at a start, and the end of each text."""
    sym = table[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
    ends = np.cumsum([len(t) for t in texts])
    prev = np.concatenate([[GAP], sym]).astype(sym.dtype)[:len(sym)]
    starts = np.concatenate([[0], ends[:-1]])
    prev[starts[starts < len(sym)]] = GAP
    keep = (sym != GAP) | (prev != GAP)
    total = np.concatenate([[0], np.cumsum(keep)])
    return sym[keep], total[ends]


class Automaton:
    """Transitions (state, symbol) -> state, ``NONE`` where no substring goes on; state 0 is the start. ``table`` has the
    first ``DENSE`` symbols, ``keys`` (state * symbols + symbol, sorted) and ``goes`` the others."""

    def __init__(self, edges: list[dict[int, int]], symbols: int):
        self.symbols, width = symbols, min(symbols, DENSE)
        self.table = np.full((len(edges), width), NONE, np.uint16)
        rest = []
        for s, out in enumerate(edges):
            for c, to in out.items():
                if c < width:
                    self.table[s, c] = to
                else:
                    rest.append((s * symbols + c, to))
        rest.sort()
        self.keys = np.array([k for k, _ in rest], np.int64)
        self.goes = np.array([to for _, to in rest], np.uint16)

    def __getitem__(self, at: tuple[int, int]) -> int:
        s, c = at
        if c < self.table.shape[1]:
            return int(self.table[s, c])
        k = np.searchsorted(self.keys, s * self.symbols + c)
        return int(self.goes[k]) if k < len(self.keys) and self.keys[k] == s * self.symbols + c else NONE


def suffix_automaton(seq: list[int], symbols: int) -> Automaton:
    """The automaton of all substrings of ``seq``."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in seq:
        cur = len(nxt)
        nxt.append({}), link.append(0), length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q])), link.append(link[q]), length.append(length[p] + 1)
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return Automaton(nxt, symbols)


class CrossParser:
    """Phrase counts of many texts under all automata."""

    def __init__(self, tables: list[Automaton], piece: int):
        self.symbols, self.width, self.piece = tables[0].symbols, tables[0].table.shape[1], piece
        self.flat = np.concatenate([t.table.ravel() for t in tables])
        self.base = np.cumsum([0] + [t.table.size for t in tables[:-1]])
        # sorted transitions of all automata one after the other; a language has at most NONE states
        self.keys = np.concatenate([k * NONE * self.symbols + t.keys for k, t in enumerate(tables)])
        self.goes = np.concatenate([t.goes for t in tables])
        root = np.full((len(tables), self.symbols), NONE, np.uint16)
        for k, t in enumerate(tables):
            root[k, :self.width] = t.table[0]
            n = np.searchsorted(t.keys, self.symbols)
            root[k, t.keys[:n]] = t.goes[:n]
        self.unseen = root == NONE
        self.root = np.where(self.unseen, 0, root).astype(np.int64)

    def sparse(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """(languages, symbols of ``c``): the next states by symbols beyond the dense tables."""
        to = np.full(state.shape, NONE, np.int64)
        lang, at = np.nonzero(~self.unseen[:, c])  # a language without the letter has no transition by it
        key = (lang * NONE + state[lang, at]) * self.symbols + c[at]
        k = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        if len(key):
            to[lang, at] = np.where(self.keys[k] == key, self.goes[k], NONE)
        return to

    def phrases(self, sym: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(texts, languages): phrases needed. Texts are parsed in pieces of fixed length, each from the start state."""
        starts = np.concatenate([[0], ends[:-1]])
        per = -(-(ends - starts) // self.piece)
        text = np.repeat(np.arange(len(ends)), per)
        k = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
        first = starts[text] + k * self.piece
        size = np.minimum(ends[text] - first, self.piece)
        order = np.argsort(-size, kind="stable")
        first, size, text = first[order], size[order], text[order]
        langs = len(self.base)
        state = np.zeros((langs, len(first)), np.int64)
        count = np.ones((langs, len(first)), np.int64)
        active = np.searchsorted(-size, -np.arange(self.piece), "left")  # pieces longer than t
        for t in range(int(size[0]) if len(size) else 0):
            m = active[t]
            c = sym[first[:m] + t]
            far = np.flatnonzero(c >= self.width) if self.symbols > self.width else ()
            near = np.minimum(c, self.width - 1) if len(far) else c
            to = self.flat[self.base[:, None] + state[:, :m] * self.width + near].astype(np.int64)
            if len(far):
                to[:, far] = self.sparse(state[:, far], c[far].astype(np.int64))
            miss = to == NONE
            count[:, :m] += miss
            count[:, :m] += miss & self.unseen[:, c]
            state[:, :m] = np.where(miss, self.root[:, c], to)
        out = np.zeros((len(ends), langs), np.int64)
        np.add.at(out, text, count.T)
        return out


def learn(docs: DataFrame, text: str, id_col: str, lang: str, sample_docs: int, sample_chars: int):
    """(languages, alphabet, automata) from at most ``sample_docs`` excerpts and ``sample_chars`` characters per
    language of different texts of rows that are not held out. The driver sees only these excerpts."""
    size = sample_chars // sample_docs
    room = F.greatest(F.length("l") - size, F.lit(0)) + 1
    rows = (docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(id_col))
            .select(F.col(lang).alias("lang"), F.xxhash64(F.col(text)).alias("k"), F.col(text).alias("t")))
    # copies share the hash and are one teacher
    # ranked in hash parts of a language first, so no task ranks a language's texts: at most sample_docs of each part go on
    first = rows.select("lang", "k").groupBy("lang", "k").agg(F.pmod("k", F.lit(64)).alias("part"))
    for by in (["lang", "part"], ["lang"]):
        top = W.partitionBy(*by).orderBy("k")
        first = first.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= sample_docs)
    first = first.select("lang", "k", "r")
    letters = F.regexp_replace("t", r"[^\p{L}]+", " ")
    rows = (rows.join(F.broadcast(first), ["lang", "k"]).withColumn("l", letters)
            .select("lang", "r", F.substr("l", (F.pmod("k", room) + 1).cast("int"), F.lit(size)).alias("s"))
            .groupBy("lang", "r").agg(F.min("s").alias("s")))
    excerpts: dict[str, list[str]] = {}
    for r in sorted(rows.collect(), key=lambda r: (r.lang, r.r)):
        excerpts.setdefault(r.lang, []).append(r.s)
    if not excerpts:
        return [], None, []
    langs = sorted(excerpts)
    alphabet = Alphabet([s for x in excerpts.values() for s in x])
    tables = []
    for name in langs:
        sym, _ = encode(alphabet.table, [" ".join(excerpts[name])[:sample_chars]])
        tables.append(suffix_automaton(sym.tolist(), alphabet.size))
    return langs, alphabet, tables


def identify(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", lang: str = "lang",
             sample_docs: int = 150, sample_chars: int = 30_000, piece: int = 512, unit: int = 1 << 20,
             names: tuple[str, str, str] = ("held_out", "lang_pred", "score")) -> DataFrame:
    """The columns of ``docs`` with held_out, lang_pred and score, or under other ``names``.

    Automata come from at most ``sample_docs`` different labelled texts and ``sample_chars`` (below 32,000)
    characters per language; every whole text is parsed, about ``unit`` bytes of texts at a time. lang_pred is a learned label, or ``und`` for null text,
    text without a letter, or where nothing could be learned; ties go to the first label in code-point order.
    score is the lead, 1 - phrases(best) / phrases(second), 0 for ``und``. Columns of ``docs`` that bear a result's
    name are replaced. Empty table: no rows.
    """
    if sample_chars > 32_000:
        raise ValueError("sample_chars must stay below 32,000: states are 16-bit")
    spark = docs.sparkSession
    small_batches(spark)
    langs, alphabet, tables = learn(docs, text, id_col, lang, sample_docs, sample_chars)
    # the parser is sent made up, so a task holds the automata once
    shared = spark.sparkContext.broadcast((alphabet.table, CrossParser(tables, piece)) if langs else None)
    del tables
    if text in names or id_col in names:
        raise ValueError("the text and the id can't bear a result's name")
    held = held_out(id_col)
    rows = docs.withColumn("__held", held).drop(*names).withColumnRenamed("__held", names[0])
    schema = rows.withColumns({names[1]: F.lit(""), names[2]: F.lit(0.0)}).schema
    col = rows.columns.index(text)

    def judge(symbols, parser, texts: list[str]) -> tuple[list, list]:
        sym, ends = encode(symbols, texts)
        counts = parser.phrases(sym, ends)
        total = np.concatenate([[0], np.cumsum(sym != GAP)])
        has = np.diff(np.concatenate([[0], total[ends]])) > 0
        best = counts.argmin(1)
        low = counts.min(1)
        rest = counts.copy()
        rest[np.arange(len(rest)), best] = np.iinfo(np.int64).max
        second = rest.min(1) if counts.shape[1] > 1 else np.maximum(np.diff(np.concatenate([[0], ends])), low)
        score = np.where(has, 1 - low / np.maximum(second, 1), 0.0)
        return [langs[b] if h else UNDETERMINED for b, h in zip(best, has)], score.tolist()

    def run(batches):
        model = shared.value
        for batch in batches:
            upto = np.cumsum(pc.binary_length(pc.fill_null(batch.column(col), "")).to_numpy(zero_copy_only=False))
            pred, score, i = [], [], 0
            while i < batch.num_rows:
                j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + unit, "right")))
                if model is None:
                    p, s = [UNDETERMINED] * (j - i), [0.0] * (j - i)
                else:
                    p, s = judge(*model, [t or "" for t in batch.column(col).slice(i, j - i).to_pylist()])
                pred += p
                score += s
                i = j
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             schema.names)

    return rows.mapInArrow(tidy(run), schema)
