import random
import re
from collections import Counter, defaultdict

import numpy as np

from panelkit.llm.collocations import collocations, marks
from tests.llm.brute import LOWER


def brute(rows, least, top=2000, covered=100):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for size in range(1, 6):
                f[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        found = []
        for g, a in counts.items():
            if len(g) < 2 or a < least:
                continue
            score, k = min((1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g)))
            longer = [counts[x] for x in counts if len(x) > len(g) and counts[x] >= least and any(
                x[i:i + len(g)] == g for i in range(len(x)))]
            if not any(100 * b >= covered * a for b in longer):
                found.append((" ".join(g), a, counts[g[:k]], counts[g[k:]], n[lang], score))
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, r + 1, *x) for r, x in enumerate(found[:top])]
    return sorted(out)


def rows(seed, many=200):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "city", "été", "a b", "x", "😀"]
    out = []
    for k in range(many):
        t = "".join(rng.choice(words) + rng.choice([" "] * 9 + ["  ", "\t", ". ", ",", "\n", "\r\n", "!", "\x0b"])
                    for _ in range(rng.randrange(0, 60)))
        if rng.random() < 0.4:
            t += " in new york city hall " + rng.choice(["now", "then", ""])
        out.append((k, t, rng.choice(["en", "en", "fr", None, "und"])))
    return out + [(901, None, "en"), (902, "", "en"), (903, " \t ", "xx"), (904, "x " * 3000, "rep"), (904, "x " * 3000, "rep"),
                  (905, ".,;:!?", None), (906, "one", "yy")]


def check(df, r, **kw):
    got = collocations(df, **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(r, kw.get("least", 100), kw.get("top", 2000), kw.get("covered_percent", 100))
    assert sorted(tuple(x) for x in got.collect()) == want
    return want


def docs(spark, r, extra=()):
    return spark.createDataFrame([(*x, *(1 for _ in extra)) for x in r],
                                 "doc_id long, text string, lang string" + "".join(f", {c} long" for c in extra)).repartition(3)


def test_against_exploded_phrases(spark):
    r = rows(1)
    assert len(check(docs(spark, r), r, least=12)) > 50


def test_few_counters_change_nothing(spark):
    r = rows(2, 120)
    check(docs(spark, r), r, least=5, counters=32)
    check(docs(spark, r), r, least=5, top=7, covered_percent=80)


def test_extra_columns_empty_table_and_nothing_frequent(spark):
    r = rows(3, 60)
    check(docs(spark, r, ("w1", "c", "words", "f", "k", "a", "n")), r, least=9)
    assert collocations(docs(spark, r[:0])).count() == 0
    assert collocations(docs(spark, [(1, "a b", "en")])).count() == 0


def test_marks_of_starts_take_four_bytes_each():
    h = np.arange(1 << 12, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    m = marks(h, 1 << 27)
    assert m.nbytes == 4 * len(h)
    assert m.astype(np.int64).tolist() == [int(x) % (1 << 27) for x in h]
