import random
import re
from collections import Counter, defaultdict

import numpy as np

from panelkit.llm.divergence import gallop, price, source_divergence
from tests.llm.brute import LOWER
from tests.llm.conftest import prose

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least=3, top=200):
    """Every kept term against every source, with whole numbers of any size."""
    held, own, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        held[lang].update(set(terms))
        own[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in held[lang].items() if d >= least]
        v = len(kept)
        total = {s: sum(own[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (own[lang, s][t] + 1) // (total[s] + v) for t in kept} for s in sources}
        n = sum(total.values())
        q = {t: 1 + 10**9 * (sum(own[lang, s][t] for s in sources) + 1) // (n + v) for t in kept}
        for s in sources:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources - {s}]
            term = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if own[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, i, x, k + 1) for k, (i, x) in enumerate(ranked)]
    return sorted(out)


def rows(seed):
    rng = random.Random(seed)
    out = [(k, prose(rng, rng.randrange(0, 120), 90).replace("w", rng.choice("wWvé")) + " a-b_c Été été",
            rng.choice(["en", "en", "fr", "de", None]), rng.choice(["s0", "s0", "s0", "s1", "s2", "É", None])) for k in range(250)]
    return out + [(900, None, "en", "s9"), (901, "", "en", "s8"), (902, "12 34 !", "xx", "only"), (903, "rare words here", "yy", "a"),
                  (904, "others", "yy", "b"), (905, "dup dup", "en", "s1"), (905, "dup dup", "en", "s1"), (906, None, None, None),
                  (907, "  nbsp em Ä ß 😀", "de", "s1"), (908, prose(rng, 20000, 500), "fr", "s0")]


def check(got, want):
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_against_every_term_of_every_pair(documents):
    r = rows(1)
    check(source_divergence(documents(r)), brute(r))


def test_small_blocks_and_units_change_nothing(documents):
    r = rows(2)
    check(source_divergence(documents(r), block=7, top_terms=5, least_docs=2), brute(r, 2, 5))


def test_no_kept_terms_and_empty_table(spark, documents):
    r = [(1, "a", "en", "x"), (2, "b", "en", "y"), (3, None, "en", None)]
    check(source_divergence(documents(r)), brute(r))
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert source_divergence(empty).count() == 0


def test_extra_columns_with_clashing_names(spark):
    base = rows(3)[:60]
    df = spark.createDataFrame([(*r, 1, "x", 2, None) for r in base],
                               "doc_id long, text string, lang string, source string, n int, term string, value int, held string")
    check(source_divergence(df), brute(base))


def test_prices_beyond_64_bits():
    count = np.array([0, 5, 10**12, 3 * 10**14], np.int64)
    assert price(count, 4 * 10**14, 10**9).tolist() == [1 + 10**9 * (int(c) + 1) // (4 * 10**14 + 10**9) for c in count]


def test_gallop_finds_the_intersection():
    rng = np.random.default_rng(4)
    for a, b, top in ((0, 5, 9), (1, 1, 2), (3, 400, 500), (50, 60, 80), (200, 4000, 4100), (10, 10, 10)):
        for _ in range(20):
            x, y = (np.sort(rng.choice(max(top, n), n, replace=False)) for n in (a, b))
            i, j = gallop(x, y)
            assert x[i].tolist() == y[j].tolist() == sorted(set(x.tolist()) & set(y.tolist()))
