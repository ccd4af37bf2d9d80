import random

import numpy as np
import pytest

from panelkit.llm.ngram_join import Members, counts, keep_one_per_component, need, ngram_components, path
from tests.llm.brute import jaccard_components, shingles
from tests.llm.conftest import prose


def got(df, **kw):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_components(df, **kw).collect()}


def crowd(seed, n=120, size=150):
    """Chains and crowds of edits around the threshold."""
    rng = random.Random(seed)
    docs, texts = {}, [prose(rng, size, 5000).split() for _ in range(3)]
    for k in range(n):
        t = list(texts[k % 3] if k < 60 or rng.random() < 0.3 else docs[rng.randrange(k)].split())
        for _ in range(rng.randrange(0, 7)):
            t[rng.randrange(len(t))] = f"e{rng.randrange(10**6)}"
        if rng.random() < 0.2:
            t = t[:rng.randrange(len(t) // 2, len(t))]
        docs[k] = " ".join(t)
    return docs


def test_odd_rows(documents, odd_rows):
    assert got(documents(odd_rows)) == jaccard_components(dict(odd_rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_crowds_match_brute_force(documents, seed):
    docs = crowd(seed)
    assert got(documents(list(docs.items()))) == jaccard_components(docs)


def test_blocks_of_a_hot_sub_tree_lose_nothing(documents):
    docs = crowd(3, 90)
    assert got(documents(list(docs.items())), block=7) == jaccard_components(docs)


def test_other_thresholds_and_sizes(documents):
    docs = crowd(4, 60, 40)
    for percent in (50, 100):
        assert got(documents(list(docs.items())), percent=percent) == jaccard_components(docs, percent)


def test_ties_at_the_threshold(documents):
    # 17 shared of 20 in the union is exactly 85 percent; 16 of 19 is below
    a = [f"a{k}" for k in range(21)]
    docs = {1: " ".join(a[:20]), 2: " ".join(a[:21]), 3: " ".join(a[3:20]), 4: " ".join(a[:17]), 5: "x y z"}
    assert got(documents(list(docs.items()))) == jaccard_components(docs)


def test_repeated_and_null_ids(documents):
    t = " ".join(f"k{k}" for k in range(40))
    rows = [(None, t), (7, t), (7, t + " z"), (7, "other words that link with nothing"), (3, t), (None, None), (9, t)]
    out = ngram_components(documents(rows)).collect()
    assert len(out) == len(rows)
    assert all(r.component_id == 3 for r in out if r.doc_id in (3, 9))
    assert {r.component_id for r in out if r.doc_id is None} == {None}
    kept = keep_one_per_component(documents(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == [(False, 3), (False, 7), (True, None)]


def test_stage_keeps_one_of_each_component(documents, odd_rows):
    df = documents(odd_rows)
    want = jaccard_components(dict(odd_rows))
    kept = keep_one_per_component(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}


def test_empty_table_and_clashing_columns(documents):
    assert ngram_components(documents([])).count() == 0
    assert keep_one_per_component(documents([])).count() == 0
    df = documents([(1, "a b c d e", "en", "s", 1, 2, "x")], ", uid long, n long, both string")
    assert keep_one_per_component(df).collect() == df.collect()


def test_bounds_never_fall_below_the_overlap():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 2**63, rng.integers(4, 900), dtype=np.uint64)
        sets.append(np.unique(base))
        sets.append(np.unique(np.concatenate([base[rng.random(len(base)) < 0.95], base[:1]])))
    for s in sets:
        assert counts(path(s).tobytes()).sum() == len(s)
    n = np.array([len(s) for s in sets])
    i, j, _ = Members(np.zeros(len(sets), np.int64), n, [path(s).tobytes() for s in sets]).pairs(85)
    found = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            if len(np.intersect1d(sets[a], sets[b])) >= need(n[a], n[b], 85):
                assert (a, b) in found
    assert shingles("A b") == {("a", "b")}
