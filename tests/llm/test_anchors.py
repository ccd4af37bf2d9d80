import random

import numpy as np
import pytest

from panelkit.llm import anchors
from panelkit.llm.anchors import pack_gaps, remove_repeats, unpack_gaps
from tests.llm.brute import sha, without_repeats
from tests.llm.conftest import prose


def got(df, **kw):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(df, **kw).collect()}


def want(docs, window=50):
    return {i: (n, k, sha(t)) for i, (n, k, t) in without_repeats(docs, window).items()}


def test_odd_rows(documents, odd_rows):
    assert got(documents(odd_rows)) == want(dict(odd_rows))


@pytest.mark.parametrize("window", [2, 9, 50])
def test_shared_passages_at_any_offset(documents, window):
    rng = random.Random(window)
    passages = [prose(rng, rng.randrange(window - 1, window * 3), 10**6) for _ in range(6)]
    docs = {}
    for k in range(80):
        parts = [prose(rng, rng.randrange(0, 40), 10**6)]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages).split()
            a = rng.randrange(0, max(1, len(p) // 3))
            parts += [" ".join(p[a:]), prose(rng, rng.randrange(0, 15), 10**6)]
        docs[rng.randrange(10**6) * 100 + k] = " ".join(parts)
    assert got(documents(list(docs.items())), window=window) == want(docs, window)


def test_small_buckets_and_few_words_of_many_repeats(documents):
    rng = random.Random(8)
    docs = {k: prose(rng, rng.randrange(0, 300), 2) for k in range(40)}
    docs |= {100 + k: "same " * (30 + k) for k in range(40)}
    assert got(documents(list(docs.items())), window=10, bucket_bytes=2000) == want(docs, 10)


def test_repeated_null_ids_and_empty(documents):
    t = " ".join(f"k{k}" for k in range(60))
    rows = [(5, t), (5, t), (None, t), (9, t), (9, t), (5, t + " more"), (None, None)]
    out = remove_repeats(documents(rows)).collect()
    assert len(out) == len(rows)
    assert sorted(r.n_removed for r in out if r.doc_id == 9) == [60, 60]
    assert all(r.n_removed == 0 for r in out if r.doc_id in (5, None))
    assert remove_repeats(documents([])).count() == 0
    clash = documents([(1, "a", "en", "s", 1, "x")], ", id long, n string")
    assert remove_repeats(clash).count() == 1


def test_gaps_round_trip():
    rng = np.random.default_rng(0)
    for top in (3, 300, 5000, 10**6):
        loc = np.unique(rng.integers(0, top, 200))
        assert (unpack_gaps(pack_gaps(loc)) == loc).all()
    assert len(unpack_gaps(pack_gaps(np.zeros(0, np.int64)))) == 0


def test_hot_windows_meet_without_a_shuffle(documents, monkeypatch):
    rng = random.Random(12)
    passage = prose(rng, 90, 10**6)
    rows = [(k, f"{prose(rng, 20, 10**6)} {passage} {prose(rng, 20, 10**6)}") for k in range(40)] + [(90, prose(rng, 80)), (91, passage)]
    want = without_repeats(dict(rows))
    for least in (3, 1000):
        monkeypatch.setattr(anchors, "LEAST_HOT", least)
        got = {r.doc_id: (r.n_words, r.n_removed) for r in remove_repeats(documents(rows)).collect()}
        assert got == {k: v[:2] for k, v in want.items()}
