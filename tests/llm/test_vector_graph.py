import math

import numpy as np
import pytest

from panelkit.llm.vector_graph import build_graph, near_duplicate_vectors, range_search
from tests.llm.brute import vector_links


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<float>, label int")


def crowd(seed, n=400, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dim))
    out = []
    for k in range(n):
        c = centres[rng.integers(30) if k % 3 else 0]
        out.append((k * 7 + 1, (c + rng.normal(size=dim) * rng.choice([0.02, 0.12, 1.0])).astype(np.float32).tolist()))
    return out


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {"shard": 50, "block": 40}), (3, {"overlaps": (1, 2, 30), "shard": 20})])
def test_links_match_brute_force(spark, seed, kw):
    vectors = crowd(seed)
    want = vector_links(dict(vectors))
    got = near_duplicate_vectors(table(spark, vectors), min_recall=1.0, **kw).collect()
    true = sum(n for n, _ in want.values())
    assert len(got) == len(vectors) and true > 1000
    assert all(r.n_links <= want[r.vec_id][0] for r in got)
    assert sum(r.n_links for r in got) >= 0.98 * true
    assert sum((r.component_id, r.kept) == (want[r.vec_id][1], want[r.vec_id][1] == r.vec_id) for r in got) >= 0.98 * len(got)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [math.nan, 1.0, 1.0]),
            (6, [math.inf, 1.0, 1.0]), (7, v), (8, v), (9, [2.0, 4.0, 6.0]), (10, [3e38, 0.0, 0.0]), (11, [1e-38, 0.0, 0.0]),
            (12, [-1.0, -2.0, -3.0]), (13, [1.0, 2.0]), (14, [1.0, 2.0, 3.0, 0.0]), (None, v), (7, v)]
    got = near_duplicate_vectors(table(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: r for r in got}
    assert [by[i].n_links for i in (1, 2, 3, 4, 5, 6, 12, 13, 14)] == [0] * 9
    assert [by[i].n_links for i in (7, 8, 9)] == [4, 4, 4] and [by[i].n_links for i in (10, 11)] == [1, 1]
    assert by[9].component_id == 7 and by[11].component_id == 10 and by[None].component_id is None
    assert not by[9].kept and by[7].kept and by[1].kept and not by[None].kept


def test_copies_are_one_node(spark):
    rows = [(k, [1.0, 1.0]) for k in range(500)] + [(1000, [1.0, 0.9])]
    got = near_duplicate_vectors(table(spark, rows)).collect()
    assert {r.n_links for r in got} == {500} and {r.component_id for r in got} == {0}


def test_empty_table_and_clashing_columns(spark):
    assert near_duplicate_vectors(table(spark, [])).count() == 0
    odd = spark.createDataFrame([(1, [1.0], 2, "x")], "vec_id long, embedding array<float>, uid long, v string")
    assert near_duplicate_vectors(odd).first().n_links == 0


def test_pruned_graph_is_searchable():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 8))
    x[150:] = x[:150] + rng.normal(size=(150, 8)) * 0.05
    x /= np.linalg.norm(x, axis=1)[:, None]
    g = build_graph(x, 12, 32, 1.2)
    assert (g[:, 0] >= 0).all() and (np.sort(g, 1)[:, -1] < 300).all()
    sim = x @ x.T
    i, j, score = range_search(x, [r[r >= 0] for r in g], 0.95, 16)
    assert np.allclose(score, sim[i, j])
    want = {(a, b) for a, b in np.argwhere(np.triu(sim >= 0.95, 1))}
    assert set(zip(i, j)) <= want and len(i) >= 0.98 * len(want)


def test_blocks_are_compared_when_no_overlap_suffices(spark):
    vectors = crowd(5, 150)
    want = vector_links(dict(vectors))
    got = near_duplicate_vectors(table(spark, vectors), min_recall=1.01, overlaps=(1,), shard=20, block=16).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want and got[0].recall == 1.0


def test_audit_counts_pairs_of_different_vectors(spark):
    # one vector that half of the rows copy, and pairs that a single small shard each would split
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 8))
    rows = [(k, [1.0] * 8) for k in range(200)] + [(1000 + k, v.tolist()) for k, v in enumerate(base)]
    rows += [(2000 + k, (v * 1.5 + rng.normal(size=8) * 0.05).tolist()) for k, v in enumerate(base)]
    want = vector_links({i: np.float32(v).tolist() for i, v in rows})
    got = near_duplicate_vectors(table(spark, rows), min_recall=1.0, overlaps=(1, 60), shard=3, block=8).collect()
    assert {r.vec_id: r.n_links for r in got} == {i: n for i, (n, _) in want.items()}
