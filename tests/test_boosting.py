"""Boosted trees against plain versions and their own properties."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import boosting as bo


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    n = 400
    x = rng.integers(0, 12, (n, 3)).astype(float)
    y = np.round(3 * (x[:, 0] > 5) * x[:, 1] + x[:, 2] + rng.normal(0, 1, n), 3)
    season = (x[:, 0] // 4 + (x[:, 2] > 9)).astype(int).clip(0, 3)
    rows = [(k, *map(float, r), float(v), int(s), k % 5) for k, (r, v, s) in enumerate(zip(x, y, season))]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, y double, s int, fold int").repartition(3).cache()
    return df, x, y, season


X = ["a", "b", "c"]


def brute_tree(x, g, h, depth, features, ridge=1.0, least=1e-6, child=1.0):
    """Nested tuples: (feature, threshold, left, right) or a value."""
    def score(m):
        return g[m].sum() ** 2 / (h[m].sum() + ridge)
    best = (least, None)
    if depth:
        m = np.ones(len(g), bool)
        for f in features:
            for v in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= v
                if h[left].sum() >= child and h[~left].sum() >= child:
                    gain = score(left) + score(~left) - score(m)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, v, left))
    if best[1] is None:
        return -g.sum() / (h.sum() + ridge)
    f, v, left = best[1]
    return f, v, *(brute_tree(x[s], g[s], h[s], depth - 1, features, ridge) for s in (left, ~left))


def nested(model, tree, n=0):
    f = tree.feature[n]
    if f < 0:
        return tree.value[n]
    return (f, model.edges[f][tree.cut[n]], nested(model, tree, tree.left[n]), nested(model, tree, tree.left[n] + 1))


def same(a, b):
    if isinstance(a, tuple):
        return isinstance(b, tuple) and a[:2] == b[:2] and all(same(*p) for p in zip(a[2:], b[2:]))
    return not isinstance(b, tuple) and abs(a - b) < 1e-6


def test_trees_equal_exhaustive_search(data):
    df, x, y, season = data
    m = bo.fit_boosted(df, X, "y", [bo.Boost(rounds=1, depth=3, eta=1.0)])[0]
    assert same(nested(m, m.trees[0][0]), brute_tree(x, y.mean() - y, np.ones(len(y)), 3, range(3)))
    m = bo.fit_boosted(df, X, "s", [bo.Boost(rounds=1, depth=2, eta=1.0)], objective="softmax", classes=4)[0]
    for k in range(4):
        p = np.full(len(y), 0.25)
        assert same(nested(m, m.trees[0][k]), brute_tree(x, p - (season == k), 2 * p * (1 - p), 2, range(3)))


def test_a_grid_equals_its_single_fits_and_losses_fall(data):
    df, x, y, _ = data
    settings = [bo.Boost(rounds=4, depth=d, column_share=c, eta=0.3, without_fold=f) for d in (2, 5) for c in (0.5, 1.0) for f in (0, 3)]
    together = bo.fit_boosted(df, X, "y", settings, fold="fold")
    for s, m in list(zip(settings, together))[::3]:
        alone = bo.fit_boosted(df.repartition(5), X, "y", [s], fold="fold")[0]
        for a, b in zip(m.trees, alone.trees):
            for name in ("feature", "cut", "left", "value", "cover"):
                assert np.array_equal(getattr(a[0], name), getattr(b[0], name))
    # nodes of few rows are finished elsewhere: sooner, later or never makes the same trees, in another order of nodes
    for small in (0, 60):
        other = bo.fit_boosted(df, X, "y", settings[2:5], fold="fold", small=small)
        for m, o in zip(together[2:5], other):
            assert all(same(nested(m, a[0]), nested(o, b[0])) for a, b in zip(m.trees, o.trees))
    m = bo.fit_boosted(df, X, "s", [bo.Boost(rounds=8, depth=4)], objective="softmax", classes=4)
    loss = [r.loss for r in bo.losses(df, m, "s").orderBy("round").collect()]
    assert len(loss) == 8 and all(b < a for a, b in zip(loss, loss[1:]))
    right = bo.predict(df, m[0]).filter(F.col("prediction") == F.col("s")).count()
    assert right > 390


def test_depth_beyond_thirty_and_leaf_bound(spark):
    rows = [(k, float(k), float(k % 2)) for k in range(60)]  # alternating labels: every cut peels one row
    df = spark.createDataFrame(rows, "k long, a double, y double")
    deep = bo.fit_boosted(df, ["a"], "y", [bo.Boost(rounds=1, depth=50, eta=1.0, ridge=0.0), bo.Boost(rounds=1, depth=50, max_leaves=5)])
    t = deep[0].trees[0][0]
    depth, at = 0, {0: 0}
    for n in range(len(t.feature)):
        if t.feature[n] >= 0:
            at[t.left[n]] = at[t.left[n] + 1] = at[n] + 1
            depth = max(depth, at[n] + 1)
    assert depth > 30 and (t.cover[t.feature < 0] >= 1).all() and t.cover[0] == 60
    kids = t.left[t.feature >= 0]
    assert np.array_equal(t.cover[kids] + t.cover[kids + 1], t.cover[t.feature >= 0])
    assert (deep[1].trees[0][0].feature < 0).sum() == 5
    level = bo.fit_boosted(df, ["a"], "y", [bo.Boost(rounds=1, depth=50, eta=1.0, ridge=0.0)], small=0)[0].trees[0][0]
    assert np.array_equal(np.sort(level.value), np.sort(t.value)) and len(level.left) == len(t.left)


def brute_shapley(tree, bins, features):
    def mean(n, known):
        if tree.feature[n] < 0:
            return tree.value[n]
        f, left = tree.feature[n], tree.left[n]
        if f in known:
            return mean(left + (bins[f] > tree.cut[n]), known)
        return sum(tree.cover[c] * mean(c, known) for c in (left, left + 1)) / tree.cover[n]
    out = []
    for f in range(features):
        rest, total = [g for g in range(features) if g != f], 0.0
        for size in range(features):
            w = math.factorial(size) * math.factorial(features - 1 - size) / math.factorial(features)
            total += w * sum(mean(0, {*s, f}) - mean(0, set(s)) for s in itertools.combinations(rest, size))
        out.append(total)
    return out


def test_attributions_are_shapley_values(data):
    df, x, y, _ = data
    m = bo.fit_boosted(df, X, "y", [bo.Boost(rounds=3, depth=4)])[0]
    got = {r.k: r for r in bo.tree_attribution(df, m, ["k"]).collect()}
    bins = bo.to_bins(list(x.T), m.edges)
    for k, r in got.items():
        assert abs(r.a_attr + r.b_attr + r.c_attr + r.expected - r.prediction) < 1e-9
    for k in range(0, 400, 23):
        want = np.sum([brute_shapley(t[0], bins[k], 3) for t in m.trees], axis=0)
        assert np.allclose([got[k].a_attr, got[k].b_attr, got[k].c_attr], want, atol=1e-9)
    assert abs(np.mean([r.prediction for r in got.values()]) - got[0].expected) < 1e-9


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 3.0), (3, 2.0, None)], "k long, a double, y double")
    m = bo.fit_boosted(df, ["a"], "y", [bo.Boost(rounds=2)])[0]
    assert m.base[0] == 2.0 and [r.prediction for r in bo.predict(df, m).orderBy("k").collect()] == [2.0, 2.0]
    empty = bo.fit_boosted(df.limit(0), ["a"], "y", [bo.Boost(rounds=2)])[0]
    assert empty.trees == [] and bo.predict(df, empty).first().prediction == 0.0
