"""Support vectors and the network against plain solvers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import gradient as gr


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 2, (150, 2))
    y = np.sin(x[:, 0]) * 3 + x[:, 1] + rng.normal(0, 0.05, 150)
    df = spark.createDataFrame([(k, *map(float, r), float(v)) for k, (r, v) in enumerate(zip(x, y))], "k long, a double, b double, y double")
    return df.repartition(3).cache(), x, y


def test_linear_support_vectors_reach_the_optimum(data):
    df, x, y = data
    m = gr.fit_svr(df, ["a", "b"], "y", waves=0, width=0.1, smooth=1e-3, iterations=200)
    u, v = (x - x.mean(0)) / x.std(0), (y - y.mean()) / y.std()

    def value(p):
        return np.maximum(np.abs(u @ p[:2] + p[2] - v) - 0.1, 0).mean() + p[:2] @ p[:2] / (2 * len(v))

    # subgradients with falling steps, far more of them than needed
    p, best = np.zeros(3), np.inf
    for k in range(60_000):
        e = u @ p[:2] + p[2] - v
        s = np.sign(e) * (np.abs(e) > 0.1)
        p = p - 0.5 / np.sqrt(k + 1) * (np.append(s @ u, s.sum()) / len(v) + np.append(p[:2], 0) / len(v))
        best = min(best, value(p))
    assert value(m.parameters) <= best + 2e-3


def kernel_svr(u, v, gamma, cost, width):
    """The dual by coordinate steps: the exact machine on a small table (bias as a penalised constant feature)."""
    k = np.exp(-gamma * ((u[:, None] - u[None]) ** 2).sum(2)) + 100.0
    beta, f = np.zeros(len(v)), np.zeros(len(v))
    for _ in range(3000):
        for i in range(len(v)):
            g = f[i] - v[i] - k[i, i] * beta[i]
            new = np.clip(-np.sign(g) * max(abs(g) - width, 0) / k[i, i], -cost, cost)
            f += (new - beta[i]) * k[i]
            beta[i] = new
    return f


def test_kernel_support_vectors_agree_with_the_exact_machine(data):
    df, x, y = data
    m = gr.fit_svr(df, ["a", "b"], "y", waves=800, width=0.1, iterations=150)
    got = np.array([r.prediction for r in m.predict(df).orderBy("k").collect()])
    u, v = (x - x.mean(0)) / x.std(0), (y - y.mean()) / y.std()
    want = kernel_svr(u, v, 0.5, 1.0, 0.1) * y.std() + y.mean()
    assert np.corrcoef(got, want)[0, 1] > 0.995 and np.abs(got - want).mean() < 0.12 * y.std()


def test_gradients_and_nulls(data, spark):
    df, x, y = data
    rng, e = np.random.default_rng(1), 1e-6
    m = gr.fit_network(df, ["a", "b"], "y", iterations=100)
    p = np.array([r.prediction for r in m.predict(df).orderBy("k").collect()])
    assert ((p - y) ** 2).mean() < 0.35 * y.var()
    value, slope = gr.tube_loss(np.array([-2.0, -0.11, 0.0, 0.105, 3.0]), 0.1, 0.02)
    up, _ = gr.tube_loss(np.array([-2.0, -0.11, 0.0, 0.105, 3.0]) + e, 0.1, 0.02)
    assert np.allclose((up - value) / e, slope, atol=1e-4) and rng
    odd = df.limit(5).withColumn("a", F.when(F.col("k") % 2 == 0, F.col("a")))
    assert gr.fit_svr(df.limit(0), ["a"], "y").parameters.any() is np.False_
    assert m.predict(odd).count() == odd.filter("a is not null").count()
