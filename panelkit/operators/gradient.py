"""Regression families fitted by summed gradients (ML-8): support vectors with a Gaussian kernel, and a neural network.

Each iteration is one pass: tasks sum loss and gradient of their rows, Spark adds the sums up, and a step of limited-memory
BFGS runs on the driver over the parameters alone, whose number does not depend on the rows. The Gaussian kernel is
approximated by random Fourier features, so the support-vector machine is a linear model over them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Loss = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[float, np.ndarray]]


def _columns(batch: pa.RecordBatch, n: int) -> np.ndarray:
    return np.stack([batch.column(k).to_numpy() for k in range(n)], 1)


def summed(data: DataFrame, n: int, loss: Loss, at: np.ndarray) -> tuple[float, np.ndarray]:
    """Loss and gradient over all rows (n features, then the label)."""
    def run(batches):
        total, grad = 0.0, np.zeros(len(at))
        for b in batches:
            v, g = loss(at, _columns(b, n), b.column(n).to_numpy())
            total, grad = total + v, grad + g
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(at) + 1)), pa.array(np.append(grad, total))], ["k", "v"])

    rows = data.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(len(at) + 1)
    out[rows["k"].to_numpy()] = rows["v"].to_numpy()
    return out[-1], out[:-1]


def minimise(value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, iterations: int = 60, memory: int = 10,
             tolerance: float = 1e-7) -> np.ndarray:
    """Limited-memory BFGS with halving steps."""
    x, (f, g) = start, value(start)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(iterations):
        q, alphas = g.copy(), []
        for s, y in reversed(steps):
            alphas.append((s @ q) / (y @ s))
            q -= alphas[-1] * y
        if steps:
            q *= (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1])
        else:
            q /= max(1.0, np.abs(g).sum())
        for (s, y), a in zip(steps, reversed(alphas)):
            q += s * (a - (y @ q) / (y @ s))
        step = 1.0
        while True:
            new = x - step * q
            fn, gn = value(new)
            if fn <= f - 1e-4 * step * (g @ q) or step < 1e-8:
                break
            step /= 2
        s, y = new - x, gn - g
        done = abs(f - fn) <= tolerance * max(abs(f), 1e-12)
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-memory:]
        x, f, g = new, fn, gn
        if done:
            break
    return x


@dataclass
class GradientModel:
    """``forward(parameters, features)`` on standardised features; predictions in the label's units."""

    features: list[str]
    mean: np.ndarray
    scale: np.ndarray
    label: tuple[float, float]
    parameters: np.ndarray
    forward: Callable[[np.ndarray, np.ndarray], np.ndarray]

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Rows with complete features and their prediction."""
        names, n = df.columns, len(self.features)
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + [f"`{out}` double"])
        at = [names.index(f) for f in self.features]

        def run(batches):
            for b in batches:
                x = np.stack([b.column(k).cast(pa.float64()).to_numpy() for k in at], 1).reshape(-1, n)
                p = self.forward(self.parameters, (x - self.mean) / self.scale) * self.label[1] + self.label[0]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], [*names, out])

        return df.dropna(subset=self.features).mapInArrow(run, schema)


def _fit(df: DataFrame, features: Sequence[str], label: str, forward, loss_of, start: np.ndarray, penalty, iterations: int) -> GradientModel:
    """Standardise, then minimise mean loss plus penalty. Rows with a null feature or label do not train."""
    features = list(features)
    data = df.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate([*features, label])]).dropna()
    names = data.columns
    row = data.agg(F.count("*"), *[f(c) for c in names for f in (F.avg, F.stddev_pop)]).first()
    n = row[0]
    mean, sd = (np.array([row[k] or 0.0 for k in range(first, len(row), 2)]) for first in (1, 2))
    sd = np.where(sd > 0, sd, 1.0)
    unit = data.select(*[((F.col(c) - float(m)) / float(s)).alias(c) for c, m, s in zip(names, mean, sd)])

    def value(at):
        if not n:
            return penalty(at)
        (v, g), (pv, pg) = summed(unit, len(features), loss_of, at), penalty(at)
        return v / n + pv, g / n + pg

    best = minimise(value, start, iterations) if n else start * 0
    return GradientModel(features, mean[:-1], sd[:-1], (float(mean[-1]), float(sd[-1])), best, forward)


def tube_loss(error: np.ndarray, width: float, smooth: float) -> tuple[np.ndarray, np.ndarray]:
    """Loss and slope of the epsilon-insensitive tube, its corners rounded over ``smooth``."""
    beyond = np.abs(error) - width
    value = np.where(beyond <= 0, 0.0, np.where(beyond < smooth, beyond ** 2 / (2 * smooth), beyond - smooth / 2))
    return value, np.sign(error) * np.clip(beyond / smooth, 0.0, 1.0)


def fit_svr(df: DataFrame, features: Sequence[str], label: str, *, waves: int = 200, gamma: float | None = None, cost: float = 1.0,
            width: float = 0.1, smooth: float = 0.01, iterations: int = 60, seed: int = 42) -> GradientModel:
    """Support-vector regression with the kernel exp(-gamma |x - y|^2) on ``waves`` random Fourier features (0: the linear
    kernel). ``gamma`` is one over the number of features unless given; features and label are standardised."""
    n, rng = len(features), np.random.default_rng(seed)
    turn = rng.normal(0, np.sqrt(2 * (1.0 / n if gamma is None else gamma)), (n, waves))
    shift = rng.uniform(0, 2 * np.pi, waves)

    def lifted(x):
        return np.sqrt(2 / waves) * np.cos(x @ turn + shift) if waves else x

    def forward(p, x):
        return lifted(x) @ p[:-1] + p[-1]

    def loss(p, x, y):
        z = lifted(x)
        v, s = tube_loss(z @ p[:-1] + p[-1] - y, width, smooth)
        return float(v.sum()), np.append(s @ z, s.sum())

    rows = max(df.count(), 1)

    def penalty(p):
        w = np.append(p[:-1], 0.0) / (cost * rows)
        return float(p[:-1] @ w[:-1] / 2), w

    return _fit(df, features, label, forward, loss, np.zeros((waves or n) + 1), penalty, iterations)


def fit_network(df: DataFrame, features: Sequence[str], label: str, *, hidden: int = 10, ridge: float = 1e-4, iterations: int = 80,
                seed: int = 42) -> GradientModel:
    """One hidden layer of rectified units, squared error."""
    n, rng = len(features), np.random.default_rng(seed)
    start = np.concatenate([rng.normal(0, np.sqrt(2 / n), n * hidden), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), hidden), [0.0]])

    def parts(p):
        return p[:n * hidden].reshape(n, hidden), p[n * hidden:(n + 1) * hidden], p[(n + 1) * hidden:-1], p[-1]

    def forward(p, x):
        w, b, v, c = parts(p)
        return np.maximum(x @ w + b, 0) @ v + c

    def loss(p, x, y):
        w, b, v, c = parts(p)
        h = np.maximum(x @ w + b, 0)
        e = h @ v + c - y
        back = (e[:, None] * v) * (h > 0)
        return float(e @ e / 2), np.concatenate([(x.T @ back).ravel(), back.sum(0), h.T @ e, [e.sum()]])

    def penalty(p):
        return float(ridge * (p @ p) / 2), ridge * p

    return _fit(df, features, label, forward, loss, start, penalty, iterations)
