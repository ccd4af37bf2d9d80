"""Boosted trees by grouped gradient sums (ML-3, ML-5, ML-7, ML-13).

Rows are binned once. A level of all trees of a round, whatever the number of classes, settings and folds, is
one pass: tasks walk their rows down the trees so far and sum gradients, Hessians and rows by (tree, node, feature, bin); Spark
adds the sums up, running sums over the bins price every cut, and the best cut of each open node comes back. So a
level costs one scan for one model and for a whole tuning grid alike, and depth has no limit. Nodes with few rows
leave this loop: their rows meet in one group per node, where the same sums grow the rest of the tree.

Gradients are rounded to whole numbers on a scale taken from the number of rows, so sums do not depend on the order
of addition and a model of a grid equals the same model fitted alone. What reaches the driver and the tasks are
trees, bounded by ``max_leaves``; rows never leave the executors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import cut_lineage, discard


@dataclass(frozen=True)
class Boost:
    """Settings of one model. ``without_fold``: rows of this fold do not train it (None: all do)."""

    rounds: int = 50
    depth: int = 6
    eta: float = 0.3
    column_share: float = 1.0
    min_child: float = 1.0
    ridge: float = 1.0
    least_gain: float = 1e-6
    max_leaves: int = 1 << 16
    without_fold: int | None = None


@dataclass
class Tree:
    """Nodes by number; node 0 is the root, a leaf has feature -1. A row goes left when its bin is at most ``cut``."""

    feature: np.ndarray = field(default_factory=lambda: np.full(1, -1, np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(1))
    cover: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row ends."""
        at = np.zeros(len(bins), np.int64)
        on = np.arange(len(bins)) if self.feature[0] >= 0 else np.zeros(0, np.int64)
        while len(on):
            n = at[on]
            at[on] = self.left[n] + (bins[on, self.feature[n]] > self.cut[n])
            on = on[self.feature[at[on]] >= 0]
        return at

    def split(self, nodes, feature, cut, value, cover) -> np.ndarray:
        """Give ``nodes`` two children each; the numbers of the new nodes. value, cover: left ones, then right ones."""
        n, k = len(self.feature), len(nodes)
        self.feature[nodes], self.cut[nodes], self.left[nodes] = feature, cut, n + 2 * np.arange(k)
        pad = np.zeros(2 * k, np.int32)
        self.feature = np.append(self.feature, pad - 1)
        self.cut, self.left = np.append(self.cut, pad), np.append(self.left, pad)
        self.value = np.append(self.value, np.stack(value, 1).ravel())
        self.cover = np.append(self.cover, np.stack(cover, 1).ravel())
        return n + np.arange(2 * k)


@dataclass
class BoostedModel:
    """``trees[round][class]``, added to ``base``; a row's bins come from ``edges``, one array a feature."""

    features: list[str]
    edges: list[np.ndarray]
    base: np.ndarray
    trees: list[list[Tree]]
    objective: str

    def margins(self, bins: np.ndarray) -> Iterator[np.ndarray]:
        """Scores (rows, classes) after each round."""
        out = np.tile(self.base, (len(bins), 1))
        for trees in self.trees:
            for k, t in enumerate(trees):
                out[:, k] += t.value[t.walk(bins)]
            yield out

    def nodes(self, spark) -> DataFrame:
        """One row a node: round, class, node, feature (null: leaf), threshold (left: at most), left child, value, cover."""
        rows = [(r, k, n, self.features[f] if f >= 0 else None, float(self.edges[f][t.cut[n]]) if f >= 0 else None,
                 int(t.left[n]) if f >= 0 else None, float(t.value[n]), float(t.cover[n]))
                for r, trees in enumerate(self.trees) for k, t in enumerate(trees) for n, f in enumerate(t.feature)]
        return spark.createDataFrame(rows, "round int, class int, node int, feature string, threshold double, left int, "
                                           "value double, cover double")


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 64, accuracy: int = 100_000) -> list[np.ndarray]:
    """Cut points of every feature: its quantiles, distinct, at most ``bins`` (one pass, bounded sketches)."""
    at = [k / bins for k in range(1, bins + 1)]
    row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), at, accuracy).alias(str(k)) for k, f in enumerate(features)]).first()
    return [np.unique(np.array(row[k] or [0.0])) for k in range(len(features))]


def to_bins(columns: Sequence[np.ndarray], edges: Sequence[np.ndarray]) -> np.ndarray:
    """(rows, features): the place of the first cut point that is not below the value."""
    return np.stack([np.searchsorted(e, np.asarray(c, float)) for c, e in zip(columns, edges)], 1).astype(np.int32)


def _gradients(objective: str, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row and class the first and second derivative of the loss."""
    if objective == "squared":
        return margin - y[:, None], np.ones_like(margin)
    e = np.exp(margin - margin.max(1, keepdims=True))
    p = e / e.sum(1, keepdims=True)
    return p - (y[:, None] == np.arange(margin.shape[1])), np.maximum(2 * p * (1 - p), 1e-16)


def _loss(objective: str, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    if objective == "squared":
        return (margin[:, 0] - y) ** 2
    top = margin.max(1)
    return top + np.log(np.exp(margin - top[:, None]).sum(1)) - margin[np.arange(len(y)), y.astype(int)]


def _unpack(batch: pa.RecordBatch, width: int, scores: int):
    """y, fold, bins and margins of a batch of state rows."""
    y, fold = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    bins = np.asarray(batch.column(2).flatten().to_numpy(), np.int32).reshape(-1, width)
    margin = batch.column(3).flatten().to_numpy().reshape(-1, scores).copy()
    return y, fold, bins, margin


def fit_boosted(df: DataFrame, features: Sequence[str], label: str, settings: Sequence[Boost], *, objective: str = "squared",
                classes: int = 1, fold: str | None = None, bins: int = 64, seed: int = 42,
                small: int = 1 << 16) -> list[BoostedModel]:
    """One model per setting, all grown together. Nodes of at most ``small`` rows are finished in one group each; the trees are
    the same for any ``small``.

    ``objective``: ``squared`` (label a number) or ``softmax`` (label 0 .. ``classes`` - 1, one tree a class and round).
    Rows with a null feature or label do not train. Empty table: every model is its base value."""
    features, spark = list(features), df.sparkSession
    source = df.select(*[F.col(f).cast("double").alias(f"f{k}") for k, f in enumerate(features)],
                       F.col(label).cast("double").alias("y"),
                       (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold")).dropna(subset=[
                           *[f"f{k}" for k in range(len(features))], "y"])
    edges = bin_edges(source, [f"f{k}" for k in range(len(features))], bins)
    folds = source.groupBy("fold").agg(F.count("*").alias("n"), F.avg("y").alias("mean"), F.max(F.abs("y")).alias("most")).collect()
    n = sum(r["n"] for r in folds)
    base, scores = [], len(settings) * classes
    for s in settings:
        own = [r for r in folds if r["fold"] != s.without_fold and r["n"]]
        mean = sum(r["n"] * r["mean"] for r in own) / sum(r["n"] for r in own) if own else 0.0
        base.append(np.full(classes, mean if objective == "squared" else 0.0))
    models = [BoostedModel(features, edges, b, [], objective) for b in base]
    if not n:
        return models
    most = 1.0 if objective == "softmax" else 2 * max(r["most"] or 0.0 for r in folds) + 1e-9
    # sums of n whole numbers stay below 2^62; a Hessian is 1 or at most 1/2
    unit = 2.0 ** min(38, 61 - math.ceil(math.log2(n + 1)))
    scale = unit / (most * 4), 1.0 if objective == "squared" else unit

    counts = [sum(r["n"] for r in folds if r["fold"] != s.without_fold) for s in settings]
    start = np.concatenate(base)

    def first(batches):
        for b in batches:
            x = to_bins([b.column(k).to_numpy() for k in range(len(features))], edges)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), w).cast(pa.list_(t))
                     for v, w, t in ((x, len(features), pa.int32()), (np.tile(start, (len(x), 1)), scores, pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(len(features)), b.column(len(features) + 1), *lists], STATE)

    STATE = ["y", "fold", "bins", "margin"]
    schema = "y double, fold int, bins array<int>, margin array<double>"
    state = cut_lineage(source.mapInArrow(first, schema), "boost")
    for r in range(max(s.rounds for s in settings)):
        live = [m for m, s in enumerate(settings) if r < s.rounds]
        trees = {m * classes + k: Tree() for m in live for k in range(classes)}
        columns = {m: _columns(len(features), settings[m].column_share, seed, r) for m in live}
        _grow(state, trees, columns, settings, edges, objective, classes, scale, scores, counts, small)
        for t, tree in trees.items():
            tree.value = np.where(tree.feature < 0, tree.value * settings[t // classes].eta, 0.0)
        for m in live:
            models[m].trees.append([trees[m * classes + k] for k in range(classes)])
        shared = spark.sparkContext.broadcast(trees)

        def add(batches):
            for b in batches:
                _, _, x, margin = _unpack(b, len(features), scores)
                for t, tree in shared.value.items():
                    margin[:, t] += tree.value[tree.walk(x)]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(margin.ravel()), scores).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), lists], STATE)

        before, state = state, cut_lineage(state.mapInArrow(add, schema), "boost")
        discard(before)
        shared.unpersist()
    discard(state)
    return models


def _columns(n: int, share: float, seed: int, round_: int) -> np.ndarray:
    """The features a tree of this round may cut."""
    order = np.random.default_rng([seed, round_]).permutation(n)
    return np.sort(order[:max(1, round(share * n))])


def _node_rows(batch, trees, open_, settings, objective, classes, scale, width, scores):
    """Per tree with open nodes the batch's training rows in them: (tree, place of the node, rounded gradients and Hessians, bins)."""
    y, fold, x, margin = _unpack(batch, width, scores)
    for m in sorted({t // classes for t in open_}):
        g, h = _gradients(objective, y, margin[:, m * classes:(m + 1) * classes])
        trains = fold != settings[m].without_fold if settings[m].without_fold is not None else np.ones(len(y), bool)
        for t in range(m * classes, (m + 1) * classes):
            if t in open_:
                place = np.full(len(trees[t].feature), -1, np.int64)
                place[open_[t]] = np.arange(len(open_[t]))
                k = place[trees[t].walk(x)]
                rows = np.flatnonzero(trains & (k >= 0))
                yield t, k[rows], np.rint(g[rows, t % classes] * scale[0]), np.rint(h[rows, t % classes] * scale[1]), x[rows]


def _grow(state, trees, columns, settings, edges, objective, classes, scale, scores, counts, small) -> None:
    """Grow the trees of one round: level by level, and node by node where few rows are left."""
    spark = state.sparkSession
    leaves, depth, width = dict.fromkeys(trees, 1), 0, len(edges)
    cells = max(len(e) for e in edges) + 1
    for t, tree in trees.items():
        tree.cover[0] = counts[t // classes]
    open_ = {t: np.zeros(1, np.int64) for t in trees if counts[t // classes]}
    few: dict[int, np.ndarray] = {}
    began: dict[int, np.ndarray] = {}

    def set_aside() -> None:
        """Open nodes of few rows wait for the end, unless they could pass the bound on leaves together."""
        for t in list(open_):
            rows = trees[t].cover[open_[t]]
            less = rows <= small
            if less.any() and rows.sum() + leaves[t] <= settings[t // classes].max_leaves:
                few[t] = np.append(few.get(t, np.zeros(0, np.int64)), open_[t][less])
                began[t] = np.append(began.get(t, np.zeros(0, np.int64)), np.full(less.sum(), depth))
                leaves[t] += int(rows[less].sum())
                open_[t] = open_[t][~less]
            if not len(open_[t]):
                del open_[t]

    set_aside()
    while open_:
        shared = spark.sparkContext.broadcast((trees, open_, columns))

        def sums(batches):
            trees, open_, columns = shared.value
            for b in batches:
                held = []
                for t, k, gi, hi, x in _node_rows(b, trees, open_, settings, objective, classes, scale, width, scores):
                    for f in columns[t // classes]:
                        cell, size = k * cells + x[:, f], len(open_[t]) * cells
                        c = np.bincount(cell, minlength=size)
                        at = np.flatnonzero(c)
                        # sums of a batch are whole numbers below 2^53, so exact as doubles
                        sg, sh = (np.bincount(cell, w, size)[at].astype(np.int64) for w in (gi, hi))
                        held.append((np.full(len(at), t), at // cells, np.full(len(at), f), at % cells, sg, sh, c[at]))
                if held:
                    cols = [np.concatenate(c).astype(np.int64) for c in zip(*held)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["tree", "place", "f", "bin", "g", "h", "c"])

        found = state.mapInArrow(sums, "tree long, place long, f long, bin long, g long, h long, c long").groupBy(
            "tree", "place", "f", "bin").agg(*[F.sum(c).alias(c) for c in "ghc"])
        best = _best_cuts(found, settings, classes, scale).toArrow().to_pydict()
        shared.unpersist()
        cols = {k: np.array(v) for k, v in best.items()}
        after = {}
        for t in open_:
            s, tree = settings[t // classes], trees[t]
            own = np.flatnonzero(cols["tree"] == t)
            own = own[np.argsort(cols["place"][own])]
            nodes = open_[t][cols["place"][own]]
            got = _split_best(tree, nodes, {k: v[own] for k, v in cols.items()}, s, depth, s.max_leaves - leaves[t])
            leaves[t] += len(got) // 2
            if len(got) and depth + 1 < s.depth:
                after[t] = got
        open_ = after
        depth += 1
        set_aside()
    if few:
        _finish(state, trees, few, began, columns, settings, edges, objective, classes, scale, scores)


def _split_best(tree: Tree, nodes: np.ndarray, cols: dict, s: Boost, depth: int, room: int) -> np.ndarray:
    """Split the nodes whose best cut gains enough (those with the highest gain when there is not room for all); the new nodes."""
    if depth == 0 and len(nodes):
        tree.value[0] = -cols["all_g"][0] / (cols["all_h"][0] + s.ridge)
    win = np.flatnonzero(cols["gain"] > s.least_gain) if depth < s.depth else np.zeros(0, np.int64)
    if len(win) > room:
        win = np.sort(win[np.argsort(-cols["gain"][win], kind="stable")[:room]])
    if not len(win):
        return np.zeros(0, np.int64)
    gl, hl, cl = (cols[f"left_{c}"][win] for c in "ghc")
    gr, hr, cr = (cols[f"all_{c}"][win] - x for c, x in zip("ghc", (gl, hl, cl)))
    return tree.split(nodes[win], cols["f"][win], cols["bin"][win], (-gl / (hl + s.ridge), -gr / (hr + s.ridge)), (cl, cr))


def _cuts_of_rows(place, n, g, h, x, columns, cells, s: Boost, scale) -> dict:
    """The best cut of each of n nodes from their rows: what ``_best_cuts`` finds, in one task."""
    best = {k: np.zeros(n) for k in ("gain", *[f"{a}_{c}" for c in "ghc" for a in ("all", "left")])}
    best["gain"] -= np.inf
    best |= {"f": np.zeros(n, np.int64), "bin": np.zeros(n, np.int64)}
    for f in columns:
        cell = place * cells + x[:, f]
        part = [np.bincount(cell, w, n * cells).reshape(n, cells) for w in (g, h)] + [
            np.bincount(cell, minlength=n * cells).reshape(n, cells).astype(float)]
        here = part[2] > 0
        left = [np.cumsum(p, 1) / u for p, u in zip(part, (*scale, 1.0))]
        (gl, hl, cl), (ga, ha, ca) = left, (p[:, -1:] for p in left)
        gr, hr = ga - gl, ha - hl
        able = here & (hl >= s.min_child) & (hr >= s.min_child) & (cl < ca)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(able, gl * gl / (hl + s.ridge) + gr * gr / (hr + s.ridge) - ga * ga / (ha + s.ridge), -np.inf)
        at = gain.argmax(1)
        rows = np.arange(n)
        better = gain[rows, at] > best["gain"]
        for k, v in (("gain", gain), ("left_g", gl), ("left_h", hl), ("left_c", cl)):
            best[k] = np.where(better, v[rows, at], best[k])
        best["f"], best["bin"] = np.where(better, f, best["f"]), np.where(better, at, best["bin"])
        best |= {"all_g": ga[:, 0], "all_h": ha[:, 0], "all_c": ca[:, 0]}
    return best


def _finish(state, trees, few, began, columns, settings, edges, objective, classes, scale, scores) -> None:
    """Grow the rest of the trees below the nodes ``few``: their rows meet in one group per node, and the nodes come back."""
    spark, width = state.sparkSession, len(edges)
    cells = max(len(e) for e in edges) + 1
    shared = spark.sparkContext.broadcast((trees, few, began, columns))

    def rows(batches):
        trees, few, _, _ = shared.value
        for b in batches:
            for t, k, g, h, x in _node_rows(b, trees, few, settings, objective, classes, scale, width, scores):
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), t)), pa.array(k), pa.array(g), pa.array(h), flat],
                                                 ["tree", "place", "g", "h", "bins"])

    def grow(group: pa.Table) -> pa.Table:
        _, _, began, columns = shared.value
        t, place = group["tree"][0].as_py(), group["place"][0].as_py()
        s, tree = settings[t // classes], Tree()
        g, h = group["g"].to_numpy(), group["h"].to_numpy()
        x = group["bins"].combine_chunks().flatten().to_numpy().reshape(-1, width)
        at, open_, start = np.zeros(len(g), np.int64), np.zeros(1, np.int64), int(began[t][place])
        depth = start
        while len(open_):
            index = np.full(len(tree.feature), -1, np.int64)
            index[open_] = np.arange(len(open_))
            on = np.flatnonzero(index[at] >= 0)
            cols = _cuts_of_rows(index[at[on]], len(open_), g[on], h[on], x[on], columns[t // classes], cells, s, scale)
            if depth == start:
                tree.value[0] = -cols["all_g"][0] / (cols["all_h"][0] + s.ridge)
                tree.cover[0] = cols["all_c"][0]
            got = _split_best(tree, open_, cols, s, depth, len(g))
            depth += 1
            cut = on[tree.feature[at[on]] >= 0]
            at[cut] = tree.left[at[cut]] + (x[cut, tree.feature[at[cut]]] > tree.cut[at[cut]])
            open_ = got if depth < s.depth else got[:0]
        n = len(tree.feature)
        return pa.table({"tree": np.full(n, t), "place": np.full(n, place), "node": np.arange(n), "feature": tree.feature, "cut": tree.cut,
                         "left": tree.left, "value": tree.value, "cover": tree.cover})

    found = state.mapInArrow(rows, "tree long, place long, g double, h double, bins array<int>").groupBy("tree", "place").applyInArrow(
        grow, "tree long, place long, node long, feature int, cut int, left int, value double, cover double").toArrow()
    found = found.sort_by([("tree", "ascending"), ("place", "ascending"), ("node", "ascending")])
    cols = {c: found[c].to_numpy() for c in found.column_names}
    first = np.flatnonzero(cols["node"] == 0)
    grafts: dict[int, list] = {}
    for a, b in zip(first, np.append(first[1:], len(found))):
        grafts.setdefault(int(cols["tree"][a]), []).append((a, b))
    for t, parts in grafts.items():
        tree, n = trees[t], len(trees[t].feature)
        new = {c: [getattr(tree, c)] for c in ("feature", "cut", "left", "value", "cover")}
        for a, b in parts:
            root = few[t][cols["place"][a]]
            # a sub-tree's root is the node itself, the others are added at the end
            for c in new:
                v = cols[c][a:b]
                v = v + (n - 1) if c == "left" else v
                new[c][0][root] = v[0]
                new[c].append(v[1:])
            n += b - a - 1
        for c, v in new.items():
            setattr(tree, c, np.concatenate(v))
    shared.unpersist()


def _best_cuts(sums: DataFrame, settings: Sequence[Boost], classes: int, scale: tuple[float, float]) -> DataFrame:
    """Per open node its totals and the cut with the highest gain (ties: the first feature, the first bin)."""
    part = Window.partitionBy("tree", "place", "f")
    upto = part.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    r = sums.repartition("tree", "place")
    for c, one in zip("ghc", (*scale, 1.0)):
        r = r.withColumn(f"all_{c}", F.sum(c).over(part) / one).withColumn(f"left_{c}", F.sum(c).over(upto) / one)
    own = {k: F.element_at(F.array(*[F.lit(float(getattr(s, k))) for s in settings]),
                           (F.floor(F.col("tree") / classes) + 1).cast("int")) for k in ("ridge", "min_child")}
    r = r.withColumns(own)

    def score(g, h):
        return g * g / (h + F.col("ridge"))

    right = F.col("all_g") - F.col("left_g"), F.col("all_h") - F.col("left_h")
    able = (F.col("left_h") >= F.col("min_child")) & (right[1] >= F.col("min_child")) & (F.col("left_c") < F.col("all_c"))
    gain = score(F.col("left_g"), F.col("left_h")) + score(*right) - score(F.col("all_g"), F.col("all_h"))
    r = r.withColumn("gain", F.when(able, gain).otherwise(F.lit(float("-inf"))))
    best = F.max_by(F.struct("f", "bin", "gain", *[f"{x}_{c}" for c in "ghc" for x in ("all", "left")]),
                    F.struct("gain", -F.col("f"), -F.col("bin"))).alias("b")
    return r.groupBy("tree", "place").agg(best).select("tree", "place", "b.*")


def _scored(df: DataFrame, models: Sequence[BoostedModel], extra: str, emit) -> DataFrame:
    """Rows of ``emit(columns, bins, models)`` per batch of df with complete features; ``extra``: its schema."""
    features, edges = models[0].features, models[0].edges
    shared = df.sparkSession.sparkContext.broadcast(list(models))
    names = df.columns
    data = df.dropna(subset=features)

    def run(batches):
        for b in batches:
            cols = {c: b.column(k) for k, c in enumerate(names)}
            bins = to_bins([cols[f].cast(pa.float64()).to_numpy() for f in features], edges)
            yield emit(cols, bins, shared.value)

    return data.mapInArrow(run, extra)


def predict(df: DataFrame, model: BoostedModel, out: str = "prediction") -> DataFrame:
    """Rows with complete features and their prediction: the value, or the likeliest class (ties: the smallest)."""
    names = df.columns
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + [f"`{out}` double"])

    def emit(cols, bins, models):
        last = np.tile(models[0].base, (len(bins), 1))
        for last in models[0].margins(bins):
            pass
        p = last[:, 0] if models[0].objective == "squared" else last.argmax(1).astype(float)
        return pa.RecordBatch.from_arrays([*(cols[c] for c in names), pa.array(p)], [*names, out])

    return _scored(df, [model], schema, emit)


def losses(df: DataFrame, models: Sequence[BoostedModel], label: str, fold: str | None = None,
           only_fold: Sequence[int | None] | None = None) -> DataFrame:
    """(model, round, n, loss): the summed loss of every model after every round, in one pass over the rows;
    ``only_fold``: per model the fold it is judged on."""
    only = list(only_fold or [None] * len(models))

    def emit(cols, bins, shared):
        y = cols[label].cast(pa.float64()).to_numpy()
        own = cols[fold].to_numpy() if fold else None
        out = []
        for m, model in enumerate(shared):
            rows = np.flatnonzero(own == only[m]) if only[m] is not None else np.arange(len(y))
            for r, margin in enumerate(model.margins(bins[rows])):
                out.append((m, r + 1, len(rows), float(_loss(model.objective, y[rows], margin).sum())))
        t, names = list(zip(*out)) or [[]] * 4, ["model", "round", "n", "loss"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(t, (pa.int32(), pa.int32(), pa.int64(), pa.float64()))], names)

    found = _scored(df.dropna(subset=[label]), models, "model int, round int, n long, loss double", emit)
    return found.groupBy("model", "round").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"))


def tune_boosted(df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int, rounds: Sequence[int],
                 depths: Sequence[int], column_shares: Sequence[float], eta: float = 0.1, **kw) -> DataFrame:
    """ML-7: (rounds, depth, column_share, cv_rmse) of the whole grid. All settings and folds grow in the same scans; a
    smaller number of rounds is the start of a larger one, so it costs nothing."""
    grid = [(d, c) for d in depths for c in column_shares]
    settings = [Boost(rounds=max(rounds), depth=d, column_share=c, eta=eta, without_fold=k) for d, c in grid for k in range(folds)]
    models = fit_boosted(df, features, label, settings, fold=fold, **kw)
    each = losses(df, models, label, fold, [s.without_fold for s in settings]).filter(F.col("round").isin(*rounds))
    names = df.sparkSession.createDataFrame([(k * folds + j, d, c) for k, (d, c) in enumerate(grid) for j in range(folds)],
                                            "model int, depth int, column_share double")
    per_fold = each.join(F.broadcast(names), "model").withColumn("rmse", F.sqrt(F.col("loss") / F.col("n")))
    return per_fold.groupBy("round", "depth", "column_share").agg(F.avg("rmse").alias("cv_rmse")).withColumnRenamed("round", "rounds")


def tree_shares(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """(rows, features): Shapley values of one tree, absent features by the cover of the branches.

    A leaf's path asks something of some features. For each of them ``one`` says whether the row meets it, ``zero`` is the
    share of cover that goes that way. Over the features of the path, the coefficients of the product of (zero + one * x)
    count the subsets by size, so a leaf costs the square of its path's features, for all rows of a batch at once."""
    out = np.zeros(bins.shape)
    stack = [(0, {})]
    while stack:
        node, path = stack.pop()
        f = int(tree.feature[node])
        if f >= 0:
            left = int(tree.left[node])
            for child, goes in ((left, bins[:, f] <= tree.cut[node]), (left + 1, bins[:, f] > tree.cut[node])):
                zero = tree.cover[child] / tree.cover[node]
                z, o = path.get(f, (1.0, True))
                stack.append((child, {**path, f: (z * zero, o & goes)}))
            continue
        m = len(path)
        if not m:
            continue
        weight = np.array([math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m) for s in range(m)])
        for f, (zero, one) in path.items():
            poly = np.zeros((m, len(bins)))
            poly[0], k = 1.0, 0
            for other, (z, o) in path.items():
                if other != f:
                    poly[1:k + 2] = poly[1:k + 2] * z + poly[:k + 1] * o
                    poly[0] *= z
                    k += 1
            out[:, f] += tree.value[node] * (one - zero) * (weight @ poly)
    return out


def expected_value(model: BoostedModel) -> float:
    """The mean of a model over its training rows, by cover."""
    total = float(model.base[0])
    for trees in model.trees:
        t = trees[0]
        leaf = t.feature < 0
        total += float((t.value[leaf] * t.cover[leaf]).sum() / max(t.cover[0], 1.0))
    return total


def tree_attribution(df: DataFrame, model: BoostedModel, key: Sequence[str]) -> DataFrame:
    """ML-13: per row the ``key``, one ``<feature>_attr`` column a feature, ``expected`` and ``prediction``; the attributions
    and the expected value add up to the prediction. Work runs batch by batch inside the tasks."""
    mean = expected_value(model)
    own = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [f"{f}_attr" for f in model.features]
    schema = ", ".join([f"`{k}` {own[k]}" for k in key] + [f"`{c}` double" for c in [*names, "expected", "prediction"]])

    def emit(cols, bins, models):
        share, p = np.zeros(bins.shape), np.full(len(bins), models[0].base[0])
        for trees in models[0].trees:
            share += tree_shares(trees[0], bins)
            p += trees[0].value[trees[0].walk(bins)]
        return pa.RecordBatch.from_arrays([*(cols[k] for k in key), *(pa.array(c) for c in share.T), pa.array(np.full(len(p), mean)),
                                           pa.array(p)], [*key, *names, "expected", "prediction"])

    return _scored(df, [model], schema, emit)
