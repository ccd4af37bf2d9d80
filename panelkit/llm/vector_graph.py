"""Near-duplicate vectors over a robust-pruned flat graph.

1. Centroids are fitted on a bounded sample; every vector joins the shards of its nearest
   few centroids, so shards overlap. A shard is worked on in units of bounded size (blocks, and pairs of blocks).
2. Each unit builds a graph: of a node's nearest candidates one is kept unless a kept
   neighbour is closer to it by the factor alpha (robust pruning).
3. The adjacency lists of a vector from all units are united.
4. Each unit searches the united graph for every member: greedily from the unit's medoid and from the member's
   own node with a beam, then in widening range through all neighbours near enough. Cosines are computed
   for the edges that the search follows, in double precision.
5. A pair met in several units counts in the first only. A bounded sample of vectors is compared with all rows, pair
   by pair: if recall falls short, the work is repeated with more overlap, and after the last one all blocks are compared.

Identical vectors are one node with a weight, so they are never expanded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.arrays import forest, spread
from panelkit.llm.common import row_key, smallest_reachable
from panelkit.session import cut_lineage


def unit_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """Adds dim and v (little-endian doubles of length one; null for vectors that can't link)."""
    col = rows.columns.index(vector)
    schema = rows.drop(vector).withColumns({"dim": F.lit(0), "v": F.lit(None).cast("binary")}).schema

    def run(batches):
        for batch in batches:
            dims, out = [], []
            for x in batch.column(col):
                a = None
                if x.is_valid and x.values.null_count == 0 and len(x.values):
                    a = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    big = np.abs(a).max()
                    a = a / big if np.isfinite(big) and big > 0 and np.isfinite(a).all() else None
                dims.append(0 if a is None else len(a))
                out.append(None if a is None else (a / np.sqrt(a @ a)).tobytes())
            rest = [c for k, c in enumerate(batch.columns) if k != col]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                                             schema.names)

    return rows.mapInArrow(run, schema)


def matrix(vectors) -> np.ndarray:
    return np.stack([np.frombuffer(v, np.float64) for v in vectors])


def centroids(x: np.ndarray, k: int, rounds: int = 6, seed: int = 7) -> np.ndarray:
    """Spherical k-means; starts are drawn by distance, so a crowded spot gets few of them."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.integers(len(x), size=1)]
    far = 1 - x @ c[0]
    for _ in range(k - 1):
        p = np.maximum(far, 0)
        if p.sum() <= 1e-9:
            break
        c = np.vstack([c, x[rng.choice(len(x), p=p / p.sum())]])
        far = np.minimum(far, 1 - x @ c[-1])
    for _ in range(rounds):
        own = np.concatenate([(x[s:s + 4096] @ c.T).argmax(1) for s in range(0, len(x), 4096)])
        new = np.zeros_like(c)
        np.add.at(new, own, x)
        norm = np.sqrt((new * new).sum(1))
        c = np.where(norm[:, None] > 1e-12, new / np.maximum(norm, 1e-12)[:, None], c)
    return c


def fit_shards(nodes: DataFrame, n: int, shard: int, sample: int, most: int) -> dict[int, np.ndarray]:
    """Centroids per dimension from at most ``sample`` vectors (the smallest hashes)."""
    rows = nodes.orderBy(F.xxhash64("v"), "uid").limit(sample).select("dim", "v").collect()
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.dim, []).append(r.v)
    k = min(most, max(1, -(-n // shard)))
    return {d: centroids(matrix(v), max(1, round(k * len(v) / len(rows)))) for d, v in by.items()}


def assign(nodes: DataFrame, model: dict[int, np.ndarray], overlap: int) -> DataFrame:
    """Adds shards: the nearest ``overlap`` centroids of a vector (dimensions not in the sample are one shard)."""
    shared = nodes.sparkSession.sparkContext.broadcast(model)
    schema = nodes.withColumn("shards", F.array(F.lit(0))).schema
    dim_at, v_at = nodes.columns.index("dim"), nodes.columns.index("v")

    def run(batches):
        cents = shared.value
        for batch in batches:
            dims, vs = batch.column(dim_at).to_numpy(), batch.column(v_at).to_pylist()
            out: list = [None] * len(vs)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if d not in cents:
                    for i in at:
                        out[i] = [0]
                    continue
                sim = matrix([vs[i] for i in at]) @ cents[d].T
                k = min(overlap, sim.shape[1])
                near = np.sort(np.argpartition(-sim, k - 1, axis=1)[:, :k], axis=1)
                for i, row in zip(at, near.tolist()):
                    out[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], schema.names)

    return nodes.mapInArrow(run, schema)


def units(nodes: DataFrame, block: int) -> DataFrame:
    """(unit, shard, block, uid, ...) rows: a shard's members hashed to blocks; a unit holds one block or two."""
    placed = nodes.withColumn("shard", F.explode("shards"))
    sizes = placed.groupBy("dim", "shard").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = placed.join(F.broadcast(sizes), ["dim", "shard"])  # one row per centroid: bounded
    placed = placed.withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.withColumns({"lo": F.least("block", "o"), "hi": F.greatest("block", "o")}).drop("o", "blocks")


def build_graph(x: np.ndarray, degree: int, candidates: int, alpha: float) -> np.ndarray:
    """Robust-pruned neighbours (n, degree) of unit vectors, -1 where there are fewer."""
    n = len(x)
    dist = np.sqrt(np.maximum(2 - 2 * (x @ x.T), 0))
    np.fill_diagonal(dist, np.inf)
    k = min(candidates, n - 1)
    near = np.argpartition(dist, k - 1, axis=1)[:, :k]
    near = np.take_along_axis(near, np.argsort(np.take_along_axis(dist, near, 1), axis=1, kind="stable"), 1)
    own = np.take_along_axis(dist, near, 1)
    np.fill_diagonal(dist, 0)
    alive, kept = np.ones((n, k), bool), np.zeros(n, np.int64)
    out = np.full((n, degree), -1, np.int64)
    for j in range(k):
        p = np.flatnonzero(alive[:, j] & (kept < degree))
        v = near[p, j]
        out[p, kept[p]] = v
        kept[p] += 1
        alive[p] &= alpha * dist[v[:, None], near[p]] > own[p]
    return out


def range_search(x: np.ndarray, nbr: list[np.ndarray], threshold: float, beam: int, slack: float = 0.02):
    """Pairs (query, node) within the threshold that a search of the graph finds, every member being a query, and their
    cosines. Only the edges that a search follows are priced."""
    n = len(x)
    kids = np.array([len(a) for a in nbr])
    by = np.concatenate(nbr) if kids.sum() else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(kids)])
    known, done = np.full((n, n), -2.0), np.zeros((n, n), bool)  # -2: not met yet

    def meet(q, node):
        """Price the pairs not met yet; which of the given ones they are."""
        new = np.flatnonzero(known[q, node] == -2)
        for s in range(0, len(new), 1 << 16):
            k = new[s:s + (1 << 16)]
            known[q[k], node[k]] = np.clip(np.einsum("ij,ij->i", x[q[k]], x[node[k]]), -1.0, 1.0)
        return new

    everyone = np.arange(n)
    start = int((x @ x.sum(0)).argmax())  # the medoid
    meet(everyone, np.full(n, start))
    meet(everyone, everyone)
    rows = everyone
    best = np.full((n, beam), -2.0)
    best[:, 0] = known[:, start]
    best[:, 1] = known[rows, rows]
    while len(rows):
        score = np.where(done[rows], -2.0, known[rows])
        at = score.argmax(1)
        top = score[np.arange(len(rows)), at]
        go = (top > -2) & (top >= best[rows].min(1))  # nothing near enough left: the beam is settled
        rows, at = rows[go], at[go]
        done[rows, at] = True
        rep, child = spread(by, first, kids, at)
        new = meet(rows[rep], child)
        child, rep = child[new], rep[new]
        most = int(kids.max()) if n else 0
        add = np.full((len(rows), most), -2.0)
        slot = np.arange(len(rep)) - np.searchsorted(rep, rep)
        add[rep, slot] = known[rows[rep], child]
        both = np.concatenate([best[rows], add], axis=1)
        best[rows] = -np.partition(-both, beam - 1, axis=1)[:, :beam]
    q, node = np.nonzero(~done & (known >= threshold - slack))
    while len(q):  # widen through everything near the range
        done[q, node] = True
        rep, child = spread(by, first, kids, node)
        qq = q[rep]
        new = meet(qq, child)
        qq, child = qq[new], child[new]
        near = known[qq, child] >= threshold - slack
        pair = np.unique(qq[near] * n + child[near])
        q, node = pair // n, pair % n
    found = known >= threshold
    q, node = np.nonzero(found | found.T)  # a pair may be met from either end
    ok = q < node
    q, node = q[ok], node[ok]
    return q, node, np.maximum(known[q, node], known[node, q])


def by_unit(rows: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work`` on the rows of each unit (dim, shard, lo, hi), one unit in memory at a time."""
    key = ["dim", "shard", "lo", "hi"]
    names = rows.columns

    def run(batches):
        held = None
        for batch in batches:
            tab = pa.Table.from_batches([batch])
            held = tab if held is None else pa.concat_tables([held, tab])
            ids = np.stack([held[k].to_numpy() for k in key])
            cut = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(0)) + 1
            edges = [0, *cut.tolist()]
            for s, e in zip(edges[:-1], edges[1:]):
                yield from work(held.slice(s, e - s))
            held = held.slice(edges[-1]).combine_chunks()
        if held is not None and held.num_rows:
            yield from work(held)

    assert set(key) <= set(names)
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


def found_links(uid, weight, i, j, once, score, pieces: list) -> pa.RecordBatch:
    """Rows (uid, links, pairs) of the pairs i, j that count here, and spanning pairs (a, b) of all."""
    span = forest(i, j, score, len(uid))
    links, pairs = np.zeros(len(uid), np.int64), np.zeros(len(uid), np.int64)
    for x, y in ((i[once], j[once]), (j[once], i[once])):
        np.add.at(links, x, weight[y])
        np.add.at(pairs, x, 1)
    some, none = np.flatnonzero(links), lambda n: np.zeros(n, np.int64)
    own = np.concatenate([np.ones(len(some), bool), np.zeros(len(span), bool)])
    cols = [(uid[some], none(len(span))), (links[some], none(len(span))), (pairs[some], none(len(span))),
            (none(len(some)), uid[i[span]]), (none(len(some)), uid[j[span]])]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), mask=~own if k < 3 else own) for k, c in enumerate(cols)], pieces)


FOUND = "uid long, links long, pairs long, a long, b long"


def gathered(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((uid, links, pairs), (a, b)) of the rows of ``found_links``."""
    links = found.filter("uid is not null").groupBy("uid").agg(F.sum("links").alias("links"), F.sum("pairs").alias("pairs"))
    return links, found.filter("a is not null").select("a", "b")


def compared(nodes: DataFrame, threshold: float, block: int) -> tuple[DataFrame, DataFrame]:
    """What ``linked`` returns, from all blocks compared with each other: exact, and quadratic."""
    placed = nodes.withColumn("shards", F.array(F.lit(0)))
    cols = ["dim", "shard", "lo", "hi", "block", "uid", "v", "weight"]

    def pairs(tab):
        uid, w, blk = (tab[c].to_numpy() for c in ("uid", "weight", "block"))
        x = matrix(tab["v"].to_pylist())
        sim = x @ x.T
        i, j = np.nonzero(np.triu(sim >= threshold, 1))
        if tab["lo"][0].as_py() != tab["hi"][0].as_py():
            ok = blk[i] != blk[j]
            i, j = i[ok], j[ok]
        yield found_links(uid, w, i, j, np.ones(len(i), bool), sim[i, j], ["uid", "links", "pairs", "a", "b"])

    return gathered(cut_lineage(by_unit(units(placed, block).select(*cols), pairs, FOUND), "found"))


def linked(nodes: DataFrame, threshold: float, overlap: int, shard: int, block: int, sample: int, degree: int,
           candidates: int, alpha: float, beam: int) -> tuple[DataFrame, DataFrame]:
    """((uid, links, pairs), (a, b)): weights and number of linked nodes per node, and spanning links."""
    model = fit_shards(nodes, nodes.count(), shard, sample, 4096)
    placed = cut_lineage(assign(nodes, model, overlap), "placed")
    members = units(placed, block)

    def build(tab):
        uid = tab["uid"].to_numpy()
        if len(uid) < 2:
            return
        out = build_graph(matrix(tab["v"].to_pylist()), degree, candidates, alpha)
        lists = [uid[r[r >= 0]] for r in out]
        yield pa.RecordBatch.from_arrays([pa.array(uid), pa.array(lists, pa.list_(pa.int64()))], ["uid", "near"])

    lists = by_unit(members.select("dim", "shard", "lo", "hi", "uid", "v"), build, "uid long, near array<long>")
    united = lists.groupBy("uid").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    full = units(placed.join(united, "uid"), block)

    def search(tab):
        uid, w = tab["uid"].to_numpy(), tab["weight"].to_numpy()
        if len(uid) < 2:
            return
        x = matrix(tab["v"].to_pylist())
        order = np.argsort(uid)
        a, b = [], []
        for i, near in enumerate(tab["near"].to_pylist()):
            at = order[np.minimum(np.searchsorted(uid[order], near), len(uid) - 1)]
            at = at[uid[at] == near]
            a.append(np.full(len(at), i)), b.append(at)
        a, b = np.concatenate(a), np.concatenate(b)
        pair = np.unique(np.concatenate([a * len(uid) + b, b * len(uid) + a]))  # edges run both ways
        cut = np.searchsorted(pair // len(uid), np.arange(len(uid) + 1))
        i, j, score = range_search(x, [pair[s:e] % len(uid) for s, e in zip(cut[:-1], cut[1:])], threshold, beam)
        here, blk = int(tab["shard"][0].as_py()), tab["block"].to_numpy()
        if tab["lo"][0].as_py() != tab["hi"][0].as_py():
            ok = blk[i] != blk[j]
            i, j, score = i[ok], j[ok], score[ok]
        shards = tab["shards"].to_pylist()
        sh = np.full((len(uid), max(map(len, shards))), -1)
        for k, s in enumerate(shards):
            sh[k, :len(s)] = s
        once = np.ones(len(i), bool)
        for s in range(0, len(i), 1 << 16):
            p, q = sh[i[s:s + (1 << 16)]], sh[j[s:s + (1 << 16)]]
            once[s:s + (1 << 16)] = ~((p[:, :, None] == q[:, None, :]) & (p[:, :, None] >= 0) & (p[:, :, None] < here)).any((1, 2))
        yield found_links(uid, w, i, j, once, score, ["uid", "links", "pairs", "a", "b"])

    cols = ["dim", "shard", "lo", "hi", "block", "uid", "v", "weight", "near", "shards"]
    return gathered(cut_lineage(by_unit(full.select(*cols), search, FOUND), "found"))


def audit(nodes: DataFrame, links: DataFrame, threshold: float, queries: int) -> tuple[int, int]:
    """(found, true) pairs of ``queries`` nodes drawn by hash and as many of those with links, compared with every node. Nodes
    are different vectors, so copies do not weigh."""
    own = nodes.join(links, "uid", "left").select("uid", "dim", "v", F.coalesce("pairs", F.lit(0)).alias("pairs"))
    by = F.xxhash64("uid", F.lit(3))
    drawn = {r.uid: r for part in (own, own.filter("pairs > 0")) for r in part.orderBy(by).limit(queries).collect()}
    shared = nodes.sparkSession.sparkContext.broadcast([(r.uid, r.dim, r.v) for r in drawn.values()])

    def run(batches):
        by: dict[int, list] = {}
        for u, d, v in shared.value:
            by.setdefault(d, []).append((u, np.frombuffer(v, np.float64)))
        for batch in batches:
            uid, dims = (batch.column(k).to_numpy() for k in (0, 1))
            vs = batch.column(2).to_pylist()
            for d, qs in by.items():
                at = np.flatnonzero(dims == d)
                if len(at):
                    ids = np.array([u for u, _ in qs])
                    hit = (matrix([vs[i] for i in at]) @ np.stack([v for _, v in qs]).T >= threshold)
                    hit &= uid[at][:, None] != ids[None, :]
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(hit.sum(0))], ["uid", "n"])

    true = (nodes.select("uid", "dim", "v").mapInArrow(run, "uid long, n long")
            .groupBy("uid").agg(F.sum("n").alias("n")).collect())
    return sum(min(drawn[r.uid].pairs, r.n) for r in true), sum(r.n for r in true)


def near_duplicate_vectors(vectors: DataFrame, *, vector: str = "embedding", id_col: str = "vec_id",
                           threshold: float = 0.95, min_recall: float = 0.98, overlaps: tuple[int, ...] = (3, 6, 12),
                           shard: int = 500, block: int = 1024, sample: int = 20_000, degree: int = 24,
                           candidates: int = 48, alpha: float = 1.2, beam: int = 16, queries: int = 256) -> DataFrame:
    """One row per input row: ``id_col``, n_links, component_id, kept and recall (the audit's).

    Two vectors link when their cosine is at least ``threshold``; vectors that are null, empty, zero or hold
    null or non-finite components link with nothing, nor do vectors of different lengths. component_id is the
    smallest id reachable; kept says whether it is the row's own. Rows with a null id keep a null component and
    are not kept; rows that repeat an id or a vector are rows of their own. ``sample`` vectors at most fit the
    centroids, all are indexed. Links below the threshold are never returned; the audit compares
    ``queries`` vectors, and as many that have links, with all and asks for ``min_recall``, else the next overlap is taken, and
    after the last one all blocks are compared. Empty table: no rows.
    """
    rows = vectors.select(row_key().alias("row"), F.col(id_col).alias("id"), F.col(vector).alias("x"))
    rows = cut_lineage(unit_vectors(rows, "x"), "vectors")
    good = rows.filter("v is not null")
    nodes = cut_lineage(good.groupBy("dim", "v").agg(
        F.min("row").alias("uid"), F.min("id").alias("low"), F.count("*").alias("weight")), "nodes")
    core = nodes.select("uid", "dim", "v", "weight")
    recall = 1.0
    for overlap in overlaps:
        links, edges = linked(core, threshold, overlap, shard, block, sample, degree, candidates, alpha, beam)
        found, true = audit(core, links, threshold, queries)
        recall = found / true if true else 1.0
        if recall >= min_recall:
            break
    else:
        links, edges = compared(core, threshold, block)
        recall = 1.0
    comp = smallest_reachable(edges)
    info = (nodes.select("uid", "dim", "v", "low", "weight").join(links.drop("pairs"), "uid", "left")
            .join(comp, F.col("uid") == F.col("node"), "left")
            .withColumn("component", F.coalesce("component", "uid")))
    least = info.groupBy("component").agg(F.min("low").alias("least"))
    info = info.join(least, "component").select(
        "dim", "v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "least")
    out = rows.join(info, ["dim", "v"], "left")
    zero = F.lit(0).cast("long")
    lowest = F.when(F.col("id").isNotNull(), F.coalesce("least", "id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", zero).alias("n_links"),
                      lowest.alias("component_id"), F.coalesce(lowest == F.col("id"), F.lit(False)).alias("kept"),
                      F.lit(float(recall)).alias("recall"))
