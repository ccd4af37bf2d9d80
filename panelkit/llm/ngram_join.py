"""N-gram Jaccard self-join as a distributed prefix-tree join.

A text's set of word n-grams is ordered by one global order: frequent n-grams last,
the others by hash. Texts with the same set are one class. Two sets of Jaccard at
least t share an n-gram among the first |x| - ceil(t |x|) + 1 of each, so these first
edges deal the classes to the sub-trees of the tree (edges with the same smallest class to one). Inside a sub-tree every set is the
path of its counts over consecutive ranges of the hash order; paths with a common start
are one node. The sub-tree is joined with itself level by level on pairs of nodes: a
pair carries the overlap so far (shared by all sets below it) and is cut as soon as
that and the remaining lengths cannot reach the overlap the threshold asks for.

Pairs that survive are bounds, not links: links are checked on the full sets. A first
pass proposes a spanning forest per sub-tree, which is linear in its members. A sub-tree with too many members for one
task is dealt to blocks by hash, each block proposes its own forest, and a second deal by another hash does the same for what
is still apart, so a crowd of near copies becomes one component without comparing its blocks in pairs.
Where a proposal failed, or a sub-tree of several blocks still holds more than one component, a last pass over that
sub-tree, block by block with all others, proposes every surviving pair that joins two components. So no
link between components is lost and copies are never expanded into all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.arrays import forest, runs, spread
from panelkit.llm.common import FixedBloom, row_key, rows_that_stay, small_batches, smallest_reachable, tidy
from panelkit.llm.textops import Hasher, U, mix, slices
from panelkit.session import cut_lineage, discard

SIGNED = np.int64


def doc_sets(col: pa.Array, size: int, hasher: Hasher) -> Iterator[np.ndarray]:
    """Per text its sorted distinct n-gram hashes (empty without words)."""
    for i, j, data, off in slices(col):
        h, _, _, at = hasher.words(data, off)
        w = hasher.windows(h, size)
        for k in range(j - i):
            a, b = at[k], at[k + 1]
            if b - a >= size:
                yield np.unique(w[a:b - size + 1])
            elif b > a:
                yield np.array([hasher.whole(h[a:b])], U)
            else:
                yield np.zeros(0, U)


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    return (int(np.add.reduce(mix(s)).astype(SIGNED)), int(np.add.reduce(mix(s ^ U(0x5851F42D4C957F2D))).astype(SIGNED)))


def path(s: np.ndarray) -> np.ndarray:
    """Counts of the sorted hashes over equal ranges, two to a byte: two ranges a hash for small sets, half a range for
    large ones, and finer where a count would pass 15."""
    n = len(s)
    bits = max(4, (2 * n).bit_length() if n <= 512 else max(10, (n // 2).bit_length()))
    while True:
        c = np.bincount((s >> U(64 - bits)).astype(np.int64), minlength=1 << bits)
        if c.max() <= 15:
            return (c[::2] * 16 + c[1::2]).astype(np.uint8)
        bits += 1


def counts(packed: bytes) -> np.ndarray:
    b = np.frombuffer(packed, np.uint8)
    return np.stack([b >> 4, b & 15], axis=1).ravel()


def need(a, b, t: int):
    """Least overlap of sets of sizes a and b that reaches t percent."""
    return -(-(t * (a + b)) // (100 + t))


def frequent_ngrams(docs: DataFrame, text: str, size: int, lower: bool, part: int, unit: int) -> np.ndarray:
    """N-grams that about one in ``part`` texts holds: at most ``part`` times the mean set size,
    whatever the number of texts. Each task counts units of ``unit`` n-grams and passes
    on what is frequent there; the sums decide. Only the order of the tree depends on it, no result."""
    def count(batches):
        hasher, held, n, docs_in = Hasher(lower), [], 0, 0

        def flush():
            v, c = np.unique(np.concatenate(held), return_counts=True)
            ok = c >= max(4, docs_in // part)
            return pa.RecordBatch.from_arrays([pa.array(v[ok].view(SIGNED)), pa.array(c[ok].astype(SIGNED))], ["g", "c"])

        for batch in batches:
            for s in doc_sets(batch.column(0), size, hasher):
                held.append(s)
                n += len(s)
                docs_in += 1
                if n >= unit:
                    yield flush()
                    held, n, docs_in = [], 0, 0
        if held:
            yield flush()

    counts = docs.select(text).mapInArrow(tidy(count), "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))
    least = max(8, docs.count() // part)
    found = counts.filter(F.col("c") >= least).select("g").toArrow()
    return np.sort(found["g"].to_numpy().view(U))


def text_digest(text: str) -> F.Column:
    return F.xxhash64(F.col(text), F.col(text).isNull())


def describe(docs: DataFrame, text: str, id_col: str, size: int, t: int, lower: bool, frequent: np.ndarray) -> DataFrame:
    """(uid, id, digest, n, s1, s2, edges, path) per row: set size and name, first edges, path."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent)

    def run(batches):
        hasher, last = Hasher(lower), shared.value
        for batch in batches:
            n, s1, s2, edges, paths = [], [], [], [], []
            for s in doc_sets(batch.column(3), size, hasher):
                n.append(len(s))
                if not len(s):
                    s1.append(0), s2.append(0), edges.append(None), paths.append(None)
                    continue
                a, b = set_key(s)
                common = np.zeros(len(s), bool)
                if len(last):
                    common = last[np.minimum(np.searchsorted(last, s), len(last) - 1)] == s
                p = len(s) - (t * len(s) + 99) // 100 + 1
                first = np.concatenate([s[~common], s[common]])[:p]
                s1.append(a), s2.append(b), paths.append(path(s).tobytes())
                edges.append((first >> U(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()), pa.array(edges, pa.list_(pa.int32())), pa.array(paths, pa.binary())],
                ["uid", "id", "digest", "n", "s1", "s2", "edges", "path"])

    rows = docs.select(row_key().alias("uid"), F.col(id_col).alias("id"), text_digest(text).alias("digest"),
                       F.col(text).alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(tidy(run), f"uid long, id {kind}, digest long, n long, s1 long, s2 long, edges array<int>, path binary")


class Members:
    """The members of some sub-trees, cut into levels of nodes."""

    def __init__(self, group: np.ndarray, n: np.ndarray, paths: list[bytes]):
        self.group, self.n = group, n
        self.rows = [counts(p) for p in paths]
        self.width = np.array([len(r) for r in self.rows])

    def pairs(self, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Members i, j of one sub-tree whose overlap bound reaches the threshold, and the bound.
        Sets of one path width are joined as they are, those of neighbouring widths folded to the
        smaller one; widths further apart differ too much in size (or are folded further)."""
        out = [[], [], []]
        widths = np.unique(self.width)
        for w in widths:
            own = np.flatnonzero(self.width == w)
            # a path can be wider than its size asks for, so sizes decide which wider members may match
            top = self.n[own].max() * 100 // t
            more = np.flatnonzero((self.width > w) & (self.n <= top))
            more = more[np.isin(self.group[more], self.group[own])]
            take = np.concatenate([own, more])
            if len(take) < 2:
                continue
            rows = np.empty((len(take), w), np.uint16 if len(more) and self.width[more].max() > 16 * w else np.uint8)
            for k, m in enumerate(take):
                r = self.rows[m]
                rows[k] = r if len(r) == w else r.reshape(w, -1).sum(1)
            folded = np.arange(len(take)) >= len(own)
            i, j, b = join_tree(self.group[take], self.n[take], rows, folded, t)
            out[0].append(take[i]), out[1].append(take[j]), out[2].append(b)
        if not out[0]:
            z = np.zeros(0, np.int64)
            return z, z, z
        return tuple(np.concatenate(x) for x in out)


def join_tree(group, n, rows, folded, t):
    """Self-join of the trees of all groups, level by level on pairs of nodes."""
    width = rows.shape[1]
    levels = min(8, width // 2)
    cuts = [width * k // levels for k in range(levels + 1)]
    _, node = np.unique(group, return_inverse=True)
    u = v = np.unique(node)
    acc, used = np.zeros(len(u), np.int64), np.zeros(len(u), np.int64)
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        chunk = rows[:, lo:hi]
        key = np.ascontiguousarray(np.concatenate([node.astype(np.int32)[:, None].view(np.uint8),
                                                   np.ascontiguousarray(chunk).view(np.uint8)], axis=1))
        _, at, child = np.unique(key.view(f"V{key.shape[1]}").ravel(), return_index=True, return_inverse=True)
        parent, chunk = node[at], chunk[at]
        spent = used[parent] + chunk.sum(1, dtype=np.int64)
        low = np.full(len(at), np.iinfo(np.int64).max)
        high = np.zeros(len(at), np.int64)
        np.minimum.at(low, child, n)
        np.maximum.at(high, child, n)
        wide = np.ones(len(at), bool)  # nothing but folded members below
        np.logical_and.at(wide, child, folded)
        by = np.argsort(parent, kind="stable")
        first = np.searchsorted(parent[by], np.arange(len(used) + 1))
        kids = np.diff(first)
        i2, j2, a2 = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        side, below = spread(by, first, kids, u)
        for s, e in runs(kids[v[side]], max(1 << 12, (1 << 23) // max(1, hi - lo))):  # about 8 MB of counts a side
            rep, cj = spread(by, first, kids, v[side[s:e]])
            ci, rep = below[s:e][rep], side[s:e][rep]
            ok = (u[rep] != v[rep]) | (ci <= cj)
            ok &= (high[ci] * 100 >= t * low[cj]) & (high[cj] * 100 >= t * low[ci]) & ~(wide[ci] & wide[cj])
            ci, cj, rep = ci[ok], cj[ok], rep[ok]
            a = acc[rep] + np.minimum(chunk[ci], chunk[cj]).sum(1, dtype=np.int64)
            rest = np.minimum(high[ci] - spent[ci], high[cj] - spent[cj])
            ok = a + rest >= need(low[ci], low[cj], t)
            i2.append(ci[ok]), j2.append(cj[ok]), a2.append(a[ok])
        u, v, acc = np.concatenate(i2), np.concatenate(j2), np.concatenate(a2)
        node, used = child, spent
    # leaves: the members below each node of a pair
    by = np.argsort(node, kind="stable")
    first = np.searchsorted(node[by], np.arange(len(used) + 1))
    kids = np.diff(first)
    side, below = spread(by, first, kids, u)
    rep, j = spread(by, first, kids, v[side])
    i, rep = below[rep], side[rep]
    ok = ((u != v)[rep] | (i < j)) & ~(folded[i] & folded[j])
    i, j, a = i[ok], j[ok], acc[rep][ok]
    small, big = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    ok = (a >= need(n[i], n[j], t)) & (small * 100 >= t * big)
    return i[ok], j[ok], a[ok]


def propose(members: DataFrame, t: int, spanning: bool) -> DataFrame:
    """Candidate pairs (a, b, gid, lo, hi) of members (gid, lo, hi, block, uid, n, path, comp): a part joins block lo
    with block hi, or one block with itself."""
    part_cols = ["gid", "lo", "hi"]

    def starts(tab):
        new = np.zeros(tab.num_rows, bool)
        new[0] = True
        for c in part_cols:
            x = tab[c].to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return new

    def run(batches):
        cols = [*part_cols, "block", "uid", "n", "path", "comp"]
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tab = pa.Table.from_batches([batch]).select(cols)
            held = tab if held is None else pa.concat_tables([held, tab])
            done = int(np.flatnonzero(starts(held))[-1])  # the last part may go on
            if done >= 2000:
                yield from work(held.slice(0, done))
                held = held.slice(done)
        if held is not None and held.num_rows:
            yield from work(held)

    def work(tab):
        comp = tab["comp"].to_numpy()
        new = starts(tab)
        one = np.logical_and.reduceat(comp == comp[np.flatnonzero(new)][np.cumsum(new) - 1], np.flatnonzero(new))
        tab = tab.filter(pa.array(~one[np.cumsum(new) - 1]))  # nothing left to link there
        if not tab.num_rows:
            return
        new = starts(tab)
        group = np.cumsum(new) - 1
        sizes = np.bincount(group)
        ends = np.cumsum(sizes)
        for s, e in runs(sizes * sizes, 1 << 21):
            sub = tab.slice(int(ends[s] - sizes[s]), int(ends[e - 1] - ends[s] + sizes[s]))
            g = group[int(ends[s] - sizes[s]):int(ends[e - 1])]
            uid, block, comp, gid, lo, hi = (sub[c].to_numpy() for c in ("uid", "block", "comp", "gid", "lo", "hi"))
            i, j, score = Members(g, sub["n"].to_numpy(), sub["path"].to_pylist()).pairs(t)
            if not len(i):
                continue
            ok = ((lo[i] == hi[i]) | (block[i] != block[j])) & (comp[i] != comp[j])
            i, j, score = i[ok], j[ok], score[ok]
            if spanning:
                k = forest(i, j, score, len(uid))
                i, j = i[k], j[k]
            a, b = np.minimum(uid[i], uid[j]), np.maximum(uid[i], uid[j])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, gid[i], lo[i], hi[i])],
                                             ["a", "b", *part_cols])

    ordered = members.repartition(*part_cols).sortWithinPartitions(*part_cols)
    return ordered.mapInArrow(tidy(run), "a long, b long, gid long, lo long, hi long")


def near_in_size(members: DataFrame, t: int) -> DataFrame:
    """(gid, uid) of the members (gid, uid, n) whose sub-tree holds another of a size that can reach t percent. Sizes are
    told apart by steps of a little more than the ratio, so two that can link are on one step or on neighbouring ones."""
    step = F.floor(F.log("n") / (max(-math.log(t / 100), 1e-9) * 1.001)).cast("long")
    members = members.withColumn("step", step)
    each = members.groupBy("gid", "step").agg(F.count("*").alias("k"))
    around = each.select("gid", F.explode(F.array(*[F.col("step") + d for d in (-1, 0, 1)])).alias("step"), "k")
    able = around.groupBy("gid", "step").agg(F.sum("k").alias("k")).filter("k > 1").select("gid", "step")
    return members.join(able, ["gid", "step"]).select("gid", "uid")


def verify(pairs: DataFrame, reps: DataFrame, docs: DataFrame, text: str, id_col: str, size: int, t: int,
           lower: bool) -> DataFrame:
    """The pairs whose full sets reach the threshold, written. Only texts in pairs are hashed again; a
    Bloom filter of fixed size keeps most others out before the shuffle."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
    wanted = cut_lineage(ids.join(reps.select("uid", "id", "s1", "s2"), "uid"), "wanted")
    bloom = FixedBloom(wanted, "id")
    shared, passes = bloom.shared, FixedBloom.passes

    def sets(batches):
        hasher, filt = Hasher(lower), shared.value
        for batch in batches:
            keep = passes(filt, batch.column(0).to_numpy())
            col = batch.column(1).filter(pa.array(keep))
            s1, s2, out = [], [], []
            for s in doc_sets(col, size, hasher):
                a, b = set_key(s)
                s1.append(a), s2.append(b), out.append(s.view(SIGNED))
            yield pa.RecordBatch.from_arrays(
                [pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                ["s1", "s2", "s"])

    rows = docs.select(bloom.mark(id_col).alias("m"), F.col(text).alias("text"))
    rows = rows.mapInArrow(tidy(sets), "s1 long, s2 long, s array<long>").dropDuplicates(["s1", "s2"])
    full = cut_lineage(rows.join(wanted, ["s1", "s2"]).select("uid", "s"), "sets")

    one = full.select(F.col("uid").alias("a"), F.col("s").alias("sa"))
    two = full.select(F.col("uid").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    links = cut_lineage(pairs.join(one, "a").join(two, "b").filter(both * 100 >= union * t).select("a", "b"), "links")
    discard(full, wanted)
    return links


def ngram_components(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", size: int = 4, percent: int = 85,
                     lower: bool = True, frequent_part: int = 8000, block: int = 1000) -> DataFrame:
    """One row per input row: a row key, ``id_col``, n_shingles, component_id, a digest of the text, and the
    component's inner number (null without n-grams).

    Texts link when the Jaccard similarity of their word n-gram sets is at least
    ``percent``; a text with fewer than ``size`` words is one n-gram; null text, empty
    text and text without words have no n-gram and link with nothing. component_id is
    the smallest id reachable, the row's own included; rows with a null id keep a null id of their own, yet
    pass links on. Rows that repeat a text or an id are rows of their own and link by text.
    Empty table: no rows.
    """
    small_batches(docs.sparkSession)
    frequent = frequent_ngrams(docs, text, size, lower, frequent_part, 1 << 20)
    rows = cut_lineage(describe(docs, text, id_col, size, percent, lower, frequent), "sets")
    reps = (rows.filter("n > 0").groupBy("s1", "s2", "n")
            .agg(F.min("uid").alias("uid"), F.min("id").alias("low"), F.min_by("id", "uid").alias("id"),
                 F.first("edges").alias("edges"), F.first("path").alias("path")))
    reps = cut_lineage(reps, "classes")

    # dealt by edge once, for the groups and for the join back to them
    postings = reps.select("uid", F.explode("edges").alias("edge")).repartition("edge")
    # the sub-trees of all edges with the same smallest class are one, so near copies meet once, not once an edge
    by_edge = postings.groupBy("edge").agg(F.min("uid").alias("gid"), F.count("*").alias("k")).filter("k > 1")
    met = cut_lineage(postings.join(by_edge, "edge").select("gid", "uid").distinct(), "members")
    members = cut_lineage(near_in_size(met.join(reps.select("uid", "n"), "uid"), percent), "members")
    discard(met)
    sizes = cut_lineage(members.groupBy("gid").agg(F.ceil(F.count("*") / block).alias("blocks")), "sizes")

    def dealt(salt: int, own: DataFrame) -> DataFrame:
        at = F.pmod(F.xxhash64("uid", F.lit(salt)), F.col("blocks"))
        return members.join(own, "gid").select("gid", "uid", "blocks", at.alias("block"))

    def described(of: DataFrame, comp: DataFrame) -> DataFrame:
        info = reps.select("uid", "n", "path").join(comp, F.col("uid") == F.col("node"), "left").select(
            "uid", "n", "path", F.coalesce("component", "uid").alias("comp"))
        return of.join(info, "uid")

    def check(pairs: DataFrame) -> DataFrame:
        return verify(pairs, reps, docs, text, id_col, size, percent, lower)

    def forests(of: DataFrame, comp: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Proposals of every block for itself, and those of them that are links."""
        own = of.select("gid", "uid", "block", F.col("block").alias("lo"), F.col("block").alias("hi"))
        tried = cut_lineage(propose(described(own, comp), percent, True), "pairs")
        return tried, check(tried.select("a", "b").distinct())

    spark = docs.sparkSession
    comp = spark.createDataFrame([], "node long, component long")
    tried, links = forests(dealt(2, sizes), comp)
    comp = cut_lineage(smallest_reachable(links), "components")
    large = sizes.filter("blocks > 1")
    if not large.isEmpty():
        again, more = forests(dealt(3, large), comp)
        tried, links = tried.union(again), links.union(more)
        comp = cut_lineage(smallest_reachable(links), "components")
    # only a sub-tree with a proposal that failed, or one of several blocks, can hold another pair that joins components
    failed = cut_lineage(tried.join(links, ["a", "b"], "left_anti"), "failed")
    whole = (members.join(large, "gid").join(comp, F.col("uid") == F.col("node"), "left").groupBy("gid", "blocks")
             .agg(F.min(F.coalesce("component", "uid")).alias("x"), F.max(F.coalesce("component", "uid")).alias("y"))
             .filter("x <> y").select("gid", "blocks"))
    open_ = failed.select("gid").distinct().join(sizes, "gid").filter("blocks = 1").union(whole)
    open_ = cut_lineage(open_, "open")
    if not open_.isEmpty():
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("o")
        left = dealt(2, open_).select("gid", "uid", "block", other).select(
            "gid", "uid", "block", F.least("block", "o").alias("lo"), F.greatest("block", "o").alias("hi"))
        rest = propose(described(left, comp), percent, False).select("a", "b").distinct()
        rest = rest.join(failed.select("a", "b").distinct(), ["a", "b"], "left_anti")
        comp = smallest_reachable(links.union(check(cut_lineage(rest, "pairs"))))
    discard(members, sizes)
    low = reps.select("s1", "s2", "n", "uid", "low").join(comp, F.col("uid") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "uid"))
    least = low.groupBy("component").agg(F.min("low").alias("component_id"))
    names = low.join(least, "component").select("s1", "s2", F.col("n").alias("m"), "component", "component_id")
    out = rows.select("uid", "id", "digest", "n", "s1", "s2").join(
        names, (F.col("n") == F.col("m")) & (rows.s1 == names.s1) & (rows.s2 == names.s2), "left")
    return out.select("uid", F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
                      "digest", "component")


def keep_one_per_component(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that stay: of each component one with the smallest id (a null id loses to
    others), and every row without n-grams. Columns as in ``docs``."""
    text, id_col = kw.get("text", "text"), kw.get("id_col", "doc_id")
    found = cut_lineage(ngram_components(docs, **kw), "components")
    stay = found.filter("component is not null").groupBy("component").agg(F.min(F.struct(
        F.col(id_col).isNull().alias("z"), F.col(id_col).alias("id"), "uid", "digest")).alias("s")).select("s.*")
    alone = found.filter("component is null").select(F.col(id_col).alias("id"), "uid", "digest")
    chosen = stay.select("id", "uid", "digest").unionByName(alone).groupBy("id", "digest").agg(F.count("*").alias("k"))
    # rows that agree in id and text are interchangeable: all of them stay, one, or none
    every = found.groupBy(F.col(id_col).alias("id"), "digest").agg(F.count("*").alias("n"))
    held = every.join(chosen, every.id.eqNullSafe(chosen.id) & (every.digest == chosen.digest), "left").select(
        every.id, every.digest, F.coalesce("k", F.lit(0).cast("long")).alias("k"), "n").filter("k < n")

    def both(id_: Column, digest: Column) -> Column:
        return F.xxhash64(id_, id_.isNull(), digest)

    return rows_that_stay(docs, both(F.col(id_col), text_digest(text)),
                          held.select(both(F.col("id"), F.col("digest")).alias("both"), "k"))
