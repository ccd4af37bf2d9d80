"""Substring deduplication by fixed-block anchors.

Every text's non-overlapping blocks of half a window are indexed (block hash -> smallest and
largest document). Any window contains a whole block of the text it is copied from, so every text
probes the index with all its rolling windows of block size; the probes travel as packed cells (32-bit
fingerprint and word distance, about five bytes each) to the bucket of the index that
answers them. Only texts with hits go on: hits are extended to all windows around them, whose hashes
decide exactly which windows also start in an earlier document, and the covered words are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import FixedBloom
from panelkit.llm.textops import Hasher, U, mix, slices
from panelkit.session import cut_lineage

KEY = ["id", "h1", "h2"]


def text_names(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per text that name its word sequence."""
    n = np.diff(at).astype(U)
    out = []
    for base in (0x9FB21C651E98DF25 | 1, 0xC2B2AE3D27D4EB4F | 1):
        powers = np.full(len(h) + 1, base, U)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=U)
        inverse = np.full(len(h) + 1, pow(base, -1, 1 << 64), U)
        inverse[0] = 1
        inverse = np.cumprod(inverse, dtype=U)
        sums = np.concatenate([[U(0)], np.cumsum(h * powers[:-1], dtype=U)])
        out.append(mix((sums[at[1:]] - sums[at[:-1]]) * inverse[at[:-1]] + n).view(np.int64))
    return out[0], out[1]


def pack_gaps(loc: np.ndarray) -> np.ndarray:
    """Increasing positions as bytes: a gap is so many 255 and one smaller byte."""
    gap = np.diff(loc, prepend=0)
    full = gap // 255
    out = np.full(int(full.sum()) + len(gap), 255, np.uint8)
    out[np.cumsum(full + 1) - 1] = gap % 255
    return out


def unpack_gaps(b: np.ndarray) -> np.ndarray:
    return np.cumsum(b.astype(np.int64))[b != 255]


def in_text(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """For every word position below n whether a run of ``size`` words from it stays in its text."""
    last = np.repeat(at[1:], np.diff(at))[:n]
    return np.arange(n) + size <= last


def block_index(docs: DataFrame, window: int, block: int, buckets: int) -> DataFrame:
    """(bucket, f, multi): fingerprints of all non-overlapping blocks and whether several documents hold them, a
    sixteenth of a bucket to a row."""
    def run(batches):
        hasher = Hasher(False)
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, off in slices(batch.column(1)):
                h, _, _, at = hasher.words(data, off)
                w = hasher.windows(h, block)
                first = np.repeat(at[:-1], np.diff(at))[:len(w)]
                long = np.repeat(np.diff(at) >= window, np.diff(at))[:len(w)]
                p = np.flatnonzero(((np.arange(len(w)) - first) % block == 0) & long & in_text(at, len(w), block))
                f, doc = w[p], np.searchsorted(at, p, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(((f >> U(32)) % U(buckets)).astype(np.int32)), pa.array(f.astype(np.uint32).view(np.int32)),
                     ids.slice(i, j - i).take(pa.array(doc))], ["bucket", "f", "id"])

    rows = docs.filter("id is not null").select("id", "text").mapInArrow(run, "bucket int, f int, id long")
    held = rows.groupBy("bucket", "f").agg((F.min("id") != F.max("id")).alias("multi"))
    return held.groupBy("bucket", F.pmod("f", F.lit(16)).alias("part")).agg(
        F.collect_list("f").alias("f"), F.collect_list("multi").alias("multi"))


CELL = ("bucket int, kind int, f array<int>, multi array<boolean>, chunk long, data binary, ids array<long>, "
        "first array<int>, h1 array<long>, h2 array<long>, sha array<string>")


def probe_cells(docs: DataFrame, window: int, block: int, buckets: int) -> DataFrame:
    """Packed probes of all texts: per slice of texts and bucket one cell of the rolling windows off
    the block grid (kind 1), one of those on it (kind 2), and a row that lists the slice's texts (kind 3)."""
    def run(batches):
        from pyspark import TaskContext
        hasher, chunk = Hasher(False), TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, j, data, off in slices(batch.column(1)):
                chunk += 1
                h, _, _, at = hasher.words(data, off)
                w = hasher.windows(h, block)
                first = np.repeat(at[:-1], np.diff(at))[:len(w)]
                long = np.repeat(np.diff(at) >= window, np.diff(at))[:len(w)]
                ok = in_text(at, len(w), block) & long
                grid = (np.arange(len(w)) - first) % block == 0
                bucket = ((w >> U(32)) % U(buckets)).astype(np.int32)
                out = {k: [] for k in ("bucket", "kind", "data")}
                for kind, take in ((1, ok & ~grid), (2, ok & grid)):
                    loc = np.flatnonzero(take)
                    loc = loc[np.argsort(bucket[loc], kind="stable")]
                    b, at_b = np.unique(bucket[loc], return_index=True)
                    for k, (s, e) in enumerate(zip(at_b, [*at_b[1:], len(loc)])):
                        p = loc[s:e]
                        out["bucket"].append(int(b[k])), out["kind"].append(kind)
                        out["data"].append(np.uint32(e - s).tobytes() + w[p].astype(np.uint32).tobytes()
                                           + pack_gaps(p).tobytes())
                h1, h2 = text_names(h, at)
                raw = data.tobytes()
                sha = [hashlib.sha256(b" ".join(raw[off[k]:off[k + 1]].split())).hexdigest() for k in range(j - i)]
                n = len(out["data"])
                lists = [batch.column(0).slice(i, j - i).to_pylist(), at.tolist(), h1.tolist(), h2.tolist(), sha]
                cols = [out["bucket"] + [chunk % buckets], out["kind"] + [3], [None] * (n + 1), [None] * (n + 1),
                        [chunk] * (n + 1), out["data"] + [None], *[[None] * n + [x] for x in lists]]
                kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.int64(), pa.binary(),
                         pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()),
                         pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 [c.split()[0] for c in CELL.split(", ")])

    return docs.select("id", "text").mapInArrow(run, CELL)


def answer_probes(cells: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """Positions whose block another document holds on its grid. A bucket's index rows come first and are
    held (their number is bounded by the choice of ``buckets``); its cells stream by."""
    names = [c.split()[0] for c in CELL.split(", ")]
    idx = index.select(*[F.col(c) if c in ("bucket", "f", "multi") else
                         F.lit(0).alias(c) if c == "kind" else F.lit(None).alias(c) for c in names])
    both = cells.unionByName(idx).repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")

    def run(batches):
        now, f, multi, held = None, None, None, []
        for batch in batches:
            bucket, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1))
            chunk, loc, lists = [], [], []
            for s, e in zip(edges, [*edges[1:], len(bucket)]):
                if bucket[s] != now:
                    now, held, f = bucket[s], [], None
                m = s + int(np.searchsorted(kind[s:e], 1))
                if m > s:
                    part = batch.slice(s, m - s)
                    held.append((part.column(2).flatten().to_numpy().view(np.uint32),
                                 part.column(3).flatten().to_numpy(zero_copy_only=False)))
                for r in range(m, e):
                    if kind[r] == 3:
                        chunk.append(batch.column(4)[r].as_py()), loc.append(None)
                        lists.append([batch.column(c)[r].as_py() for c in range(6, 11)])
                        continue
                    if f is None:
                        f = np.concatenate([x for x, _ in held]) if held else np.zeros(0, np.uint32)
                        multi = np.concatenate([x for _, x in held]) if held else np.zeros(0, bool)
                        order = np.argsort(f)
                        f, multi = f[order], multi[order]
                    if not len(f):
                        continue
                    d = np.frombuffer(batch.column(5)[r].as_buffer(), np.uint8)
                    n = int(d[:4].view(np.uint32)[0])
                    q = np.frombuffer(d[4:4 + 4 * n].tobytes(), np.uint32)
                    at = np.minimum(np.searchsorted(f, q), len(f) - 1)
                    hit = f[at] == q
                    if kind[r] == 2:  # its own block is in the index, so another document must hold it too
                        hit &= multi[at]
                    if hit.any():
                        chunk.append(batch.column(4)[r].as_py())
                        loc.append(unpack_gaps(d[4 + 4 * n:])[hit].tolist()), lists.append([None] * 5)
            if chunk:
                cols = [pa.array(chunk, pa.int64()), pa.array(loc, pa.list_(pa.int32()))]
                for c, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())):
                    cols.append(pa.array([x[c] for x in lists], pa.list_(t)))
                yield pa.RecordBatch.from_arrays(cols, ["chunk", "loc", "ids", "first", "h1", "h2", "sha"])

    return both.mapInArrow(run, "chunk long, loc array<int>, ids array<long>, first array<int>, "
                                "h1 array<long>, h2 array<long>, sha array<string>")


def hit_texts(answers: DataFrame, window: int, block: int) -> DataFrame:
    """(id, h1, h2, n, sha, starts, ends) per text: ranges of windows that contain a hit (ends exclusive)."""
    def run(batches):
        now, locs = None, []
        for batch in batches:
            rows = []
            for chunk, loc, ids, first, h1, h2, sha in zip(*[c.to_pylist() for c in batch.columns]):
                if chunk != now:
                    now, locs = chunk, []
                if ids is None:
                    locs.append(np.array(loc, np.int64))
                    continue
                p = np.sort(np.concatenate(locs)) if locs else np.zeros(0, np.int64)
                cut = np.searchsorted(p, first)
                for k in range(len(ids)):
                    n, own = first[k + 1] - first[k], p[cut[k]:cut[k + 1]] - first[k]
                    lo = np.maximum(own - (window - block), 0)
                    hi = np.minimum(own + 1, n - window + 1)
                    lo, hi = lo[lo < hi], hi[lo < hi]
                    if len(lo):
                        new = np.concatenate([[True], lo[1:] > np.maximum.accumulate(hi)[:-1]])
                        hi = np.append(np.maximum.accumulate(hi)[np.flatnonzero(new)[1:] - 1], hi[-1])
                        lo = lo[new]
                    rows.append((ids[k], h1[k], h2[k], n, sha[k], lo.tolist(), hi.tolist()))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                         pa.list_(pa.int32()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                 ["id", "h1", "h2", "n", "sha", "starts", "ends"])

    # within a slice its hits come before the list of its texts
    ordered = (answers.withColumn("last", F.col("ids").isNotNull()).repartition("chunk")
               .sortWithinPartitions("chunk", "last").drop("last"))
    return ordered.mapInArrow(run, "id long, h1 long, h2 long, n long, sha string, starts array<int>, ends array<int>")


#: Windows held by more rows than these, and by more than one in so many, are hot.
LEAST_HOT, HOT_PARTS = 5_000, 10_000


def fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (distinct KEY columns and more) with the texts it names."""
    bloom = FixedBloom(wanted, "id")
    shared, passes = bloom.shared, FixedBloom.passes

    def run(batches):
        hasher, filt = Hasher(False), shared.value
        for batch in batches:
            batch = batch.filter(pa.array(passes(filt, batch.column(0).to_numpy())))
            for i, j, data, off in slices(batch.column(2)):
                h, _, _, at = hasher.words(data, off)
                h1, h2 = text_names(h, at)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(h1), pa.array(h2), part.column(2)],
                                                 [*KEY, "text"])

    rows = docs.filter("id is not null").select(bloom.mark("id").alias("m"), "id", "text")
    texts = rows.mapInArrow(run, "id long, h1 long, h2 long, text string").dropDuplicates(KEY)
    return texts.join(wanted, KEY)


def repeated_positions(texts: DataFrame, window: int) -> DataFrame:
    """(id, h1, h2, cover): windows within the hit ranges that also start in a smaller document, one or more rows a text."""
    def run(batches):
        hasher = Hasher(False)
        for batch in batches:
            for i, j, data, off in slices(batch.column(3)):
                h, _, _, at = hasher.words(data, off)
                w = hasher.windows(h, window)
                starts, ends = (batch.column(c).slice(i, j - i).to_pylist() for c in (4, 5))
                pos, doc = [], []
                for k in range(j - i):
                    own = [np.arange(s, e) for s, e in zip(starts[k], ends[k])]
                    pos += own
                    doc.append(sum(map(len, own)))
                p, doc = np.concatenate(pos), np.repeat(np.arange(j - i), doc)
                names = batch.slice(i, j - i)
                names = [names.column(c).take(pa.array(doc)) for c in range(3)]
                yield pa.RecordBatch.from_arrays([*names, pa.array(w[p + at[doc]].view(np.int64)),
                                                  pa.array(p.astype(np.int32))], [*KEY, "w", "at"])

    rows = texts.select(*KEY, "text", "starts", "ends").mapInArrow(run, "id long, h1 long, h2 long, w long, at int")
    rows = cut_lineage(rows, "windows")
    owners = rows.groupBy("w").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).filter("lo < hi")
    owners = cut_lineage(owners.drop("hi"), "owners")
    # a window that more than one in HOT_PARTS rows hold is sent to its rows (fewer than HOT_PARTS such windows), others meet by a shuffle
    often = max(LEAST_HOT, rows.count() // HOT_PARTS)
    hot = owners.filter(F.col("n") > often).select("w", "lo").orderBy("w").toArrow()
    shared = texts.sparkSession.sparkContext.broadcast((hot["w"].to_numpy(), hot["lo"].to_numpy()))

    def find(w):
        """For every window whether it is hot, and its smallest document if so."""
        names, lo = shared.value
        if not len(names):
            return np.zeros(len(w), bool), w
        at = np.minimum(np.searchsorted(names, w), len(names) - 1)
        return names[at] == w, lo[at]

    def others(batches):
        for batch in batches:
            yield batch.filter(pa.array(~find(batch.column(3).to_numpy())[0]))

    def covers(batches):
        """The hot windows of a text with a smaller owner, one row for each run of the text's rows."""
        for batch in batches:
            is_hot, lo = find(batch.column(3).to_numpy())
            part = batch.filter(pa.array(is_hot & (batch.column(0).to_numpy() > lo)))
            if part.num_rows:
                keys = np.stack([part.column(c).to_numpy() for c in range(3)])
                starts = np.flatnonzero(np.append(True, (np.diff(keys) != 0).any(0)))
                cover = pa.ListArray.from_arrays(pa.array(np.append(starts, part.num_rows), pa.int32()), part.column(4))
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(starts)) for c in range(3)), cover],
                                                 [*KEY, "cover"])

    cold = rows.mapInArrow(others, rows.schema)
    few = cold.join(owners.filter(F.col("n") <= often).select("w", "lo"), "w").filter("id > lo")
    few = few.groupBy(*KEY).agg(F.collect_list("at").alias("cover"))
    return rows.mapInArrow(covers, "id long, h1 long, h2 long, cover array<int>").unionByName(few)


def remove_repeats(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", window: int = 50,
                   bucket_bytes: int = 6 << 20, most_buckets: int = 20_000) -> DataFrame:
    """One row per input row: ``id_col``, n_words, n_removed, kept_sha256 and kept (the words
    that stay, joined by one space; null where nothing was removed: the text's own words).

    A word goes if a run of ``window`` words that covers it also starts in a row with a
    smaller id (integral ids). Words are unchanged runs between ASCII white space; null text has none. Rows
    with a null id are neither removed from nor a source. Rows that share an id do not
    count as smaller than each other. Texts with the same words as a smaller row are removed whole if they hold a
    window. Empty table: no rows. The index has a bucket per ``bucket_bytes`` of text, beyond
    ``most_buckets`` larger ones. Windows are compared by 64-bit hashes of 64-bit word hashes.
    """
    block = window // 2
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(max(8, -(-size // bucket_bytes)), most_buckets)
    index = block_index(docs, window, block, buckets)
    answers = cut_lineage(answer_probes(probe_cells(docs, window, block, buckets), index, buckets), "hits")
    info = cut_lineage(hit_texts(answers, window, block), "texts")
    known = info.filter("id is not null and n >= %d" % window)
    low = known.filter(F.size("starts") > 0).groupBy("h1", "h2").agg(F.min("id").alias("low"))
    hit = known.filter(F.size("starts") > 0).dropDuplicates(KEY).join(low, ["h1", "h2"])
    first = cut_lineage(hit.filter("id = low").select(*KEY, "starts", "ends"), "firsts")
    covered = repeated_positions(fetch(docs, first), window).groupBy(*KEY).agg(
        F.flatten(F.collect_list("cover")).alias("cover"))
    covered = cut_lineage(covered, "covered")
    schema = "id long, h1 long, h2 long, n_removed long, kept string"

    def cut(batches):
        for batch in batches:
            removed, kept = [], []
            for t, cover in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                words = t.encode().split()
                edge = np.zeros(len(words) + 1, np.int64)
                cover = np.array(cover)
                np.add.at(edge, cover, 1)
                np.add.at(edge, cover + window, -1)
                stay = np.cumsum(edge)[:-1] == 0
                removed.append(int((~stay).sum()))
                kept.append(b" ".join([words[k] for k in np.flatnonzero(stay)]).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.string())], [*KEY, "n_removed", "kept"])

    parts = fetch(docs, covered).select(*KEY, "text", "cover").mapInArrow(cut, schema)
    copies = hit.filter("id > low").select(*KEY, F.col("n").alias("n_removed"), F.lit("").alias("kept"))
    gone = parts.unionByName(copies)
    out = info.join(gone, KEY, "left")
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_words"),
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.when(F.col("kept").isNull(), F.col("sha")).otherwise(F.sha2("kept", 256)).alias("kept_sha256"), "kept")
