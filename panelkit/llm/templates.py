"""Main text of HTML pages by equivalence classes of template tokens.

A token is a structural tag or a word, together with the path of elements it stands in. Pages meet by host, a large host in
parts. A token that stands on half of the pages of every part can belong to the template; its occurrence vector is
summed to a fingerprint part by part, and Spark adds the parts up, so no vector is ever gathered. Tokens of one vector are an
equivalence class; large classes are candidates for the template of the host. Each page then checks the candidates: the tokens of a class come in one order in every round
(ordered), and a class lies inside one gap of another one (nested). Classes that fail on any page are dropped,
the valid ones nest into the template, and what stands between its tokens are the slots.

Slots give the text: those inside the article (else the main element, else the page without its marked
parts and link lists), block by block. Text that is template itself (the same words on all pages of the class,
such as a notice inside the article) goes if it is small against the text in slots; articles that are copies of each
other are template-like too, but they have little else beside them, and stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.markup import Page
from panelkit.llm.textops import Hasher, U, mix
from panelkit.session import cut_lineage

SIGNED = np.int64
#: At most so many hosts are split (a broadcast table of one row each).
SPLIT_HOSTS = 100_000


def page_tokens(pages: list[list], hasher: Hasher) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per page 64 bits per token, and per item the place of its first token (one more at the end)."""
    items = [i for page in pages for i in page]
    path = np.array([i[0] for i in items], U)
    texts = pa.array([i[1] or "" for i in items], pa.large_binary())
    off = np.frombuffer(texts.buffers()[1], np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    h, _, _, at = hasher.words(data, off)
    tag = np.array([i[1] is None for i in items], bool)
    count = np.where(tag, 1, np.diff(at))
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.repeat(path, count)
    word = np.repeat(~tag, count)
    out[word] = mix(out[word] ^ h)
    out[~word] = mix(out[~word] + U(1))
    out = out.view(SIGNED)
    ends = np.concatenate([[0], np.cumsum([len(page) for page in pages])])
    return [(out[first[a]:first[b]], first[a:b + 1] - first[a]) for a, b in zip(ends[:-1], ends[1:])]


def read_pages(batch: pa.RecordBatch, column: int, paths: dict, hasher: Hasher, step: int = 256) -> Iterator[tuple]:
    """(row, items, tokens, places) of the pages of a batch."""
    for s in range(0, batch.num_rows, step):
        pages = [Page(h or "", paths).items for h in batch.column(column).slice(s, step).to_pylist()]
        for k, (items, (tokens, first)) in enumerate(zip(pages, page_tokens(pages, hasher))):
            yield s + k, items, tokens, first


def count_vectors(pages: DataFrame, least_pages: int, unit: int = 1 << 20) -> DataFrame:
    """(host, token, pages, print) of pages (host, salt, key, html) whose hosts or parts of hosts come together: the tokens that
    stand on half of the pages of a part, on how many they stand, and the sum of hashes of (page, times there). A row
    without token opens every part. A part with more than ``unit`` distinct tokens ends early, the next goes on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, paths = Hasher(lower=False), {}
        own, held, n, size = None, [], 0, 0
        out, waiting = [], 0

        def total():
            token, count, vec = (np.concatenate(x) for x in zip(*held))
            by = np.argsort(token, kind="stable")
            new = np.flatnonzero(np.concatenate([[True], token[by][1:] != token[by][:-1]]))
            return token[by][new], np.add.reduceat(count[by], new), np.add.reduceat(vec[by], new)

        def close():
            if not held or own[1] < 0 and n < least_pages:
                return  # a whole host with too few pages has no template
            token, count, vec = total()
            ok = count * 2 >= n
            out.append((own[0], n, token[ok], count[ok], vec[ok]))

        def batch_of():
            sizes = [len(o[2]) + 1 for o in out]
            hosts = pa.array([o[0] for o in out], pa.string()).take(pa.array(np.repeat(np.arange(len(out)), sizes)))
            head = np.zeros(sum(sizes), bool)
            head[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = True
            cols = [np.concatenate([np.concatenate([[a], o[k].view(SIGNED)]) for o, a in zip(out, first)])
                    for k, first in ((2, [0] * len(out)), (3, [o[1] for o in out]), (4, [0] * len(out)))]
            return pa.RecordBatch.from_arrays([hosts, pa.array(cols[0], mask=head), pa.array(cols[1]), pa.array(cols[2])],
                                              ["host", "token", "pages", "print"])

        for batch in batches:
            hosts, salts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keys = batch.column(2).to_numpy().view(U)
            for k, _, tokens, _ in read_pages(batch, 3, paths, hasher):
                if (hosts[k], salts[k]) != own:
                    close()
                    waiting += len(out[-1][2]) if out else 0
                    own, held, n, size = (hosts[k], salts[k]), [], 0, 0
                    if waiting > 100_000:
                        yield batch_of()
                        out.clear()
                        waiting = 0
                token, times = np.unique(tokens, return_counts=True)
                held.append((token, np.ones(len(token), np.int64), mix(keys[k] ^ mix(times.astype(U)))))
                n, size = n + 1, size + len(token)
                if size > 4 * unit:
                    held = [total()]
                    size = len(held[0][0])
                    if size > unit:
                        close()
                        held, n, size = [], 0, 0
        close()
        if out:
            yield batch_of()

    return pages.select("host", "salt", "key", "html").mapInArrow(run, "host string, token long, pages long, print long")


def candidate_classes(vectors: DataFrame, least_pages: int, least_tokens: int) -> DataFrame:
    """(host, template): per host its candidate tokens (token, class), those of every part of the host. A part passes on at
    most twice as many tokens as its pages have on average, so this bounds a host's template too."""
    parts = vectors.filter("token is null").groupBy("host").agg(F.count("*").alias("all"), F.sum("pages").alias("n"))
    tokens = vectors.filter("token is not null").groupBy("host", "token").agg(
        F.count("*").alias("parts"), F.sum("pages").alias("pages"), F.sum(F.col("print").cast("decimal(20,0)")).alias("print"))
    tokens = tokens.join(parts, "host").filter((F.col("parts") == F.col("all")) & (F.col("pages") >= least_pages))
    tokens = tokens.select("host", "token", F.xxhash64("pages", "print").alias("class"))
    large = tokens.groupBy("host", "class").agg(F.collect_list("token").alias("t")).filter(F.size("t") >= least_tokens)
    return (large.select("host", "class", F.explode("t").alias("token")).groupBy("host")
            .agg(F.array_sort(F.collect_list(F.struct("token", "class"))).alias("template")))


def attach(pages: DataFrame, by_host: DataFrame, entries: str, limit: int) -> DataFrame:
    """``by_host`` (written, one row a host) joined to pages. With at most ``limit`` entries altogether it goes to every
    task; beyond that, pages are shuffled to it by (host, salt), so a large host is as many keys as it has salts."""
    total = by_host.agg(F.sum(F.size(entries)), F.count("*")).first()
    if (total[0] or 0) + total[1] <= limit:
        return pages.join(F.broadcast(by_host), "host", "left")
    parts = pages.select("host", "salt").distinct()
    return pages.join(parts.join(by_host, "host"), ["host", "salt"], "left")


def check_order(classes: np.ndarray, tokens: np.ndarray, sizes: dict[int, int]) -> list[tuple[int, int, bool]]:
    """(class, order, valid) of one page: ``tokens`` of ``classes`` in page order."""
    seen, orders, bad = {}, {}, set()
    stack: list[int] = []
    for c, t in zip(classes.tolist(), tokens.tolist()):
        k = seen.get(c, 0)
        place, size = k % sizes[c], sizes[c]
        seen[c] = k + 1
        order = orders.setdefault(c, [])
        if k < size:
            order.append(t)
        elif order[place] != t:
            bad.add(c)
        if place == 0:
            stack.append(c)
        elif c in bad:
            continue
        elif stack and stack[-1] == c:
            pass
        elif c in stack:  # classes that opened since are crossed by this one
            while stack[-1] != c:
                bad.add(stack.pop())
        else:
            bad.add(c)
        if place == size - 1 and stack and stack[-1] == c:
            stack.pop()
    bad |= {c for c, k in seen.items() if k % sizes[c] or len(set(orders[c])) != sizes[c]}
    return [(c, hash(tuple(o)), c not in bad) for c, o in orders.items()]


def read_slots(pages: DataFrame, kind: str) -> DataFrame:
    """Per page its blocks in slots and the checks of the candidate classes that it holds."""
    def one(items, t, first, template):
        tok, cls, sizes = template
        at = np.minimum(np.searchsorted(tok, t), max(0, len(tok) - 1))
        held = tok[at] == t if len(tok) else np.zeros(len(t), bool)
        own = np.flatnonzero(held)
        checks = check_order(cls[at[own]], t[own], sizes)
        # the slot of a block is the template token before it
        before = np.maximum.accumulate(np.where(held, np.arange(len(t)), -1)) if len(t) else t
        fixed = np.concatenate([[0], np.cumsum(held)])
        part = max((i[2] for i in items if i[1]), default=0)
        rows = []
        for k, (_, text, p, links) in enumerate(items):
            if text is None or p != part:
                continue
            a, b = first[k], first[k + 1]
            names = np.unique(cls[at[a:b]]).tolist() if fixed[b] - fixed[a] == b - a else []
            rows.append((text, int(b - a), names, int(before[a - 1]) if a else -1, links))
        if part == 0:  # no article and no main element: slots that are mostly links are lists of links
            size, link = {}, {}
            for text, _, _, slot, links in rows:
                size[slot] = size.get(slot, 0) + len(text)
                link[slot] = link.get(slot, 0) + links
            rows = [r for r in rows if link[r[3]] * 2 <= size[r[3]]]
        return part, rows, checks

    def lists(sizes, values):
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)

    def table(ids, out):
        blocks = [r for _, rows, _ in out for r in rows]
        names = lists([len(r[2]) for r in blocks], pa.array([c for r in blocks for c in r[2]], pa.int64()))
        rows = pa.StructArray.from_arrays([pa.array([r[0] for r in blocks], pa.string()), pa.array([r[1] for r in blocks], pa.int32()), names],
                                          ["text", "words", "classes"])
        found = [c for *_, checks in out for c in checks]
        marks = pa.StructArray.from_arrays([pa.array([c[k] for c in found], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))],
                                           ["class", "order", "valid"])
        return pa.RecordBatch.from_arrays(
            [*ids, pa.array([o[0] for o in out], pa.int32()), lists([len(o[1]) for o in out], rows), lists([len(o[2]) for o in out], marks)],
            ["page_id", "url", "host", "salt", "part", "blocks", "checks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, paths = Hasher(lower=False), {}
        held, template = None, None
        for batch in batches:
            hosts = batch.column(2).to_pylist()
            out, n, done = [], 0, 0
            for k, items, tokens, first in read_pages(batch, 4, paths, hasher):
                if hosts[k] != held or template is None:
                    held, t = hosts[k], batch.column(5)[k]
                    tok, cls = ((t.values.field(f).to_numpy().astype(SIGNED) for f in ("token", "class")) if t.is_valid
                                else (np.zeros(0, SIGNED), np.zeros(0, SIGNED)))
                    template = tok, cls, dict(zip(*(x.tolist() for x in np.unique(cls, return_counts=True))))
                out.append(one(items, tokens, first, template))
                n += sum(len(r[0]) for r in out[-1][1])
                if n >= 4 << 20 or k + 1 == batch.num_rows:
                    yield table([batch.column(c).slice(done, k + 1 - done) for c in range(4)], out)
                    out, n, done = [], 0, k + 1

    return pages.select("page_id", "url", "host", "salt", "html", "template").mapInArrow(
        run, f"page_id {kind}, url string, host string, salt long, part int, blocks array<struct<text:string,words:int,"
             "classes:array<bigint>>>, checks array<struct<class:bigint,order:bigint,valid:boolean>>")


def main_text(pages: DataFrame, *, id_col: str = "page_id", url: str = "url", html: str = "html", least_pages: int = 4,
              least_tokens: int = 3, notice: int = 4, split: int = 500, broadcast_entries: int = 1 << 19) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page, blocks in page order joined by a line feed.

    Null or empty html and pages without text give an empty text; rows that repeat are rows of their own; a null id
    or url stays null (the pages without a host are one host). Character references are decoded, white space inside a block
    is one space. Hosts with fewer than ``least_pages`` pages have no template: there the page is one slot.
    Template text goes if it is at most a ``notice``-th of the words beside it. Large hosts are
    worked on in parts of about ``split`` pages. Templates go to every task up to ``broadcast_entries`` tokens (16
    bytes each), beyond that pages are shuffled to them. Other columns are not looked at. Empty table: no rows.
    """
    kind = dict(pages.dtypes)[id_col]
    host = F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.coalesce(host, F.lit("")).alias("host"),
                        F.xxhash64(F.col(id_col), F.col(url)).alias("key"), F.col(html).alias("html"))
    counts = cut_lineage(rows.groupBy("host").agg(F.count("*").alias("n")), "hosts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    unit = max(split, total // SPLIT_HOSTS)
    large = counts.filter(F.col("n") > unit).select(F.col("host").alias("h"), F.ceil(F.col("n") / unit).alias("salts"))
    # fewer than SPLIT_HOSTS hosts have more than ``unit`` pages, so this side is bounded; -1: the whole host
    salt = F.coalesce(F.pmod("key", F.col("salts")), F.lit(-1)).cast("long").alias("salt")
    salted = rows.join(F.broadcast(large), F.col("host") == F.col("h"), "left").select(
        "page_id", "url", "host", "key", "html", salt)
    parts = salted.select("host", "salt", "key", "html").repartition("host", "salt").sortWithinPartitions("host", "salt", "key")
    vectors = cut_lineage(count_vectors(parts, least_pages), "vectors")
    template = cut_lineage(candidate_classes(vectors, least_pages, least_tokens), "templates")
    read = cut_lineage(read_slots(attach(salted, template, "template", broadcast_entries), kind), "slots")

    bad = (read.select("host", F.explode("checks").alias("c")).groupBy("host", F.col("c.class").alias("class"))
           .agg((F.min("c.order") != F.max("c.order")).alias("moves"), F.min("c.valid").alias("valid"))
           .filter("moves or not valid").groupBy("host").agg(F.collect_list("class").alias("bad")))
    read = read.drop("checks")
    fixed = F.exists("blocks", lambda b: F.size(b["classes"]) > 0)
    judged = attach(read.filter(fixed), cut_lineage(bad, "bad"), "bad", broadcast_entries)

    def is_template(b):
        return (F.size(b["classes"]) > 0) & ~F.coalesce(F.arrays_overlap(b["classes"], "bad"), F.lit(False))

    def words(keep):
        return F.aggregate(F.filter("blocks", keep), F.lit(0).cast("long"), lambda n, b: n + b["words"])

    slot = words(lambda b: ~is_template(b))
    small = F.when(F.col("part") > 0, words(is_template) * notice <= slot).otherwise(slot > 0)
    judged = judged.withColumn("small", small).withColumn(
        "blocks", F.when(F.col("small"), F.filter("blocks", lambda b: ~is_template(b))).otherwise(F.col("blocks")))
    cols = ["page_id", "url", "blocks"]
    text = F.array_join(F.transform("blocks", lambda b: b["text"]), "\n")
    out = read.filter(~fixed).select(*cols).union(judged.select(*cols)).withColumn("text", text)
    return out.select(F.col("page_id").alias(id_col), F.col("url").alias(url), "text",
                      F.length("text").cast("long").alias("n_chars"))
