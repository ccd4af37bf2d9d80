"""Secret scans with corpus-wide ownership frequency (DataFrame functions only).

Each text is scanned once per kind of pattern. The values found, and generic
high-entropy tokens beside them, are candidates. Candidates are hashed and counted over the whole
corpus by distinct repositories and distinct owners: a value that many owners hold is a
copied example, a value that few owners hold looks live. Generic tokens that look live
become spans of their own; base spans always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import row_key
from panelkit.session import cut_lineage

# The patterns of the contract.
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 8, 16, 32

#: Runs long enough; a shorter run fails the length test, so the scan may skip it.
ACCESS_LONG = r"AKIA[A-Z0-9]{12,}"
HEX_LONG = r"[0-9a-f]{32,}"
#: Generic candidates: long tokens that mix capitals, small letters and digits.
GENERIC = r"[A-Za-z0-9+/_-]{24,}"

SPAN = "struct<start:int,rank:int,stop:int,kind:string,value:string>"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, whatever ``body`` does with it."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, start: Column, merge, block: int = 128) -> Column:
    """For each integer of an array the merge of ``start`` and all before it. Appending copies an array, so this is done inside
    blocks and over the blocks: the work grows as the array, not as its square."""
    def inside(of, first):
        def step(acc, x):
            return F.struct(merge(acc["now"], x).alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out"))
        return F.aggregate(of, F.struct(first.alias("now"), F.array().cast("array<int>").alias("out")), step)

    def blocks(of):
        last = F.greatest(F.ceil(F.size(of) / block).cast("int") - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(of, k * block + 1, block))

    def whole(parts):
        each = F.transform(parts, lambda x: F.aggregate(x, start, merge))
        return F.flatten(F.zip_with(parts, inside(each, start)["out"], lambda x, first: inside(x, first)["out"]))

    return let(values, lambda v: let(blocks(v), whole))


def matches(text: Column, pattern: str, rank: int, kind: str) -> Column:
    """All leftmost non-overlapping matches as spans in code points. A match starts
    after the pieces between matches and the matches before it."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def spans(pairs: Column) -> Column:
        before = running(F.transform(pairs, lambda x: F.length(x["gap"]) + F.length(x["hit"])), F.lit(0), lambda n, x: n + x)
        return F.zip_with(pairs, before, lambda x, n: F.struct(
            (n + F.length(x["gap"])).alias("start"), F.lit(rank).alias("rank"),
            (n + F.length(x["gap"]) + F.length(x["hit"])).alias("stop"), F.lit(kind).alias("kind"), x["hit"].alias("value")))

    pairs = let(found, lambda f: F.zip_with(F.slice(gaps, 1, F.size(f)), f,
                                            lambda g, h: F.struct(g.alias("gap"), h.alias("hit"))))
    return let(pairs, lambda p: F.when(F.size(p) > 0, spans(p)).otherwise(F.array().cast(f"array<{SPAN}>")))


def apart(base: Column, more: Column) -> Column:
    """The spans of ``more`` that touch none of ``base``: in order of starts, the base spans before one end in time, and those
    after it start in time. One sort and two running values, so many spans cost no more than their order."""
    far = 2 ** 31 - 1

    def clear(spans):
        ends = running(F.transform(spans, lambda s: F.when(s["kind"] == "live", F.lit(0)).otherwise(s["stop"])),
                       F.lit(0), lambda a, x: F.greatest(a, x))
        starts = F.reverse(running(F.reverse(F.transform(spans, lambda s: F.when(s["kind"] == "live", F.lit(far)).otherwise(s["start"]))),
                                   F.lit(far), lambda a, x: F.least(a, x)))
        judged = F.zip_with(F.arrays_zip(spans.alias("span"), ends.alias("end")), starts, lambda x, start: F.struct(
            x["span"].alias("span"), (x["end"] <= x["span"]["start"]).alias("before"), (start >= x["span"]["stop"]).alias("after")))
        kept = F.filter(judged, lambda x: (x["span"]["kind"] == "live") & x["before"] & x["after"])
        return F.transform(kept, lambda x: x["span"])

    return F.when(F.size(more) > 0, let(F.array_sort(F.concat(base, more)), clear)).otherwise(more)


def base_spans(text: Column) -> Column:
    assign = F.filter(matches(text, ASSIGN, 0, "assign"),
                      lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_MIN)
    return F.array_sort(F.concat(assign, matches(text, ACCESS_LONG, 1, "access"), matches(text, HEX_LONG, 2, "hex")))


def generic_spans(text: Column) -> Column:
    return F.filter(matches(text, GENERIC, 3, "live"),
                    lambda s: s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[0-9]"))


def secret_value(span: Column) -> Column:
    """What is counted: the assigned value, or the whole match."""
    return F.when(span["kind"] == "assign", F.regexp_extract(span["value"], ASSIGN, 2)).otherwise(span["value"])


def ownership(candidates: DataFrame) -> DataFrame:
    """(digest, n_rows, n_repositories, n_owners) of candidates (digest, repository, owner).
    Rows are first reduced per (digest, owner, repository), then per (digest, owner),
    then per digest, each with map-side sums, so a value in a third of all rows is no hot key."""
    per_repo = candidates.groupBy("digest", "owner", "repository").agg(F.count("*").alias("n"))
    per_owner = per_repo.groupBy("digest", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("r"))
    return per_owner.groupBy("digest").agg(F.sum("n").alias("n_rows"), F.sum("r").alias("n_repositories"),
                                           F.count("*").alias("n_owners"))


def scan_secrets(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", repository: str = "doc_id",
                 owner: str = "source", live_owners: int = 2, live_repositories: int = 8) -> DataFrame:
    """One row per input row: ``id_col``, base (array of spans), added (array of spans),
    n_live and n_example.

    A candidate looks live if at most ``live_owners`` owners and ``live_repositories``
    repositories hold it; else it is a copied example. ``added`` holds the generic
    tokens that look live and touch no base span. n_live and n_example count all candidate
    spans of the row by that verdict. Null text is empty; null repositories and owners count as one
    of their own. Repeated rows are scanned each. Empty table: no rows.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    scanned = docs.select(
        row_key().alias("__uid"), F.col(id_col).alias("__id"), F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"), base_spans(t).alias("base"), generic_spans(t).alias("more"))
    scanned = cut_lineage(scanned.withColumn("more", apart(F.col("base"), F.col("more"))), "spans")
    spans = (scanned.filter((F.size("base") > 0) | (F.size("more") > 0))
             .select("__uid", "repository", "owner", F.explode(F.concat("base", "more")).alias("s"))
             .withColumn("digest", F.sha2(secret_value(F.col("s")), 256)))
    freq = ownership(spans)
    live = (F.col("n_owners") <= live_owners) & (F.col("n_repositories") <= live_repositories)
    judged = spans.join(freq.select("digest", live.alias("live")), "digest")
    per_row = judged.groupBy("__uid").agg(
        F.array_sort(F.collect_list(F.when(F.col("live") & (F.col("s.kind") == "live"), F.col("s")))).alias("added"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example"))
    none = F.array().cast(f"array<{SPAN}>")
    zero = F.lit(0).cast("long")
    out = scanned.join(per_row, "__uid", "left")
    return out.select(F.col("__id").alias(id_col), "base", F.coalesce("added", none).alias("added"),
                      F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_example", zero).alias("n_example"))


def span_text(spans: Column) -> Column:
    """kind:start:end of the spans in order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
