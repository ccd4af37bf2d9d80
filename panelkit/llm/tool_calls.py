"""Tool-call linking: calls joined to results, ordered, validated, serialised.

Calls and results meet in a hash join on (conversation, identifier). The order within a
conversation is topological over the calls a call depends on, found in relational rounds (chains by doubling
pointers, calls that need several others level by level); only the last numbering sorts the calls of a
conversation and level together. Arguments are checked against the schema of
their tool and written as canonical JSON (sorted keys, no spaces, shortest numbers).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelkit.session import cut_lineage

KINDS = {"string": str, "number": (int, float), "integer": int, "boolean": bool, "object": dict, "array": list,
         "null": type(None)}


def problems(value, schema: dict, at: str = "$") -> Iterator[str]:
    """What is wrong with a value under a JSON schema: type, enum, required, properties, additionalProperties,
    items, minLength, maxLength, minimum, maximum."""
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        fits = any(isinstance(value, KINDS[k]) and not (isinstance(value, bool) and k in ("integer", "number"))
                   for k in kinds)
        if not fits:
            yield f"{at}: not {'|'.join(kinds)}"
            return
    if "enum" in schema and value not in schema["enum"]:
        yield f"{at}: not in enum"
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            yield f"{at}: shorter than {schema['minLength']}"
        if len(value) > schema.get("maxLength", len(value)):
            yield f"{at}: longer than {schema['maxLength']}"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            yield f"{at}: below {schema['minimum']}"
        if value > schema.get("maximum", value):
            yield f"{at}: above {schema['maximum']}"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        yield from (f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value)
        for k in sorted(value):
            if k in known:
                yield from problems(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                yield f"{at}.{k}: unknown"
    if isinstance(value, list) and "items" in schema:
        for k, x in enumerate(value):
            yield from problems(x, schema["items"], f"{at}[{k}]")


#: Half a surrogate pair: valid in JSON as an escape, in no text.
LONE = re.compile("[\ud800-\udfff]")


def no_lone(text: str | None) -> str | None:
    """Lone surrogates written as the escapes they came as."""
    return LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text) if text else text


def canonical(value) -> str:
    return no_lone(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def checked_arguments(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Adds canonical (null where the text is no JSON) and problem (null where valid) to calls (name, arguments)."""
    @F.pandas_udf("canonical string, problem string")
    def check(name: pd.Series, arguments: pd.Series) -> pd.DataFrame:
        out = []
        for tool, text in zip(name, arguments):
            try:
                value = json.loads(text, parse_constant=lambda c: (_ for _ in ()).throw(ValueError(c)))
                form = canonical(value)
            except (TypeError, ValueError, RecursionError):
                out.append((None, "$: not JSON"))
                continue
            if tool not in schemas:
                out.append((form, "$: unknown tool"))
            else:
                out.append((form, no_lone(next(problems(value, schemas[tool]), None))))
        return pd.DataFrame(out, columns=["canonical", "problem"])

    return calls.withColumn("__c", check("name", "arguments")).select("*", "__c.*").drop("__c")


def chain_ends(calls: DataFrame, deps: DataFrame) -> DataFrame:
    """(conv_id, call_id, end, steps): where the chain of single needs above a call ends (a call that needs
    nothing or several calls) and how many steps away. Calls on or behind a cycle of such
    chains are absent. Pointers double in each round, so a chain of n calls takes about log2(n) rounds."""
    keys = ["conv_id", "call_id"]
    single = deps.groupBy(*keys).agg(F.count("*").alias("n"), F.min("needs").alias("end")).filter("n = 1")
    p = calls.select(*keys).join(single, keys, "left").select(
        *keys, F.coalesce("end", "call_id").alias("end"), F.when(F.col("n") == 1, 1).otherwise(0).alias("steps"),
        F.col("n").isNull().alias("done"))
    p, left = cut_lineage(p, "chains"), None
    while True:
        open_now = p.filter(~F.col("done")).count()
        if open_now == 0 or open_now == left:  # a round that ends no chain has met only cycles
            return p.filter("done").drop("done")
        left = open_now
        ahead = p.select("conv_id", F.col("call_id").alias("end"), F.col("end").alias("far"),
                         F.col("steps").alias("more"), F.col("done").alias("ended"))
        moved = p.filter(~F.col("done")).join(ahead, ["conv_id", "end"]).select(
            *keys, F.col("far").alias("end"), (F.col("steps") + F.col("more")).alias("steps"), F.col("ended").alias("done"))
        p = cut_lineage(p.filter("done").unionByName(moved), "chains")


def topological_levels(calls: DataFrame, deps: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls (conv_id, call_id) and deps (conv_id, call_id, needs). Level 0 needs
    nothing, every other call comes one level after the highest it needs. Needs that are no call are ignored; calls
    on or behind a cycle have no level.

    Chains of calls that need one other call are skipped at once (``chain_ends``); the rounds below place
    the calls that need several, as many rounds as such calls follow on one another."""
    keys = ["conv_id", "call_id"]
    known = calls.select("conv_id", F.col("call_id").alias("needs"))
    deps = cut_lineage(deps.join(known, ["conv_id", "needs"], "left_semi").distinct(), "deps")
    ends = chain_ends(calls, deps)
    done = calls.select(*keys).join(deps, keys, "left_anti").withColumn("level", F.lit(0))
    several = deps.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys)
    above = ends.select("conv_id", F.col("call_id").alias("needs"), "end", "steps")
    # one row per need; a need without an end leaves its call open for ever
    edges = cut_lineage(deps.join(several, keys, "left_semi").join(above, ["conv_id", "needs"], "left")
                        .select(*keys, "end", "steps"), "edges")
    while True:
        place = done.select("conv_id", F.col("call_id").alias("end"), "level")
        ready = (edges.join(place, ["conv_id", "end"], "left").groupBy(*keys)
                 .agg(F.count("*").alias("n"), F.count("level").alias("m"),
                      F.max(F.col("level") + F.col("steps") + 1).alias("level")).filter("n = m").select(*keys, "level"))
        ready = cut_lineage(ready, "levels")
        if ready.isEmpty():
            break
        done = cut_lineage(done.unionByName(ready), "levels")
        edges = cut_lineage(edges.join(ready, keys, "left_anti"), "edges")
    place = done.select("conv_id", F.col("call_id").alias("end"), F.col("level").alias("base"))
    return ends.join(place, ["conv_id", "end"]).select(*keys, (F.col("base") + F.col("steps")).cast("int").alias("level"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per (conversation, identifier) of a call or result: conv_id, call_id, position, level, status, problem, json.

    ``calls``: conv_id, call_id, seq, name, arguments (JSON text), needs (array of call_id). ``results``: conv_id,
    call_id, seq, content. Of calls or results that repeat an identifier the first by seq
    counts (ties: the smaller text), the others are counted in n_repeats. status: ok, invalid (arguments fail),
    unanswered, orphan (a result without call; its position is null), cycle (no order exists). position numbers the calls
    of a conversation by (level, seq, call_id). Rows whose conv_id or call_id is null link with nothing and are
    dropped from the order but returned with status ``unnamed``. Empty tables: no rows.
    """
    keys = ["conv_id", "call_id"]
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    one_call = (calls.filter(named).groupBy(*keys).agg(
        F.min(F.struct("seq", "name", "arguments", F.coalesce("needs", F.array().cast("array<string>")).alias("needs")))
        .alias("c"), (F.count("*") - 1).alias("more_calls")).select(*keys, "c.*", "more_calls"))
    one_call = cut_lineage(checked_arguments(one_call, schemas), "calls")
    one_result = (results.filter(named).groupBy(*keys).agg(
        F.min(F.struct("seq", "content")).alias("r"), (F.count("*") - 1).alias("more_results"))
        .select(*keys, F.col("r.seq").alias("result_seq"), F.col("r.content").alias("content"), "more_results",
                F.lit(True).alias("answered")))
    deps = one_call.select(*keys, F.explode("needs").alias("needs")).filter("needs is not null")
    levels = cut_lineage(topological_levels(one_call.select(*keys), deps), "levels")
    both = (one_call.withColumn("called", F.lit(True)).join(levels, keys, "left")
            .join(one_result, keys, "full_outer"))
    # the position in a conversation: those on smaller levels, then the order within a level
    sizes = levels.groupBy("conv_id", "level").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(
        W.partitionBy("conv_id").orderBy("level").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("n")
    both = both.join(before, ["conv_id", "level"], "left").withColumn("position", F.when(
        F.col("level").isNotNull(), F.col("before") + F.row_number().over(
            W.partitionBy("conv_id", "level").orderBy("seq", "call_id")) - 1))
    status = (F.when(F.col("called").isNull(), "orphan").when(F.col("level").isNull(), "cycle")
              .when(F.col("problem").isNotNull(), "invalid").when(F.col("answered").isNull(), "unanswered")
              .otherwise("ok"))
    both = both.withColumns({"status": status,
                             "n_repeats": F.coalesce("more_calls", F.lit(0)) + F.coalesce("more_results", F.lit(0))})

    @F.pandas_udf("string")
    def as_json(call_id: pd.Series, name: pd.Series, arguments: pd.Series, content: pd.Series,
                status: pd.Series) -> pd.Series:
        out = []
        for i, n, a, c, s in zip(call_id, name, arguments, content, status):
            # keys in order; arguments are canonical already, and as deep as the parser went
            row = {"arguments": a, **{k: None if v is None else canonical(v) for k, v in (("id", i), ("name", n), ("result", c), ("status", s))}}
            out.append("{" + ",".join(f'"{k}":{v}' for k, v in row.items() if v is not None) + "}")
        return pd.Series(out, dtype=object)

    out = both.select(*keys, "position", "level", "status", "problem", "n_repeats",
                      as_json("call_id", "name", "canonical", "content", "status").alias("json"))
    none = F.lit(None)
    unnamed = calls.filter(~named).select(*keys).unionByName(results.filter(~named).select(*keys)).select(
        *keys, none.cast("long").alias("position"), none.cast("int").alias("level"), F.lit("unnamed").alias("status"),
        none.cast("string").alias("problem"), F.lit(0).cast("long").alias("n_repeats"),
        none.cast("string").alias("json"))
    return out.withColumn("position", F.col("position").cast("long")).unionByName(unnamed)


def exchanges(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversation turns (conv_id, turn, role, text) as calls and results: a user turn calls the tool ``reply``
    with its text, an assistant turn is the result of the last user turn before it, and a system turn calls
    ``instruct``. A call needs the call before it in its conversation. Identifiers are turn numbers as text."""
    call = F.col("role").isin("user", "system")
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    t = turns.select("conv_id", "turn", "role", "text").withColumns({
        "call_id": F.when(call, F.col("turn").cast("string")),
        "last_user": F.last(F.when(F.col("role") == "user", F.col("turn").cast("string")), ignorenulls=True).over(
            order.rowsBetween(W.unboundedPreceding, -1)),
        "before": F.last(F.when(call, F.col("turn").cast("string")), ignorenulls=True).over(
            order.rowsBetween(W.unboundedPreceding, -1))})
    args = F.to_json(F.struct(F.col("text").alias("text"), F.col("turn").alias("turn")))
    calls = t.filter(call).select(
        "conv_id", "call_id", F.col("turn").alias("seq"),
        F.when(F.col("role") == "user", "reply").otherwise("instruct").alias("name"), args.alias("arguments"),
        F.when(F.col("before") != F.col("call_id"), F.array("before")).otherwise(F.array().cast("array<string>"))
        .alias("needs"))
    results = t.filter(F.col("role") == "assistant").select(
        "conv_id", F.coalesce("last_user", F.concat(F.lit("?"), F.col("turn").cast("string"))).alias("call_id"),
        F.col("turn").alias("seq"), F.col("text").alias("content"))
    return calls, results


#: Schemas of the two tools of ``exchanges``.
TURN_SCHEMA = {"type": "object", "required": ["text", "turn"], "additionalProperties": False,
               "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}}
TURN_SCHEMAS = {"reply": TURN_SCHEMA, "instruct": TURN_SCHEMA}
