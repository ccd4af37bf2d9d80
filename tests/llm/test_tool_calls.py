import json

import pytest

from panelkit.llm.tool_calls import TURN_SCHEMAS, canonical, exchanges, link_calls, problems

CALLS = "conv_id long, call_id string, seq long, name string, arguments string, needs array<string>"
RESULTS = "conv_id long, call_id string, seq long, content string"
SCHEMAS = {"add": {"type": "object", "required": ["a"], "additionalProperties": False,
                   "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["string", "null"]}}}}


def link(spark, calls, results):
    return link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS)


def test_links_order_validity_and_json(spark):
    calls = [(1, "c", 1, "add", '{"b":null, "a": 3}', ["a", "b"]), (1, "a", 5, "add", '{"a":1}', None),
             (1, "b", 2, "add", '{"a":-1}', ["a"]), (1, "d", 9, "add", "{", []), (1, "e", 3, "nope", "{}", ["missing"]),
             (1, "x", 1, "add", '{"a":1}', ["y"]), (1, "y", 1, "add", '{"a":1}', ["x"]), (1, "z", 1, "add", '{"a":1}', ["y"]),
             (2, "a", 1, "add", '{"a":1}', []), (2, "a", 0, "add", '{"a":7}', []), (None, "a", 1, "add", "{}", []),
             (3, "self", 1, "add", '{"a":1}', ["self"])]
    results = [(1, "a", 1, "r"), (1, "b", 1, "s"), (1, "c", 1, "é\n"), (2, "a", 4, "late"), (2, "a", 2, "first"),
               (4, "a", 1, "nobody asked"), (2, None, 1, "?")]
    got = {(r.conv_id, r.call_id): r for r in link(spark, calls, results).collect()}
    assert len(got) == 13
    one = {k[1]: r for k, r in got.items() if k[0] == 1}
    assert {k: r.status for k, r in one.items()} == {
        "a": "ok", "b": "invalid", "c": "ok", "d": "invalid", "e": "invalid", "x": "cycle", "y": "cycle", "z": "cycle"}
    assert [one[k].position for k in "eadbc"] == [0, 1, 2, 3, 4]
    assert one["b"].problem == "$.a: below 0" and one["d"].problem == "$: not JSON" and one["e"].problem == "$: unknown tool"
    assert one["c"].json == '{"arguments":{"a":3,"b":null},"id":"c","name":"add","result":"é\\n","status":"ok"}'
    two = got[(2, "a")]
    assert (two.n_repeats, json.loads(two.json)["result"], json.loads(two.json)["arguments"]) == (2, "first", {"a": 7})
    assert got[(4, "a")].status == "orphan" and got[(3, "self")].status == "cycle"
    assert got[(None, "a")].status == "unnamed" and got[(2, None)].status == "unnamed"


def test_a_long_chain_and_a_hot_conversation(spark):
    calls = [(1, str(k), 100 - k, "add", '{"a":1}', [str(k - 1)] if k else []) for k in range(8)]
    calls += [(2, f"p{k}", k, "add", '{"a":1}', []) for k in range(500)]
    got = link(spark, calls, []).collect()
    assert [r.call_id for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)] == list("01234567")
    assert sorted(r.position for r in got if r.conv_id == 2) == list(range(500))
    assert {r.status for r in got} == {"unanswered"}


def plain_levels(calls, needs):
    level = {}
    while True:
        new = {c: max((level[n] for n in needs[c]), default=-1) + 1 for c in calls
               if c not in level and all(n in level for n in needs[c])}
        if not new:
            return level
        level.update(new)


@pytest.mark.parametrize("seed", range(3))
def test_levels_of_random_graphs(spark, seed):
    import random

    from panelkit.llm.tool_calls import topological_levels
    rng = random.Random(seed)
    calls = [(c, str(k)) for c in range(3) for k in range(40)]
    needs = {(c, k): {(c, str(n)) for n in rng.sample(range(int(k)), min(int(k), rng.choice([0, 1, 1, 1, 2, 3])))}
             for c, k in calls}
    for a, b in [("5", "9"), ("30", "31"), ("31", "30")]:  # cycles in one conversation
        needs[(2, a)].add((2, b))
    deps = [(c, k, n[1]) for (c, k), ns in needs.items() for n in ns] + [(0, "3", "missing")]
    got = topological_levels(spark.createDataFrame(calls, "conv_id long, call_id string"),
                             spark.createDataFrame(deps, "conv_id long, call_id string, needs string")).collect()
    assert {(r.conv_id, r.call_id): r.level for r in got} == plain_levels(calls, needs)


def test_empty_tables(spark):
    assert link(spark, [], []).count() == 0
    assert link(spark, [], [(1, "a", 1, "x")]).first().status == "orphan"


def test_turns_become_exchanges(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "be"), (1, 1, "user", "q"), (1, 2, "assistant", "r"), (1, 3, "user", ""), (1, 4, "user", None),
         (2, 0, "assistant", "lonely"), (2, 1, "tool", "ignored"), (2, 2, None, "x"), (3, 0, "user", "q"), (3, 0, "user", "q")],
        "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.call_id): r for r in link_calls(*exchanges(turns), TURN_SCHEMAS).collect()}
    assert {k: r.status for k, r in got.items()} == {
        (1, "0"): "unanswered", (1, "1"): "ok", (1, "3"): "invalid", (1, "4"): "invalid", (2, "?0"): "orphan",
        (3, "0"): "unanswered"}
    assert [got[(1, k)].position for k in "0134"] == [0, 1, 2, 3] and got[(3, "0")].n_repeats == 1


@pytest.mark.parametrize("value,schema,want", [
    (True, {"type": "integer"}, "$: not integer"), (1.5, {"type": "number", "maximum": 1}, "$: above 1"),
    ({"a": [1, "x"]}, {"properties": {"a": {"items": {"type": "integer"}}}}, "$.a[1]: not integer"),
    ("ab", {"enum": ["a"]}, "$: not in enum"), ("ab", {"maxLength": 1}, "$: longer than 1"),
    ({}, {"required": ["k"]}, "$.k: missing"), ({"k": 1}, {"required": ["k"]}, None), (None, {"type": "null"}, None)])
def test_schema_checks(value, schema, want):
    assert next(problems(value, schema), None) == want
    assert canonical({"b": 1, "a": "é"}) == '{"a":"é","b":1}'


def test_lone_surrogates_and_deep_arguments(spark):
    deep = lambda n: "[" * n + "]" * n
    calls = [(1, "a", 1, "add", '{"a":1,"b":"\\ud800x"}', []), (1, "b", 2, "add", '{"\\udfff":1,"a":1}', []),
             (1, "c", 3, "add", '{"a":1,"b":"\\ud83d\\ude00"}', []), *((1, f"d{n}", n, "add", deep(n), []) for n in (50, 900, 990, 5000, 200000))]
    got = {r.call_id: r for r in link(spark, calls, []).collect()}
    assert got["a"].status == "unanswered" and '"b":"\\ud800x"' in got["a"].json
    assert got["b"].problem == "$.\\udfff: unknown" and '"\\udfff":1' in got["b"].json
    assert '"b":"😀"' in got["c"].json
    assert all(json.loads(got[k].json)["id"] == k for k in "abc")
    for n in (50, 900, 990, 5000, 200000):
        r = got[f"d{n}"]
        # what the parser takes is in the result whole, what it does not take is no JSON
        assert (deep(n) in r.json) if r.problem != "$: not JSON" else "arguments" not in r.json
    assert got["d50"].problem == "$: not object" and got["d200000"].problem == "$: not JSON"


def test_clashing_extra_columns(spark):
    calls = spark.createDataFrame([(1, "a", 1, "add", '{"a":1}', [], "x", 1, 2, True, None)], CALLS + ", content string, level int, position int, answered boolean, c string")
    results = spark.createDataFrame([(1, "a", 2, "r", "y", 3, 4)], RESULTS + ", name string, n int, more_calls int")
    r = link_calls(calls, results, SCHEMAS).collect()
    assert len(r) == 1 and r[0].status == "ok" and json.loads(r[0].json)["result"] == "r"
