"""Tool calls against a plain version, and what can be wrong with them."""

import json
import random

from orderflow.llm import chat

CALLS = "conv long, id string, turn long, name string, arguments string, after array<string>, level long, errors string"
RESULTS = "conv long, id string, turn long, content string"
TOOLS = "name string, param string, type string, required boolean"


def run(spark, calls, results, tools):
    calls = spark.createDataFrame([(*c, 99, "x") for c in calls], CALLS)
    found = chat.link(calls, spark.createDataFrame(results, RESULTS), spark.createDataFrame(tools, TOOLS))
    return {(r.conv, r.id): r for r in found.collect()}


def longest(waits, calls):
    """Longest chain by following every wait; None on and behind cycles."""
    level = {}
    for _ in range(len(calls) + 1):
        for c in calls:
            deps = [d for k, d in waits if k == c]
            if c not in level and all(d in level for d in deps):
                level[c] = 1 + max((level[d] for d in deps), default=-1)
    return level


def test_levels_are_longest_chains(spark):
    rng = random.Random(3)
    calls, waits = [], []
    for conv in range(6):
        for i in range(8):
            after = [f"c{rng.randrange(i)}" for _ in range(rng.choice([0, 1, 2]))] if i else []
            if conv == 5 and i == 2:
                after = ["c4"]
            if conv == 5 and i == 4:
                after = ["c2"]
            calls.append((conv, f"c{i}", i, "t", "{}", after))
            waits += [((conv, f"c{i}"), (conv, a)) for a in after]
    got = run(spark, calls, [(c, i, t + 1, "done") for c, i, t, *_ in calls], [("t", None, None, None)])
    expected = longest(waits, [(c[0], c[1]) for c in calls])
    for key, row in got.items():
        assert row.level == expected.get(key)
        assert row.errors == ([] if key in expected else ["cycle"])


def test_arguments_are_checked_and_written_canonically(spark):
    tools = [("t", "s", "string", True), ("t", "i", "Integer", False), ("t", "n", "number", False), ("t", "b", "boolean", None), ("t", "a", "array", False), ("t", "o", "object", False)]
    cases = {
        "ok": ('{ "s": "x\\n\\u00e9/", "i": 3, "n": 2.50, "b": true, "a": [1, "z"], "o": {"k": 1, "a": null} }', []),
        "missing": ('{"i": 3}', ["missing s"]),
        "types": ('{"s": 1, "i": 1.5, "n": "1", "b": 0, "a": {}, "o": []}', [f"type of {p}" for p in "abinos"]),
        "whole": ('{"s": "", "i": 7.0, "n": 1e3}', []),
        "unknown": ('{"s": "x", "zz": 1}', ["unknown zz"]),
        "broken": ("{", ["not an object"]),
        "twice": ('{"s": "a", "s": "b"}', ["not an object"]),
        "list": ("[1]", ["not an object"]),
        "none": (None, ["not an object"]),
    }
    calls = [(1, k, 1, "t", a, []) for k, (a, _) in cases.items()] + [(1, "tool", 1, "nope", "{}", [])]
    got = run(spark, calls, [(1, c[1], 2, "r") for c in calls], tools)
    for k, (_, errors) in cases.items():
        assert got[1, k].errors == errors, k
    assert got[1, "tool"].errors == ["no such tool"]
    text = '{"arguments":{"a":[1,"z"],"b":true,"i":3,"n":2.5,"o":{"a":null,"k":1},"s":"x\\né/"},"conversation":1,"id":"ok","level":0,"name":"t","result":"r"}'
    assert got[1, "ok"].json == text and json.loads(text)
    assert json.loads(got[1, "broken"].json)["arguments"] is None


def test_links_of_every_kind(spark):
    calls = [
        (1, "a", 1, "t", "{}", ["gone"]), (1, "b", 3, "t", "{}", None), (1, "b", 2, "t", "{}", []), (2, "a", 1, "t", "{}", ["a"]),
        (None, "a", 1, "t", "{}", []), (None, "a", 1, "t", "{}", []), (3, None, 1, "t", "{}", []),
    ]
    results = [(1, "b", 9, "late"), (1, "b", 4, "first"), (1, "lost", 5, "x"), (None, "a", 1, "y"), (2, None, 1, "z")]
    table = spark.createDataFrame([(*c, 1, "x") for c in calls], CALLS)
    found = chat.link(table, spark.createDataFrame(results, RESULTS), spark.createDataFrame([("t", None, None, None)], TOOLS)).collect()
    got = sorted(((r.conv, r.id, r.turn, r.level, r.n_results, r.errors) for r in found), key=str)
    assert got == sorted(
        [
            (1, "a", 1, 0, 0, ["no result", "waits for no call"]),
            (1, "b", 2, 0, 2, ["id used again"]),
            (1, "lost", 5, None, 1, ["no call"]),
            (2, "a", 1, None, 0, ["no result", "cycle"]),
            (None, "a", 1, 0, 0, ["no id", "no result"]),
            (None, "a", 1, 0, 0, ["no id", "no result"]),
            (3, None, 1, 0, 0, ["no id", "no result"]),
        ],
        key=str,
    )
    assert json.loads(next(r.json for r in found if r.id == "b"))["result"] == "first"


def test_empty_tables_and_messages(spark):
    assert run(spark, [], [], []) == {}
    messages = spark.createDataFrame(
        [(1, 1, '{"tool_calls": [{"id": "x", "name": "t", "arguments": {"b": 1, "a": 2}, "after": ["w"]}, {"id": "w", "name": "t", "arguments": {}}]}'),
         (1, 2, '{"call_id": "x", "content": "ok"}'), (1, 3, "plain words"), (1, 4, None), (1, 5, "")],
        "c long, t long, m string",
    )
    calls = chat.calls_of(messages, "c", "t", "m")
    assert [(r.id, r.arguments, r.after) for r in calls.orderBy("id").collect()] == [("w", "{}", []), ("x", '{"a":2,"b":1}', ["w"])]
    results = chat.results_of(messages, "c", "t", "m")
    assert [(r.id, r.content) for r in results.collect()] == [("x", "ok")]
    linked = chat.link(calls, results, spark.createDataFrame([("t", "a", "integer", False), ("t", "b", "integer", False)], TOOLS))
    assert sorted((r.id, r.level, r.n_results) for r in linked.collect()) == [("w", 0, 0), ("x", 1, 1)]


def test_plan_has_no_python(spark):
    calls = spark.createDataFrame([(1, "a", 1, "t", "{}", [], 1, "x")], CALLS)
    found = chat.link(calls, spark.createDataFrame([], RESULTS), spark.createDataFrame([], TOOLS))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_names_of_parameters_may_hold_any_character(spark):
    names = ["it's", "a.b", "x']['y", 'say "hi"', "$", "ä[0]", "", "*"]
    tools = [("t", n, "string", True) for n in names]
    given = [(json.dumps(dict.fromkeys(names, "v")), []), (json.dumps({"it's": 1, "a": {"b": "v"}, "o'k": None}), ["missing " + n for n in names if n != "it's"] + ["type of it's", "unknown a", "unknown o'k"])]
    rows = [(f"c{i}", a) for i, (a, _) in enumerate(given)]
    calls = spark.createDataFrame([("v", i, 1, "t", a, []) for i, a in rows], "conv string, id string, turn long, name string, arguments string, after array<string>")
    results = spark.createDataFrame([("v", i, 2, "r") for i, _ in rows], "conv string, id string, turn long, content string")
    found = {r.id: r.errors for r in chat.link(calls, results, spark.createDataFrame(tools, "name string, param string, type string, required boolean")).collect()}
    assert found == {f"c{i}": sorted(errors) for i, (_, errors) in enumerate(given)}
