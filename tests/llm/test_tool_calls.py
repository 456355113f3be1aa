"""Tool-call linking against a plain brute force, and the edge cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tablewright.llm import queries as Q
from tablewright.llm import tool_calls as T

CALLS = "conv_id long, call_id string, seq long, tool string, arguments string, needs array<string>, level string"
RESULTS = "conv_id long, call_id string, seq long, content string, extra int"


def link(spark, calls, results):
    return T.link_tool_calls(spark.createDataFrame([(*c, "clash") for c in calls], CALLS),
                             spark.createDataFrame([(*r, 1) for r in results], RESULTS), Q.SCHEMAS)


def test_canonical_json():
    v = json.loads('{"b": [1.0, 1e21, 1e-7, 0.000001, -0.0, 12.50, true, null], "a": "\\u00e9\\n", "\\ud83d\\ude00": 1, "\\ufb33": 2}')
    assert T.canonical(v) == '{"a":"é\\n","b":[1,1e+21,1e-7,0.000001,0,12.5,true,null],"😀":1,"דּ":2}'


@pytest.mark.parametrize("value, schema, wrong", [
    (1, {"type": "string"}, True), ("a", {"type": ["string", "null"]}, False), (3, {"type": "integer", "maximum": 2}, True),
    (True, {"type": "integer"}, True), (2.0, {"type": "integer"}, False), ([1, "a"], {"items": {"type": "integer"}}, True),
    ({"a": 1}, {"required": ["b"]}, True), ({"a": 1}, {"properties": {}, "additionalProperties": False}, True),
    ("x", {"enum": ["y"]}, True), ("", {"type": "string", "minLength": 1}, True)])
def test_schema(value, schema, wrong):
    assert bool(list(T.violations(value, schema))) == wrong


def test_layers_cycles_dangling_and_duplicates(spark):
    ok = '{"query":"q","limit":1}'
    calls = [
        (1, "a", 0, "search", ok, ["b", "zz"]),           # needs a later call, and one that is not there
        (1, "b", 1, "search", ok, []),
        (1, "b", 1, "search", ok, []),                    # repeated row
        (1, "c", 2, "search", ok, ["a", "b"]),
        (1, "x", 3, "search", ok, ["y"]), (1, "y", 4, "search", ok, ["x"]), (1, "z", 5, "search", ok, ["x"]),
        (1, None, 6, "search", "nope", []), (1, None, 7, None, None, None),
        (None, "a", 0, "search", '{"limit":0,"query":"q"}', ["a"]),
    ]
    results = [(1, "b", 9, "r"), (1, "b", 9, "r"), (1, "nowhere", 9, "r"), (1, None, 9, None), (None, "a", 1, "ä\n")]
    rows = link(spark, calls, results).collect()
    at = {(r.conv_id, r.kind, r.call_id): r for r in rows if r.call_id}
    assert [at[1, "call", i].level for i in "bac"] == [0, 1, 2]
    assert all(at[1, "call", i].level is None for i in "xyz")
    assert at[1, "call", "b"].copies == 2 and at[1, "result", "b"].copies == 2
    assert at[1, "call", "b"].status == "ok" and at[1, "call", "a"].status == "ok, unanswered"
    assert at[1, "result", "nowhere"].status == "orphan"
    assert at[1, "result", "b"].position == at[1, "call", "b"].position + 1
    assert at[None, "call", "a"].status == "invalid_arguments" and at[None, "call", "a"].level is None
    assert at[None, "result", "a"].message == '{"content":"ä\\n","role":"tool","tool_call_id":"a"}'
    none = [r for r in rows if r.call_id is None]
    assert sorted(r.status for r in none) == ["invalid_json, unanswered", "invalid_json, unanswered", "orphan"]
    for conv in (1, None):
        assert sorted(r.position for r in rows if r.conv_id == conv) == list(range(sum(r.conv_id == conv for r in rows)))
    for r in rows:
        assert T.canonical(json.loads(r.message)) == r.message


def test_empty(spark):
    assert link(spark, [], []).count() == 0


def plain_levels(needs):
    level, left = {}, dict(needs)
    while ready := [i for i, js in left.items() if all(j in level for j in js)]:
        level |= {i: max((level[j] + 1 for j in needs[i]), default=0) for i in ready}
        for i in ready:
            del left[i]
    return level


@pytest.mark.parametrize("graph", [T.GRAPH, 10])        # by one task, and by joins
def test_hot_conversation_against_kahn(spark, graph):
    rng = random.Random(5)
    n = 300
    needs = {i: sorted({rng.randrange(n) for _ in range(rng.choice([0, 1, 2]))}) for i in range(n)}
    needs |= {i: [i - 1] for i in range(100, 140)} | {200: [201], 201: [202], 202: [200], 203: [202]}   # a chain, a cycle
    calls = [(7, f"k{i}", i, "search", "{}", [f"k{j}" for j in needs[i]]) for i in range(n)]
    got = T.link_tool_calls(spark.createDataFrame([(*c, "clash") for c in calls], CALLS), spark.createDataFrame([], RESULTS), Q.SCHEMAS, graph=graph)
    rows = {r.call_id: r for r in got.collect()}
    level = plain_levels(needs)
    assert {i: rows[f"k{i}"].level for i in range(n)} == {i: level.get(i) for i in range(n)}
    order = sorted(range(n), key=lambda i: (level.get(i, 1 << 30), i))
    assert [rows[f"k{i}"].position for i in order] == list(range(n))


def test_random_graphs(spark):
    rng = random.Random(11)
    want, data = {}, []
    for conv in range(12):
        n = rng.randint(1, 25)
        needs = {f"{i}": [f"{rng.randrange(max(1, i + rng.choice([0, 0, 0, 3])))}" for _ in range(rng.choice([0, 1, 1, 2]))] for i in range(n)}
        needs = {i: [j for j in js if j in needs] for i, js in needs.items()}
        used = {x for i, js in needs.items() if js for x in (i, *js)}
        level = plain_levels(needs)
        want |= {(f"{conv}", i): level.get(i) for i in used}
        data += [(f"{conv}", i, j) for i, js in needs.items() for j in js]
    edges = spark.createDataFrame(data, "_conv string, _id string, _need string")
    for graph in (T.GRAPH, 5, 0):
        assert {(r._conv, r._id): r._level for r in T.layers(edges, graph).collect()} == want


def test_long_chain_takes_few_rounds(spark):
    edges = spark.createDataFrame([("c", f"{i}", f"{i - 1}") for i in range(1, 1001)], "_conv string, _id string, _need string")
    for graph in (T.GRAPH, 0):
        assert {r._id: r._level for r in T.layers(edges, graph).collect()} == {f"{i}": i for i in range(1001)}


def test_hot_call_null_turns_and_conflicts(spark):
    """Thousands of results of one call, turns that are all null, and calls
    that differ under one identifier: each has its row."""
    calls = [(1, "a", None, "search", f'{{"query":"q","limit":{1 + i % 3}}}', []) for i in range(30)]
    calls += [(1, f"b{i}", None, "search", '{"query":"q","limit":1}', ["a"]) for i in range(200)]
    results = [(1, "a", None, f"r{i}") for i in range(3000)]
    rows = link(spark, calls, results).collect()
    assert sorted(r.position for r in rows) == list(range(3 + 200 + 3000))
    a = [r for r in rows if r.call_id == "a" and r.kind == "call"]
    assert sorted((r.status, r.level, r.copies) for r in a if r.level == 0) == [("ok", 0, 10)]
    assert [(r.status, r.level, r.copies) for r in a if r.level is None] == [("conflicting, ok", None, 10)] * 2
    assert len({r.message for r in a}) == 3
    first = next(r.position for r in a if r.level == 0)
    assert {r.position for r in rows if r.kind == "result"} == set(range(first + 1, first + 3001))


def test_deep_and_long_arguments(spark):
    deep, wide = "[" * 100_000 + "]" * 100_000, '{"limit":1,"query":"' + "x" * 3_000_000 + '"}'
    rows = {r.call_id: r for r in link(spark, [(1, "d", 0, "search", deep, []), (1, "w", 1, "search", wide, [])], []).collect()}
    assert rows["d"].status == "invalid_json, unanswered" and json.loads(rows["d"].message)["function"]["arguments"] == deep
    assert rows["w"].status == "ok, unanswered" and json.loads(rows["w"].message)["function"]["arguments"]["query"] == "x" * 3_000_000


def test_json_text_by_the_jvm(spark):
    texts = ["", "plain é 😀", 'a"b\\c/', "line\nnext\r\t", "".join(map(chr, range(33))) + "\x7f\u2028", "\\u001f \\n"]
    d = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.json_text(F.col("t")).alias("j"))
    assert all(r.j == T.canonical(r.t) for r in d.collect())


def test_query_covers_every_turn(spark):
    from conftest import SF01
    rows = Q.op1_tool_calls(spark, SF01).collect()
    turns = spark.read.parquet(f"{SF01}/conversations.parquet").collect()
    assert len(rows) == len(turns)
    text = {(t.conv_id, t.text) for t in turns}
    for r in rows:
        m = json.loads(r.message)
        if r.kind == "result":
            assert (r.conv_id, m["content"]) in text
        elif isinstance(m["function"]["arguments"], dict):
            a = m["function"]["arguments"]
            assert (r.conv_id, a.get("query", a.get("text"))) in text
