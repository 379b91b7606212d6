import json

from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import tools as T
from tidemark.llm.queries import op9_tool_call_linking

CALLS = "conv_id bigint, call_id string, after_id string, position bigint, name string, arguments string"
RESULTS = "call_id string, position bigint, content string"


def plain_layers(calls):
    """Layer by walking up from each identifier; None on or behind a cycle."""
    up = {}
    for c in sorted((c for c in calls if c[1] is not None), key=lambda c: (c[0], c[3], c[5] or "")):
        up.setdefault(c[1], c[2])
    out = {}
    for c in up:
        seen, x, n = set(), c, 0
        while up.get(x) in up and x not in seen:
            seen.add(x)
            x, n = up[x], n + 1
        out[c] = None if x in seen else n
    return out


def test_layers_of_chains_trees_and_cycles(spark):
    calls = [(1, f"c{k}", f"c{k - 1}", k, "lookup", "{}") for k in range(70)]
    calls += [(2, f"t{k}", f"t{k // 2}" if k else None, k, "lookup", "{}") for k in range(1, 40)]
    calls += [(3, "x", "y", 0, "lookup", "{}"), (3, "y", "z", 1, "lookup", "{}"), (3, "z", "x", 2, "lookup", "{}"), (3, "w", "x", 3, "lookup", "{}"), (3, "s", "s", 4, "lookup", "{}")]
    got = {r.call_id: r.layer for r in T.linked(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), T.SCHEMAS).collect()}
    assert got == plain_layers(calls)
    assert got["c69"] == 69 and got["x"] is None and got["w"] is None and got["s"] is None


def problem(spark, name, arguments):
    calls = spark.createDataFrame([(1, "a", None, 0, name, arguments)], CALLS)
    return T.linked(calls, spark.createDataFrame([], RESULTS), T.SCHEMAS).first().problem


def test_schemas(spark):
    cases = [("search", '{"query":"x","strict":true}', None), ("search", '{"query":"x"}', "missing:strict"), ("search", '{"strict":true}', "missing:query"),
             ("search", '{"query":1,"strict":true}', "kind:query"), ("search", '{"query":"x","strict":true,"more":1}', "unexpected"),
             ("search", '{"limit":"1","query":"x","strict":true}', "kind:limit"), ("search", "[1]", "not_object"), ("search", "{", "not_json"),
             ("search", None, "not_json"), ("draw", "{}", "unknown_tool"), (None, "{}", "unknown_tool")]
    assert [problem(spark, n, a) for n, a, _ in cases] == [p for _, _, p in cases]


def test_results_and_canonical_json(spark):
    calls = spark.createDataFrame([(1, "a", None, 0, "lookup", ' {"query": "q\\n\\u00e9 \\" /", "limit": 2, "in": {"z": [1, 2.5], "b": null}} '),
                                   (1, "b", "a", 1, 'n"x', "no json"), (1, None, None, 2, "lookup", None), (1, "a", None, 0, "lookup", "{}")], CALLS)
    calls = calls.withColumn("layer", F.lit("own")).withColumn("content", F.lit("own")).withColumn("json", F.lit("own"))
    results = spark.createDataFrame([("a", 5, "late"), ("a", 1, "first\t"), (None, 1, "lost"), ("z", 1, "nobody's"), ("b", None, None)], RESULTS)
    rows = T.linked(calls, results, T.SCHEMAS).collect()
    assert len(rows) == 4
    by = {(r.call_id, r.position): r for r in rows if "in" in r.json or r.call_id != "a"}
    a, b, none = by["a", 0], by["b", 1], by[None, 2]
    assert (a.n_results, b.n_results, none.n_results) == (2, 1, 0) and (a.layer, b.layer, none.layer) == (0, 1, None)
    assert a.json == '{"arguments":{"in":{"b":null,"z":[1,2.5]},"limit":2,"query":"q\\né \\" /"},"id":"a","name":"lookup","result":"first\\t"}'
    assert json.loads(b.json) == {"arguments": "no json", "id": "b", "name": 'n"x', "result": None}
    assert json.loads(none.json) == {"arguments": None, "id": None, "name": "lookup", "result": None}
    assert T.linked(calls.limit(0), results, T.SCHEMAS).count() == 0


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    users = {(c, t) for c, t, role, _ in rows if role == "user"}
    answers = {(c, t - 1): x for c, t, role, x in rows if role == "assistant"}

    def layer(c, t):
        return 1 + layer(c, t - 2) if (c, t - 2) in users else 0

    want = []
    for c, t, role, text in rows:
        if role != "user":
            continue
        name = "draw" if c % 7 == 0 else "search" if t % 4 == 0 else "lookup"
        arguments = {"limit": t, "query": text} | ({"strict": t % 2 == 0} if (c + t) % 3 else {})
        problem = "unknown_tool" if name == "draw" else "missing:strict" if name == "search" and "strict" not in arguments else "unexpected" if name == "lookup" and "strict" in arguments else None
        js = json.dumps({"arguments": arguments, "id": f"call_{c}_{t}", "name": name, "result": answers.get((c, t))}, ensure_ascii=False, separators=(",", ":"))
        want.append((c, f"call_{c}_{t}", layer(c, t), t, int((c, t) in answers), problem is None, problem, js))
    assert sorted(map(tuple, op9_tool_call_linking(spark, SF).collect())) == sorted(want)
    plan = op9_tool_call_linking(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
