import json

import odd_docs
from pyspark.sql import functions as F

from meterwise.llm import chat, queries
from meterwise.llm.chat import Field

CALLS = (
    "conv_id BIGINT, turn BIGINT, call_id STRING, name STRING, arguments STRING, depends_on ARRAY<STRING>, "
    "content STRING, status STRING, position INT, _nth STRING"
)
RESULTS = "conv_id BIGINT, turn BIGINT, call_id STRING, content STRING, name STRING, errors INT"
SCHEMAS = {
    "add": {"x": Field("number"), "y": Field("integer", low=0, high=9)},
    "say": {"text": Field("string", low=1, high=5), "loud": Field("boolean", required=False)},
}


def run(spark, calls, results):
    full = [(*c, "mine", "mine", 5, "mine") for c in calls]
    made = spark.createDataFrame(full, CALLS).repartition(3)
    given = spark.createDataFrame([(*r, "mine", 5) for r in results], RESULTS)
    return {(r["conv_id"], r["call_id"], r["turn"]): r for r in chat.format_calls(made, given, SCHEMAS).collect()}


def test_links_orphans_and_repeated_identifiers(spark):
    add = '{"y": 1, "x": 2}'
    got = run(
        spark,
        [(1, 0, "a", "add", add, None), (1, 4, "a", "add", add, None), (1, 2, "b", "add", add, []),
         (2, 0, "a", "add", add, []), (None, 0, None, "add", add, None)],
        [(1, 1, "a", "one"), (1, 5, "a", "two"), (3, 1, "a", "lost"), (None, 1, None, "null id")],
    )
    found = {k: (r["status"], r["result_turn"], r["position"]) for k, r in got.items()}
    assert found == {
        (1, "a", 0): ("linked", 1, 0), (1, "a", 4): ("linked", 5, 2), (1, "b", 2): ("unanswered", None, 1),
        (2, "a", 0): ("unanswered", None, 0), (None, None, 0): ("linked", 1, 0), (3, "a", None): ("orphan", 1, None),
    }
    assert json.loads(got[1, "a", 4]["json"]) == {
        "arguments": {"x": 2, "y": 1}, "id": "a", "name": "add", "result": "two"
    }
    assert got[1, "a", 0]["json"] == '{"arguments":{"x":2,"y":1},"id":"a","name":"add","result":"one"}'
    assert got[1, "a", 0]["valid"] and not got[2, "a", 0]["valid"]


def test_topological_order(spark):
    say = '{"text":"x"}'
    needs = {"a": ["d"], "b": ["a", "c"], "c": [], "d": ["c", "elsewhere"], "e": ["e"], "f": ["g"], "g": ["f"], "h": ["g"]}
    calls = [(1, t, i, "say", say, needs[i]) for t, i in enumerate(needs)]
    calls += [(2, t, i, "say", say, [prev] if prev else None) for t, (i, prev) in enumerate([("a", None), ("b", "a"), ("c", "a")])]
    got = run(spark, calls, [])
    place = {k[1]: r["position"] for k, r in got.items() if k[0] == 1}
    assert [place[i] for i in "cdab"] == [0, 1, 2, 3]
    assert all(place[i] is None and got[1, i, "abcdefgh".index(i)]["errors"] == ["depends_on: cycle"] for i in "efgh")
    assert [got[2, i, t]["position"] for t, i in enumerate("abc")] == [0, 1, 2]


def test_arguments_against_schemas(spark):
    cases = {
        '{"x": 1.5, "y": 9}': [], '{"x": 1, "y": 10}': ["y: above 9"], '{"x": "1", "y": -1}': ["x: no number", "y: below 0"],
        '{"y": 2.5, "x": 1}': ["y: no integer"], '{"y": null, "x": 1, "z": []}': ["y: missing", "z: not in the schema"],
        "[1]": ["arguments: no object"], "{": ["arguments: not JSON"], "": ["arguments: not JSON"], None: ["arguments: not JSON"],
    }
    got = run(spark, [(1, k, f"c{k}", "add", a, None) for k, a in enumerate(cases)], [])
    assert [got[1, f"c{k}", k]["errors"] for k in range(len(cases))] == list(cases.values())
    other = {'{"text": ""}': ["text: below 1"], '{"text": "éééééé"}': ["text: above 5"], '{"text": "é", "loud": 1}': ["loud: no boolean"]}
    got = run(spark, [(1, k, f"c{k}", "say", a, None) for k, a in enumerate(other)] + [(1, 9, "u", "fly", "{}", None), (1, 10, "n", None, "{}", None)], [])
    assert [got[1, f"c{k}", k]["errors"] for k in range(3)] == list(other.values())
    assert got[1, "u", 9]["errors"] == got[1, "n", 10]["errors"] == ["name: unknown tool"]


def test_canonical_json(spark):
    text = '{ "b" : [ 1 , {"z":null,"a":"q\\n\\u00e9\\"/"} ], "a":true, "é":{} }'
    out = spark.createDataFrame([(text,), (None,), ("no",)], "t STRING").select(chat.canonical("t")).collect()
    assert [r[0] for r in out] == ['{"a":true,"b":[1,{"a":"q\\né\\"/","z":null}],"é":{}}', None, None]


def test_empty_tables_and_long_texts(spark):
    assert run(spark, [], []) == {}
    long = json.dumps({"text": odd_docs.LONG})
    got = run(spark, [(1, 0, "a", "say", long, None)], [(1, 1, "a", odd_docs.LONG)])
    assert json.loads(got[1, "a", 0]["json"])["result"] == odd_docs.LONG and got[1, "a", 0]["errors"] == ["text: above 5"]


def test_places_of_a_hot_key(spark):
    rows = spark.range(0, 500, 1, 7).select(F.lit(3).alias("k"), F.col("id").alias("t")).union(spark.range(4).select(F.lit(4), "id"))
    got = chat.numbered(rows, ("k",), ("t",), "n")
    assert got.where("n <> t").count() == 0 and got.count() == 504


def test_query_runs_without_python(spark, sf_dir):
    plan = queries.registered()["op3_chat_formatting"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
