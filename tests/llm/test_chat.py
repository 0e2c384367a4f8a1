import json
import random

import duckdb

from barforge.llm import chat, queries

CALL = "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>, level int"
SCHEMAS = [("add", "a", "integer", True, 0.0, None), ("add", "b", "number", False, None, 9.0), ("add", "note", "string", False, None, None)]


def _run(spark, calls, results=()):
    schemas = spark.createDataFrame(SCHEMAS, "name string, param string, type string, required boolean, minimum double, maximum double")
    return chat.linked_calls(spark.createDataFrame([(*c, 1) for c in calls], CALL),
                             spark.createDataFrame([(*r, 7) for r in results], "conv_id long, call_id string, content string, turn int"), schemas).collect()


def test_links_validates_and_serialises(spark):
    calls = [(1, 0, "x", "add", '{"b": 2.5, "a": 1}', []), (1, 1, "y", "add", '{"a": -1, "zz": {"q": 1, "c": [1, {"z": 0, "a": null}]}}', ["x"]),
             (1, 2, "z", "add", "not json", ["y", "gone"]), (2, 0, "w", "other", None, None), (2, 1, None, "add", "{}", ["w"]),
             (2, 2, "v", "add", '{"a": "1", "b": 10, "note": "é/\\""}', ["w", "w"]), (2, 3, "u", "add", "[1]", [])]
    out = {r.call_id: r for r in _run(spark, calls, [(1, "x", "3"), (2, "v", None)])}
    assert len(out) == 7
    assert {k: r.problems for k, r in out.items()} == {"x": [], "y": ["a", "zz"], "z": ["arguments"], "w": ["name"], None: ["a"],
                                                      "v": ["a", "b"], "u": ["arguments"]}
    assert {k for k, r in out.items() if r.linked} == {"x", "v"}
    assert out["x"].json == '{"arguments":{"a":1,"b":2.5},"id":"x","name":"add","result":"3"}'
    assert out["y"].json == '{"arguments":{"a":-1,"zz":{"c":[1,{"a":null,"z":0}],"q":1}},"id":"y","name":"add","result":null}'
    assert json.loads(out["v"].json)["arguments"]["note"] == 'é/"'


def test_every_result_is_a_row(spark):
    calls = [(1, 0, "x", "add", '{"a": 1}', []), (1, 1, "y", "add", '{"a": 2}', []), (1, 2, None, "add", '{"a": 3}', [])]
    results = [(1, "x", "3"), (1, "x", "2"), (1, "x", "3"), (1, "x", None), (1, "y", "1"), (1, "gone", "lost"), (1, None, "none"), (None, "x", "nowhere")]
    rows = _run(spark, calls, results)
    assert sorted((r.n_results, json.loads(r.json)["result"] or "") for r in rows if r.call_id == "x" and r.linked) == [(4, ""), (4, "2"), (4, "3"), (4, "3")]
    lost = [(r.conv_id, r.call_id, r.turn, r.problems, r.json) for r in rows if r.turn is None]
    assert sorted(json.loads(j)["result"] for *_, j in lost) == ["lost", "none", "nowhere"] and all(p == ["call"] for *_, p, _ in lost)
    assert ('{"arguments":null,"id":"gone","name":null,"result":"lost"}') in [j for *_, j in lost]
    assert [(r.linked, r.n_results) for r in rows if r.turn == 2] == [(False, 0)] and len(rows) == 9


def test_identifiers_hold_within_their_conversation(spark):
    """Two conversations that both use call_1, and rows without a conversation."""
    calls = [(1, 0, "call_1", "add", '{"a": 1}', []), (2, 0, "call_1", "add", '{"a": -5}', ["call_2"]), (2, 1, "call_2", "add", '{"a": 1}', []),
             (None, 0, "call_1", "add", '{"a": 1}', ["call_1"]), (None, 1, "call_1", "add", '{"a": 1}', [])]
    rows = _run(spark, calls, [(1, "call_1", "one"), (2, "call_1", "two"), (None, "call_1", "none")])
    found = {(r.conv_id, r.turn): (r.linked, r.problems, json.loads(r.json)["result"], r.level) for r in rows}
    assert found[1, 0] == (True, [], "one", 0) and found[2, 0] == (True, ["a"], "two", 1) and found[2, 1] == (False, [], None, 0)
    assert found[None, 0] == found[None, 1] == (False, [], None, 0) and found[None, None] == (False, ["call"], "none", None)


def test_repeated_and_conflicting_calls(spark):
    calls = [(1, 0, "x", "add", '{"a": 1}', [])] * 3 + [(1, 2, "x", "add", '{"a": -2}', []), (None, 0, "n", "add", '{"a": 1}', [])] + [
        (None, 0, "n", "add", '{"a": 1}', [])]
    rows = sorted(_run(spark, calls, [(1, "x", "r"), (1, "x", "s")]), key=str)
    assert sorted((r.conv_id or 0, r.turn, r.copies, r.linked, r.n_results, r.problems, json.loads(r.json)["result"]) for r in rows) == [
        (0, 0, 2, False, 0, [], None), (1, 0, 3, True, 2, [], "r"), (1, 0, 3, True, 2, [], "s"), (1, 2, 1, False, 0, ["a", "id"], None)]


def test_a_very_long_text_and_a_call_with_very_many_results(spark):
    long = "x" * 1_000_000
    calls = [(1, 0, "x", "add", json.dumps({"a": 1, "note": long}), []), (1, 1, "y", "add", '{"a": 1}', [])]
    rows = _run(spark, calls, [(1, "x", long)] + [(1, "y", str(i)) for i in range(5000)])
    assert len(rows) == 5001 and {r.n_results for r in rows} == {1, 5000}
    assert max(len(r.json) for r in rows) > 2_000_000


def test_query_matches_its_sql_on_odd_rows(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text \"{c}\" é {t} " + "y" * (t * 60)) for c in range(4) for t in range(9)]
    rows += [(0, 0, "user", "another first"), (0, 2, "user", rows[2][3]), (1, 1, "assistant", "second answer"), (1, 1, "assistant", None),
             (None, 0, "user", "nobody"), (None, 1, "assistant", "to nobody"), (None, 0, "user", "nobody"), (7, 1, "assistant", "no question"),
             (8, None, "user", "no turn"), (9, 0, "user", None), (9, 1, "assistant", ""), (9, 2, "system", "rule"), (10, 2, "user", "before"), (10, 4, "user", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.execute(queries.SQL["op6_chat"])
    columns = [c[0] for c in want.description]
    got = sorted(map(tuple, queries.op6_chat(spark, str(tmp_path)).select(columns).collect()), key=repr)
    assert got == sorted(want.fetchall(), key=repr)
    assert {r[columns.index("level")] for r in got} == {0, 1, None}


def test_order_is_topological_and_cycles_are_found(spark):
    rng = random.Random(6)
    calls = []
    for conv in range(6):
        turns = list(range(25))
        rng.shuffle(turns)  # call k may depend on calls before it in this hidden order
        for k, turn in enumerate(turns):
            deps = [f"{conv}-{j}" for j in rng.sample(range(k), min(k, rng.randint(0, 2)))]
            calls.append((conv, turn, f"{conv}-{k}", "add", "{}", deps))
    calls += [(9, 0, "p", "add", "{}", ["q"]), (9, 1, "q", "add", "{}", ["p"]), (9, 2, "r", "add", "{}", ["q"]), (9, 3, "s", "add", "{}", ["s"]),
              (9, 4, "t", "add", "{}", [])]
    out = {r.call_id: r for r in _run(spark, calls)}
    place = {k: (r.level, r.turn, k) for k, r in out.items()}
    for conv, _, call, _, _, deps in calls:
        if conv < 9:
            assert not out[call].cyclic and all(place[d] < place[call] for d in deps)
    assert {k for k, r in out.items() if r.cyclic} == {"p", "q", "r", "s"}


def test_empty_tables(spark):
    assert _run(spark, []) == []
