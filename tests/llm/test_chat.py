import json

from gleanery.llm import chat

SCHEMAS = {"t": {"required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0, "maximum": 9}, "b": {"type": "array", "items": {"enum": ["x", "y"]}}}, "additionalProperties": False}}
CALLS = "conv long, id string, place long, name string, arguments string, needs array<string>, status string"
RESULTS = "conv long, id string, place long, content string, line string"


def link(spark, calls, results=()):
    frames = spark.createDataFrame([(*c, "clash") for c in calls], CALLS), spark.createDataFrame([(*r, "clash") for r in results], RESULTS)
    return {(r["conv"], r["id"]): r for r in chat.link_calls(*frames, SCHEMAS).collect()}


def test_schema_faults():
    assert chat.faults({"a": 1, "b": ["x"]}, SCHEMAS["t"]) == []
    assert chat.faults({"a": 10, "b": ["z"], "c": 1}, SCHEMAS["t"]) == ["$.c: unknown", "$.a: above maximum", "$.b[0]: not in enum"]
    assert chat.faults({}, SCHEMAS["t"]) == ["$.a: missing"] and chat.faults({"a": True}, SCHEMAS["t"]) == ["$.a: not integer"]
    assert chat.faults(1.5, {"type": ["integer", "null"]}) == ["$: not integer or null"]


def test_links_status_and_canonical_lines(spark):
    ok = '{ "b": ["y"],\n "a": 1 }'
    calls = [
        (1, "c1", 1, "t", ok, None), (1, "c1", 5, "t", "{}", []), (1, "c2", 2, "t", "nonsense", []), (1, "c3", 3, "none", "{}", []),
        (1, "c4", 4, "t", None, ["c1", "gone"]), (2, "c1", 1, "t", '{"a":"é"}', []), (None, "c9", 1, "t", ok, []), (3, None, 1, "t", ok, []), (4, "c1", 1, "t", "[1]", []),
    ]
    results = [(1, "c1", 9, "late"), (1, "c1", 2, "first \"é\""), (2, "c7", 1, "orphan"), (None, "c9", 1, "r"), (1, "c2", 3, None)]
    got = link(spark, calls, results)
    assert set(got) == {(1, "c1"), (1, "c2"), (1, "c3"), (1, "c4"), (2, "c1"), (4, "c1")}
    assert got[1, "c1"]["status"] == "linked" and got[1, "c1"]["line"] == '{"arguments":{"a":1,"b":["y"]},"id":"c1","name":"t","result":"first \\"é\\""}'
    assert {k: r["status"] for k, r in got.items() if k != (1, "c1")} == dict.fromkeys([(1, "c2"), (1, "c3"), (1, "c4"), (2, "c1"), (4, "c1")], "invalid")
    assert got[1, "c3"]["faults"] == ["$: unknown tool"] and got[2, "c1"]["line"] == '{"arguments":{"a":"é"},"id":"c1","name":"t"}'
    frames = spark.createDataFrame([(*c, "") for c in calls], CALLS), spark.createDataFrame([(*r, "") for r in results], RESULTS)
    assert sorted(str(r["id"]) for r in chat.orphans(*frames).collect()) == ["c7", "c9"]
    assert link(spark, []) == {}


def test_order_follows_needs(spark):
    arguments = '{"a":1}'
    call = lambda conv, i, place, *needs: (conv, i, place, "t", arguments, list(needs))
    calls = [call(1, f"c{i}", i, *([f"c{i - 1}"] if i else [])) for i in range(5)]
    calls += [call(2, "a", 1, "d"), call(2, "b", 2), call(2, "c", 3, "a", "b"), call(2, "d", 4), call(2, "e", 5, "d")]
    calls += [call(3, "x", 1, "y"), call(3, "y", 2, "x"), call(3, "z", 3, "y"), call(3, "w", 4), call(3, "s", 5, "s")]
    got = link(spark, calls)
    for conv in (1, 2):
        rows = sorted((r for (c, _), r in got.items() if c == conv), key=lambda r: (r["at"], r["depth"], r["place"]))
        seen = set()
        for r in rows:
            assert set(r["needs"]) <= seen
            seen.add(r["id"])
    assert [r["id"] for r in rows] == ["b", "d", "a", "c", "e"]
    assert {i for (c, i), r in got.items() if r["status"] == "circular"} == {"x", "y", "z", "s"}
    assert got[3, "w"]["status"] == "unanswered"


def test_given_conversations(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "First one. More"), (1, 2, "user", "answer"), (1, 3, "assistant", None), (2, 0, "assistant", ""), (1, 1, "assistant", "First one. More")]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, line string")
    got = {(r["conv_id"], r["call_id"]): r for r in chat.report(df).collect()}
    assert len(got) == 3
    assert json.loads(got[1, "call-1"]["line"]) == {"arguments": {"query": "First one", "words": 3}, "id": "call-1", "name": "search", "result": "answer"}
    assert got[1, "call-3"]["name"] == "lookup" and got[2, "call-0"]["status"] == "invalid"


def test_transcript_holds_whole_turns_and_needs_of_both_directions(spark):
    turns = [(1, 0, "user", "A prompt. Of two sentences"), (1, 1, "assistant", "Two words. "), (1, 2, "user", "é \"answer\". More"), (1, 3, "assistant", "Now three words. No: six")]
    turns += [(2, 0, "system", "Be brief."), (2, 1, "user", "q"), (2, 2, "assistant", "one. two"), (2, 3, "user", "r"), (2, 4, "assistant", "a. b c d")]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, line string")
    rows = chat.transcript(df).collect()
    assert sorted((r["conv_id"], r["order_at"], r["name"], r["line"]) for r in rows if r["kind"] == "orphan") == [
        (1, 0, "user", '{"role":"user","text":"A prompt. Of two sentences"}'),
        (2, 0, "system", '{"role":"system","text":"Be brief."}'), (2, 1, "user", '{"role":"user","text":"q"}'),
    ]
    calls = {(r["conv_id"], r["call_id"]): r for r in rows if r["kind"] == "call"}
    assert len(calls) == 4 and len(rows) == 7
    assert json.loads(calls[1, "call-1"]["line"])["arguments"]["query"] == "Two words. " and json.loads(calls[1, "call-1"]["line"])["result"] == 'é "answer". More'
    assert json.loads(calls[1, "call-3"]["line"])["arguments"]["query"] == "Now three words. No: six"
    assert (calls[1, "call-1"]["order_at"], calls[1, "call-1"]["order_depth"]) == (3, 1) and calls[1, "call-3"]["order_at"] == 3  # it waits for the call after
    assert calls[2, "call-2"]["status"] == calls[2, "call-4"]["status"] == "circular"


def test_turns_without_keys_or_role_stay(spark):
    turns = [(None, 1, "assistant", "no conversation"), (1, None, "assistant", "no number"), (1, None, "assistant", "no number"), (1, None, "user", "nor this"), (None, 2, "user", "u")]
    turns += [(2, 1, "assistant", "a b c"), (2, 2, None, "of no role"), (2, 5, None, "alone"), (None, None, None, None)]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, line string")
    rows = chat.transcript(df).collect()
    calls = [r for r in rows if r["kind"] == "call"]
    assert sorted((str(r["conv_id"]), str(r["call_id"]), r["status"], json.loads(r["line"])["arguments"]["query"]) for r in calls) == [
        ("1", "None", "unanswered", "no number"), ("1", "None", "unanswered", "no number"), ("2", "call-1", "linked", "a b c"), ("None", "call-1", "unanswered", "no conversation"),
    ]
    assert next(json.loads(r["line"])["result"] for r in calls if r["conv_id"] == 2) == "of no role"
    left = sorted(r["line"] for r in rows if r["kind"] == "orphan")
    assert left == ['{"role":"user","text":"nor this"}', '{"role":"user","text":"u"}', '{"role":null,"text":"alone"}', '{"role":null,"text":null}']


def test_every_turn_is_in_a_call_or_a_row_of_its_own(spark):
    turns = [(1, 0, "user", "ask"), (1, 1, "assistant", "d e f"), (1, 1, "assistant", "a b c"), (1, 1, "assistant", "a b c"), (1, 2, "user", "r2"), (1, 2, "user", "r1"), (1, 2, "tool", "r1")]
    turns += [(2, 1, "assistant", None), (2, 1, "assistant", ""), (2, 2, None, None), (2, 2, "user", None), (3, 9, "user", "x"), (3, 9, "user", "x"), (None, 1, "assistant", "n"), (None, 1, "assistant", "n")]
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, line string, n int")
    rows = chat.transcript(df).collect()
    own = [r for r in rows if r["kind"] != "call"]
    answered = sum("result" in json.loads(r["line"]) for r in rows if r["kind"] == "call")
    assert len(rows) + answered == len(turns)
    # What the rows say is what the turns said.
    said = sorted(str(json.loads(r["line"])["text"]) for r in own if r["kind"] == "repeat")
    assert said == ["", "None", "a b c", "d e f", "r1", "r2"]
    assert sorted(json.loads(r["line"])["text"] for r in own if r["kind"] == "orphan") == ["ask", "x", "x"]
