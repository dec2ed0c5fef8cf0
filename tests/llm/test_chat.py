import json

import pytest

from mediamart.llm import chat

KINDS = f"conv_id long, turn int, role string, text string, calls array<{chat.CALL}>, result_of string, row string, link string"
TOOLS = {"f": {"type": "object", "properties": {"a": {"type": "integer"}, "b": {"type": "array", "items": {"type": "string"}}}, "required": ["a"]}}


def call(name, arguments='{"a":1}', needs=(), tool="f"):
    return (name, tool, arguments, list(needs))


def rows(*messages):
    return [(c, t, role, text, calls, result, "x", "y") for c, t, role, text, calls, result in messages]


def run(spark, messages, lane=256):
    df = spark.createDataFrame(rows(*messages), KINDS).repartition(3)
    return chat.transcripts(chat.link(df, TOOLS), lane).orderBy("conv_id", "position").collect()


@pytest.mark.parametrize("lane", [1, 256])
def test_linking_and_order(spark, lane):
    got = run(
        spark,
        [
            (1, 0, "user", "hi", [], None),
            (1, 1, "assistant", "", [call("c1"), call("c2", needs=["c1"])], None),
            (1, 3, "tool", "r1", [], "c1"),
            (1, 2, "tool", "r2", [], "c2"),  # stored before the result that its call needs
            (1, 4, "tool", "again", [], "c1"),
            (1, 5, "tool", "lost", [], "zz"),
            (2, 0, "assistant", None, [call("c1")], None),  # the same identifier in another conversation
            (None, None, "user", "no id", [], None),
        ],
        lane,
    )
    one = [(r.kind, r.call_id, r.link) for r in got if r.conv_id == 1]
    assert one == [
        ("message", None, None), ("message", None, None), ("call", "c1", "linked"), ("result", "c1", "linked"),
        ("call", "c2", "linked"), ("result", "c2", "linked"), ("result", "c1", "repeated"), ("result", "zz", "orphan"),
    ]
    assert [(r.kind, r.link) for r in got if r.conv_id == 2] == [("message", None), ("call", "unanswered")]
    assert sum(r.conv_id is None for r in got) == 1
    assert [r.position for r in got if r.conv_id == 1] == list(range(8))


def test_cycles_are_marked(spark):
    got = run(
        spark,
        [
            (1, 0, "assistant", "", [call("a", needs=["b"])], None),
            (1, 1, "assistant", "", [call("b", needs=["a"])], None),
            (1, 2, "tool", "", [], "a"),
            (1, 3, "tool", "", [], "b"),
            (1, 4, "user", "after", [], None),
        ],
    )
    marked = {(r.kind, r.call_id) for r in got if r.cyclic}
    assert len(marked) == 1 and marked < {("call", "a"), ("call", "b"), ("result", "a"), ("result", "b")}
    assert len(got) == 7
    place = {(r.kind, r.call_id): r.position for r in got}
    needs = {("result", "a"): ("call", "a"), ("call", "b"): ("result", "a"), ("result", "b"): ("call", "b"), ("call", "a"): ("result", "b")}
    assert all(place[n] > place[before] for n, before in needs.items() if n not in marked)


def test_chain_against_the_turns(spark):
    n = 12  # every result is stored before its call, and every call needs the call after it in the table
    messages = [(1, 2 * k + 1, "assistant", "", [call(f"c{k}", needs=[f"c{k + 1}"] if k + 1 < n else [])], None) for k in range(n)]
    messages += [(1, 2 * k, "tool", "", [], f"c{k}") for k in range(n)]
    place = {(r.kind, r.call_id): r.position for r in run(spark, messages) if r.kind != "message"}
    for k in range(n):
        assert place["call", f"c{k}"] < place["result", f"c{k}"]
        if k + 1 < n:
            assert place["result", f"c{k + 1}"] < place["call", f"c{k}"]


ARGUMENTS = [
    ('{"a":1}', None),
    ('{"a":1.0}', None),
    ('{"a":true}', "$.a: not of type integer"),
    ('{"a":"1"}', "$.a: not of type integer"),
    ("{}", "$.a: missing"),
    ('{"a":1,"b":["x",2]}', "$.b[1]: not of type string"),
    ('{"a":1} x', "not JSON"),
    ('{"a":NaN}', "not JSON"),
    ('{"a":1,"a":2}', "not JSON"),
    ("[" * 100_000, "not JSON"),
    ("", "not JSON"),
    (None, "not JSON"),
    ("[]", "$: not of type object"),
]


def test_arguments(spark):
    messages = [(1, k, "assistant", "", [call(f"c{k}", text)], None) for k, (text, _) in enumerate(ARGUMENTS)]
    got = {r.turn: r for r in run(spark, messages) if r.kind == "call"}
    for k, (_, wrong) in enumerate(ARGUMENTS):
        assert (got[k].fault, got[k].valid) == (wrong, wrong is None)
        assert json.loads(got[k].json)["id"] == f"c{k}"


def test_unknown_tool_and_canonical_json(spark):
    got = run(spark, [(1, 0, "assistant", "é\n", [call("c", '{ "b" : 2.0, "a": "é/\\u00e9" }', tool="g")], None)])
    assert got[0].json == '{"content":"é\\n","role":"assistant","type":"message"}'
    assert got[1].json == '{"arguments":{"a":"é/é","b":2},"id":"c","name":"g","type":"call"}'
    assert got[1].fault == "unknown tool"


def test_empty(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("text", ['{"a":"\\ud800"}', '{"\\udfff":1}', '["\\uD83D x"]'])
def test_half_characters_are_not_json(text):
    with pytest.raises(ValueError):
        chat.parsed(text)


def test_whole_characters_are_json():
    assert chat.parsed('{"a":"\\ud83d\\ude00"}') == {"a": "\U0001f600"} and chat.parsed('"\\\\ud800"') == "\\ud800"


def test_schema_traps():
    closed = {"type": "object", "additionalProperties": False}
    assert chat.fault({"": 1}, closed) and chat.fault({}, {"type": "object", "required": [""]})
    assert chat.fault(True, {"enum": [1]}) and chat.fault(1, {"enum": [True]}) and chat.fault([True], {"enum": [[1]]})
    assert chat.fault(1.0, {"enum": [1]}) is None and chat.fault(False, {"enum": [False]}) is None
    for keyword in ("anyOf", "pattern", "$ref", "const"):
        with pytest.raises(ValueError, match="not known"):
            chat.check_schema({"type": "object", "properties": {"a": {"type": "array", "items": {keyword: []}}}})
