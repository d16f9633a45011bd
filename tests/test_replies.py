"""Reply parsing, judging and cutting."""

import json

import pytest
from pyspark.sql import functions as F

from loomspark.operators import replies as R
from loomspark.operators.prep import parse_messages, valid_file_name


def calls(spark, fmt, text):
    r = R.extract_tool_calls(spark.createDataFrame([(text,)], "text string"), fmt).first()
    return r.content, [(c.name, c.arguments) for c in r.calls], r.error


@pytest.mark.parametrize(
    "fmt,text,want",
    [
        ("generic", '{"tool_calls": [{"name": "f", "arguments": {"b": 1, "a": [2]}}]}', ("", [("f", '{"b":1,"a":[2]}')], None)),
        ("generic", '{"response": "hi"}', ("hi", [], None)),
        ("mistral-nemo", "plain", ("plain", [], None)),
        ("mistral-nemo", 'Bleh[TOOL_CALLS][{"name": "f", "arguments": {"x": 1}, "id": "1"}]', ("Bleh", [("f", '{"x":1}')], None)),
        ("hermes", '<tool_call>{"name": "f", "arguments": {"x": "}"}}</tool_call>', ("", [("f", '{"x":"}"}')], None)),
        ("hermes", '{"name": "f", "arguments": {"x": 1}}', ("", [("f", '{"x":1}')], None)),
        ("hermes", '<function name="f">{"x": 1}</function>', ("", [("f", '{"x":1}')], None)),
        ("hermes", "no call", ("no call", [], None)),
        ("llama3", '{"name": "f", "parameters": {"x": 1}}', ("", [("f", '{"x":1}')], None)),
        ("llama3", "Hello {}", ("Hello {}", [], None)),
        ("llama3-builtin", '<|python_tag|>brave.call(query="a, b", n=2)', ("", [("brave", '{"query":"a, b","n":2}')], None)),
        ("functionary-3.1", '<function=f>{"x": 1}</function>', ("", [("f", '{"x":1}')], None)),
        ("functionary-3.1", "<|python_tag|>print(1)", ("", [("python", '{"code":"print(1)"}')], None)),
        ("functionary-3.2", 'f\n{"x": 1}', ("", [("f", '{"x":1}')], None)),
        ("functionary-3.2", 'all\nhello>>>f\n{"x": 1}\n>>>python\nprint(1)', ("hello", [("f", '{"x":1}'), ("python", '{"code":"print(1)"}')], None)),
        ("command-r7b", "<|START_RESPONSE|>hi<|END_RESPONSE|>", ("hi", [], None)),
    ],
)
def test_calls(spark, fmt, text, want):
    assert calls(spark, fmt, text) == want


@pytest.mark.parametrize(
    "fmt,text",
    [("hermes", '<tool_call>{"name": "f", "arguments": {"x"'), ("llama3", '{"name": "f", "parameters": {"x": 1}'), ("mistral-nemo", '[TOOL_CALLS][{"name"'), ("generic", "{}")],
)
def test_incomplete_calls_are_errors(spark, fmt, text):
    assert calls(spark, fmt, text)[2]


def test_every_format_keeps_plain_text(spark):
    for fmt in R.FORMATS[1:]:
        assert calls(spark, fmt, "just text") == ("just text", [], None)


def test_reasoning(spark):
    cases = {"<think>a</think> b": ("a", "b"), "<think>a": ("a", ""), "a</think>b": (None, "a</think>b"), "<think> </think>b": (None, "b")}
    df = spark.createDataFrame([(k,) for k in cases], "text string")
    assert {r.text: (r.reasoning, r.content) for r in R.split_reasoning(df).collect()} == cases
    forced = R.split_reasoning(spark.createDataFrame([("a</think>b",)], "text string"), forced_open=True).first()
    assert (forced.reasoning, forced.content) == ("a", "b")
    kept = R.split_reasoning(spark.createDataFrame([("<think> a </think>\nb",)], "text string"), in_content=True).first()
    assert kept.content == "<think>a</think>b"


def test_partial_stops(spark):
    df = spark.createDataFrame([("abc<",), ("abc</s",), ("abc",), ("",)], "t string")
    assert [r.p for r in df.select(R.partial_stop("t", ["</s>", "zz"]).alias("p")).collect()] == [3, 3, None, None]


def test_utf8_cut_on_every_prefix(spark):
    raw = "aé€😀".encode()
    df = spark.createDataFrame([(i, bytearray(raw[:i])) for i in range(len(raw) + 1)], "i int, b binary")
    got = {r.i: r.n for r in df.select("i", R.utf8_cut("b").alias("n")).collect()}
    whole = [0, 1, 3, 6, 10]
    assert got == {i: max(w for w in whole if w <= i) for i in range(len(raw) + 1)}


SCHEMA_CASES = [
    ({"type": "string", "maxLength": 3}, ['"abc"', '""'], ['"abcd"', "1", "null"]),
    ({"type": "integer", "minimum": 0, "exclusiveMaximum": 10}, ["0", "9"], ["10", "-1", "1.5", '"1"']),
    ({"type": "number"}, ["1", "1.5", "-2e3"], ['"1"', "true"]),
    ({"type": "boolean"}, ["true"], ["1"]),
    ({"enum": ["red", 1, None]}, ['"red"', "1", "null"], ['"blue"', "2"]),
    ({"const": "x"}, ['"x"'], ['"y"']),
    ({"oneOf": [{"type": "string"}, {"type": "null"}]}, ['"x"', "null"], ["1"]),
    ({"type": ["integer", "boolean"]}, ["1", "false"], ['"x"']),
    ({"type": "array", "items": {"type": "integer"}, "minItems": 1, "maxItems": 2}, ["[1]", "[1, 2]"], ["[]", "[1,2,3]", '["a"]', "1"]),
    ({"prefixItems": [{"type": "string"}, {"type": "number"}]}, ['["a", 1]'], ['["a"]', '["a", "b"]', '["a", 1, 2]']),
    ({"type": "string", "pattern": "^ab?c$"}, ['"abc"', '"ac"'], ['"abb"']),
    ({"type": "string", "format": "uuid"}, ['"12345678-1234-1234-1234-1234567890ab"'], ['"12345678"']),
    ({"type": "string", "format": "date"}, ['"2024-02-29"'], ['"2024-13-01"', '"24-01-01"']),
    ({"type": "object", "properties": {"a": {"type": "integer"}, "b": {}}, "required": ["a"]}, ['{"a": 1}', '{"a": 1, "b": []}'], ["{}", '{"a": "x"}', '{"a": 1, "c": 2}']),
    ({"type": "object", "additionalProperties": {"type": "integer"}}, ["{}", '{"z": 1}'], ['{"z": "x"}']),
    ({"type": "object", "properties": {"o": {"type": "object", "properties": {"k": {"type": "string"}}, "required": ["k"]}}}, ['{"o": {"k": "v"}}', "{}"], ['{"o": {}}']),
]


@pytest.mark.parametrize("i", range(len(SCHEMA_CASES)))
def test_conformance(spark, i):
    schema, good, bad = SCHEMA_CASES[i]
    df = spark.createDataFrame([(t,) for t in [*good, *bad, "{broken"]], "text string")
    got = {r.text: r.ok for r in R.conforms(df, schema).collect()}
    assert got == {**dict.fromkeys(good, True), **dict.fromkeys(bad, False), "{broken": False}


def test_message_errors(spark):
    cases = {
        '{"a": 1}': "expected messages to be an array", "[1]": "expected message to be an object", '[{"content": "x"}]': "missing role", '[{"role": "user"}]': "expected content or tool_calls",
        '[{"role": "user", "content": 1}]': "invalid content type", '[{"role": "user", "content": [{"text": "x"}]}]': "missing content part type", '[{"role": "user", "content": null}]': None,
        '[{"role": "user", "tool_calls": [{"type": "x"}]}]': "unsupported tool call type", '[{"role": "user", "tool_calls": [{"type": "function"}]}]': "missing tool call function",
        '[{"role": "user", "tool_calls": [{"type": "function", "function": {}}]}]': "missing tool call name", '[{"role": "user", "tool_calls": [{}]}]': "missing tool call type",
    }
    df = spark.createDataFrame([(k, k) for k in cases], "id string, body string")
    assert {r.id: r.error for r in parse_messages(df, "body", key="id").collect()} == cases


def test_file_names(spark):
    good, bad = ["a", "a b.txt", "é", "x" * 255], ["", " a", "a ", "a.", "..", "a..b", "a/b", "a\\b", "a:b", "a\x00", "a\x7f", "a∕", "x" * 256, "é" * 128, "﻿a", "a|b"]
    df = spark.createDataFrame([(n,) for n in good + bad], "n string")
    got = {r.n: r.ok for r in df.select("n", valid_file_name("n").alias("ok")).collect()}
    assert got == {**dict.fromkeys(good, True), **dict.fromkeys(bad, False)}


def test_deltas_report_contradictions(spark):
    rows = [(1, 0, "a", "", 0), (1, 1, "ab", "r", 1), (1, 2, "a", "r", 1), (1, 3, "x", "r", 0)]
    df = spark.createDataFrame(rows, "reply_id long, seq long, content string, reasoning string, n_calls int")
    got = [(r.content_delta, r.reasoning_delta, r.new_calls, r.error) for r in R.message_deltas(df).orderBy("seq").collect()]
    assert got[:3] == [("a", "", 0, None), ("b", "r", 1, None), ("", "", 0, None)]
    assert got[3][3] == "fewer tool calls than before"


def test_judge(spark):
    text = json.dumps({"name": "f", "parameters": {"q": "tomorrow"}})
    df = R.extract_tool_calls(spark.createDataFrame([(text,), ("none",)], "text string"), "llama3")
    assert R.judge_tool_calls(df, name="f", argument="q", pattern="^to").filter("success").count() == 1
