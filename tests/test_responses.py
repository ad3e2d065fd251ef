import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import jsontext as J
from corpusloom.functions import text as X
from corpusloom.operators import responses as R
from corpusloom.operators import rewards as W
from corpusloom.operators import tools as T


def one(spark, value, fn, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, content, reasoning, finish",
    [
        ("", "", None, "stop"),
        (" hi ", "hi", None, "stop"),
        ("<think>\n a \n</think>\n\nb", "b", "a", "stop"),
        ("<think>a</think> x <think>b</think>  y", "x y", "a", "stop"),
        ("a</think> b </think> c", "b </think> c", "a", "stop"),
        ('x<tool_call>{"name": "f", "arguments": {"a": 1}}</tool_call><tool_call>bad</tool_call>', "x", None, "tool_calls"),
        ("x<tool_call>bad</tool_call>", "x<tool_call>bad</tool_call>", None, "stop"),
    ],
)
def test_parse_response(spark, text, content, reasoning, finish):
    r = one(spark, text, R.parse_response)
    assert (r["content"], r["reasoning"], r["finish_reason"]) == (content, reasoning, finish)


def test_call_arguments(spark):
    text = (
        '<tool_call>{"name":"f","arguments":{"b":[1,2],"a":"x,y:z"}}</tool_call><tool_call>oops</tool_call>'
        '<tool_call>{"arguments":"plain \\"q\\""}</tool_call><tool_call>{"name":"n"}</tool_call><tool_call>[1]</tool_call>'
    )
    calls = one(spark, text, R.parse_response)["calls"]
    assert [(c["index"], c["name"], c["arguments"]) for c in calls] == [
        (0, "f", '{"b": [1, 2], "a": "x,y:z"}'),
        (2, "", '"plain \\"q\\""'),
        (3, "n", "{}"),
    ]
    # The looser form only counts spans that hold braces; a broken one leaves a gap.
    braced = text + "<tool_call>{bad}</tool_call>" + '<tool_call>{"name":"z"}</tool_call>'
    assert [c["id"] for c in one(spark, braced, R.braced_calls)] == ["call_0", "call_1", "call_2", "call_4"]


@pytest.mark.parametrize("text, ok", [('{"a":1}', True), ('{"a":1} x', False), ("", False), ("{'a':1}", False), ("[1, 2]", True), ("3", True), ('{"a":1}{"b":2}', False), (None, False), ("1],[2", False), ('1},{"a":2', False), ("null", True)])
def test_is_json(spark, text, ok):
    assert one(spark, text, J.is_json) is ok


@pytest.mark.parametrize("text, found", [
    ("a 1,234 b", [1234.0]), ("x12 3.5 -7 +2", [3.5, -7.0, 2.0]), ("ends with 12.", []), ("1.2.3", []), ("5-3", [5.0, 3.0]), ("値12", []),
])
def test_numbers(spark, text, found):
    assert one(spark, text, X.numbers) == found


def test_strip_covers_unicode_blanks(spark):
    assert one(spark, "　\t a b  \x1f\n", X.strip) == "a b"
    assert one(spark, "\n a \n", X.strip_newlines) == " a "


@pytest.mark.parametrize("text, value", [("", 0.0), ("a b", 0.0), ("a b c", 0.0), ("a b c a b c", 0.25), ("x " * 30, 0.5)])
def test_repeat_fraction(spark, text, value):
    assert one(spark, text, X.repeat_fraction) == pytest.approx(value)


@pytest.mark.parametrize("n, score", [(4, -0.5), (5, 0.5), (19, 0.5), (20, 0.5), (800, 0.5), (801, -0.5)])
def test_agent_length_band(spark, n, score):
    # One long word: no repeated trigrams.
    df = spark.createDataFrame([("x" * n,)], "v string")
    v = F.col("v")
    none = F.array().cast("array<string>")
    assert df.select(W.agent_reward(v, F.array(v), F.lit(False), none, none).alias("r")).first()["r"] == pytest.approx(score)


@pytest.mark.parametrize("n, score", [(19, -0.5), (20, 0.5), (800, 0.5), (801, -0.5)])
def test_single_length_band(spark, n, score):
    assert one(spark, "x" * n, W.single_turn_reward) == pytest.approx(score)


def test_thinking_terms(spark):
    # length 0.5, thinking of 20 characters 1.0, one close tag 0.25
    assert one(spark, "t" * 20 + "</think>answer", W.single_turn_reward) == pytest.approx(1.75)
    # thinking too short, two close tags
    assert one(spark, "t</think>answer is here</think>", W.single_turn_reward) == pytest.approx(0.5 - 0.5 - 0.25)


@pytest.mark.parametrize("text, gt, found", [
    ("answer is 19", ["9"], ["9"]),
    ("total 1,234", ["1234"], ["1234"]),
    ("total 12.", ["12.0"], []),
    ("Paris!", ["paris", "paris", "PARIS"], ["paris", "PARIS"]),
    ("value 3.0", [" 3 ", "4"], [" 3 "]),
    ("anything", [""], []),
    ("x", [], []),
])
def test_verified_values(spark, text, gt, found):
    df = spark.createDataFrame([(text, gt)], "t string, gt array<string>")
    assert df.select(W.verified_values(F.col("t"), F.col("gt")).alias("r")).first()["r"] == found


def agent(spark, turns, unfinished, names, gt):
    df = spark.createDataFrame([(turns[-1], turns, unfinished, names, gt)], "r string, t array<string>, u boolean, n array<string>, g array<string>")
    return df.select(W.agent_reward(*[F.col(c) for c in "rtung"]).alias("x")).first()["x"]


CALL = '<tool_call>{"name": "get_current_weather", "arguments": {"location": "Tokyo"}}</tool_call>'


def test_agent_reward_with_calls(spark):
    # one valid call for one expected value (0.5) and the value verified (2.5) -> clipped at 3
    assert agent(spark, [CALL, "It is 12°C in Tokyo"], False, ["get_current_weather"], ["12°C"]) == pytest.approx(3.0)
    # value missing from the answer
    assert agent(spark, [CALL, "no idea"], False, ["get_current_weather"], ["12°C"]) == pytest.approx(0.5)
    # tool not offered: gap is 1 (valid against expected) + 1 (invalid call)
    assert agent(spark, [CALL, "no idea"], False, [], ["12°C"]) == pytest.approx(-1.0)
    # unfinished: final text is empty, nothing is verified, repetition is measured on the answer
    repeated = one(spark, CALL, X.repeat_fraction)
    assert agent(spark, [CALL], True, ["get_current_weather"], ["Tokyo"]) == pytest.approx(0.5 - 0.5 - repeated)
    # an open tag without its close
    assert agent(spark, [CALL, "no idea <tool_call>"], False, ["get_current_weather"], ["12°C"]) == pytest.approx(0.0)
    # a broken call is skipped: this turn has no calls
    assert agent(spark, ["<tool_call>{bad</tool_call>"], False, [], []) == pytest.approx(0.5)


@pytest.mark.parametrize("name, args, ok", [
    ("unit_converter", '{"value": 0, "from_unit": "km", "to_unit": "miles"}', True),
    ("unit_converter", '{"value": null, "from_unit": "km", "to_unit": "miles"}', False),
    ("unit_converter", '{"from_unit": "km", "to_unit": "miles"}', False),
    ("unit_converter", '{"value": 1, "from_unit": "", "to_unit": "miles"}', False),
    ("calculate_math", '{"expression": 0}', False),
    ("calculate_math", '{"expression": "1+1"}', True),
    ("get_current_time", "{}", True),
    ("fly", "{}", False),
])
def test_argument_rules(spark, name, args, ok):
    df = spark.createDataFrame([(name, args)], "n string, a string")
    assert df.select(T.arguments_ok(F.col("n"), F.col("a")).alias("r")).first()["r"] is ok


def test_string_arguments_are_read_as_json(spark):
    call = '{"name": "f", "arguments": "{\\"x\\": 1}"}'
    assert one(spark, call, J.argument_object) == '{"x": 1}'
    assert one(spark, '{"name": "f", "arguments": "nope"}', J.argument_object) == "{}"


def test_repeated_keys_take_their_last_value(spark):
    call = '{"name": "f", "arguments": {"x": 1, "y": {"b": 1, "a": 2}, "x": "2"}, "name": "g"}'
    assert one(spark, call, lambda t: J.last_member(t, "name")) == "g"
    assert json.loads(one(spark, call, J.argument_object)) == {"x": "2", "y": {"b": 1, "a": 2}}
    row = spark.createDataFrame([(f"<tool_call>{call}</tool_call>",)], "t string").select(R.call_spans(F.col("t")).alias("c")).first()["c"][0]
    assert row["name"] == "g" and json.loads(row["arguments"]) == {"x": "2", "y": {"b": 1, "a": 2}}
    plain = '{"name": "f", "arguments": {"z": 1, "a": "2"}}'
    assert one(spark, plain, J.argument_object) == '{"z":1,"a":"2"}'


def test_deep_repeats_are_those_of_a_json_reader(spark):
    import random

    dice = random.Random(3)

    def value(depth):
        kind = dice.random()
        if depth == 0 or kind < 0.35:
            return dice.choice(["1", "-2.5e3", "true", "null", '"a\\"b"', '"{,:]"', '""', '"\\u00e9 x"'])
        if kind < 0.55:
            return "[" + " , ".join(value(depth - 1) for _ in range(dice.randint(0, 3))) + "]"
        keys = ['"a"', '"b"', '"\\u0061"', '"c d"']
        return "{ " + ",".join(f"{dice.choice(keys)} : {value(depth - 1)}" for _ in range(dice.randint(0, 4))) + "}"

    texts = [value(5) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert all(json.loads(r["t"]) == json.loads(r["v"]) for r in df.select("t", J.last_values(F.col("t")).alias("v")).collect())
    call = '{"name": "f", "arguments": {"y": {"b": 1, "b": [{"c": 1, "c": 2}]}, "z": 3}}'
    assert json.loads(one(spark, call, J.argument_object)) == json.loads(call)["arguments"]
    row = spark.createDataFrame([(f"<tool_call>{call}</tool_call>",)], "t string").select(R.call_spans(F.col("t")).alias("c")).first()["c"][0]
    assert json.loads(row["arguments"]) == json.loads(call)["arguments"]
    assert one(spark, '{"a": 1, "a": 2', J.without_repeats) == '{"a": 1, "a": 2' and one(spark, None, J.without_repeats) is None


def test_hooks(spark):
    import pandas as pd

    from corpusloom.operators.hooks import generate, score_responses

    df = spark.createDataFrame([([("user", "q")], "abcdefgh"), ([("user", "q")], "a")], "m array<struct<role:string,content:string>>, r string")
    scored = score_responses(df, F.col("m"), F.col("r"), lambda state, context, text: text.str.len() + state, setup=lambda: 0.5)
    assert [r["score"] for r in scored.collect()] == [3.0, 1.5]

    def twice(state, batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"r": batch["r"], "completion": batch["r"] * 2})

    assert sorted(r["completion"] for r in generate(df.select("r"), twice, "r string, completion string").collect()) == ["aa", "abcdefghabcdefgh"]
