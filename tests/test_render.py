from pyspark.sql import functions as F

from corpusloom.operators import messages as M
from corpusloom.operators.render import generation_prompt, render, reparse
from corpusloom.sources.readers import MESSAGE, SCHEMAS

S, E = "<|im_start|>", "<|im_end|>\n"


def msg(role, content=None, reasoning=None, tools=None, calls=None):
    return (role, content, reasoning, tools, calls)


def rendered(spark, *messages):
    df = spark.createDataFrame([(list(messages),)], SCHEMAS["conversation"])
    c = F.col("conversations")
    return df.select(render(c, M.tool_schema(c)).alias("t")).first()["t"]


def think(reasoning=""):
    return f"<think>\n{reasoning}\n</think>\n\n"


def test_system_positions(spark):
    assert rendered(spark, msg("system", "s"), msg("user", "u")) == f"{S}system\ns{E}{S}user\nu{E}"
    assert rendered(spark, msg("user", "u"), msg("system", "s")) == f"{S}user\nu{E}{S}system\ns{E}"


def test_null_content_counts_as_empty(spark):
    assert rendered(spark, msg("user", None), msg("assistant", None)) == f"{S}user\n{E}{S}assistant\n{think()}{E}"


def test_reasoning_sources(spark):
    a = f"{S}assistant\n"
    assert rendered(spark, msg("assistant", "\nhi", "\nwhy\n")) == f"{a}{think('why')}hi{E}"
    assert rendered(spark, msg("assistant", "<think>\nwhy\n</think>\n\nhi")) == f"{a}{think('why')}hi{E}"
    assert rendered(spark, msg("assistant", "why</think>hi")) == f"{a}{think('why')}hi{E}"
    # Two close tags: reasoning ends at the first, content starts after the last.
    assert rendered(spark, msg("assistant", "a</think>b</think>c")) == f"{a}{think('a')}c{E}"
    # A separate reasoning field leaves tags in the content alone.
    assert rendered(spark, msg("assistant", "x</think>y", "r")) == f"{a}{think('r')}x</think>y{E}"


def test_tools_and_calls(spark):
    tools = '[{"name": "f", "p": {"b": 1, "a": "x, y: z \\u4f60"}}]'
    calls = '[{"name": "f", "arguments": {"k": [1, 2], "s": "a:b"}}, {"function": {"name": "g", "arguments": "{\\"raw\\":1}"}}]'
    text = rendered(
        spark, msg("system", "sys", tools=tools), msg("assistant", "", calls=calls), msg("tool", "r1"), msg("tool", "r2"), msg("user", "u")
    )
    assert text.startswith(f"{S}system\nsys\n\n# Tools\n\n")
    assert '\n<tools>\n{"name": "f", "p": {"b": 1, "a": "x, y: z 你"}}\n</tools>\n' in text
    expected_calls = (
        '<tool_call>\n{"name": "f", "arguments": {"k": [1, 2], "s": "a:b"}}\n</tool_call>\n'
        '<tool_call>\n{"name": "g", "arguments": {"raw":1}}\n</tool_call>'
    )
    assert f"{S}assistant\n{think()}{expected_calls}{E}" in text
    responses = "\n<tool_response>\nr1\n</tool_response>\n<tool_response>\nr2\n</tool_response>"
    assert text.endswith(f"{S}user{responses}{E}{S}user\nu{E}")


def test_calls_after_content_start_on_a_new_line(spark):
    text = rendered(spark, msg("assistant", "look", calls='[{"name": "f", "arguments": {}}]'))
    assert 'look\n<tool_call>\n{"name": "f", "arguments": {}}\n</tool_call>' in text


def test_last_system_message_with_tools_wins(spark):
    df = spark.createDataFrame(
        [([msg("system", "a", tools="[1]"), msg("system", "b", tools="[2]"), msg("system", "c", tools="")],)], SCHEMAS["conversation"]
    )
    assert df.select(M.tool_schema(F.col("conversations")).alias("t")).first()["t"] == "[2]"


def test_generation_prompt(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean").select(generation_prompt(F.col("f")).alias("p"))
    open_, closed, missing = [r["p"] for r in df.collect()]
    assert open_ == f"{S}assistant\n<think>\n"
    assert closed == missing == f"{S}assistant\n{think()}"


def test_reparse_inverts_render(spark):
    text = rendered(spark, msg("system", " s "), msg("user", "line\nline"), msg("assistant", "ok"))
    df = spark.createDataFrame([(text.replace(think(), ""),)], "t string").select(reparse(F.col("t")).alias("m"))
    assert [tuple(m) for m in df.first()["m"]] == [("system", "s"), ("user", "line\nline"), ("assistant", "ok")]


def test_pieces_make_up_the_text(spark):
    from corpusloom.operators.render import render_turns

    roles = ["system", "user", "assistant", "tool", "tool", "user", "tool"]
    messages = [msg(r, f"{r} {i}") for i, r in enumerate(roles)]
    turns = spark.createDataFrame([(1, i, m[0], m[1]) for i, m in enumerate(messages)], "conv_id int, turn int, role string, text string")
    pieces = sorted(map(tuple, render_turns(turns).select("turn", "piece").collect()))
    assert "".join(p for _, p in pieces) == rendered(spark, *messages)


def test_system_prompt_is_not_added_to_tools_or_system(spark):
    rows = [(i, [msg("system", "s"), msg("user", "u")]) for i in range(50)]
    rows += [(i, [msg("user", "u", tools="[1]")]) for i in range(50, 100)]
    rows += [(i, [msg("user", "u")]) for i in range(100, 1100)]
    df = spark.createDataFrame(rows, "id int, conversations array<struct<role:string,content:string,reasoning_content:string,tools:string,tool_calls:string>>")
    grown = df.select("id", (F.size(M.add_system_prompt(F.col("conversations"), F.col("id"))) - F.size("conversations")).alias("n"))
    added = [r["id"] for r in grown.filter("n = 1").collect()]
    assert min(added) >= 100
    assert 150 <= len(added) <= 250


def test_history_styles(spark):
    df = spark.createDataFrame([([msg("user", str(i)) for i in range(5)],)], SCHEMAS["conversation"])
    c = F.col("conversations")
    kept = df.select(
        *[F.size(M.history(c, n, s)).alias(f"{s}{n}") for s in ("cli", "client", "web") for n in (0, 2, 9)]
    ).first()
    assert tuple(kept) == (0, 2, 5, 1, 2, 5, 1, 3, 5)


def test_message_schema_matches_sources():
    assert [f.name for f in MESSAGE.fields] == list(M.FIELDS)


def test_judge_context(spark):
    df = spark.createDataFrame([([msg("user", "q1"), msg("assistant", "a1"), msg("user", "q2")],), ([msg("user", "q")],)], SCHEMAS["conversation"])
    long, short = [r["c"] for r in df.select(M.judge_context(F.col("conversations")).alias("c")).collect()]
    assert long == "user: q1\nassistant: a1\n以上是对话历史。我的新问题是：\nq2"
    assert short == "q"
