"""Conversations to training text, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import fixed
from corpusloom.functions.bind import let
from corpusloom.functions.jsontext import spaced
from corpusloom.functions.text import (
    WS_CLASS,
    after_last,
    before_first,
    lstrip_newlines,
    rstrip_newlines,
    strip,
    strip_newlines,
)
from corpusloom.operators.messages import FIELDS, decode_calls, role_neighbours, tool_list


def _block(role: Column, body: Column) -> Column:
    return F.concat(F.lit(fixed.START), role, F.lit("\n"), body, F.lit(fixed.END + "\n"))


def tool_preamble(first_content: Column | None, tools: Column) -> Column:
    """System block with one JSON line per tool, after the system text if there is one."""
    lead = F.lit("") if first_content is None else first_content
    lines = F.array_join(F.transform(tools, lambda t: F.concat(F.lit("\n"), spaced(t))), "")
    return F.concat(
        F.lit(fixed.START + "system\n"), lead, F.lit(fixed.TOOLS_INTRO), lines, F.lit(fixed.TOOLS_OUTRO)
    )


def split_reasoning(content: Column, reasoning_content: Column | None = None) -> Column:
    """(reasoning, content) of a reply.

    A separate reasoning field wins and leaves the content alone. Otherwise the text up to the
    first close tag, after its last open tag, is the reasoning and the text behind the last
    close tag the content.
    """
    closed = F.contains(content, F.lit(fixed.THINK_CLOSE))
    head = rstrip_newlines(before_first(content, fixed.THINK_CLOSE))
    inner = lstrip_newlines(after_last(head, fixed.THINK_OPEN))
    rest = lstrip_newlines(after_last(content, fixed.THINK_CLOSE))
    plain = F.struct(
        F.when(closed, inner).otherwise(F.lit("")).alias("reasoning"),
        F.when(closed, rest).otherwise(content).alias("content"),
    )
    if reasoning_content is None:
        return plain
    given = F.struct(reasoning_content.alias("reasoning"), content.alias("content"))
    return F.when(reasoning_content.isNotNull(), given).otherwise(plain)


def _call_text(call: Column) -> Column:
    arguments = F.when(call["verbatim"], call["arguments"]).otherwise(spaced(call["arguments"]))
    return F.concat(
        F.lit(fixed.CALL_OPEN + '\n{"name": "'),
        F.coalesce(call["name"], F.lit("")),
        F.lit('", "arguments": '),
        F.coalesce(arguments, F.lit("")),
        F.lit("}\n" + fixed.CALL_CLOSE),
    )


def _assistant(m: Column) -> Column:
    content = F.coalesce(m["content"], F.lit(""))

    def body(parts: Column) -> Column:
        calls = F.transform(
            decode_calls(m["tool_calls"]),
            lambda call, i: F.concat(
                F.when((i > 0) | (F.length(parts["content"]) > 0), F.lit("\n")).otherwise(F.lit("")),
                _call_text(call),
            ),
        )
        return F.concat(
            F.lit(fixed.THINK_OPEN + "\n"),
            strip_newlines(parts["reasoning"]),
            F.lit("\n" + fixed.THINK_CLOSE + "\n\n"),
            lstrip_newlines(parts["content"]),
            F.when(m["tool_calls"].isNull(), F.lit("")).otherwise(F.coalesce(F.array_join(calls, ""), F.lit(""))),
        )

    return _block(F.lit("assistant"), let(split_reasoning(content, m["reasoning_content"]), body))


def _tool(m: Column, previous: Column, following: Column) -> Column:
    opens = F.coalesce(previous != "tool", F.lit(True))
    closes = F.coalesce(following != "tool", F.lit(True))
    return F.concat(
        F.when(opens, F.lit(fixed.START + "user")).otherwise(F.lit("")),
        F.lit("\n" + fixed.RESPONSE_OPEN + "\n"),
        F.coalesce(m["content"], F.lit("")),
        F.lit("\n" + fixed.RESPONSE_CLOSE),
        F.when(closes, F.lit(fixed.END + "\n")).otherwise(F.lit("")),
    )


def message_text(m: Column, first: Column, previous: Column, following: Column) -> Column:
    """Text of one message, given whether it is the first and the roles next to it.

    Consecutive tool results share one user block. A leading system message is part of the
    header and gives nothing here.
    """
    role = m["role"]
    plain = (role == "user") | ((role == "system") & ~first)
    return (
        F.when(plain, _block(role, F.coalesce(m["content"], F.lit(""))))
        .when(role == "assistant", _assistant(m))
        .when(role == "tool", _tool(m, previous, following))
        .otherwise(F.lit(""))
    )


def header(messages: Column, tools_json: Column | None = None) -> Column:
    """Text before the first message: the tool preamble or a leading system message."""
    first = F.get(messages, F.lit(0))
    leads = F.coalesce(first["role"] == "system", F.lit(False))
    text = F.coalesce(first["content"], F.lit(""))
    without = F.when(leads, _block(F.lit("system"), text)).otherwise(F.lit(""))
    if tools_json is None:
        return without
    lead = F.when(leads, F.concat(text, F.lit("\n\n"))).otherwise(F.lit(""))
    return let(
        tool_list(tools_json),
        lambda tools: F.when(F.coalesce(F.size(tools) > 0, F.lit(False)), tool_preamble(lead, tools)).otherwise(without),
    )


def generation_prompt(thinking: Column) -> Column:
    """Open reply header, with an open think tag or an empty think block."""
    return F.concat(
        F.lit(fixed.START + "assistant\n"),
        F.when(F.coalesce(thinking, F.lit(False)), F.lit(fixed.THINK_OPEN + "\n")).otherwise(
            F.lit(fixed.EMPTY_THINK)
        ),
    )


def render(messages: Column, tools_json: Column | None = None, prompt_thinking: Column | None = None) -> Column:
    """One conversation as training text.

    ``tools_json`` is the tool list as JSON text. With ``prompt_thinking`` an open reply header
    is added at the end.
    """

    def build(ms: Column) -> Column:
        pieces = F.transform(
            ms,
            lambda m, i: message_text(m, i == 0, F.get(ms, i - 1)["role"], F.get(ms, i + 1)["role"]),
        )
        return F.concat(header(ms, tools_json), F.array_join(pieces, ""))

    text = let(messages, build)
    return text if prompt_thinking is None else F.concat(text, generation_prompt(prompt_thinking))


def render_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The long form: each turn with its ``piece`` of the rendered text, for gap-free turn numbers.

    Pieces in turn order make up the text. No conversation is gathered, so this also serves
    conversations too long for one row, and lengths or counts can be summed over the pieces.
    """
    none = F.lit(None).cast("string")
    m = F.struct(F.col(role).alias("role"), F.col(text).alias("content"), *[none.alias(n) for n in FIELDS[2:]])
    first = F.col("prev_role").isNull()
    lead = F.when(first & (F.col(role) == "system"), _block(F.lit("system"), F.coalesce(F.col(text), F.lit("")))).otherwise(F.lit(""))
    piece = F.concat(lead, message_text(m, first, F.col("prev_role"), F.col("next_role")))
    return role_neighbours(turns, conv, turn, role).select(conv, turn, piece.alias("piece"))


_BLOCKS = rf"(?s)<\|im_start\|>(system|user|assistant)[{WS_CLASS}]+(.*?)<\|im_end\|>"


def reparse(rendered: Column) -> Column:
    """Rendered text back to (role, content) messages; contents are stripped."""
    roles = F.regexp_extract_all(rendered, F.lit(_BLOCKS), F.lit(1))
    bodies = F.regexp_extract_all(rendered, F.lit(_BLOCKS), F.lit(2))
    return F.zip_with(roles, bodies, lambda r, b: F.struct(r.alias("role"), strip(b).alias("content")))
