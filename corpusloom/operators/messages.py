"""Operators on message arrays: normalising, sampling, selecting and cutting conversations.

A conversation is an array of (role, content, reasoning_content, tools, tool_calls) structs
in one row, so none of these shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import fixed
from corpusloom.functions.bind import let
from corpusloom.functions.draws import choose, draw_int, draw_uniform
from corpusloom.functions.text import strip
from corpusloom.session import settled

FIELDS = ("role", "content", "reasoning_content", "tools", "tool_calls")
CALL_TYPE = "struct<name:string,arguments:{0},function:struct<name:string,arguments:{0}>>"


def message(role: str, content: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(role).alias("role"), content.alias("content"), *[none.alias(n) for n in FIELDS[2:]]
    )


def full_messages(messages: Column) -> Column:
    """Widen (role, content) messages to the five-field form."""
    none = F.lit(None).cast("string")
    return F.transform(
        messages,
        lambda m: F.struct(
            m["role"].alias("role"), m["content"].alias("content"), *[none.alias(n) for n in FIELDS[2:]]
        ),
    )


def _filled(text: Column) -> Column:
    return F.coalesce(F.length(text) > 0, F.lit(False))


def has_tools(messages: Column) -> Column:
    return F.exists(messages, lambda m: _filled(m["tools"]))


def starts_with_system(messages: Column) -> Column:
    return F.coalesce(F.get(messages, F.lit(0))["role"] == "system", F.lit(False))


def tool_schema(messages: Column) -> Column:
    """Tool list (JSON text) of the last system message that carries one."""
    carriers = F.filter(messages, lambda m: (m["role"] == "system") & _filled(m["tools"]))
    return F.try_element_at(carriers, F.lit(-1))["tools"]


def tool_list(schema_json: Column) -> Column:
    """Tool list as an array with the JSON text of each tool."""
    return F.from_json(schema_json, "array<string>")


def decode_calls(tool_calls: Column) -> Column:
    """JSON call list to an array of (name, arguments, verbatim).

    ``arguments`` is JSON text when the call held an object and the plain string when it held a
    string; ``verbatim`` tells which. A ``function`` member, if present, is unwrapped.
    """
    texts = F.from_json(tool_calls, f"array<{CALL_TYPE.format('string')}>")
    kinds = F.from_json(tool_calls, f"array<{CALL_TYPE.format('variant')}>")

    def merge(text: Column, kind: Column) -> Column:
        wrapped = text["function"].isNotNull()
        variant = F.when(wrapped, kind["function"]["arguments"]).otherwise(kind["arguments"])
        return F.struct(
            F.when(wrapped, text["function"]["name"]).otherwise(text["name"]).alias("name"),
            F.when(wrapped, text["function"]["arguments"]).otherwise(text["arguments"]).alias("arguments"),
            F.coalesce(F.schema_of_variant(variant) == "STRING", F.lit(False)).alias("verbatim"),
        )

    return F.zip_with(texts, kinds, merge)


def normalised(messages: Column) -> Column:
    """Messages with the JSON call list of each decoded."""
    return F.transform(
        messages,
        lambda m: F.struct(
            *[m[n].alias(n) for n in FIELDS[:4]], decode_calls(m["tool_calls"]).alias("calls")
        ),
    )


def drop_last(messages: Column) -> Column:
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))


def history(messages: Column, n: int, style: str = "cli") -> Column:
    """Trailing window of a conversation.

    ``cli``: the last ``n``, none for 0. ``client``: the last ``n``, the last one for 0.
    ``web``: the last ``n + 1``.
    """
    count = {"cli": n, "client": n or 1, "web": n + 1}[style]
    if count == 0:
        return F.slice(messages, 1, 0)
    return let(
        messages,
        lambda m: F.slice(m, F.greatest(F.size(m) - F.lit(count - 1), F.lit(1)), F.lit(count)),
    )


def add_system_prompt(
    messages: Column, key: Column, seed: int = 42, ratio: float = 0.2, assistant_name: str = "assistant"
) -> Column:
    """Put a system prompt in front of a share of the conversations.

    Conversations with tools or with a system message in front are left alone. The prompt is
    one of ten, each equally likely.
    """
    prompt = choose(fixed.system_prompts(assistant_name), draw_int(seed, "system_pick", key))
    wanted = ~has_tools(messages) & ~starts_with_system(messages)
    chosen = wanted & (draw_uniform(seed, "system_add", key) < F.lit(ratio))
    return F.when(chosen, F.concat(F.array(message("system", prompt)), messages)).otherwise(messages)


def thinking_flag(key: Column, ratio: float = 0.5, seed: int = 42) -> Column:
    """True for a share of the rows: whether the reply is asked to think first."""
    return draw_uniform(seed, "thinking", key) < F.lit(ratio)


def strip_empty_think(rendered: Column, key: Column, keep: float = 0.2, seed: int = 42) -> Column:
    """Remove all empty think blocks from a share of the texts; one draw decides for a text."""
    removed = F.replace(rendered, F.lit(fixed.EMPTY_THINK), F.lit(""))
    return F.when(draw_uniform(seed, "empty_think", key) > F.lit(keep), removed).otherwise(rendered)


def corpus_text(messages: Column) -> Column:
    """Non-empty contents joined by newlines; null when there is none."""
    contents = F.transform(F.filter(messages, lambda m: _filled(m["content"])), lambda m: m["content"])
    return let(contents, lambda c: F.when(F.size(c) > 0, F.array_join(c, "\n")))


def total_chars(messages: Column) -> Column:
    return F.aggregate(
        messages, F.lit(0).cast("bigint"), lambda acc, m: acc + F.coalesce(F.length(m["content"]), F.lit(0))
    )


def rl_subset(
    conversations: DataFrame,
    max_chars: int,
    max_turns: int,
    placeholder: str = "",
    column: str = "conversations",
) -> DataFrame:
    """Prompt set drawn from chat data: short enough conversations, last reply blanked.

    Only conversations whose last message is from the assistant qualify.
    """
    messages = F.col(column)
    last = F.try_element_at(messages, F.lit(-1))
    blank = F.array(message("assistant", F.lit(placeholder)))
    return conversations.filter(
        (F.size(messages) <= max_turns) & (total_chars(messages) <= max_chars) & (last["role"] == "assistant")
    ).withColumn(column, F.concat(drop_last(messages), blank))


def rl_subset_turns(
    turns: DataFrame,
    max_chars: int,
    max_turns: int,
    placeholder: str = "",
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Runs a job. ``rl_subset`` on the long form. Totals are aggregated, written out and joined back, so
    no task ever holds a whole conversation and a very long one can be split."""
    totals = (
        turns.groupBy(conv)
        .agg(
            F.sum(F.length(text)).alias("_chars"),
            F.count(F.lit(1)).alias("_turns"),
            F.max_by(role, turn).alias("_last_role"),
            F.max(turn).alias("_last"),
        )
        .filter(
            (F.col("_chars") <= max_chars) & (F.col("_turns") <= max_turns) & (F.col("_last_role") == "assistant")
        )
        .select(conv, "_last")
    )
    blanked = F.when(F.col(turn) == F.col("_last"), F.lit(placeholder)).otherwise(F.col(text))
    return turns.join(settled(totals), conv).withColumn(text, blanked).drop("_last")


def last_query_index(messages: Column) -> Column:
    """Zero-based index of the last user message that is not a wrapped tool response.

    The last index when there is none. An analysis column only.
    """

    def real_query(m: Column) -> Column:
        wrapped = F.startswith(m["content"], F.lit(fixed.RESPONSE_OPEN)) & F.endswith(
            m["content"], F.lit(fixed.RESPONSE_CLOSE)
        )
        return F.coalesce((m["role"] == "user") & ~wrapped, F.lit(False))

    marks = F.transform(messages, lambda m, i: F.when(real_query(m), i))
    return F.coalesce(F.array_max(marks), F.size(messages) - 1)


def last_query_turn(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``last_query_index`` on the long form: (conv, query_turn) from two partial maxima per conversation."""
    wrapped = F.startswith(F.col(text), F.lit(fixed.RESPONSE_OPEN)) & F.endswith(F.col(text), F.lit(fixed.RESPONSE_CLOSE))
    asked = F.coalesce((F.col(role) == "user") & ~wrapped, F.lit(False))
    return turns.groupBy(conv).agg(F.coalesce(F.max(F.when(asked, F.col(turn))), F.max(turn)).alias("query_turn"))


def recent_turns(turns: DataFrame, n: int, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The last ``n`` turns of each conversation; map tasks already drop the others."""
    back = F.row_number().over(Window.partitionBy(conv).orderBy(F.desc(turn)))
    return turns.withColumn("_back", back).filter(F.col("_back") <= n).drop("_back")


def role_neighbours(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role"
) -> DataFrame:
    """Previous and next role of each turn, for gap-free turn numbers.

    Two equi-joins on (conversation, turn ± 1): a very long conversation spreads over many
    tasks, where a window would sort it in one.
    """
    roles = turns.select(F.col(conv), F.col(turn), F.col(role))
    before = roles.select(conv, (F.col(turn) + 1).alias(turn), F.col(role).alias("prev_role"))
    after = roles.select(conv, (F.col(turn) - 1).alias(turn), F.col(role).alias("next_role"))
    return turns.join(before, [conv, turn], "left").join(after, [conv, turn], "left")


def pair_samples(pairs: DataFrame, key: str = "pair_id") -> DataFrame:
    """Preference pairs to one row per side; both sides then take the same steps."""
    return pairs.select(
        key,
        F.expr("stack(2, 'chosen', chosen, 'rejected', rejected) as (side, conversations)"),
    )


def prompt_only(prompt: Column) -> list[Column]:
    """Prompt with an empty answer."""
    return [prompt.alias("prompt"), F.lit("").alias("answer")]


def augment_prompt(
    rows: DataFrame, variants: list[tuple[str, str]], text: str, key: str, seed: int = 42
) -> DataFrame:
    """Put one of a few (prefix, suffix) pairs around a text, picked by a keyed draw."""
    listed = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(s).alias("s")) for p, s in variants])
    at = (F.pmod(draw_int(seed, "augment", F.col(key)), F.lit(len(variants))) + 1).cast("int")
    return rows.withColumn("_v", F.element_at(listed, at)).withColumn(
        text, F.concat(F.col("_v.p"), F.col(text), F.col("_v.s"))
    ).drop("_v")


def judge_context(messages: Column) -> Column:
    """Earlier messages as ``role: content`` lines, a bridge sentence and the last question.

    Without history the last question stands alone.
    """

    def build(ms: Column) -> Column:
        earlier = F.transform(drop_last(ms), lambda m: F.concat_ws(": ", m["role"], F.coalesce(m["content"], F.lit(""))))
        past = F.array_join(earlier, "\n")
        last = F.coalesce(F.try_element_at(ms, F.lit(-1))["content"], F.lit(""))
        packed = F.concat(past, F.lit("\n" + fixed.HISTORY_BRIDGE + "\n"), last)
        return F.when(F.length(past) > 0, packed).otherwise(last)

    return let(messages, build)


def stripped_between(text: Column, low: int, high: int | None = None) -> Column:
    """Length of the stripped text is at least ``low`` and, if ``high`` is given, at most that."""
    size = F.length(strip(text))
    return size >= low if high is None else size.between(low, high)
