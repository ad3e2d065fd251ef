"""Model responses to structured parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import fixed
from corpusloom.functions.bind import let
from corpusloom.functions.jsontext import field_json, is_json_object, last_member, one_value_per_key
from corpusloom.functions.text import WS_CLASS, after_first, before_first, remove_tag_spans, strip, tag_pattern, tag_spans


def _complete_think(text: Column) -> Column:
    return F.regexp_like(text, F.lit(tag_pattern("think")))


def split_think(text: Column) -> Column:
    """(reasoning, text). A complete think block gives its stripped body and all blocks go; a lone
    close tag splits the text; otherwise reasoning is null."""
    complete = _complete_think(text)
    lone = F.contains(text, F.lit(fixed.THINK_CLOSE))
    return F.struct(
        F.when(complete, strip(F.regexp_extract(text, tag_pattern("think"), 1)))
        .when(lone, strip(before_first(text, fixed.THINK_CLOSE)))
        .alias("reasoning"),
        F.when(complete, remove_tag_spans(text, "think", trailing_space=True))
        .when(lone, strip(after_first(text, fixed.THINK_CLOSE)))
        .otherwise(text)
        .alias("text"),
    )


def _call(span: Column, index: Column) -> Column:
    return F.struct(
        index.alias("index"),
        F.coalesce(last_member(span, "name"), F.lit("")).alias("name"),
        let(one_value_per_key(span), lambda t: field_json(t, "$.arguments", "{}")).alias("arguments"),
    )


def call_spans(text: Column) -> Column:
    """Calls between call tags whose body is a JSON object, with their position among all spans."""
    spans = F.transform(tag_spans(text, "tool_call"), strip)
    marked = F.transform(spans, lambda s, i: F.struct(s.alias("span"), i.alias("index")))
    good = F.filter(marked, lambda p: is_json_object(p["span"]))
    return F.transform(good, lambda p: _call(p["span"], p["index"]))


def braced_calls(text: Column) -> Column:
    """Looser form for plain replies: only ``{…}`` bodies count and ids keep their gaps.

    Null when nothing parses.
    """
    pattern = rf"(?s)<tool_call>[{WS_CLASS}]*(\{{.*?\}})[{WS_CLASS}]*</tool_call>"
    spans = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    marked = F.transform(spans, lambda s, i: F.struct(s.alias("span"), i.alias("index")))
    calls = F.transform(
        F.filter(marked, lambda p: is_json_object(p["span"])),
        lambda p: F.struct(
            F.concat(F.lit("call_"), p["index"].cast("string")).alias("id"),
            F.coalesce(last_member(p["span"], "name"), F.lit("")).alias("name"),
            let(one_value_per_key(p["span"]), lambda t: field_json(t, "$.arguments", "{}")).alias("arguments"),
        ),
    )
    return let(calls, lambda c: F.when(F.size(c) > 0, c))


def call_texts(text: Column) -> Column:
    """JSON text of every call span that parses; broken ones are skipped."""
    return F.filter(F.transform(tag_spans(text, "tool_call"), strip), is_json_object)


def parse_response(text: Column) -> Column:
    """Response text to (content, reasoning, calls, finish_reason).

    When any call parses, all call spans leave the content. No call gives null.
    """

    def build(split: Column) -> Column:
        def finish(calls: Column) -> Column:
            some = F.size(calls) > 0
            content = F.when(some, remove_tag_spans(split["text"], "tool_call")).otherwise(split["text"])
            return F.struct(
                strip(content).alias("content"),
                split["reasoning"].alias("reasoning"),
                F.when(some, calls).alias("calls"),
                F.when(some, F.lit("tool_calls")).otherwise(F.lit("stop")).alias("finish_reason"),
            )

        return let(call_spans(split["text"]), finish)

    return let(split_think(text), build)


def answer_of(text: Column) -> Column:
    """Stripped text after the first close-think tag, or the stripped text."""
    return strip(F.coalesce(after_first(text, fixed.THINK_CLOSE), text))


def reply_status(text: Column) -> Column:
    """``thinking`` while a think block is open, ``answered`` once closed, else ``none``."""
    opened = F.contains(text, F.lit(fixed.THINK_OPEN))
    closed = F.contains(text, F.lit(fixed.THINK_CLOSE))
    return F.when(closed, F.lit("answered")).when(opened, F.lit("thinking")).otherwise(F.lit("none"))
