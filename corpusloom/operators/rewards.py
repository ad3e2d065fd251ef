"""Rule rewards, written as column expressions on one row per response."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import fixed
from corpusloom.functions.bind import let
from corpusloom.functions.jsontext import argument_object, last_member
from corpusloom.functions.numbers import clamp
from corpusloom.functions.text import (
    after_first,
    after_last,
    before_first,
    contains_ignore_case,
    count_of,
    numbers,
    repeat_fraction,
    strip,
)
from corpusloom.operators.messages import stripped_between
from corpusloom.operators.responses import answer_of, call_texts
from corpusloom.operators.tools import arguments_ok, offered

_NUMBER = r"[-+]?\p{Nd}+(?:\.\p{Nd}+)?"


def _either(test: Column, good: float, bad: float) -> Column:
    return F.when(F.coalesce(test, F.lit(False)), F.lit(good)).otherwise(F.lit(bad))


def think_terms(response: Column) -> Column:
    """Score of the thinking part; 0 without a close tag."""
    thinking = before_first(response, fixed.THINK_CLOSE)
    score = _either(stripped_between(thinking, 20, 300), 1.0, -0.5) + _either(
        count_of(response, fixed.THINK_CLOSE) == 1, 0.25, -0.25
    )
    return F.when(F.contains(response, F.lit(fixed.THINK_CLOSE)), score).otherwise(F.lit(0.0))


def single_turn_reward(response: Column, score: Column | None = None) -> Column:
    """Length, thinking and repetition terms plus an optional scorer value; no final clip."""
    answer = F.coalesce(strip(after_first(response, fixed.THINK_CLOSE)), response)
    reward = _either(stripped_between(response, 20, 800), 0.5, -0.5) + think_terms(response) - repeat_fraction(answer)
    return reward if score is None else reward + clamp(score, -3.0, 3.0)


def tag_imbalance(turns: Column) -> Column:
    """Open minus close call tags, absolute, summed over turns."""
    return F.aggregate(
        turns,
        F.lit(0),
        lambda acc, t: acc + F.abs(count_of(t, fixed.CALL_OPEN) - count_of(t, fixed.CALL_CLOSE)),
    )


def verified_values(text: Column, expected: Column) -> Column:
    """Distinct expected values found in the text: as a case-blind substring, or as a number
    within 1e-6 of a number in the text."""

    def found(nums: Column) -> Column:
        def check(value: Column) -> Column:
            plain = F.replace(strip(value), F.lit(","), F.lit(""))
            number = F.when(F.regexp_like(plain, F.lit(rf"\A{_NUMBER}\z")), plain.try_cast("double"))
            as_text = (F.length(strip(value)) > 0) & contains_ignore_case(text, strip(value))
            as_number = F.exists(nums, lambda n: F.coalesce(F.abs(number - n) < F.lit(1e-6), F.lit(False)))
            return F.coalesce(as_text, F.lit(False)) | as_number

        return F.array_distinct(F.filter(expected, check))

    return let(numbers(text), found)


def verified_share(text: Column, expected: Column) -> Column:
    """Distinct verified values over the number of expected ones; 0 without any."""
    n = F.size(expected)
    return F.when(F.coalesce(n, F.lit(0)) > 0, F.size(verified_values(text, expected)) / n).otherwise(F.lit(0.0))


def valid_calls(calls: Column, names: Column) -> Column:
    """Number of calls of an offered, known tool with its required arguments."""

    def valid(call: Column) -> Column:
        named = F.coalesce(last_member(call, "name"), F.lit(""))
        return let(named, lambda n: let(argument_object(call), lambda a: offered(n, names) & arguments_ok(n, a)))

    return F.size(F.filter(calls, valid))


def agent_reward(
    response: Column,
    turns: Column,
    unfinished: Column,
    names: Column,
    expected: Column,
    score: Column | None = None,
) -> Column:
    """Reward of a multi-turn trajectory, clipped to ±3.

    ``turns`` holds the model output of each turn, ``response`` the last one, ``names`` the
    offered tools and ``expected`` the values the final answer must contain.
    """
    expected = F.coalesce(expected, F.array().cast("array<string>"))
    names = F.coalesce(names, F.array().cast("array<string>"))
    unfinished = F.coalesce(unfinished, F.lit(False))

    def without_calls(answer: Column) -> Column:
        final = F.coalesce(strip(after_first(response, fixed.THINK_CLOSE)), answer)
        reward = _either(stripped_between(response, 5, 800), 0.5, -0.5) + think_terms(response) - repeat_fraction(final)
        return reward if score is None else reward + clamp(score, -3.0, 3.0)

    def with_calls(answer: Column, calls: Column) -> Column:
        def rate(valid: Column) -> Column:
            wanted = F.size(expected)
            gap = F.abs(valid - wanted) + F.greatest(F.size(calls) - valid, F.lit(0))
            return F.when(gap == 0, F.lit(0.5)).otherwise(F.lit(-0.5) * gap)

        final = F.when(unfinished, F.lit("")).otherwise(after_last(answer, fixed.CALL_CLOSE))

        def rest(text: Column) -> Column:
            repeated = repeat_fraction(F.when(F.length(text) > 0, text).otherwise(answer))
            return F.lit(2.5) * verified_share(text, expected) - _either(unfinished, 0.5, 0.0) - repeated

        return let(valid_calls(calls, names), rate) + let(final, rest)

    def total(answers: Column) -> Column:
        answer = F.coalesce(F.try_element_at(answers, F.lit(-1)), strip(response))
        calls = F.flatten(F.transform(answers, call_texts))
        base = F.lit(-0.5) * tag_imbalance(answers)
        return let(
            F.struct(answer.alias("answer"), calls.alias("calls")),
            lambda s: base
            + F.when(F.size(s["calls"]) == 0, without_calls(s["answer"])).otherwise(
                with_calls(s["answer"], s["calls"])
            ),
        )

    return clamp(let(F.transform(turns, answer_of), total), -3.0, 3.0)
