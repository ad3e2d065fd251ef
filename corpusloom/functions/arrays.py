"""Token-array functions: framing, padding, cutting, masks and labels.

Ids 0, 1 and 2 are padding, start and end; a label of -100 is ignored by every loss.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.bind import let

PAD, BOS, EOS, IGNORE = 0, 1, 2, -100


def _int(value: int) -> Column:
    return F.lit(value).cast("int")


def head(ids: Column, n: int) -> Column:
    return F.slice(ids, 1, n)


def tail(values: Column, n: int) -> Column:
    """The last ``n`` elements, or all when there are fewer."""
    return let(
        values,
        lambda v: F.slice(v, F.greatest(F.size(v) - F.lit(n - 1), F.lit(1)), F.lit(n)),
    )


def frame(ids: Column) -> Column:
    """Start id, tokens, end id."""
    return F.concat(F.array(_int(BOS)), ids, F.array(_int(EOS)))


def _filler(values: Column, length: int, fill: Column) -> Column:
    return F.array_repeat(fill, F.greatest(F.lit(length) - F.size(values), F.lit(0)))


def pad_right(ids: Column, length: int, fill: Column | None = None) -> Column:
    fill = _int(PAD) if fill is None else fill
    return let(ids, lambda v: F.concat(v, _filler(v, length, fill)))


def pad_left(ids: Column, length: int, fill: Column | None = None) -> Column:
    fill = _int(PAD) if fill is None else fill
    return let(ids, lambda v: F.concat(_filler(v, length, fill), v))


def labels_from_ids(ids: Column) -> Column:
    """Copy of the ids with padding replaced by the ignore label."""
    return F.transform(ids, lambda x: F.when(x == PAD, _int(IGNORE)).otherwise(x))


def drop_left_padding(ids: Column, mask: Column) -> Column:
    """Ids whose mask entry is set."""
    kept = F.filter(F.arrays_zip(ids.alias("id"), mask.alias("m")), lambda p: p["m"] != 0)
    return F.transform(kept, lambda p: p["id"])


def align_logps(logps: Column, n: Column) -> Column:
    """Exactly ``n`` log-probabilities: zeros are put in front, or only the last ``n`` are kept."""

    def fit(v: Column) -> Column:
        missing = n - F.size(v)
        return (
            F.when(missing >= 0, F.concat(F.array_repeat(F.lit(0.0), missing), v))
            .when(n <= 0, F.slice(v, 1, 0))
            .otherwise(F.slice(v, -n, n))
        )

    return let(F.coalesce(logps, F.array().cast("array<double>")), fit)


def drop_control_tokens(ids: Column, logps: Column) -> Column:
    """(id, logp) pairs without padding and end ids."""
    pairs = F.arrays_zip(ids.alias("id"), logps.alias("logp"))
    return F.filter(pairs, lambda p: ~p["id"].isin(PAD, EOS))


def first_response_position(mask: Column) -> Column:
    """Zero-based index of the first 1 in the mask; its length when there is none."""
    pos = F.array_position(mask, 1)
    return F.when(pos > 0, pos.cast("int") - 1).otherwise(F.size(mask))


def first_end_position(ids: Column, mask: Column | None = None) -> Column:
    """Zero-based index of the first end id (inside the mask); the last index when there is none."""
    seen = ids if mask is None else F.zip_with(ids, mask, lambda i, m: F.when(m != 0, i).otherwise(_int(-1)))
    return let(
        F.array_position(seen, EOS).cast("int"),
        lambda pos: F.when(pos > 0, pos - 1).otherwise(F.size(ids) - 1),
    )


def prefix_mask(mask: Column, last: Column) -> Column:
    """The mask with everything after index ``last`` cleared."""
    return F.transform(mask, lambda m, i: F.when(i <= last, m).otherwise(_int(0)))


def shift_inputs(ids: Column) -> Column:
    """Inputs for next-token prediction: everything but the last token."""
    return F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0)))


def shift_targets(ids: Column) -> Column:
    """Targets for next-token prediction: everything but the first token."""
    return F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0)))


def _matches(arr: Column, pattern: list[int]) -> Column:
    """One-based positions at which the pattern starts."""

    def here(pos: Column) -> Column:
        hit = F.lit(True)
        for k, token in enumerate(pattern):
            hit = hit & (F.coalesce(F.get(arr, pos + F.lit(k - 1)), _int(-1)) == token)
        return hit

    return F.filter(F.sequence(_int(1), F.size(arr)), here)


def reply_mask(ids: Column, open_ids: list[int], close_ids: list[int]) -> Column:
    """1 from the token after each reply opener through its closer (inclusive), else 0.

    A reply without a closer runs to the end. Openers start and closers begin with atomic
    control tokens, so an opener met inside a reply ends at the same closer and the union of
    the spans of all openers is the answer.
    """
    n_open, n_close = len(open_ids), len(close_ids)

    def switch(pos: Column, on: int) -> Column:
        return F.struct(pos.cast("int").alias("pos"), _int(on).alias("on"))

    def paint(arr: Column, switches: Column) -> Column:
        """Each switch paints up to the next one, so the work is one step per token and per marker."""
        end = F.size(arr) + 1

        def stretch(s: Column, i: Column) -> Column:
            until = F.least(F.coalesce(F.get(switches, i + 1)["pos"], end), end)
            return F.array_repeat(s["on"], F.greatest(until - s["pos"], _int(0)))

        return F.flatten(F.transform(switches, stretch))

    def build(arr: Column) -> Column:
        on = F.transform(_matches(arr, open_ids), lambda o: switch(o + F.lit(n_open), 1))
        off = F.transform(_matches(arr, close_ids), lambda c: switch(c + F.lit(n_close), 0))
        return let(F.array_sort(F.concat(F.array(switch(_int(1), 0)), on, off)), lambda s: paint(arr, s))

    return let(ids, lambda arr: F.when(F.size(arr) == 0, F.array().cast("array<int>")).otherwise(build(arr)))


def labels_from_mask(ids: Column, mask: Column) -> Column:
    return F.zip_with(ids, mask, lambda i, m: F.when(m != 0, i).otherwise(_int(IGNORE)))
