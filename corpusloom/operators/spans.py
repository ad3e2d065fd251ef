"""Reply spans found in the text and carried over to its tokens."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import fixed
from corpusloom.functions.bind import let
from corpusloom.functions.lists import row_bounds
from corpusloom.operators.vocabulary import Encoder

OPENER = f"{fixed.START}assistant\n"
CLOSER = f"{fixed.END}\n"


def text_spans(text: Column, opener: str = OPENER, closer: str = CLOSER) -> Column:
    """array<struct<start, stop>>: from behind each opener through its closer, in bytes of the text's UTF-8.

    A span without a closer runs to the end; an opener within a span is part of it. One step per opener.
    """
    size, closed = F.lit(len(opener.encode())), F.lit(len(closer.encode()))
    span = "struct<start:int,stop:int>"
    none = F.array().cast(f"array<{span}>")

    def made(start: Column, stop: Column) -> Column:
        return F.array(F.struct(start.cast("int").alias("start"), stop.cast("int").alias("stop")))

    def step(acc: Column, piece: Column) -> Column:
        start = F.when(acc["open"] >= 0, acc["open"]).otherwise(acc["at"])
        end = acc["at"] + F.octet_length(F.substring_index(piece, closer, 1)) + closed
        has = F.contains(piece, F.lit(closer))
        return F.struct(
            (acc["at"] + F.octet_length(piece) + size).cast("int").alias("at"),
            F.when(has, F.lit(-1)).otherwise(start).cast("int").alias("open"),
            F.when(has, F.concat(acc["spans"], made(start, end))).otherwise(acc["spans"]).alias("spans"),
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["open"] >= 0, F.concat(acc["spans"], made(acc["open"], acc["at"] - size))).otherwise(acc["spans"])

    pieces = F.split(text, re.escape(opener))

    def walk(pieces: Column) -> Column:
        """Every piece but the first stands behind an opener."""
        behind = (F.octet_length(F.get(pieces, F.lit(0))) + size).cast("int")
        head = F.struct(behind.alias("at"), F.lit(-1).alias("open"), none.alias("spans"))
        return F.aggregate(F.slice(pieces, F.lit(2), F.size(pieces)), head, step, finish)

    return let(pieces, walk)


def token_ends(ids: Column, encoder: Encoder) -> Column:
    """Where each token ends, in bytes of the text: prefix sums of the tokens' lengths."""
    sizes = encoder.byte_lengths()

    @F.arrow_udf("array<int>")
    def ends(column: pa.Array) -> pa.Array:
        at, tokens = row_bounds(column), column.flatten().to_numpy(zero_copy_only=False)
        out = np.empty(len(tokens), np.int32)
        for low, high in zip(at[:-1], at[1:]):
            np.cumsum(sizes[tokens[low:high]], out=out[low:high])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(out), mask=column.is_null())

    return ends(ids)


def spans_to_mask(ends: Column, spans: Column) -> Column:
    """1 for tokens that lie in a span whole, else 0: an interval join of the sorted token ends with the sorted spans."""

    @F.arrow_udf("array<int>")
    def mask(ends: pa.Array, spans: pa.Array) -> pa.Array:
        at, stops = row_bounds(ends), ends.flatten().to_numpy(zero_copy_only=False)
        held, found = row_bounds(spans), spans.flatten()
        first, last = (c.to_numpy(zero_copy_only=False) for c in found.flatten())
        out = np.zeros(len(stops), np.int32)
        for low, high, i, j in zip(at[:-1], at[1:], held[:-1], held[1:]):
            mine = stops[low:high]
            starts = np.concatenate([[0], mine[:-1]])
            for a, b in zip(np.searchsorted(starts, first[i:j]), np.searchsorted(mine, last[i:j], "right")):
                out[low + a : low + b] = 1
        nulls = pc.or_(ends.is_null(), spans.is_null())
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(out), mask=nulls)

    return mask(ends, spans)
