"""Repeatable random draws.

A draw depends only on (seed, stream name, row key). It is the same on every retry, on
every cluster size and in any SQL engine with md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw_hash(seed: int | str, stream: str, *keys: Column) -> Column:
    """Hex md5 of ``seed:stream:key…``."""
    parts = [F.lit(f"{seed}:{stream}")] + [k.cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def draw_int(seed: int | str, stream: str, *keys: Column) -> Column:
    """Uniform integer in [0, 2^32)."""
    return F.conv(F.substring(draw_hash(seed, stream, *keys), 1, 8), 16, 10).cast("bigint")


def draw_uniform(seed: int | str, stream: str, *keys: Column) -> Column:
    """Uniform double in [0, 1)."""
    return draw_int(seed, stream, *keys) / F.lit(4294967296.0)


def choose(values: list[str], draw: Column) -> Column:
    """The element of ``values`` picked by an integer draw."""
    listed = F.array(*[F.lit(v) for v in values])
    return F.element_at(listed, (F.pmod(draw, F.lit(len(values))) + 1).cast("int"))
