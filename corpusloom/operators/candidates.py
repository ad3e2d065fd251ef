"""Cutting weighted candidate lists. A distribution is one array in one row: nothing shuffles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.bind import let


def ranked(weights: Column) -> Column:
    """(weight, index) structs, heaviest first, ties by index."""
    items = F.transform(weights, lambda w, i: F.struct((-w).alias("neg"), i.alias("index")))
    return F.transform(F.array_sort(items), lambda x: F.struct((-x["neg"]).alias("weight"), x["index"].alias("index")))


def top_k(weights: Column, k: int) -> Column:
    """Candidates at least as heavy as the k-th; ties with it are kept."""

    def cut(r: Column) -> Column:
        threshold = F.element_at(r, F.least(F.lit(k), F.size(r)))["weight"]
        return let(threshold, lambda t: F.filter(r, lambda x: x["weight"] >= t))

    return let(ranked(weights), lambda r: F.when(F.size(r) == 0, r).otherwise(cut(r)))


def nucleus(probabilities: Column, p: float) -> Column:
    """Heaviest candidates as long as the probability before them is at most ``p``.

    The first is always kept.
    """

    def cut(r: Column) -> Column:
        counted = F.aggregate(
            r,
            F.struct(F.lit(0.0).alias("before"), F.lit(0).alias("kept")),
            lambda s, x: F.struct(
                (s["before"] + x["weight"]).alias("before"),
                F.when((s["kept"] == 0) | (s["before"] <= F.lit(float(p))), s["kept"] + 1)
                .otherwise(s["kept"])
                .alias("kept"),
            ),
            lambda s: s["kept"],
        )
        return F.slice(r, F.lit(1), counted)

    return let(ranked(probabilities), cut)
