"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.bind import let


def clamp(x: Column, low: float | None = None, high: float | None = None) -> Column:
    if high is not None:
        x = F.least(x, F.lit(float(high)))
    if low is not None:
        x = F.greatest(x, F.lit(float(low)))
    return x


def log_sigmoid(x: Column) -> Column:
    """``log(1 / (1 + exp(-x)))`` without overflow for large negative ``x``."""
    return F.least(x, F.lit(0.0)) - F.log1p(F.exp(-F.abs(x)))


def rsqrt(x: Column) -> Column:
    return F.lit(1.0) / F.sqrt(x)


def k3(ref: Column, policy: Column) -> Column:
    """Non-negative divergence estimate ``exp(d) - d - 1`` with ``d = ref - policy``."""
    d = ref - policy
    return F.exp(d) - d - F.lit(1.0)


def importance_ratio(policy: Column, old: Column) -> Column:
    return F.exp(policy - old)


def squared_log_ratio(policy: Column, old: Column) -> Column:
    d = policy - old
    return F.lit(0.5) * d * d


def softmax(values: Column, temperature: float = 1.0) -> Column:
    """Softmax of an array of doubles, shifted by its maximum."""
    scaled = F.transform(values, lambda v: v / F.lit(float(temperature)))

    def shift(vs: Column) -> Column:
        return let(F.array_max(vs), lambda top: F.transform(vs, lambda v: F.exp(v - top)))

    def normalise(es: Column) -> Column:
        return let(array_sum(es), lambda total: F.transform(es, lambda e: e / total))

    return let(let(scaled, shift), normalise)


def log_softmax(values: Column, temperature: float = 1.0) -> Column:
    scaled = F.transform(values, lambda v: v / F.lit(float(temperature)))

    def build(vs: Column) -> Column:
        def with_top(top: Column) -> Column:
            log_total = F.log(array_sum(F.transform(vs, lambda v: F.exp(v - top))))
            return let(log_total, lambda lt: F.transform(vs, lambda v: v - top - lt))

        return let(F.array_max(vs), with_top)

    return let(scaled, build)


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def weighted_mix(model_score: Column, rule_score: Column, alpha: float, beta: float) -> Column:
    return F.lit(float(alpha)) * model_score + F.lit(float(beta)) * rule_score
