"""Losses and divergences recomputed from logged per-token tables.

Input rows are (sample, pos, policy, ref, old, value, mask …) with log-probabilities. Sums are
plain grouped aggregates, so partial sums form before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import IGNORE
from corpusloom.functions.bind import let
from corpusloom.functions.numbers import (
    array_sum,
    clamp,
    importance_ratio,
    k3,
    log_sigmoid,
    log_softmax,
    squared_log_ratio,
)
from corpusloom.operators.groups import row_mean, token_mean, token_mean_eps
from corpusloom.session import settled


def align(policy: DataFrame, reference: DataFrame, old: DataFrame | None = None, keys: tuple[str, ...] = ("sample_id", "pos")) -> DataFrame:
    """Join the log-probabilities of several models by (sample, position)."""
    joined = policy.join(reference, list(keys))
    return joined if old is None else joined.join(old, list(keys))


def preference_margins(tokens: DataFrame, pair: str = "pair_id", beta: float = 0.1) -> DataFrame:
    """Preference margin and loss per pair.

    Tokens of both sides of a pair are summed in one grouped aggregate; no self-join.
    """

    def total(side: str, column: str) -> Column:
        return F.sum(F.when(F.col("side") == side, F.col(column) * F.col("mask")).otherwise(F.lit(0.0)))

    sums = tokens.groupBy(pair).agg(
        (total("chosen", "policy") - total("rejected", "policy")).alias("policy_margin"),
        (total("chosen", "ref") - total("rejected", "ref")).alias("ref_margin"),
    )
    margin = F.col("policy_margin") - F.col("ref_margin")
    return sums.withColumn("margin", margin).withColumn("loss", -log_sigmoid(F.lit(float(beta)) * margin))


def clipped_token_loss(epsilon: float = 0.2, beta: float = 0.1) -> Column:
    """Clipped surrogate with a divergence term, per token."""
    ratio = importance_ratio(F.col("policy"), F.col("old"))
    plain = ratio * F.col("advantage")
    clipped = clamp(ratio, 1 - epsilon, 1 + epsilon) * F.col("advantage")
    return -(F.least(plain, clipped) - F.lit(float(beta)) * k3(F.col("ref"), F.col("policy")))


def capped_token_loss(epsilon_high: float = 5.0, beta: float = 0.1) -> Column:
    """Capped-weight variant, per token."""
    weight = clamp(importance_ratio(F.col("policy"), F.col("old")), high=epsilon_high)
    return -(weight * F.col("advantage") * F.col("policy") - F.lit(float(beta)) * k3(F.col("ref"), F.col("policy")))


def group_policy_loss(tokens: DataFrame, token_loss: Column, sample: str = "sample_id", drop_empty: bool = True) -> DataFrame:
    """Token losses averaged inside each sample, then over samples."""
    return row_mean(tokens, [sample], token_loss, F.col("mask"), drop_empty).withColumnRenamed("row_mean", "policy_loss")


def actor_critic_metrics(clip: float = 0.2, value_clip: float = 0.2, kl_coef: float = 0.02) -> list[Column]:
    """Aggregates over tokens (policy, old, ref, advantage, value, old_value, returns, mask)."""
    policy, old, ref, mask = F.col("policy"), F.col("old"), F.col("ref"), F.col("mask")
    ratio = importance_ratio(policy, old)
    worst = F.greatest(
        -F.col("advantage") * ratio, -F.col("advantage") * clamp(ratio, 1 - clip, 1 + clip)
    )
    near = F.least(
        F.greatest(F.col("value"), F.col("old_value") - F.lit(float(value_clip))),
        F.col("old_value") + F.lit(float(value_clip)),
    )
    plain_error = F.col("value") - F.col("returns")
    near_error = near - F.col("returns")
    value_error = F.greatest(plain_error * plain_error, near_error * near_error)
    outside = (F.abs(ratio - 1.0) > F.lit(float(clip))).cast("double")
    kl_ref = token_mean(k3(ref, policy), mask)
    return [
        (token_mean(worst, mask) + F.lit(float(kl_coef)) * kl_ref).alias("policy_loss"),
        (F.lit(0.5) * token_mean(value_error, mask)).alias("value_loss"),
        token_mean(outside, mask).alias("clip_fraction"),
        token_mean(squared_log_ratio(policy, old), mask).alias("approx_kl"),
        kl_ref.alias("kl_ref"),
    ]


def signed_kl() -> Column:
    """Mean of (ref - policy) over counted tokens."""
    return token_mean(F.col("ref") - F.col("policy"), F.col("mask"))


def early_stop(steps: DataFrame, threshold: float = 0.25, run: str = "run", step: str = "step", kl: str = "approx_kl") -> DataFrame:
    """Runs a job. Add ``stopped``: true from the first step of the run whose divergence passes the threshold.

    The first such step is a grouped minimum, written out and joined back, not a running window over the run.
    """
    first = steps.groupBy(run).agg(F.min(F.when(F.col(kl) > F.lit(threshold), F.col(step))).alias("_first"))
    return (
        steps.join(settled(first), run)
        .withColumn("stopped", F.coalesce(F.col(step) >= F.col("_first"), F.lit(False)))
        .drop("_first")
    )


def distillation_kl(student: Column, teacher: Column, temperature: float = 1.0) -> Column:
    """Divergence of teacher from student for one position, arrays of logits, times T².

    The teacher is cut to the student's vocabulary first.
    """

    def build(s: Column, t: Column) -> Column:
        terms = F.zip_with(s, t, lambda a, b: F.exp(b) * (b - a))
        return array_sum(terms) * F.lit(float(temperature) ** 2)

    cut = F.slice(teacher, F.lit(1), F.size(student))
    return let(
        log_softmax(student, temperature),
        lambda s: let(log_softmax(cut, temperature), lambda t: build(s, t)),
    )


def distillation_kl_long(
    student: DataFrame, teacher: DataFrame, temperature: float = 1.0, position: tuple[str, ...] = ("sample_id", "pos")
) -> DataFrame:
    """The same for long tables (…position, token_id, logit): divergence per position.

    The join on (position, token) also cuts the teacher to tokens the student has. A position
    has at most vocabulary-size rows.
    """
    keys = list(position)
    t = F.lit(float(temperature))
    joined = student.select(*keys, "token_id", (F.col("logit") / t).alias("s")).join(
        teacher.select(*keys, "token_id", (F.col("logit") / t).alias("t")), [*keys, "token_id"]
    )
    tops = joined.groupBy(*keys).agg(F.max("s").alias("ms"), F.max("t").alias("mt"))
    e_t = F.exp(F.col("t") - F.col("mt"))
    sums = joined.join(tops, keys).groupBy(*keys).agg(
        F.sum(F.exp(F.col("s") - F.col("ms"))).alias("zs"),
        F.sum(e_t).alias("zt"),
        F.sum(e_t * (F.col("t") - F.col("s"))).alias("cross"),
        F.first("ms").alias("ms"),
        F.first("mt").alias("mt"),
    )
    kl = (
        F.col("cross") / F.col("zt") - (F.col("mt") + F.log("zt")) + (F.col("ms") + F.log("zs"))
    )
    return sums.select(*keys, (kl * t * t).alias("kl"))


def mixed_distillation_loss(ce: Column, kl: Column, alpha: float) -> Column:
    return F.lit(float(alpha)) * ce + F.lit(1.0 - float(alpha)) * kl


def masked_cross_entropy(logp: Column, label: Column, eps: float | None = None) -> Column:
    """Mean negative log-probability where the label is not ignored.

    With ``eps`` the count gets that much added, as the mixed distillation loss does.
    """
    counted = (label != IGNORE).cast("double")
    if eps is None:
        return F.sum(-logp * counted) / F.sum(counted)
    return token_mean_eps(-logp, counted, eps)


def routing_balance(slots: DataFrame, coef: float = 0.001, expert: str = "expert", score: str = "score", chosen: str = "chosen") -> DataFrame:
    """Load-balance term: sum over experts of load times mean score, times experts and weight."""
    per_expert = slots.groupBy(expert).agg(
        F.avg(F.col(chosen).cast("double")).alias("load"), F.avg(score).alias("mean_score")
    )
    return per_expert.agg(
        (F.sum(F.col("load") * F.col("mean_score")) * F.count(F.lit(1)) * F.lit(float(coef))).alias("aux_loss")
    )
