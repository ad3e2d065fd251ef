"""Evaluation reports and metric-log reductions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import settled


def accuracy(results: DataFrame, by: list[str], predicted: str, expected: str) -> DataFrame:
    """Correct answers, answers and accuracy per model."""
    hit = F.coalesce(F.col(predicted) == F.col(expected), F.lit(False))
    return results.groupBy(*by).agg(
        F.count_if(hit).alias("n_correct"),
        F.count(F.lit(1)).alias("n_total"),
        F.avg(hit.cast("double")).alias("accuracy"),
    )


def rubric_ranking(scores: DataFrame, model: str, criteria: list[str]) -> DataFrame:
    """Total over the criteria and rank, best first. Scores are summed per model first; the
    ranking window then sees one row per model."""
    totals = scores.groupBy(model).agg(*[F.sum(c).alias(c) for c in criteria])
    total = sum((F.col(c) for c in criteria[1:]), F.col(criteria[0]))
    return totals.withColumn("total", total).withColumn("rank", F.rank().over(Window.orderBy(F.desc("total"))))


def benchmark_lift(scores: DataFrame, model: str, task: str, score: str, base: str) -> DataFrame:
    """Mean score per model over tasks and its difference from the base model's."""
    means = scores.groupBy(model, task).agg(F.avg(score).alias("_s")).groupBy(model).agg(F.avg("_s").alias("mean_score"))
    base_mean = means.filter(F.col(model) == base).select("mean_score").scalar()
    return means.withColumn("lift", F.col("mean_score") - base_mean)


def choice_scores(tokens: DataFrame, question: str, option: str, logp: str) -> DataFrame:
    """Summed log-probability per answer option."""
    return tokens.groupBy(question, option).agg(F.sum(logp).alias("score"))


def best_choice(tokens: DataFrame, question: str, option: str, logp: str) -> DataFrame:
    """Most likely option per question; the smallest option wins a tie."""
    best = F.min(F.struct((-F.col("score")).alias("neg"), F.col(option).alias("choice")))
    return (
        choice_scores(tokens, question, option, logp)
        .groupBy(question)
        .agg(best.alias("_b"))
        .select(question, F.col("_b.choice").alias("choice"), (-F.col("_b.neg")).alias("score"))
    )


def throughput(log: DataFrame, by: list[str], tokens: Column, seconds: Column) -> DataFrame:
    """Tokens per second: ratio of sums."""
    return log.groupBy(*by).agg((F.sum(tokens) / F.sum(seconds)).alias("tokens_per_second"))


def minutes_left(spent_seconds: Column, steps_done: Column, steps_total: Column) -> Column:
    """Remaining time from the mean step time so far, in whole minutes."""
    per_step = spent_seconds / F.greatest(steps_done, F.lit(1))
    return F.floor(per_step * (steps_total - steps_done) / F.lit(60)).cast("bigint")


def reported_steps(log: DataFrame, every: int, run: str = "run", step: str = "step") -> DataFrame:
    """Runs a job. Every ``every``-th step and the last step of each run."""
    last = log.groupBy(run).agg(F.max(step).alias("_last"))
    return (
        log.join(settled(last), run)
        .filter((F.pmod(F.col(step), F.lit(every)) == 0) | (F.col(step) == F.col("_last")))
        .drop("_last")
    )
