"""Per-group and global statistics joined back to rows.

Statistics are aggregated with map-side combine and joined back. A window over the group
would bring every row of a hot group into one task. The statistics, one row per group, are written out
before the join: Spark broadcasts them when they are small, and when they are not it can split the partition of a
hot group, which it does not do for a join to an aggregate still to be computed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.numbers import rsqrt
from corpusloom.session import settled


def with_group_stats(rows: DataFrame, keys: list[str], stats: list[Column]) -> DataFrame:
    """Runs a job. Rows with the statistics of their group."""
    return rows.join(settled(rows.groupBy(*keys).agg(*stats)), keys)


def group_stats(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean and population deviation per group."""
    return rows.groupBy(*keys).agg(
        F.avg(value).alias("group_mean"), F.stddev_pop(value).alias("group_std"), F.count(value).alias("group_n")
    )


def group_advantage(rows: DataFrame, keys: list[str], reward: str, eps: float = 1e-4) -> DataFrame:
    """Runs a job. Add ``advantage``: the reward relative to its group, ``(r - mean) / (std + eps)``."""
    stats = [F.avg(reward).alias("group_mean"), F.stddev_pop(reward).alias("group_std")]
    return with_group_stats(rows, keys, stats).withColumn(
        "advantage", (F.col(reward) - F.col("group_mean")) / (F.col("group_std") + F.lit(eps))
    )


def degenerate_groups(rows: DataFrame, keys: list[str], reward: str, eps: float = 1e-6) -> DataFrame:
    """Groups, groups without spread and the mean spread: the reward-variance monitor."""
    return group_stats(rows, keys, reward).agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count_if(F.col("group_std") < F.lit(eps)).alias("n_degenerate"),
        F.avg("group_std").alias("mean_group_std"),
    )


def overall(value: str) -> list[Column]:
    """Global mean and *sample* deviation, as written to the metric log."""
    return [F.avg(value).alias(f"{value}_mean"), F.stddev_samp(value).alias(f"{value}_std")]


def token_mean(value: Column, mask: Column) -> Column:
    """Masked mean over tokens: ``sum(x m) / max(sum(m), 1)``."""
    return F.sum(value * mask) / F.greatest(F.sum(mask), F.lit(1))


def token_mean_eps(value: Column, mask: Column, eps: float = 1e-8) -> Column:
    """Masked mean over tokens with ``eps`` added to the count."""
    return F.sum(value * mask) / (F.sum(mask) + F.lit(eps))


def row_mean(tokens: DataFrame, row: list[str], value: Column, mask: Column, drop_empty: bool = False) -> DataFrame:
    """Masked mean inside each row, then the mean over rows; differs from ``token_mean``.

    ``drop_empty`` leaves out rows without a counted token instead of counting them as 0.
    """
    per_row = tokens.groupBy(*row).agg(F.sum(value * mask).alias("_total"), F.sum(mask).alias("_count"))
    if drop_empty:
        per_row = per_row.filter(F.col("_count") > 0)
    return per_row.agg(F.avg(F.col("_total") / F.greatest("_count", F.lit(1))).alias("row_mean"))


def sequence_logp(tokens: DataFrame, row: list[str], logp: str, mask: str) -> DataFrame:
    """Sum of the counted token log-probabilities per sequence."""
    return tokens.groupBy(*row).agg(F.sum(F.col(logp) * F.col(mask)).alias("sequence_logp"))


def whiten(rows: DataFrame, value: str, mask: str, eps: float = 1e-8) -> DataFrame:
    """Add ``whitened``: ``(x - mean) * rsqrt(var + eps) * mask``, statistics over counted rows.

    Mean and variance come from one aggregate, attached as a scalar subquery.
    """
    counted = F.when(F.col(mask) != 0, F.col(value))
    stats = rows.agg(
        F.struct(
            F.coalesce(F.avg(counted), F.lit(0.0)).alias("mean"),
            F.coalesce(F.var_pop(counted), F.lit(0.0)).alias("var"),
        ).alias("s")
    ).scalar()
    return (
        rows.withColumn("_s", stats)
        .withColumn("whitened", (F.col(value) - F.col("_s.mean")) * rsqrt(F.col("_s.var") + F.lit(eps)) * F.col(mask))
        .drop("_s")
    )


def response_lengths(tokens: DataFrame, row: list[str], mask: str) -> DataFrame:
    """Counted tokens per row."""
    return tokens.groupBy(*row).agg(F.sum(mask).cast("bigint").alias("n_tokens"))
