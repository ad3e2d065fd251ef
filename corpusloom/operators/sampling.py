"""Seeded order, shards, batches, fixed-size samples and mixing.

Every random choice is a keyed md5 draw, so results do not depend on partitioning, retries
or cluster size. ``key`` names a column with a unique value per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.draws import draw_hash, draw_uniform


def _bucket_offsets(hashed: DataFrame, bucket: str) -> DataFrame:
    """Rows before each bucket. One row per bucket, so the running sum and the broadcast are
    bounded by the number of buckets, whatever the table size."""
    counts = hashed.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))


def shuffled(rows: DataFrame, key: str, seed: int = 42, epoch: int = 0, digits: int = 3) -> DataFrame:
    """Add ``rank``: the row's zero-based place in the permutation of this epoch.

    A global ``row_number`` would sort the table in one task. Instead the hash is cut into
    ``16**digits`` even buckets: rows are numbered inside their bucket and the bucket's offset
    is added.
    """
    return _ranked(rows, key, draw_hash(seed + epoch, "shuffle", F.col(key)), digits)


def _ranked(rows: DataFrame, key: str, hashed: Column, digits: int, first: int | None = None) -> DataFrame:
    with_hash = rows.withColumn("_hash", hashed).withColumn("_bucket", F.substring("_hash", 1, digits))
    keys_only = rows.select(F.substring(hashed, 1, digits).alias("_bucket"))
    offsets = _bucket_offsets(keys_only, "_bucket")
    if first is not None:
        offsets = offsets.filter(F.col("_offset") < first)
    inside = Window.partitionBy("_bucket").orderBy("_hash", key)
    ranked = with_hash.join(F.broadcast(offsets), "_bucket").withColumn(
        "rank", (F.col("_offset") + F.row_number().over(inside) - 1).cast("bigint")
    )
    return ranked.drop("_hash", "_bucket", "_offset")


def shards(ranked: DataFrame, workers: int) -> DataFrame:
    """Add ``shard`` and ``place``: ranks are dealt out to workers in turn."""
    return ranked.withColumn("shard", F.pmod("rank", F.lit(workers)).cast("int")).withColumn(
        "place", F.floor(F.col("rank") / F.lit(workers)).cast("bigint")
    )


def batches(rows: DataFrame, batch_size: int, skip: int = 0, place: str = "rank") -> DataFrame:
    """Add ``batch_id`` and drop the first ``skip`` batches; a short last batch stays."""
    return rows.withColumn("batch_id", F.floor(F.col(place) / F.lit(batch_size)).cast("bigint")).filter(
        F.col("batch_id") >= skip
    )


def batch_count(n: Column, batch_size: int, skip: int = 0) -> Column:
    """Number of batches left to run."""
    return F.greatest(F.ceil(n / F.lit(batch_size)) - F.lit(skip), F.lit(0)).cast("bigint")


def rescaled_step(step: Column, old_workers: Column, new_workers: Column) -> Column:
    """Resume position after the number of workers changed."""
    return F.floor(step * old_workers / new_workers).cast("bigint")


def minibatches(batched: DataFrame, key: str, size: int, seed: int = 42, batch: str = "batch_id") -> DataFrame:
    """Add ``minibatch_id``: a random order inside each batch, cut into pieces.

    A batch holds at most ``batch_size`` rows, so the window partition is bounded.
    """
    order = Window.partitionBy(batch).orderBy(draw_hash(seed, "minibatch", F.col(key)), key)
    return batched.withColumn(
        "minibatch_id", F.floor((F.row_number().over(order) - 1) / F.lit(size)).cast("bigint")
    )


def sample_rows(rows: DataFrame, key: str, n: int, seed: int = 42, digits: int = 3) -> DataFrame:
    """Exactly ``n`` random rows (all when there are fewer).

    Only hash buckets that can hold one of the first ``n`` places are shuffled at all.
    """
    ranked = _ranked(rows, key, draw_hash(seed, "sample", F.col(key)), digits, first=n)
    return ranked.filter(F.col("rank") < n).drop("rank")


def keep_fraction(rows: DataFrame, key: str, fraction: float, seed: int = 42, stream: str = "keep") -> DataFrame:
    return rows.filter(draw_uniform(seed, stream, F.col(key)) < F.lit(fraction))


def mix(corpora: dict[str, tuple[DataFrame, float]], key: str, seed: int = 42) -> DataFrame:
    """Union of corpora with a ``mix_source`` column, each thinned to its keep fraction."""
    parts = [
        keep_fraction(rows, key, fraction, seed, f"mix:{name}").withColumn("mix_source", F.lit(name))
        for name, (rows, fraction) in corpora.items()
    ]
    return unite(parts)


def unite(parts: list[DataFrame]) -> DataFrame:
    """Union by column name; columns a part lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
