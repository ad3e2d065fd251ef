"""Rendezvous hashing of stable keys over weighted shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.scratch import fresh, keep, new_folder


def rendezvous(key: Column, weights: list[float], seed: int = 0) -> Column:
    """The shard (0, 1, ...) in which a key wins: the least -ln(u) / weight over all shards.

    ``u`` is hashed from seed, shard and key only. A shard that is added takes the keys it wins and moves no others; one that
    goes gives its keys to the rest; each shard gets keys in proportion to its weight. Shards with weight 0 get none.
    A null key is hashed as a key of its own.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    text = F.coalesce(key.cast("string"), F.lit("\0null"))
    tickets = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(shard), text), 11)
            u = (bits.cast("double") + 0.5) / F.lit(float(1 << 53))
            tickets.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard")))
    return F.array_min(F.array(*tickets))["shard"]


def sharded(docs: DataFrame, key: str, weights: list[float], seed: int = 0, shard: str = "shard") -> DataFrame:
    """``docs`` with their shard; a column of that name is replaced. No shuffle."""
    return docs.withColumn(shard, rendezvous(F.col(key), weights, seed))


def slotted(rows: DataFrame, shard: str, key: str, order: list[str], seed: int = 0, buckets: int = 1024, slot: str = "slot") -> DataFrame:
    """Runs a job. ``rows`` with their place within the shard, gapless from 0.

    A shard is as large as the corpus over the number of shards, so it is numbered in ``buckets`` parts by a hash of key and ``order``; a
    table of one row per shard and bucket says where each begins. Rows of one bucket are ordered by key and ``order``; rows equal in
    all of them are interchangeable. A key with a third of all rows is spread by the columns in ``order``.
    """
    part, before = fresh(rows.columns, "slot_bucket"), fresh(rows.columns, "slots_before")
    rest = rows.drop(slot) if slot in rows.columns else rows
    dealt = rest.withColumn(part, F.pmod(F.xxhash64(F.lit(seed), F.col(key), *order), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy(shard, part).agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.partitionBy(shard).orderBy(part)) - F.col("n")
    offsets = keep(sizes.select(shard, part, so_far.alias(before)), new_folder(rows.sparkSession, "slots"))
    within = F.row_number().over(Window.partitionBy(shard, part).orderBy(key, *order))
    numbered = dealt.withColumn(slot, within.cast("bigint"))
    return numbered.join(offsets, [shard, part]).withColumn(slot, F.col(slot) - 1 + F.col(before)).drop(part, before)
