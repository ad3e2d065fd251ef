"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.scratch import draw, fresh, keep, new_folder

BUCKETS = 4096


def mean_repeats(
    docs: DataFrame, source: str, weights: dict[str | None, float] | None = None, total: float | None = None
) -> DataFrame:
    """(source, rate): how often a row of each source should be repeated on average.

    ``weights`` are target shares by source, in any unit; sources it doesn't name get none. Without
    it every source gets the same share. ``total`` is the expected number of rows of the mix, by default as many as
    there are. Counts are partial sums per source, so a hot source is no hot task. A null source is a source.
    """
    counted = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighed = counted.withColumn("w", F.lit(1.0))
    else:
        # A row per weight the caller wrote down: a literal of the plan, not data.
        given = F.array(*[F.struct(F.lit(k).cast("string").alias("k"), F.lit(float(v)).alias("w")) for k, v in weights.items()])
        mine = F.filter(given, lambda g: g["k"].eqNullSafe(F.col("source").cast("string")))
        weighed = counted.withColumn("w", F.coalesce(F.get(mine, 0)["w"], F.lit(0.0))) if weights else counted.withColumn("w", F.lit(0.0))
    whole = Window.partitionBy()
    goal = F.lit(float(total)) if total is not None else F.sum("n").over(whole).cast("double")
    share = F.try_divide(F.col("w"), F.sum("w").over(whole))
    return weighed.select("source", F.coalesce(goal * share / F.col("n"), F.lit(0.0)).alias("rate"))


def poisson_table(rates: DataFrame) -> DataFrame:
    """``rates`` with ``cdf``, the Poisson distribution function of each rate at 0, 1, 2, ... up to where it is 1.

    The probabilities come from running sums of logarithms, so large rates don't underflow.
    """
    top = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 12).cast("int")
    steps = rates.select("source", "rate", F.explode(F.sequence(F.lit(0), top)).alias("k"))
    order = Window.partitionBy("source").orderBy("k")
    logs = F.sum(F.when(F.col("k") == 0, F.lit(0.0)).otherwise(F.log(F.col("k").cast("double")))).over(order)
    mass = F.when(F.col("rate") > 0, F.exp(F.col("k") * F.log(F.col("rate")) - F.col("rate") - logs)).otherwise(
        F.when(F.col("k") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    )
    summed = steps.withColumn("p", mass).withColumn("c", F.sum("p").over(order))
    return summed.groupBy("source", "rate").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda s: s["c"]).alias("cdf"))


def replicated(
    docs: DataFrame, key: str, source: str, weights: dict[str | None, float] | None = None,
    total: float | None = None, seed: int = 0, repeats: str = "repeats", copy: str = "copy",
) -> DataFrame:
    """Runs a job. ``docs`` with each row ``repeats`` times, numbered by ``copy`` from 0; rows drawn 0 times are gone.

    The number of repeats is the Poisson distribution of the source's rate, inverted at a number hashed from seed and
    key: the smallest count whose distribution function reaches it. The same key gets the same count anywhere, on
    any partitioning; repeated rows share one, null keys are hashed like an empty key. The table of rates (one row per source) is
    written first, so Spark knows its size before it decides how to join it. Columns named as the new ones are replaced.
    """
    table = keep(poisson_table(mean_repeats(docs, source, weights, total)), new_folder(docs.sparkSession, "rates"))
    rest = [c for c in docs.columns if c.lower() not in {repeats.lower(), copy.lower()}]
    mark, cdf = fresh(docs.columns, "rate_source"), fresh(docs.columns, "rate_cdf")
    small = table.select(F.col("source").alias(mark), F.col("cdf").alias(cdf))
    u = draw(F.lit(seed), F.col(key))
    count = F.size(F.filter(cdf, lambda c: c < u))
    joined = docs.select(*rest).join(small, F.col(source).eqNullSafe(F.col(mark))).withColumn(repeats, count)
    some = joined.filter(F.col(repeats) > 0)
    return some.withColumn(copy, F.explode(F.sequence(F.lit(0), F.col(repeats) - 1))).drop(mark, cdf)


def order_draw(key: str, copy: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit("order"), F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(copy).cast("string")).cast("binary"))


def shuffled(rows: DataFrame, key: str, copy: str = "copy", seed: int = 0, position: str = "position") -> DataFrame:
    """Runs a job. ``rows`` with a ``position`` in one global random order, gapless from 0.

    The order is that of an md5 of seed, key and copy. Its leading 12 bits deal the rows into even buckets; the buckets
    are numbered separately, and a table of one row per bucket gives each its offset: no task sees more than a bucket. Rows
    equal in key and copy stand next to each other in no particular order. A column named ``position`` is replaced.
    """
    rest = [c for c in rows.columns if c.lower() != position.lower()]
    h, bucket, before = (fresh(rows.columns, n) for n in ("order_md5", "order_bucket", "rows_before"))
    dealt = rows.select(*rest).withColumn(h, order_draw(key, copy, seed)).withColumn(bucket, F.conv(F.substring(h, 1, 3), 16, 10).cast("int"))
    sizes = dealt.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.orderBy(bucket)) - F.col("n")
    offsets = keep(sizes.select(bucket, so_far.alias(before)), new_folder(rows.sparkSession, "offsets"))
    within = F.row_number().over(Window.partitionBy(bucket).orderBy(h, key, copy))
    numbered = dealt.withColumn(position, within).join(F.broadcast(offsets), bucket)  # at most BUCKETS rows
    return numbered.withColumn(position, F.col(position) - 1 + F.col(before)).drop(h, bucket, before)
