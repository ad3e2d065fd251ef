"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.scratch import discard, keep, new_folder


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it sees."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionAll(low.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Runs jobs. (node, root) for every node of the edge table; the root is the component's smallest node.

    Union-find as joins: each round points nodes at the smallest node in sight, until every
    component is a star. Nothing is collected but a count and a checksum per round. A hub is
    reduced to one row per map task by the partial minimum, and its edges are joined back to a
    table of one row per node, so a hot hub is split like any skewed join. Rows with a null end and
    self-links are ignored; an empty table gives an empty table. Both columns must have one type.
    """
    spark = edges.sparkSession
    start = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct()
    folder = new_folder(spark, "edges")
    now, seen = keep(start, folder), None
    while True:
        following = new_folder(spark, "edges")
        later = keep(_small_star(_large_star(now)).distinct(), following)
        discard(spark, folder)
        now, folder = later, following
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.unionAll(now.select(F.col("a").alias("node"), F.col("b").alias("root")))
