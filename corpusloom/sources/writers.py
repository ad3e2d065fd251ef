"""Outputs: training samples, vocabulary, metric log and structured responses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_samples(samples: DataFrame, path: str, partition_by: tuple[str, ...] = ("epoch", "shard")) -> None:
    """Training samples as Parquet, one folder per (epoch, shard).

    The rebalance hint brings a folder's rows together and lets Spark split large folders and
    merge small ones to its advisory size, so file sizes stay even at any scale.
    """
    folders = [c for c in partition_by if c in samples.columns]
    out = samples.hint("rebalance", *folders) if folders else samples
    out.write.mode("overwrite").partitionBy(*folders).parquet(path)


def write_vocabulary(vocabulary: DataFrame, merges: DataFrame, path: str) -> None:
    """Token table and merge table; both hold at most vocabulary-size rows."""
    vocabulary.coalesce(1).write.mode("overwrite").parquet(f"{path}/tokens")
    merges.coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")


def metric_rows(steps: DataFrame, metrics: list[str], run: str = "run", step: str = "step") -> DataFrame:
    """Wide step rows to (run, step, metric, value)."""
    return steps.unpivot([run, step], metrics, "metric", "value").filter(F.col("value").isNotNull())


def append_metrics(rows: DataFrame, path: str) -> None:
    rows.select("run", "step", "metric", "value").write.mode("append").parquet(path)


def metric_sink(path: str, query: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink for (run, step, metric, value) that takes each batch of a query once.

    A batch has a folder of its own, which a repeated try overwrites, and then an entry in the table of commits, by query and batch. A batch that is
    committed already adds nothing. ``read_metrics`` reads committed batches only, so a batch that broke off is never seen.
    """

    def write(rows: DataFrame, batch: int) -> None:
        place = f"query={query}/batch={batch}"
        if _exists(rows.sparkSession, f"{path}/commits/{place}/_SUCCESS"):
            return
        rows.select("run", "step", "metric", "value").write.mode("overwrite").parquet(f"{path}/rows/{place}")
        rows.sparkSession.range(1).select(F.current_timestamp().alias("at")).write.mode("overwrite").parquet(f"{path}/commits/{place}")

    return write


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(run, step, metric, value, query, batch) of the committed batches under ``path``."""
    rows = spark.read.parquet(f"{path}/rows")
    commits = spark.read.parquet(f"{path}/commits").select("query", "batch").distinct()
    return rows.join(commits, ["query", "batch"], "left_semi").select("run", "step", "metric", "value", "query", "batch")


def _exists(spark: SparkSession, file: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def response_json(
    request_id: Column, created: Column, model: Column, content: Column, reasoning: Column, calls: Column
) -> Column:
    """One response as JSON. Empty reasoning and empty call lists are left out."""
    has_calls = F.coalesce(F.size(calls) > 0, F.lit(False))
    message = F.struct(
        F.lit("assistant").alias("role"),
        content.alias("content"),
        F.when(F.length(reasoning) > 0, reasoning).alias("reasoning_content"),
        F.when(has_calls, calls).alias("tool_calls"),
    )
    choice = F.struct(
        F.lit(0).alias("index"),
        message.alias("message"),
        F.when(has_calls, F.lit("tool_calls")).otherwise(F.lit("stop")).alias("finish_reason"),
    )
    return F.to_json(
        F.struct(
            F.concat(F.lit("chatcmpl-"), request_id.cast("string")).alias("id"),
            F.lit("chat.completion").alias("object"),
            created.alias("created"),
            model.alias("model"),
            F.array(choice).alias("choices"),
        )
    )
