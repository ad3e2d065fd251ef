"""Evaluation reports and metric logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import reports as R
from corpusloom.plans.derived import TOKENS_SQL, loose_tokens, tokens
from corpusloom.plans.registry import query, table
from corpusloom.sources.writers import metric_rows


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id")


_L = "l AS (SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


@query(f"""WITH {_L} SELECT lang AS model, count(*) FILTER (WHERE n_chars % 2 = quality) AS n_correct, count(*) AS n_total,
 round(avg(CASE WHEN n_chars % 2 = quality THEN 1e0 ELSE 0e0 END), 6) AS accuracy FROM l GROUP BY lang""")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir).select(F.col("lang").alias("model"), (F.col("n_chars") % 2).alias("pred"), F.col("quality").alias("gt"))
    return R.accuracy(rows, ["model"], "pred", "gt").withColumn("accuracy", F.round("accuracy", 6))


@query(f"""WITH {_L}, t AS (SELECT source AS model, CAST(sum(quality) AS BIGINT) AS quality, CAST(sum(toxic) AS BIGINT) AS toxic FROM l GROUP BY source)
SELECT model, quality, toxic, quality + toxic AS total, rank() OVER (ORDER BY quality + toxic DESC) AS rank FROM t""")
def rubric_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir).withColumnRenamed("source", "model")
    ranked = R.rubric_ranking(rows, "model", ["quality", "toxic"])
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


@query("""WITH m AS (SELECT lang AS model, source, avg(n_chars) AS s FROM documents GROUP BY 1, 2), a AS (SELECT model, avg(s) AS mean_score FROM m GROUP BY model)
SELECT model, round(mean_score, 6) AS mean_score, round(mean_score - (SELECT mean_score FROM a WHERE model = 'en'), 6) AS lift FROM a""")
def benchmark_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("lang").alias("model"), F.col("source").alias("task"), "n_chars")
    lift = R.benchmark_lift(rows, "model", "task", "n_chars", "en")
    return lift.select("model", F.round("mean_score", 6).alias("mean_score"), F.round("lift", 6).alias("lift"))


@query("""WITH s AS (SELECT user_id, event_type, sum(-value / 1e2) AS score FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_type) AS k FROM s)
SELECT user_id AS question, event_type AS choice, round(score, 6) AS score FROM r WHERE k = 1""")
def choice_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most likely option per question by summed log-probability."""
    rows = loose_tokens(spark, sf_dir).select(F.col("sample_id").alias("question"), F.col("event_type").alias("option"), "policy")
    return R.best_choice(rows, "question", "option", "policy").select("question", "choice", F.round("score", 6).alias("score"))


@query("""SELECT event_type, round(sum(event_id % 100) / sum(value), 6) AS tokens_per_second,
 CAST(floor(sum(value) / greatest(count(*), 1) * (20000 - count(*)) / 60) AS BIGINT) AS minutes_left FROM events GROUP BY event_type""")
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    speed = R.throughput(rows, ["event_type"], F.col("event_id") % 100, F.col("value"))
    spent = rows.groupBy("event_type").agg(F.sum("value").alias("spent"), F.count(F.lit(1)).alias("done"))
    left = R.minutes_left(F.col("spent"), F.col("done"), F.lit(20000))
    return speed.join(spent, "event_type").select(
        "event_type", F.round("tokens_per_second", 6).alias("tokens_per_second"), left.alias("minutes_left")
    )


_STEPS = f"""t AS ({TOKENS_SQL}), k AS (SELECT sample_id, max(pos) AS last FROM t GROUP BY 1),
r AS (SELECT t.sample_id AS run, pos AS step, policy AS loss, value AS reward FROM t JOIN k ON t.sample_id = k.sample_id WHERE pos % 10 = 0 OR pos = last)"""


@query(f"""WITH {_STEPS} SELECT run, step, 'loss' AS metric, round(loss, 6) AS value FROM r
UNION ALL SELECT run, step, 'reward', round(reward, 6) FROM r""")
def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth step and the last one of each run, as metric rows."""
    steps = tokens(spark, sf_dir).select(
        F.col("sample_id").alias("run"), F.col("pos").alias("step"), F.round("policy", 6).alias("loss"), F.round("value", 6).alias("reward")
    )
    return metric_rows(R.reported_steps(steps, 10), ["loss", "reward"])
