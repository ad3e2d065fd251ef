"""Queries on seeded order, shards, batches, samples and mixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import messages as M
from corpusloom.operators import sampling as P
from corpusloom.plans import sqltext as S
from corpusloom.plans.registry import query, table

_RANK = "row_number() OVER (ORDER BY md5('42:shuffle:' || doc_id), doc_id) - 1"
_RANKED = f"ranked AS (SELECT doc_id, CAST({_RANK} AS BIGINT) AS rank FROM documents)"


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id")


@query(f"WITH {_RANKED} SELECT doc_id, rank FROM ranked")
def epoch_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.shuffled(_ids(spark, sf_dir), "doc_id")


@query(f"WITH {_RANKED} SELECT doc_id, rank, CAST(rank % 8 AS INT) AS shard, rank // 8 AS place FROM ranked")
def shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.shards(P.shuffled(_ids(spark, sf_dir), "doc_id"), 8).select("doc_id", "rank", "shard", "place")


@query(f"""WITH {_RANKED} SELECT CAST(rank % 4 AS INT) AS shard, rank // 4 // 16 AS batch_id, count(*) AS n_rows, min(doc_id) AS min_id,
 CAST(sum(doc_id) AS BIGINT) AS sum_id FROM ranked WHERE rank // 4 // 16 >= 3 GROUP BY 1, 2""")
def batch_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 16 per worker, the first 3 skipped."""
    dealt = P.shards(P.shuffled(_ids(spark, sf_dir), "doc_id"), 4)
    return P.batches(dealt, 16, skip=3, place="place").groupBy("shard", "batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("min_id"), F.sum("doc_id").alias("sum_id")
    )


@query(f"""WITH {_RANKED} SELECT doc_id, rank // 32 AS batch_id, (row_number() OVER (PARTITION BY rank // 32
 ORDER BY md5('42:minibatch:' || doc_id), doc_id) - 1) // 8 AS minibatch_id FROM ranked""")
def minibatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = P.batches(P.shuffled(_ids(spark, sf_dir), "doc_id"), 32)
    return P.minibatches(batched, "doc_id", 8).select("doc_id", "batch_id", "minibatch_id")


@query("""SELECT doc_id, lang FROM documents ORDER BY md5('42:sample:' || doc_id), doc_id LIMIT 300""")
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed-size random sample; the limit is the operator."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return P.sample_rows(rows, "doc_id", 300)


@query("""WITH n AS (SELECT count(*) AS n FROM documents), r AS (SELECT unnest([0, 3, 62, 63, 1000000]) AS skip)
SELECT CAST(skip AS BIGINT) AS skip, CAST(greatest(ceil(n / 16) - skip, 0) AS BIGINT) AS n_batches,
 CAST(n * 8 // 3 AS BIGINT) AS rescaled FROM n, r""")
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches left after a skip, and the step count carried over from 8 to 3 workers."""
    counted = _ids(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    skips = F.array(*[F.lit(k) for k in (0, 3, 62, 63, 1000000)])
    return counted.select("n", F.explode(skips).alias("skip")).select(
        F.col("skip").cast("bigint").alias("skip"),
        F.greatest(P.batch_count(F.col("n"), 16) - F.col("skip"), F.lit(0)).cast("bigint").alias("n_batches"),
        P.rescaled_step(F.col("n"), F.lit(8), F.lit(3)).alias("rescaled"),
    )


_MIX = f"""SELECT doc_id AS id, 'general' AS mix_source, lang, CAST(NULL AS VARCHAR) AS role FROM documents
 WHERE {S.draw(42, "mix:general", "doc_id")} < 0.5
UNION ALL SELECT item_id, 'exam', NULL, NULL FROM benchmark WHERE {S.draw(42, "mix:exam", "item_id")} < 0.9
UNION ALL SELECT conv_id * 1000 + turn, 'chat', NULL, role FROM conversations WHERE {S.draw(42, "mix:chat", "(conv_id * 1000 + turn)")} < 0.2"""


@query(_MIX)
def corpus_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three corpora in one format, each thinned to its share."""
    general = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    exam = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"))
    chat = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "role")
    mixed = P.mix({"general": (general, 0.5), "exam": (exam, 0.9), "chat": (chat, 0.2)}, "id")
    return mixed.select("id", "mix_source", "lang", "role")


_VARIANTS = [("Question: ", "\nAnswer:"), ("", " Choose one."), ("Please answer. ", "")]


@query(f"""WITH v AS (SELECT *, {S.draw_int(42, "augment", "item_id")} % 3 AS k FROM benchmark)
SELECT item_id, CASE k WHEN 0 THEN 'Question: ' WHEN 1 THEN '' ELSE 'Please answer. ' END || text
 || CASE k WHEN 0 THEN chr(10) || 'Answer:' WHEN 1 THEN ' Choose one.' ELSE '' END AS text FROM v""")
def prompt_augment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.augment_prompt(table(spark, sf_dir, "benchmark"), _VARIANTS, "text", "item_id").select("item_id", "text")


@query("""SELECT conv_id, CAST(g AS INT) AS gen_id, conv_id * 4 + g AS idx, n FROM
 (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id), range(4) r(g)""")
def generation_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four generations per prompt, then each matched back to its prompt by number."""
    from corpusloom.operators.tools import attach_prompt, fan_out

    prompts = (
        table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
        .withColumnRenamed("conv_id", "prompt_id")
    )
    made = fan_out(prompts.select("prompt_id"), 4).select(
        "gen_id", (F.col("prompt_id") * 4 + F.col("gen_id")).alias("idx")
    )
    return attach_prompt(made, prompts, 4).select(F.col("prompt_id").alias("conv_id"), "gen_id", "idx", "n")
