"""Sources, sinks and hooks: the given tables written as the files users have, and read back.

Each query writes to a folder of its own below the checkpoint folder, and removes it once its result is taken.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.hooks import generate, score_responses
from corpusloom.plans.conversation_queries import nested
from corpusloom.plans.derived import RESPONSES_SQL, responses
from corpusloom.plans.registry import query, table
from corpusloom.session import checked_in, ensure_checkpoint_dir
from corpusloom.sources import readers, writers


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


@query("SELECT doc_id, lang, md5(text) AS text_md5 FROM documents")
def jsonl_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSONL, read with an inferred schema."""
    folder = _folder(spark)
    table(spark, sf_dir, "documents").select("doc_id", "lang", "text").write.json(folder)
    rows = readers.read_inferred(spark, folder)
    return checked_in(rows.select("doc_id", "lang", F.md5("text").alias("text_md5")), folder)


@query("SELECT md5(text) AS text_md5, count(*) AS n FROM documents GROUP BY 1")
def jsonl_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as JSONL, read with the declared schema, through the view of their corpus."""
    folder = _folder(spark)
    table(spark, sf_dir, "documents").select("text", "lang").write.json(f"{folder}/pretrain_t2t.jsonl")
    (view,) = readers.register_views(spark, folder, ["pretrain_t2t.jsonl"])
    rows = spark.table(view).groupBy(F.md5("text").alias("text_md5")).agg(F.count(F.lit(1)).alias("n"))
    return checked_in(rows, folder)


@query("""SELECT md5(string_agg(text, '|' ORDER BY turn)) AS contents_md5, count(*) AS n_messages FROM conversations GROUP BY conv_id""")
def jsonl_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as nested JSONL, read by the reader that fails on any bad line."""
    folder = _folder(spark)
    nested(spark, sf_dir).select("conversations").write.json(folder)
    rows = readers.read_strict(spark, folder, "conversation")
    contents = F.array_join(F.transform("conversations", lambda m: m["content"]), "|")
    return checked_in(rows.select(F.md5(contents).alias("contents_md5"), F.size("conversations").cast("bigint").alias("n_messages")), folder)


@query("""SELECT 'pretrain_t2t' AS view, 'pretrain' AS stage, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents
UNION ALL SELECT 'sft_t2t', 'sft', count(DISTINCT conv_id), CAST(sum(length(text)) AS BIGINT) FROM conversations""")
def corpus_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two corpora written under their registered names, read through their views with the registry's stages."""
    folder = _folder(spark)
    table(spark, sf_dir, "documents").select("text").write.json(f"{folder}/pretrain_t2t.jsonl")
    nested(spark, sf_dir).select("conversations").write.json(f"{folder}/sft_t2t.jsonl")
    readers.register_views(spark, folder, ["pretrain_t2t.jsonl", "sft_t2t.jsonl"])
    contents = F.aggregate("conversations", F.lit(0).cast("bigint"), lambda n, m: n + F.length(m["content"]))
    sizes = [spark.table("pretrain_t2t").select(F.lit("pretrain_t2t").alias("view"), F.length("text").cast("bigint").alias("size"))]
    sizes.append(spark.table("sft_t2t").select(F.lit("sft_t2t").alias("view"), contents.alias("size")))
    totals = sizes[0].union(sizes[1]).groupBy("view").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("n_chars"))
    named = readers.registry(spark).select(F.regexp_replace("file", r"\.jsonl$", "").alias("view"), "stage")
    return checked_in(totals.join(named, "view").select("view", "stage", "n", "n_chars"), folder)


@query("""WITH w AS (SELECT word, count(*) AS freq FROM (SELECT unnest(string_split(lang || ' ' || source, ' ')) AS word FROM documents) GROUP BY word)
SELECT word AS token, row_number() OVER (ORDER BY freq DESC, word) - 1 AS token_id, freq > (SELECT avg(freq) FROM w) AS special, 'tokens' AS part FROM w
UNION ALL SELECT word || ' ' || word, row_number() OVER (ORDER BY word) - 1, false, 'merges' FROM w""")
def vocabulary_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A token and a merge table written as the vocabulary's files and read back."""
    folder = _folder(spark)
    parts = table(spark, sf_dir, "documents").select(F.explode(F.array("lang", "source")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    mean = parts.agg(F.avg("freq").alias("mean"))
    by_freq = Window.partitionBy(F.lit(0)).orderBy(F.desc("freq"), "word")  # languages and sources: a handful of rows
    by_word = Window.partitionBy(F.lit(0)).orderBy("word")
    tokens = parts.select((F.row_number().over(by_freq) - 1).alias("token_id"), F.col("word").alias("token"), (F.col("freq") > mean.scalar()).alias("special"))
    merges = parts.select((F.row_number().over(by_word) - 1).alias("rank"), F.col("word").alias("left"), F.col("word").alias("right"))
    writers.write_vocabulary(tokens, merges, folder)
    read = spark.read.parquet(f"{folder}/tokens").select("token", F.col("token_id").cast("bigint").alias("token_id"), "special", F.lit("tokens").alias("part"))
    pairs = spark.read.parquet(f"{folder}/merges").select(
        F.concat_ws(" ", "left", "right").alias("token"), F.col("rank").cast("bigint").alias("token_id"), F.lit(False).alias("special"), F.lit("merges").alias("part")
    )
    return checked_in(read.union(pairs), folder)


_BROKEN = "CASE doc_id % 10 WHEN 3 THEN 'not json' WHEN 6 THEN '{\"text\": \"open' END"


@query(f"""SELECT CASE WHEN {_BROKEN} IS NULL THEN md5(text || chr(65533)) ELSE {_BROKEN} END AS row, {_BROKEN} IS NOT NULL AS bad, count(*) AS n
FROM documents GROUP BY 1, 2""")
def jsonl_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some are broken: good rows, and bad lines set aside. Replacement characters stay."""
    folder = _folder(spark)
    line = F.to_json(F.struct(F.concat("text", F.lit("\ufffd")).alias("text")))
    table(spark, sf_dir, "documents").select(F.coalesce(F.expr(_BROKEN), line).alias("value")).write.text(folder)
    good, bad = readers.read_tolerant(spark, folder, "text")
    both = good.select(F.md5("text").alias("row"), F.lit(False).alias("bad")).unionByName(bad.select(F.col("line").alias("row"), F.lit(True).alias("bad")))
    return checked_in(both.groupBy("row", "bad").agg(F.count(F.lit(1)).alias("n")), folder)


@query("""SELECT md5(text) AS text_md5 FROM (SELECT text FROM documents ORDER BY doc_id LIMIT 100)""")
def jsonl_first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred lines of sorted files, which are read in the order of their paths."""
    folder = _folder(spark)
    ordered = table(spark, sf_dir, "documents").orderBy("doc_id").select(F.to_json(F.struct("text")).alias("value"))
    ordered.write.text(folder)
    good, _ = readers.read_tolerant(spark, folder, "text", first_lines=100)
    return checked_in(good.select(F.md5("text").alias("text_md5")), folder)


@query("SELECT CAST(doc_id % 2 AS INT) AS epoch, CAST(doc_id % 3 AS INT) AS shard, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY 1, 2")
def samples_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples by epoch and shard, written and read back."""
    folder = _folder(spark)
    rows = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % 2).cast("int").alias("epoch"), (F.col("doc_id") % 3).cast("int").alias("shard"), "text"
    )
    writers.write_samples(rows, folder)
    back = spark.read.parquet(folder).groupBy("epoch", "shard").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).alias("n_chars"))
    return checked_in(back, folder)


@query(f"""WITH r AS ({RESPONSES_SQL}) SELECT conv_id, turn, greatest(least(length(response) / 1e2 - 3e0, 3e0), -3e0) AS score FROM r""")
def hook_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses scored by a plugged-in function, here their length."""
    rows = responses(spark, sf_dir)
    asked = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))

    def length(shift: float, context: pd.Series, response: pd.Series) -> pd.Series:
        return response.str.len() / 100 + shift

    return score_responses(rows, asked, F.col("response"), length, setup=lambda: -3.0).select("conv_id", "turn", "score")


@query("SELECT conv_id, turn, reverse(text) AS completion FROM conversations WHERE role = 'user'")
def hook_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completions of user turns by a plugged-in generator, here their reversal."""
    prompts = table(spark, sf_dir, "conversations").filter("role = 'user'").select("conv_id", "turn", "text")

    def backwards(state: None, batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(completion=batch["text"].str[::-1])[["conv_id", "turn", "completion"]]

    return generate(prompts, backwards, "conv_id bigint, turn bigint, completion string")
