"""The end-to-end jobs on the given tables: counts under a vocabulary of single bytes, digests under the trained one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import arrays as A
from corpusloom.functions.times import epoch_seconds, time_text
from corpusloom.operators import messages as M
from corpusloom.operators.spans import spans_to_mask, text_spans, token_ends
from corpusloom.operators.vocabulary import Encoder, base_vocabulary
from corpusloom.plans import jobs
from corpusloom.plans import sqltext as S
from corpusloom.plans.conversation_queries import _AUGMENT, _EMPTY, _PIECE, _RENDERED, conv, nested
from corpusloom.plans.corpus_queries import ids_digest, trained
from corpusloom.plans.derived import responses
from corpusloom.plans.registry import query, table
from corpusloom.plans.response_queries import _AGENT, _THINK_TERMS, _verified
from corpusloom.sources.readers import spread


def _encoder(spark: SparkSession) -> Encoder:
    return Encoder(*base_vocabulary(spark))


def _real(ids: str):
    return F.size(F.filter(ids, lambda x: x != A.PAD)).cast("bigint")


@query("""SELECT doc_id, least(octet_length(encode(text)) + 2, 512) AS n_real, 512 AS n_ids,
 greatest(510 - octet_length(encode(text)), 0) AS n_ignored FROM documents""")
def pretrain_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text samples of 512 tokens."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    made = jobs.pretrain_samples(docs, _encoder(spark), "doc_id")
    ignored = F.size(F.filter("labels", lambda x: x == A.IGNORE)).cast("bigint")
    return made.select("doc_id", _real("input_ids").alias("n_real"), F.size("input_ids").alias("n_ids"), ignored.alias("n_ignored"))


def _tokens_sql(text: str) -> str:
    """Tokens of a rendered text when every reserved token is one and everything else bytes."""
    plain = text
    for token in ("<|im_start|>", "<|im_end|>", "<think>", "</think>"):
        plain = f"replace({plain}, '{token}', '#')"
    return f"octet_length(encode({plain}))"


@query(f"""WITH {_RENDERED}, {_AUGMENT},
x AS (SELECT r.conv_id, CASE WHEN added THEN '<|im_start|>system' || chr(10) || prompt || '<|im_end|>' || chr(10) ELSE '' END || rendered AS t
  FROM rendered r JOIN chosen c ON r.conv_id = c.conv_id),
s AS (SELECT conv_id, CASE WHEN {S.draw(42, "empty_think", "conv_id")} > 0.2 THEN replace(t, {_EMPTY}, '') ELSE t END AS t FROM x),
a AS (SELECT conv_id, sum({_tokens_sql(_PIECE)}) AS n, count(*) AS k FROM conversations WHERE role = 'assistant' GROUP BY conv_id)
SELECT s.conv_id, {_tokens_sql("t")} AS n_real,
 CAST(coalesce(n - k * (1 + 9 + 1) - CASE WHEN {S.draw(42, "empty_think", "s.conv_id")} > 0.2 THEN k * 6 ELSE 0 END, 0) AS BIGINT) AS n_labelled
FROM s LEFT JOIN a ON s.conv_id = a.conv_id""")
def chat_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat samples of up to 32,768 tokens: real tokens and labelled tokens."""
    made = jobs.chat_samples(nested(spark, sf_dir), _encoder(spark), "conv_id", max_length=32768)
    labelled = F.size(F.filter("labels", lambda x: x != A.IGNORE)).cast("bigint")
    return made.select("conv_id", _real("input_ids").alias("n_real"), labelled.alias("n_labelled"))


@query("SELECT DISTINCT conv_id, 511 AS n_x, 511 AS n_y, true AS shifted FROM conversations")
def preference_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference samples of 512 tokens: lengths, and targets one step ahead of inputs."""
    refusal = F.array(M.message("assistant", F.lit("no")))
    pairs = nested(spark, sf_dir).select("conv_id", conv().alias("chosen"), F.concat(M.drop_last(conv()), refusal).alias("rejected"))
    made = jobs.preference_samples(pairs, _encoder(spark), "conv_id", 512)
    shifted = F.slice("x_chosen", 2, 510) == F.slice("y_chosen", 1, 510)
    both = shifted & (F.size("mask_rejected") == F.size("x_rejected"))
    return made.select("conv_id", F.size("x_chosen").alias("n_x"), F.size("y_rejected").alias("n_y"), both.alias("shifted"))


@query(f"""WITH {_RENDERED}, {_AUGMENT},
x AS (SELECT r.conv_id, CASE WHEN added THEN '<|im_start|>system' || chr(10) || prompt || '<|im_end|>' || chr(10) ELSE '' END || rendered AS t
  FROM rendered r JOIN chosen c ON r.conv_id = c.conv_id),
s AS (SELECT conv_id, CASE WHEN {S.draw(42, "empty_think", "conv_id")} > 0.2 THEN replace(t, {_EMPTY}, '') ELSE t END AS t FROM x),
a AS (SELECT conv_id, unnest(string_split(t, '<|im_start|>assistant' || chr(10))[2:]) AS reply FROM s),
n AS (SELECT conv_id, sum({_tokens_sql("left(reply, instr(reply, '<|im_end|>') + 10)")}) AS n FROM a GROUP BY conv_id)
SELECT s.conv_id, {_tokens_sql("t")} AS n_tokens, CAST(coalesce(n, 0) AS BIGINT) AS n_labelled, true AS same,
 CASE WHEN n IS NULL THEN NULL ELSE {_tokens_sql("left(t, instr(t, '<|im_start|>assistant' || chr(10)) + 21)")} END AS first_labelled
FROM s LEFT JOIN n ON s.conv_id = n.conv_id""")
def text_span_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply spans found in the text and carried over to tokens; the same as the spans found among the tokens."""
    encoder = _encoder(spark)
    texts = nested(spark, sf_dir).select("conv_id", jobs.chat_text(F.col("conversations"), F.col("conv_id")).alias("text"))
    coded = texts.select("conv_id", text_spans(F.col("text")).alias("spans"), encoder.encode(F.col("text")).alias("ids"))
    masks = coded.select(
        "conv_id", spans_to_mask(token_ends(F.col("ids"), encoder), F.col("spans")).alias("mask"), A.reply_mask(F.col("ids"), *encoder.reply_marks()).alias("by_tokens")
    )
    first = F.array_position("mask", 1)
    return masks.select(
        "conv_id", F.size("mask").cast("bigint").alias("n_tokens"), F.size(F.filter("mask", lambda m: m == 1)).cast("bigint").alias("n_labelled"),
        (F.col("mask") == F.col("by_tokens")).alias("same"), F.when(first > 0, first - 1).alias("first_labelled"),
    )


@query()
def pretrain_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text samples of 512 tokens under the trained vocabulary: digests of ids and labels."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    made = jobs.pretrain_samples(docs, Encoder(*trained(spark, sf_dir)), "doc_id")
    return made.select("doc_id", _real("input_ids").alias("n_real"), *[ids_digest(F.col(c)).alias(f"{c}_md5") for c in ("input_ids", "labels")])


@query()
def chat_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat samples of 1,024 tokens under the trained vocabulary: digests of ids and labels."""
    made = jobs.chat_samples(nested(spark, sf_dir), Encoder(*trained(spark, sf_dir)), "conv_id")
    return made.select("conv_id", _real("input_ids").alias("n_real"), *[ids_digest(F.col(c)).alias(f"{c}_md5") for c in ("input_ids", "labels")])


def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation as chosen; with a refusal in place of its last message as rejected."""
    refusal = F.array(M.message("assistant", F.lit("no")))
    return nested(spark, sf_dir).select("conv_id", conv().alias("chosen"), F.concat(M.drop_last(conv()), refusal).alias("rejected"))


@query()
def preference_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference samples of 512 tokens under the trained vocabulary: digests of all six arrays."""
    made = jobs.preference_samples(preference_pairs(spark, sf_dir), Encoder(*trained(spark, sf_dir)), "conv_id", 512)
    return made.select("conv_id", *[ids_digest(F.col(c)).alias(f"{c}_md5") for c in made.columns if c != "conv_id"])


@query(f"""WITH {_AUGMENT}, l AS (SELECT conv_id, max(turn) AS lt FROM conversations GROUP BY conv_id),
p AS (SELECT c.conv_id, string_agg({_PIECE}, '' ORDER BY turn) FILTER (WHERE turn < lt) AS body FROM conversations c JOIN l ON c.conv_id = l.conv_id GROUP BY c.conv_id)
SELECT p.conv_id, md5(CASE WHEN added THEN '<|im_start|>system' || chr(10) || prompt || '<|im_end|>' || chr(10) ELSE '' END || coalesce(body, '')
 || '<|im_start|>assistant' || chr(10) || CASE WHEN {S.draw(42, "thinking", "p.conv_id")} < 0.9 THEN '<think>' || chr(10) ELSE {_EMPTY} END) AS prompt_md5, '' AS answer
FROM p JOIN chosen c ON p.conv_id = c.conv_id""")
def rollout_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = jobs.rollout_prompts(nested(spark, sf_dir), "conv_id", thinking_ratio=0.9)
    return made.select("conv_id", F.md5("prompt").alias("prompt_md5"), "answer")


@query(f"""WITH {_AGENT}, k AS (SELECT conv_id, turn, least(greatest(
 -0.5::DOUBLE * abs({S.count_of("answer", "<tool_call>")} - {S.count_of("answer", "</tool_call>")})
 + CASE WHEN len(calls) = 0 THEN CAST(CASE WHEN length({S.strip("response")}) BETWEEN 5 AND 800 THEN 0.5 ELSE -0.5 END + {_THINK_TERMS} AS DOUBLE)
   ELSE CASE WHEN gap = 0 THEN 0.5::DOUBLE ELSE -0.5::DOUBLE * gap END + 2.5::DOUBLE * len({_verified("final", "gt")}) / len(gt)
     - CASE WHEN unfinished THEN 0.5::DOUBLE ELSE 0 END END - {S.repeat_fraction("g")}, -3), 3) AS reward FROM g),
s AS (SELECT conv_id, avg(reward) AS mu, stddev_pop(reward) AS sd FROM k GROUP BY conv_id)
SELECT k.conv_id, turn, round(reward, 6) AS reward, round((reward - mu) / (sd + 1e-4), 3) AS advantage FROM k JOIN s ON k.conv_id = s.conv_id""")
def agent_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewards and group-relative advantages; the replies of a conversation are one group."""
    gt = F.when(F.col("conv_id") % 2 == 0, F.array(F.lit("1234"))).otherwise(F.array(F.left("text", F.lit(5)), F.lit("-7.5")))
    rows = responses(spark, sf_dir).select(
        "conv_id",
        "turn",
        "response",
        F.array("response").alias("turns"),
        (F.col("conv_id") % 13 == 0).alias("unfinished"),
        F.array(*[F.lit(n) for n in ("get_current_weather", "get_exchange_rate", "unit_converter", "fly")]).alias("names"),
        gt.alias("gt"),
    )
    scored = jobs.scored_trajectories(rows, ["conv_id"])
    return scored.select("conv_id", "turn", F.round("reward", 6).alias("reward"), F.round("advantage", 3).alias("advantage"))


@query("""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('45:shuffle:' || doc_id), doc_id) - 1 AS k FROM documents)
SELECT 3 AS epoch, CAST(k % 2 AS INT) AS shard, k // 2 // 8 AS batch_id, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM r
WHERE k // 2 // 8 >= 1 GROUP BY 1, 2, 3""")
def batch_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch 3 dealt to two workers in batches of 8, the first batch skipped."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    made = jobs.epoch_batches(docs, "doc_id", 8, epoch=3, workers=2, skip=1)
    return made.groupBy("epoch", "shard", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def time_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", time_text(F.col("ts")).alias("time_text"), epoch_seconds(F.col("ts")).alias("seconds")
    )
