"""Queries on token arrays and token logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import arrays as A
from corpusloom.functions.numbers import log_softmax, softmax
from corpusloom.functions.text import words
from corpusloom.operators import candidates as C
from corpusloom.operators import groups as G
from corpusloom.operators import losses as L
from corpusloom.operators import sequences as Q
from corpusloom.operators.render import render
from corpusloom.operators.vocabulary import hashed_ids, marked_words
from corpusloom.plans import sqltext as S
from corpusloom.plans.conversation_queries import _PIECE, nested
from corpusloom.plans.derived import RESPONSES_SQL, TOKENS_SQL, loose_tokens, responses, tokens
from corpusloom.plans.registry import query, table
from corpusloom.sources.readers import spread

# --- arrays ------------------------------------------------------------------------------------

_ID = "36 + CAST('0x' || substr(md5(x), 1, 8) AS BIGINT) % 6364"


def _ids_sql(x: str) -> str:
    return f"list_transform({S.words(x)}, lambda x: {_ID})"


def digest(ids: Column) -> Column:
    return F.md5(F.array_join(ids.cast("array<string>"), ","))


def _digest_sql(ids: str) -> str:
    return f"md5(array_to_string({ids}, ','))"


@query(f"""WITH t AS (SELECT doc_id, list_slice({_ids_sql("text")}, 1, 126) AS ids FROM documents),
f AS (SELECT doc_id, len(ids) + 2 AS n_real, list_resize(list_concat([1::BIGINT], ids, [2::BIGINT]), 128, 0) AS ids FROM t)
SELECT doc_id, n_real, {_digest_sql("ids")} AS ids_md5, {_digest_sql("list_transform(ids, lambda i: CASE WHEN i = 0 THEN -100 ELSE i END)")} AS labels_md5 FROM f""")
def frame_pad_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain-text samples: cut, framed, padded to 128, labels without padding."""
    ids = hashed_ids(A.head(words(F.col("text")), 126))
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = docs.select("doc_id", A.frame(ids).alias("framed"))
    padded = rows.select("doc_id", F.size("framed").cast("bigint").alias("n_real"), A.pad_right(F.col("framed"), 128).alias("ids"))
    return padded.select(
        "doc_id", "n_real", digest(F.col("ids")).alias("ids_md5"), digest(A.labels_from_ids(F.col("ids"))).alias("labels_md5")
    )


_MARKED = rf"<\|im_start\|>|<\|im_end\|>|\n|{S.WORDS}"
_MARKED_ID = f"CASE x WHEN '<|im_start|>' THEN 1 WHEN '<|im_end|>' THEN 2 ELSE {_ID} END"
_MASKED = f"""t AS (SELECT conv_id, turn, role, list_transform(regexp_extract_all(lower({_PIECE}), '{_MARKED}'), lambda x: {_MARKED_ID}) AS ids FROM conversations),
m AS (SELECT *, list_transform(range(1, len(ids) + 1), lambda i: CASE WHEN role = 'assistant' AND i > 3 THEN 1 ELSE 0 END) AS mask FROM t),
c AS (SELECT conv_id, flatten(list(ids ORDER BY turn)) AS ids, flatten(list(mask ORDER BY turn)) AS mask FROM m GROUP BY conv_id)"""


def _reply_ids(token: str) -> int:
    """Id of a plain token in the hashed vocabulary, on the driver."""
    import hashlib

    return 36 + int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 6364


OPEN_IDS = [A.BOS, _reply_ids("assistant"), _reply_ids("\n")]
CLOSE_IDS = [A.EOS, _reply_ids("\n")]


def _masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = hashed_ids(marked_words(render(F.col("conversations"))))
    rows = nested(spark, sf_dir).select("conv_id", ids.alias("ids"))
    return rows.select("conv_id", "ids", A.reply_mask(F.col("ids"), OPEN_IDS, CLOSE_IDS).alias("mask"))


@query(f"""WITH {_MASKED} SELECT conv_id, len(ids) AS n_tokens, CAST(list_sum(mask) AS BIGINT) AS n_masked,
 {_digest_sql("list_transform(range(1, len(ids) + 1), lambda i: CASE WHEN mask[i] = 1 THEN ids[i] ELSE -100 END)")} AS labels_md5 FROM c""")
def span_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels on reply tokens only, from the opener's end through the closer."""
    labels = A.labels_from_mask(F.col("ids"), F.col("mask"))
    return _masked(spark, sf_dir).select(
        "conv_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.size(F.filter("mask", lambda m: m == 1)).cast("bigint").alias("n_masked"),
        digest(labels).alias("labels_md5"),
    )


@query(f"""WITH {_MASKED}, p AS (SELECT conv_id, list_resize(list_slice(ids, 1, 256), 256, 0) AS ids, list_resize(list_slice(mask, 1, 256), 256, 0) AS mask FROM c)
SELECT conv_id, {_digest_sql("ids[1:255]")} AS x_md5, {_digest_sql("ids[2:256]")} AS y_md5, {_digest_sql("mask[2:256]")} AS mask_md5 FROM p""")
def next_token_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs, targets and mask for next-token prediction at length 256."""
    rows = _masked(spark, sf_dir).select(
        "conv_id",
        A.pad_right(A.head(F.col("ids"), 256), 256).alias("ids"),
        A.pad_right(A.head(F.col("mask"), 256), 256).alias("mask"),
    )
    return rows.select(
        "conv_id",
        digest(A.shift_inputs(F.col("ids"))).alias("x_md5"),
        digest(A.shift_targets(F.col("ids"))).alias("y_md5"),
        digest(A.shift_targets(F.col("mask"))).alias("mask_md5"),
    )


@query(f"""WITH r AS ({RESPONSES_SQL}), t AS (SELECT conv_id, turn, {_ids_sql("text")} AS p, {_ids_sql("response")} AS q FROM r),
a AS (SELECT *, list_concat(p, q) AS ids, list_concat(list_transform(p, lambda x: 0), list_transform(q, lambda x: 1)) AS mask,
 list_concat(list_transform(range(1, len(p)), lambda x: 0.0::DOUBLE), list_transform(range(1, len(q) + 1), lambda i: i * -1e-2)) AS lp FROM t),
k AS (SELECT *, least(len(ids), 200) AS n FROM a),
s AS (SELECT conv_id, turn, ids[len(ids) - n + 1:] AS ids, mask[len(mask) - n + 1:] AS mask, CASE WHEN len(ids) > 200 THEN lp[len(lp) - n + 2:] ELSE lp END AS lp FROM k)
SELECT conv_id, turn, {_digest_sql("ids")} AS ids_md5, len(lp) AS n_logps, round(coalesce(list_sum(lp), 0), 6) AS logp_sum,
 CASE WHEN list_position(mask, 1) > 0 THEN list_position(mask, 1) - 1 ELSE len(mask) END AS prompt_len FROM s""")
def tail_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and response packed to the last 200 tokens with aligned mask and log-probabilities."""
    rows = responses(spark, sf_dir).select(
        "conv_id", "turn", hashed_ids(words(F.col("text"))).alias("p"), hashed_ids(words(F.col("response"))).alias("q")
    )
    ones = F.transform("q", lambda _: F.lit(1))
    logps = F.transform("q", lambda _, i: (i + 1) * F.lit(-0.01))
    packed = rows.select("conv_id", "turn", Q.pack(F.col("p"), F.col("q"), ones, logps, 200).alias("s"))
    return packed.select(
        "conv_id",
        "turn",
        digest(F.col("s.ids")).alias("ids_md5"),
        F.size("s.logps").cast("bigint").alias("n_logps"),
        F.round(F.aggregate("s.logps", F.lit(0.0), lambda a, x: a + x), 6).alias("logp_sum"),
        F.col("s.prompt_len").cast("bigint").alias("prompt_len"),
    )


@query(f"""WITH t AS (SELECT item_id, {_ids_sql("text")} AS ids FROM benchmark), k AS (SELECT *, ids[greatest(len(ids) - 31, 1):] AS last FROM t)
SELECT item_id, len(last) AS n_kept, {_digest_sql("list_concat(list_transform(range(32 - len(last)), lambda x: 0::BIGINT), last)")} AS padded_md5,
 {_digest_sql("last")} AS restored_md5 FROM k""")
def left_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts cut to their last 32 tokens, padded on the left, and the padding taken off again."""
    kept = A.tail(hashed_ids(words(F.col("text"))), 32)
    rows = table(spark, sf_dir, "benchmark").select("item_id", kept.alias("last")).withColumn("padded", A.pad_left(F.col("last"), 32))
    mask = F.transform("padded", lambda x: F.when(x == A.PAD, F.lit(0)).otherwise(F.lit(1)))
    return rows.select(
        "item_id",
        F.size("last").cast("bigint").alias("n_kept"),
        digest(F.col("padded")).alias("padded_md5"),
        digest(A.drop_left_padding(F.col("padded"), mask)).alias("restored_md5"),
    )


@query(f"""WITH t AS (SELECT item_id, list_concat({_ids_sql("text")}, [2, 0, 0]) AS ids, item_id % 50 AS n FROM benchmark)
SELECT item_id, len(ids) - 3 AS n_tokens, len(ids) - 3 AS end_pos,
 round(coalesce(list_sum(list_transform(range(greatest(len(ids) - 3 - n, 0), len(ids) - 3), lambda i: i * 1e-1)), 0), 6) AS aligned_sum,
 n AS n_aligned FROM t""")
def token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control tokens dropped with their log-probabilities, then as many kept as asked for."""
    ids = F.concat(hashed_ids(words(F.col("text"))), F.array(F.lit(A.EOS), F.lit(A.PAD), F.lit(A.PAD)))
    rows = table(spark, sf_dir, "benchmark").select("item_id", ids.alias("ids"))
    logps = F.transform("ids", lambda _, i: i * F.lit(0.1))
    pairs = rows.select("item_id", "ids", A.drop_control_tokens(F.col("ids"), logps).alias("pairs"))
    n = (F.col("item_id") % 50).cast("int")
    aligned = A.align_logps(F.transform("pairs", lambda p: p["logp"]), n)
    return pairs.select("item_id", "ids", F.size("pairs").alias("k"), aligned.alias("a")).select(
        "item_id",
        F.col("k").cast("bigint").alias("n_tokens"),
        A.first_end_position(F.col("ids")).cast("bigint").alias("end_pos"),
        F.round(F.aggregate("a", F.lit(0.0), lambda s, x: s + x), 6).alias("aligned_sum"),
        F.size("a").cast("bigint").alias("n_aligned"),
    )


@query(f"""WITH t AS (SELECT conv_id, turn, role, {_ids_sql("text")} AS ids FROM conversations)
SELECT conv_id, {_digest_sql("flatten(list(ids ORDER BY turn))")} AS ids_md5, CAST(sum(len(ids)) AS BIGINT) AS n_tokens,
 CAST(coalesce(sum(len(ids)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS n_generated,
 round(coalesce(sum(len(ids) * -5e-1) FILTER (WHERE role = 'assistant'), 0), 6) AS logp_sum FROM t GROUP BY conv_id""")
def trajectory_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a trajectory as one token row; only what the model wrote is marked."""
    segments = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.lit(0).alias("part"), (F.col("role") == "assistant").alias("generated"),
        hashed_ids(words(F.col("text"))).alias("ids"),
    )
    made = Q.trajectories(segments.withColumn("logps", F.transform("ids", lambda _: F.lit(-0.5))), ["conv_id"])
    return made.select(
        "conv_id",
        digest(F.col("ids")).alias("ids_md5"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.size(F.filter("mask", lambda m: m == 1)).cast("bigint").alias("n_generated"),
        F.round(F.aggregate("logps", F.lit(0.0), lambda a, x: a + x), 6).alias("logp_sum"),
    )


# --- token logs --------------------------------------------------------------------------------

_T = f"t AS ({TOKENS_SQL})"
_ENDS = f"""{_T}, e AS (SELECT sample_id, coalesce(min(pos) FILTER (WHERE event_type = 'signup'), max(pos)) AS end_pos FROM t GROUP BY sample_id),
m AS (SELECT t.* EXCLUDE (mask), e.end_pos, CASE WHEN pos <= end_pos THEN 1 ELSE 0 END AS mask FROM t JOIN e ON t.sample_id = e.sample_id)"""


def _cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.cut_at_end(tokens(spark, sf_dir).drop("mask"), "sample_id", F.col("event_type") == "signup")


@query(f"WITH {_ENDS} SELECT sample_id, pos, end_pos, mask FROM m")
def eos_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut(spark, sf_dir).select("sample_id", "pos", "end_pos", "mask")


@query(f"WITH {_ENDS} SELECT sample_id, pos, CASE WHEN pos = end_pos THEN sequence_reward ELSE 0 END AS token_reward FROM m")
def reward_last_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.reward_on_last(_cut(spark, sf_dir), "sample_id", "sequence_reward").select("sample_id", "pos", "token_reward")


@query(f"""WITH {_ENDS}, v AS (SELECT * REPLACE (value * mask AS value) FROM m),
d AS (SELECT sample_id, pos, value, CASE WHEN pos = end_pos THEN sequence_reward ELSE 0 END
  + coalesce(lead(value) OVER (PARTITION BY sample_id ORDER BY pos), 0) - value AS delta FROM v),
a AS (SELECT x.sample_id, x.pos, x.value, sum(pow(95e-2, y.pos - x.pos) * y.delta) AS advantage FROM d x JOIN d y
  ON x.sample_id = y.sample_id AND y.pos >= x.pos GROUP BY x.sample_id, x.pos, x.value)
SELECT sample_id, pos, round(advantage, 6) AS advantage, round(advantage + value, 6) AS returns FROM a""")
def gae(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advantages and returns along each sequence."""
    placed = Q.reward_on_last(_cut(spark, sf_dir), "sample_id", "sequence_reward", last="end_pos")
    rows = placed.select("sample_id", "pos", "token_reward", "value", "mask")
    return Q.gae(rows, "sample_id", mask="mask").select(
        "sample_id", "pos", F.round("advantage", 6).alias("advantage"), F.round("returns", 6).alias("returns")
    )


@query(f"""WITH {_T}, s AS (SELECT avg(advantage) FILTER (WHERE mask = 1) AS mu, var_pop(advantage) FILTER (WHERE mask = 1) AS v FROM t)
SELECT event_id, round((advantage - mu) / sqrt(v + 1e-8) * mask, 6) AS whitened FROM t, s""")
def whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = loose_tokens(spark, sf_dir).select("event_id", "advantage", "mask")
    return G.whiten(rows, "advantage", "mask").select("event_id", F.round("whitened", 6).alias("whitened"))


@query("""WITH s AS (SELECT user_id, avg(value) AS mu, stddev_pop(value) AS sd FROM events GROUP BY user_id)
SELECT event_id, e.user_id AS prompt_id, round((value - mu) / (sd + 1e-4), 6) AS advantage FROM events e JOIN s ON e.user_id = s.user_id""")
def group_adv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("prompt_id"), "value")
    return G.group_advantage(rows, ["prompt_id"], "value").select(
        "event_id", "prompt_id", F.round("advantage", 6).alias("advantage")
    )


@query("""WITH s AS (SELECT user_id, event_type, stddev_pop(CASE WHEN user_id % 5 = 0 THEN 1 ELSE value END) AS sd FROM events GROUP BY 1, 2)
SELECT count(*) AS n_groups, count(*) FILTER (WHERE sd < 1e-6) AS n_degenerate, round(avg(sd), 6) AS mean_group_std FROM s""")
def degenerate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    reward = F.when(F.col("user_id") % 5 == 0, F.lit(1.0)).otherwise(F.col("value"))
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", reward.alias("reward"))
    return G.degenerate_groups(rows, ["user_id", "event_type"], "reward").withColumn(
        "mean_group_std", F.round("mean_group_std", 6)
    )


@query(f"""WITH {_T}, r AS (SELECT sample_id, sum(policy * mask) / greatest(sum(mask), 1) AS m, sum(mask) AS n FROM t GROUP BY sample_id)
SELECT round((SELECT sum(policy * mask) / greatest(sum(mask), 1) FROM t), 6) AS token_mean,
 round((SELECT sum(policy * mask) / (sum(mask) + 1e-8) FROM t), 6) AS token_mean_eps, round((SELECT avg(m) FROM r), 6) AS row_mean,
 round((SELECT avg(n) FROM r), 6) AS mean_length, round((SELECT avg(policy) FROM t), 6) AS overall_mean,
 round((SELECT stddev_samp(policy) FROM t), 6) AS overall_std""")
def masked_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The masked means side by side: over tokens, with a small count term, and row by row."""
    rows = loose_tokens(spark, sf_dir).select("sample_id", "policy", "mask")
    policy, mask = F.col("policy"), F.col("mask")
    whole = rows.agg(
        F.round(G.token_mean(policy, mask), 6).alias("token_mean"),
        F.round(G.token_mean_eps(policy, mask), 6).alias("token_mean_eps"),
        *[F.round(c, 6) for c in G.overall("policy")],
    ).toDF("token_mean", "token_mean_eps", "overall_mean", "overall_std")
    lengths = G.response_lengths(rows, ["sample_id"], "mask").agg(F.avg("n_tokens")).scalar()
    by_row = G.row_mean(rows, ["sample_id"], policy, mask).scalar()
    return whole.withColumn("row_mean", F.round(by_row, 6)).withColumn("mean_length", F.round(lengths, 6))


@query(f"WITH {_T} SELECT event_type AS side, round(sum((ref - policy) * mask) / greatest(sum(mask), 1), 6) AS kl_ref FROM t GROUP BY 1")
def kl_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = loose_tokens(spark, sf_dir)
    return rows.groupBy(F.col("event_type").alias("side")).agg(F.round(L.signed_kl(), 6).alias("kl_ref"))


_K3 = "(exp(ref - policy) - (ref - policy) - 1)"


def _policy_sql(loss: str) -> str:
    return f"""WITH {_T}, l AS (SELECT sample_id, sum(({loss}) * mask) AS s, sum(mask) AS n FROM t GROUP BY sample_id)
SELECT round(avg(s / greatest(n, 1)), 6) AS policy_loss FROM l WHERE n > 0"""


@query(_policy_sql(f"-(least(exp(policy - old) * advantage, least(greatest(exp(policy - old), 8e-1), 12e-1) * advantage) - 1e-1 * {_K3})"))
def ratio_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clipped surrogate with token divergence."""
    return L.group_policy_loss(loose_tokens(spark, sf_dir), L.clipped_token_loss()).select(
        F.round("policy_loss", 6).alias("policy_loss")
    )


@query(_policy_sql(f"-(least(exp(policy - old), 5) * advantage * policy - 1e-1 * {_K3})"))
def cispo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capped-weight variant."""
    return L.group_policy_loss(loose_tokens(spark, sf_dir), L.capped_token_loss()).select(
        F.round("policy_loss", 6).alias("policy_loss")
    )


@query(f"""WITH {_T}, s AS (SELECT sample_id, sum(CASE WHEN side = 'chosen' THEN policy * mask ELSE 0 END) - sum(CASE WHEN side = 'rejected' THEN policy * mask ELSE 0 END) AS pm,
 sum(CASE WHEN side = 'chosen' THEN ref * mask ELSE 0 END) - sum(CASE WHEN side = 'rejected' THEN ref * mask ELSE 0 END) AS rm FROM t GROUP BY sample_id)
SELECT sample_id AS pair_id, round(pm - rm, 6) AS margin, round(ln(1 + exp(-1e-1 * (pm - rm))), 6) AS loss FROM s""")
def dpo_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = loose_tokens(spark, sf_dir).withColumnRenamed("sample_id", "pair_id")
    return L.preference_margins(rows).select("pair_id", F.round("margin", 6).alias("margin"), F.round("loss", 6).alias("loss"))


@query(f"WITH {_T} SELECT sample_id, side, round(sum(policy * mask), 6) AS sequence_logp FROM t GROUP BY 1, 2")
def sequence_logp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = loose_tokens(spark, sf_dir)
    return G.sequence_logp(rows, ["sample_id", "side"], "policy", "mask").withColumn(
        "sequence_logp", F.round("sequence_logp", 6)
    )


@query(f"""WITH {_T}, k AS (SELECT *, exp(policy - old) AS r, least(greatest(value, old_value - 2e-1), old_value + 2e-1) AS vc FROM t),
a AS (SELECT sum(mask) AS n, sum(greatest(-advantage * r, -advantage * least(greatest(r, 8e-1), 12e-1)) * mask) AS pl,
 sum(greatest((value - returns) * (value - returns), (vc - returns) * (vc - returns)) * mask) AS vl, sum(CASE WHEN abs(r - 1) > 2e-1 THEN mask ELSE 0 END) AS cf,
 sum(5e-1 * (policy - old) * (policy - old) * mask) AS ak, sum({_K3} * mask) AS kr FROM k)
SELECT round(pl / n + 2e-2 * kr / n, 6) AS policy_loss, round(5e-1 * vl / n, 6) AS value_loss, round(cf / n, 6) AS clip_fraction,
 round(ak / n, 6) AS approx_kl, round(kr / n, 6) AS kl_ref FROM a""")
def ppo_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy and value loss, clip fraction and both divergences, in one aggregate."""
    row = loose_tokens(spark, sf_dir).agg(*L.actor_critic_metrics())
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


@query(f"""WITH {_T}, f AS (SELECT sample_id, min(pos) FILTER (WHERE abs(policy - ref) > 25e-3) AS first FROM t GROUP BY sample_id)
SELECT t.sample_id AS run, pos AS step, coalesce(pos >= first, false) AS stopped FROM t JOIN f ON t.sample_id = f.sample_id""")
def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = tokens(spark, sf_dir).select(
        F.col("sample_id").alias("run"), F.col("pos").alias("step"), F.abs(F.col("policy") - F.col("ref")).alias("approx_kl")
    )
    return L.early_stop(steps, 0.025).select("run", "step", "stopped")


@query("""WITH e AS (SELECT event_type, avg(CASE WHEN event_id % 3 = 0 THEN 1e0 ELSE 0e0 END) AS l, avg(value / 5e2) AS s FROM events GROUP BY 1)
SELECT round(sum(l * s) * count(*) * 1e-1, 6) AS aux_loss FROM e""")
def routing_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("expert"), (F.col("value") / 500.0).alias("score"), (F.col("event_id") % 3 == 0).alias("chosen")
    )
    return L.routing_balance(slots, 0.1).select(F.round("aux_loss", 6).alias("aux_loss"))


@query(f"""WITH {_T} SELECT t.sample_id, pos, pos - (t.sample_id % 5) + 1 AS i, round(policy, 6) AS policy FROM t
WHERE pos - (t.sample_id % 5) + 1 >= 0 AND pos - (t.sample_id % 5) + 1 < 20""")
def gather_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values at computed positions."""
    rows = tokens(spark, sf_dir).select("sample_id", "pos", "policy")
    starts = rows.select("sample_id").distinct().select(
        "sample_id", (F.col("sample_id") % 5).alias("prompt_len"), F.lit(20).alias("n")
    )
    return Q.gather(rows, starts, "sample_id", "n").select("sample_id", "pos", "i", F.round("policy", 6).alias("policy"))


@query(f"""WITH {_T} SELECT sample_id, pos, round(policy, 6) AS policy, round(ref, 6) AS ref, round(old, 6) AS old FROM t""")
def logp_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of three models joined by (sequence, position)."""
    rows = tokens(spark, sf_dir)
    sides = [rows.select("sample_id", "pos", F.round(c, 6).alias(c)) for c in ("policy", "ref", "old")]
    return L.align(*sides)


@query("""SELECT conv_id, max_by(md5(text), turn) AS final_md5 FROM conversations GROUP BY conv_id""")
def final_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5("text").alias("text"))
    return Q.final_answer(rows, "conv_id", "turn", "text").withColumnRenamed("final_text", "final_md5")


@query("""WITH n AS (SELECT *, lead(role) OVER w AS nr, lead(md5(text)) OVER w AS nt FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, md5(text) AS call_md5, CASE WHEN nr = 'user' THEN nt END AS result_md5 FROM n WHERE role = 'assistant'""")
def call_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reply with the message that answers it."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.md5("text").alias("text"))
    return Q.call_results(rows, roles=("assistant", "user")).toDF("conv_id", "turn", "call_md5", "result_md5")


# --- distributions: each embedding is read as a row of logits ----------------------------------


def _logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("logits"))


_E = "e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)"
_P = f"""{_E}, z AS (SELECT vec_id, max(x) AS top FROM e GROUP BY 1), s AS (SELECT e.vec_id, i, exp(x - top) AS w FROM e JOIN z ON e.vec_id = z.vec_id),
t AS (SELECT vec_id, sum(w) AS total FROM s GROUP BY 1), p AS (SELECT s.vec_id, i, w / total AS p FROM s JOIN t ON s.vec_id = t.vec_id)"""


@query(f"""WITH {_E}, r AS (SELECT vec_id, i, rank() OVER (PARTITION BY vec_id ORDER BY round(x, 1) DESC) AS k, round(x, 1) AS w FROM e)
SELECT vec_id, count(*) AS n_kept, string_agg(CAST(i AS VARCHAR), ',' ORDER BY w DESC, i) AS kept FROM r WHERE k <= 5 GROUP BY vec_id""")
def topk_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five heaviest candidates and everything tied with the fifth."""
    weights = F.transform("logits", lambda x: F.round(x, 1))
    rows = _logits(spark, sf_dir).select("vec_id", C.top_k(weights, 5).alias("k"))
    return rows.select(
        "vec_id",
        F.size("k").cast("bigint").alias("n_kept"),
        F.array_join(F.transform("k", lambda x: x["index"].cast("string")), ",").alias("kept"),
    )


@query(f"""WITH {_P}, c AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY vec_id ORDER BY p DESC, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p)
SELECT vec_id, count(*) AS n_kept, round(sum(p), 6) AS kept_mass FROM c WHERE before <= 85e-2 GROUP BY vec_id""")
def nucleus(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _logits(spark, sf_dir).select("vec_id", C.nucleus(softmax(F.col("logits")), 0.85).alias("k"))
    return rows.select(
        "vec_id",
        F.size("k").cast("bigint").alias("n_kept"),
        F.round(F.aggregate("k", F.lit(0.0), lambda a, x: a + x["weight"]), 6).alias("kept_mass"),
    )


_KL = """s AS (SELECT vec_id, i, x / 2 AS a FROM e WHERE i < 48), t AS (SELECT vec_id, 63 - i AS i, x / 2 AS b FROM e WHERE 63 - i < 48),
j AS (SELECT s.vec_id, a, b FROM s JOIN t ON s.vec_id = t.vec_id AND s.i = t.i),
z AS (SELECT vec_id, ln(sum(exp(a))) AS za, ln(sum(exp(b))) AS zb FROM j GROUP BY 1),
k AS (SELECT j.vec_id, 4 * sum(exp(b - zb) * ((b - zb) - (a - za))) AS kl FROM j JOIN z ON j.vec_id = z.vec_id GROUP BY 1)"""


@query(f"WITH {_E}, {_KL} SELECT vec_id, round(kl, 6) AS kl FROM k")
def distill_kl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teacher (the row reversed, cut to 48 tokens) against student, temperature 2, arrays."""
    student = F.slice("logits", 1, 48)
    kl = L.distillation_kl(student, F.reverse("logits"), 2.0)
    return _logits(spark, sf_dir).select("vec_id", F.round(kl, 6).alias("kl"))


@query(f"WITH {_E}, {_KL} SELECT vec_id, round(kl, 6) AS kl, round(5e-1 * (vec_id % 3) + 5e-1 * kl, 6) AS loss FROM k")
def distill_kl_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from long tables joined by (position, token)."""
    rows = _logits(spark, sf_dir)
    student = rows.select("vec_id", F.posexplode("logits").alias("token_id", "logit")).filter("token_id < 48")
    teacher = rows.select("vec_id", F.posexplode(F.reverse("logits")).alias("token_id", "logit"))
    kl = L.distillation_kl_long(student, teacher, 2.0, ("vec_id",))
    loss = L.mixed_distillation_loss(F.col("vec_id") % 3, F.col("kl"), 0.5)
    return kl.select("vec_id", F.round("kl", 6).alias("kl"), F.round(loss, 6).alias("loss"))


@query(f"""WITH {_P}, l AS (SELECT ln(p) AS lp, vec_id FROM p WHERE i = vec_id % 64)
SELECT round(-sum(lp) FILTER (WHERE vec_id % 5 <> 0) / count(*) FILTER (WHERE vec_id % 5 <> 0), 6) AS ce,
 round(-sum(lp) FILTER (WHERE vec_id % 5 <> 0) / (count(*) FILTER (WHERE vec_id % 5 <> 0) + 1e-8), 6) AS ce_eps FROM l""")
def masked_ce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy where the label is not ignored."""
    at = (F.col("vec_id") % 64).cast("int")
    label = F.when(F.col("vec_id") % 5 == 0, F.lit(A.IGNORE)).otherwise(at)
    rows = _logits(spark, sf_dir).select(F.get(log_softmax(F.col("logits")), at).alias("logp"), label.alias("label"))
    return rows.agg(
        F.round(L.masked_cross_entropy(F.col("logp"), F.col("label")), 6).alias("ce"),
        F.round(L.masked_cross_entropy(F.col("logp"), F.col("label"), 1e-8), 6).alias("ce_eps"),
    )
