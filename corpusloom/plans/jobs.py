"""End-to-end jobs: from corpus rows to padded training samples, prompts, batches and scores.

The samples and prompts are one lazy plan of row-local columns. ``epoch_batches`` shuffles for its order; ``scored_trajectories`` runs a job for its
group statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import arrays as A
from corpusloom.functions.bind import computed, let
from corpusloom.operators import groups as G
from corpusloom.operators import messages as M
from corpusloom.operators import sampling as P
from corpusloom.operators.render import render
from corpusloom.operators.rewards import agent_reward
from corpusloom.operators.vocabulary import Encoder


def pretrain_samples(rows: DataFrame, encoder: Encoder, key: str, text: str = "text", max_length: int = 512) -> DataFrame:
    """Plain text to (key, input_ids, labels). Rows without text are dropped."""
    ids = rows.filter(F.col(text).isNotNull()).select(key, encoder.encode(F.col(text)).alias("_ids"))
    padded = A.pad_right(A.frame(A.head(F.col("_ids"), max_length - 2)), max_length)
    return ids.select(key, padded.alias("input_ids")).withColumn("labels", A.labels_from_ids(F.col("input_ids")))


def chat_text(
    messages: Column, key: Column, seed: int = 42, add_system: float = 0.2, keep_empty_think: float = 0.2, assistant_name: str = "assistant"
) -> Column:
    """One conversation as training text, with the sampled system prompt and think-block removal."""
    grown = M.add_system_prompt(messages, key, seed, add_system, assistant_name)
    text = let(grown, lambda m: render(m, M.tool_schema(m)))
    return let(text, lambda t: M.strip_empty_think(t, key, keep_empty_think, seed))


def _padded(ids: Column, max_length: int) -> Column:
    return A.pad_right(A.head(ids, max_length), max_length)


def chat_samples(
    rows: DataFrame, encoder: Encoder, key: str, column: str = "conversations", max_length: int = 1024, seed: int = 42, **sampling
) -> DataFrame:
    """Conversations to (key, input_ids, labels); only reply tokens are labelled.

    Use ``seed + epoch`` as the seed for new draws each epoch.
    """
    text = chat_text(F.col(column), F.col(key), seed, **sampling)
    encoded = rows.select(key, computed(_text=text)).select(key, encoder.encode(F.col("_text")).alias("_ids"))
    padded = encoded.select(key, _padded(F.col("_ids"), max_length).alias("input_ids"))
    masked = padded.withColumn("_mask", A.reply_mask(F.col("input_ids"), *encoder.reply_marks()))
    return masked.select(key, "input_ids", A.labels_from_mask(F.col("input_ids"), F.col("_mask")).alias("labels"))


def preference_samples(
    pairs: DataFrame, encoder: Encoder, key: str, max_length: int = 4096, seed: int = 42, keep_empty_think: float = 0.2
) -> DataFrame:
    """Preference pairs to six aligned arrays: inputs, targets and mask of both sides.

    Both sides are columns of one row, so nothing is shuffled to bring them together again.
    """
    sides = ("chosen", "rejected")

    def text(side: str) -> Column:
        draw_key = F.concat_ws(":", F.col(key).cast("string"), F.lit(side))
        return M.strip_empty_think(render(M.full_messages(F.col(side))), draw_key, keep_empty_think, seed)

    texts = pairs.select(key, computed(**{s: text(s) for s in sides}))
    encoded = texts.select(key, *[encoder.encode(F.col(s)).alias(s) for s in sides])
    ids = encoded.select(key, *[_padded(F.col(s), max_length).alias(s) for s in sides])
    masks = ids.select("*", *[A.reply_mask(F.col(s), *encoder.reply_marks()).alias(f"_m_{s}") for s in sides])
    out = []
    for s in sides:
        out += [
            A.shift_inputs(F.col(s)).alias(f"x_{s}"),
            A.shift_targets(F.col(s)).alias(f"y_{s}"),
            A.shift_targets(F.col(f"_m_{s}")).alias(f"mask_{s}"),
        ]
    return masks.select(key, *out)


def rollout_prompts(
    rows: DataFrame, key: str, column: str = "conversations", thinking_ratio: float = 0.5, seed: int = 42, add_system: float = 0.2,
    assistant_name: str = "assistant",
) -> DataFrame:
    """Conversations to (key, prompt, answer): the last message gives way to an open reply."""
    grown = M.add_system_prompt(F.col(column), F.col(key), seed, add_system, assistant_name)
    prompt = render(M.drop_last(grown), prompt_thinking=M.thinking_flag(F.col(key), thinking_ratio, seed))
    return rows.select(key, *M.prompt_only(prompt))


def epoch_batches(
    samples: DataFrame, key: str, batch_size: int, epoch: int = 0, seed: int = 42, workers: int = 1, skip: int = 0
) -> DataFrame:
    """Samples in this epoch's order with ``epoch``, ``shard`` and ``batch_id``, ready to write."""
    dealt = P.shards(P.shuffled(samples, key, seed, epoch), workers)
    return P.batches(dealt, batch_size, skip, "place").withColumn("epoch", F.lit(epoch))


def scored_trajectories(rows: DataFrame, group: list[str], score: Column | None = None) -> DataFrame:
    """Add ``reward`` and the group-relative ``advantage`` to logged trajectories.

    Rows hold (…group, response, turns, unfinished, names, gt).
    """
    reward = agent_reward(*[F.col(c) for c in ("response", "turns", "unfinished", "names", "gt")], score)
    return G.group_advantage(rows.withColumn("reward", reward), group, "reward")
