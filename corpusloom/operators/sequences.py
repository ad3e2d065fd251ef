"""Sequences stored one position per row: numbering, end cuts, credit assignment and packing.

A sequence can be arbitrarily long, so nothing here gathers or sorts a whole one in a task:
numbering works per (sequence, bucket), recurrences per fixed-size block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.arrays import first_response_position, tail
from corpusloom.functions.bind import let
from corpusloom.session import settled


def number_positions(rows: DataFrame, key: str, order: str, bucket: Column) -> DataFrame:
    """Add ``pos``: the zero-based place of each row in its sequence, ordered by ``order``.

    ``bucket`` is a coarse step of the order column (an hour of a timestamp, say) that splits
    long sequences. Rows are numbered inside (sequence, bucket); the rows of earlier buckets
    are added. ``order`` values are unique in a sequence.
    """
    marked = rows.withColumn("_bucket", bucket)
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(key, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(key, "_bucket").orderBy(order)
    return (
        marked.join(offsets, [key, "_bucket"])
        .withColumn("pos", (F.col("_offset") + F.row_number().over(inside) - 1).cast("bigint"))
        .drop("_bucket", "_offset")
    )


def cut_at_end(
    rows: DataFrame, key: str, is_end: Column, pos: str = "pos", padding: Column | None = None
) -> DataFrame:
    """Runs a job. Add ``end_pos`` (first end token, else the last position) and ``mask`` (1 up to it).

    Rows where ``padding`` is true are no end tokens, no last position and have mask 0. The ends, one
    row per sequence, are written out first: Spark can then split a sequence that holds much of the rows.
    """
    real = F.lit(True) if padding is None else ~F.coalesce(padding, F.lit(False))
    ends = rows.groupBy(key).agg(
        F.coalesce(F.min(F.when(is_end & real, F.col(pos))), F.max(F.when(real, F.col(pos)))).alias("end_pos")
    )
    counted = real & (F.col(pos) <= F.col("end_pos"))
    return rows.join(settled(ends), key).withColumn("mask", F.coalesce(counted, F.lit(False)).cast("int"))


def reward_on_last(
    rows: DataFrame, key: str, reward: str, mask: str = "mask", pos: str = "pos", last: str | None = None
) -> DataFrame:
    """Add ``token_reward``: the sequence reward on the last counted token, 0 elsewhere.

    ``last`` names a column that already holds that position (``end_pos`` after
    ``cut_at_end``), which saves the aggregate.
    """
    placed = F.when(F.col(pos) == F.col(last or "_last"), F.col(reward)).otherwise(F.lit(0.0))
    if last is not None:
        return rows.withColumn("token_reward", placed)
    found = rows.groupBy(key).agg(F.max(F.when(F.col(mask) != 0, F.col(pos))).alias("_last"))
    return rows.join(found, key).withColumn("token_reward", placed).drop("_last")


def _blocks(rows: DataFrame, key: str, pos: str, columns: dict[str, Column], block: int | None) -> DataFrame:
    """(key, _block, _items): consecutive positions gathered in order, ``block`` at a time."""
    group = F.lit(0) if block is None else F.floor(F.col(pos) / F.lit(block))
    item = F.struct(F.col(pos).cast("bigint").alias("pos"), *[c.alias(n) for n, c in columns.items()])
    return rows.groupBy(F.col(key), group.cast("bigint").alias("_block")).agg(
        F.sort_array(F.collect_list(item)).alias("_items")
    )


def _solve(blocks: DataFrame, key: str, add, factor, block: int, levels: int) -> DataFrame:
    """Add ``_carry``: the solution at the first position of the block behind, 0 at the end.

    ``add`` and ``factor`` give the terms of an item. Linear recurrences compose, so a block
    acts on what follows it like one step; the shorter sequence of steps is solved the same way.
    """
    folded = F.aggregate(
        F.reverse("_items"),
        F.struct(F.lit(0.0).alias("x"), F.lit(1.0).alias("f")),
        lambda s, it: F.struct((add(it) + factor(it) * s["x"]).alias("x"), (factor(it) * s["f"]).alias("f")),
    )
    steps = blocks.select(key, F.col("_block").alias("pos"), folded.alias("_s"))
    columns = {"add": F.col("_s.x"), "factor": F.col("_s.f")}
    upper = _blocks(steps, key, "pos", columns, block if levels > 1 else None)
    inner = (lambda it: it["add"]), (lambda it: it["factor"])
    if levels > 1:
        upper = _solve(upper, key, *inner, block, levels - 1)
    else:
        upper = upper.withColumn("_carry", F.lit(0.0))
    solved = upper.select(key, F.inline(_unfold(*inner))).select(
        key, (F.col("item.pos") - 1).alias("_block"), F.col("x").alias("_carry")
    )
    return blocks.join(solved, [key, "_block"], "left").withColumn("_carry", F.coalesce("_carry", F.lit(0.0)))


def _unfold(add, factor) -> Column:
    """Array of (item, x) of a block, from the last position to the first."""
    start = F.struct(F.col("_carry").alias("x"), F.transform(F.slice("_items", 1, 0), lambda _: F.lit(0.0)).alias("xs"))

    def step(s: Column, it: Column) -> Column:
        return let(add(it) + factor(it) * s["x"], lambda x: F.struct(x.alias("x"), F.array_append(s["xs"], x).alias("xs")))

    xs = F.aggregate(F.reverse("_items"), start, step, lambda s: s["xs"])
    return F.arrays_zip(F.reverse("_items").alias("item"), xs.alias("x"))


def backward_recurrence(
    rows: DataFrame, key: str, add: str, factor: str, pos: str = "pos", block: int = 128, levels: int = 2
) -> DataFrame:
    """Solve ``x[t] = add[t] + factor[t] * x[t+1]`` along each sequence; returns (key, pos, x).

    With two levels and blocks of 128, the longest array a task sees is a block or 1/16384 of
    a sequence, and the joins are between tables of blocks, not of rows.
    """
    blocks = _blocks(rows, key, pos, {"add": F.col(add), "factor": F.col(factor)}, block)
    terms = (lambda it: it["add"]), (lambda it: it["factor"])
    solved = _solve(blocks, key, *terms, block, levels)
    return solved.select(key, F.inline(_unfold(*terms))).select(key, F.col("item.pos").alias(pos), "x")


def gae(
    rows: DataFrame,
    key: str,
    reward: str = "token_reward",
    value: str = "value",
    gamma: float = 1.0,
    lam: float = 0.95,
    pos: str = "pos",
    block: int = 128,
    keep: tuple[str, ...] = (),
    mask: str | None = None,
) -> DataFrame:
    """Advantages and returns by generalised advantage estimation.

    Returns (key, pos, …keep, value, advantage, returns); ``keep`` names further row columns to
    carry along. Values where ``mask`` is 0 (behind the end token, padding) count as 0, so that nothing
    flows back from there. Rows are gathered into blocks of consecutive positions; the value one position
    later is 0 at the end of the sequence.
    """
    counted = F.col(value) if mask is None else F.when(F.col(mask) != 0, F.col(value)).otherwise(F.lit(0.0))
    columns = {"reward": F.col(reward), "value": counted, **{c: F.col(c) for c in keep}}
    # The first row of a block also goes to the block before it, whose last row needs its value.
    own = F.floor(F.col(pos) / F.lit(block)).cast("bigint")
    homes = F.when((F.col(pos) % block == 0) & (F.col(pos) > 0), F.array(own, own - 1)).otherwise(F.array(own))
    item = F.struct(F.col(pos).cast("bigint").alias("pos"), *[c.alias(n) for n, c in columns.items()])
    blocks = (
        rows.select(key, F.explode(homes).alias("_block"), item.alias("_item"))
        .groupBy(key, "_block")
        .agg(F.sort_array(F.collect_list("_item")).alias("_rows"))
    )
    inside = F.filter("_rows", lambda it: it["pos"] < (F.col("_block") + 1) * block)

    def with_error(it: Column, i: Column) -> Column:
        ahead = F.coalesce(F.get("_rows", i + 1)["value"], F.lit(0.0))
        error = it["reward"] + F.lit(float(gamma)) * ahead - it["value"]
        return F.struct(it["pos"].alias("pos"), it["value"].alias("value"), error.alias("error"), *[it[c].alias(c) for c in keep])

    ready = blocks.select(key, "_block", F.transform(inside, with_error).alias("_items"))
    terms = (lambda it: it["error"]), (lambda it: F.lit(float(gamma * lam)))
    out = _solve(ready, key, *terms, block, 2).select(key, F.inline(_unfold(*terms)))
    return out.select(
        key,
        F.col("item.pos").alias(pos),
        *[F.col(f"item.{c}").alias(c) for c in keep],
        F.col("item.value").alias(value),
        F.col("x").alias("advantage"),
        (F.col("x") + F.col("item.value")).alias("returns"),
    )


def gae_array(
    rewards: Column, values: Column, gamma: float = 1.0, lam: float = 0.95, mask: Column | None = None
) -> Column:
    """The same for sequences held as arrays in one row: advantages, first position first."""
    n = F.size(values)
    if mask is not None:
        values = F.transform(values, lambda v, i: F.when(F.get(mask, i) != 0, v).otherwise(F.lit(0.0)))
    errors = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get(rewards, i)
        + F.lit(float(gamma)) * F.coalesce(F.get(values, i + 1), F.lit(0.0))
        - F.get(values, i),
    )
    start = F.struct(F.lit(0.0).alias("a"), F.array().cast("array<double>").alias("out"))

    def step(s: Column, e: Column) -> Column:
        a = e + F.lit(float(gamma * lam)) * s["a"]
        return F.struct(a.alias("a"), F.array_append(s["out"], a).alias("out"))

    solved = F.reverse(F.aggregate(F.reverse(errors), start, step, lambda s: s["out"]))
    return F.when(n == 0, F.array().cast("array<double>")).otherwise(solved)


def trajectories(segments: DataFrame, sample: list[str]) -> DataFrame:
    """Turn segments to one token row per sample, with generated tokens marked.

    ``segments`` holds (…sample, turn, part, generated, ids, logps): what the model wrote has
    mask 1 and its log-probabilities, what a tool returned has mask 0 and zeros. A sample has at
    most ``2 * max_turns`` segments and the row is the output.
    """
    flag = F.col("generated").cast("int")
    marked = segments.select(
        *sample,
        F.struct(
            F.col("turn"),
            F.col("part"),
            F.col("ids"),
            F.transform("ids", lambda _: flag).alias("mask"),
            F.when(F.col("generated"), F.col("logps"))
            .otherwise(F.transform("ids", lambda _: F.lit(0.0)))
            .alias("logps"),
        ).alias("seg"),
    )
    ordered = marked.groupBy(*sample).agg(F.sort_array(F.collect_list("seg")).alias("segs"))
    return ordered.select(*sample, *[F.flatten(F.col(f"segs.{n}")).alias(n) for n in ("ids", "mask", "logps")])


def pack(prompt_ids: Column, response_ids: Column, response_mask: Column, logps: Column, max_len: int) -> Column:
    """Prompt and response as one sequence cut to its last ``max_len`` tokens.

    Log-probabilities belong to predicted tokens, so there is one fewer than tokens. The last
    field is the index of the first response token.
    """
    ids = F.concat(prompt_ids, response_ids)
    mask = F.concat(F.transform(prompt_ids, lambda _: F.lit(0).cast("int")), response_mask)
    lead = F.array_repeat(F.lit(0.0), F.greatest(F.size(prompt_ids) - 1, F.lit(0)))
    cut = F.struct(
        tail(ids, max_len).alias("ids"),
        tail(mask, max_len).alias("mask"),
        F.when(F.size(ids) > max_len, tail(F.concat(lead, logps), max_len - 1))
        .otherwise(F.concat(lead, logps))
        .alias("logps"),
    )
    return let(
        cut,
        lambda c: F.struct(
            c["ids"].alias("ids"),
            c["mask"].alias("mask"),
            c["logps"].alias("logps"),
            first_response_position(c["mask"]).alias("prompt_len"),
        ),
    )


def gather(rows: DataFrame, starts: DataFrame, key: str, length: str, pos: str = "pos") -> DataFrame:
    """Values at positions ``prompt_len - 1 + i`` for ``i`` in [0, length); adds ``i``."""
    return (
        rows.join(starts, key)
        .withColumn("i", F.col(pos) - F.col("prompt_len") + 1)
        .filter((F.col("i") >= 0) & (F.col("i") < F.col(length)))
    )


def final_answer(turns: DataFrame, key: str, turn: str, text: str) -> DataFrame:
    """Text of the last turn of each trajectory."""
    return turns.groupBy(key).agg(F.max_by(text, turn).alias("final_text"))


def call_results(
    turns: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    roles: tuple[str, str] = ("assistant", "tool"),
) -> DataFrame:
    """Each assistant turn with the tool result right behind it (null when another role follows)."""
    calls = turns.filter(F.col(role) == roles[0]).select(key, turn, F.col(text).alias("call_text"))
    results = turns.filter(F.col(role) == roles[1]).select(
        key, (F.col(turn) - 1).alias(turn), F.col(text).alias("result_text")
    )
    return calls.join(results, [key, turn], "left")
