"""Queries on conversations: rendering, sampling, windows and subsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import fixed
from corpusloom.functions.bind import keep_if
from corpusloom.functions.text import repeat_fraction
from corpusloom.operators import messages as M
from corpusloom.operators.render import render, render_turns, reparse
from corpusloom.plans import sqltext as S
from corpusloom.plans.registry import query, table
from corpusloom.sources.readers import nest_turns, spread

def conv() -> Column:
    return F.col("conversations")



def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest_turns(spread(table(spark, sf_dir, "conversations"), "conv_id"))


_PIECE = """'<|im_start|>' || role || chr(10)
 || CASE WHEN role = 'assistant' THEN '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || ltrim(text, chr(10))
    ELSE text END || '<|im_end|>' || chr(10)"""
_RENDERED = f"""rendered AS (SELECT conv_id, count(*) AS n_turns, string_agg({_PIECE}, '' ORDER BY turn) AS rendered
 FROM conversations GROUP BY conv_id)"""


@query(f"WITH {_RENDERED} SELECT conv_id, n_turns, length(rendered) AS n_chars, md5(rendered) AS text_md5 FROM rendered")
def conv_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = render(conv())
    return nested(spark, sf_dir).select(
        "conv_id", F.size(conv()).cast("bigint").alias("n_turns"), rendered.alias("rendered")
    ).select(
        "conv_id", "n_turns", F.length("rendered").cast("bigint").alias("n_chars"), F.md5("rendered").alias("text_md5")
    )


@query(f"SELECT conv_id, turn, md5({_PIECE}) AS piece_md5 FROM conversations")
def conv_render_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered text as one piece per turn; no conversation is gathered."""
    pieces = render_turns(table(spark, sf_dir, "conversations"))
    return pieces.select("conv_id", "turn", F.md5("piece").alias("piece_md5"))


_PROMPTS_SQL = "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in fixed.system_prompts()) + "]"
_AUGMENT = f"""firsts AS (SELECT conv_id, role FROM conversations WHERE turn = 0),
chosen AS (SELECT conv_id, role <> 'system' AND {S.draw(42, "system_add", "conv_id")} < 0.2 AS added,
  CAST({_PROMPTS_SQL} AS VARCHAR[])[CAST({S.draw_int(42, "system_pick", "conv_id")} % 10 + 1 AS INT)] AS prompt FROM firsts)"""


@query(f"""WITH {_AUGMENT} SELECT conv_id, added, CASE WHEN added THEN prompt END AS system_prompt FROM chosen""")
def conv_system_augment(spark: SparkSession, sf_dir: str) -> DataFrame:
    firsts = nest_turns(table(spark, sf_dir, "conversations").filter("turn = 0"))
    grown = firsts.withColumn("grown", M.add_system_prompt(conv(), F.col("conv_id")))
    added = F.size("grown") > F.size(conv())
    return grown.select(
        "conv_id", added.alias("added"), F.when(added, F.get("grown", F.lit(0))["content"]).alias("system_prompt")
    )


_FLAGSHIP = f"""WITH {_RENDERED}, {_AUGMENT},
texts AS (SELECT r.conv_id, n_turns + CAST(added AS BIGINT) AS n_turns,
  CASE WHEN added THEN '<|im_start|>system' || chr(10) || prompt || '<|im_end|>' || chr(10) ELSE '' END || rendered AS rendered
  FROM rendered r JOIN chosen c ON r.conv_id = c.conv_id),
w AS (SELECT *, {S.words("rendered")} AS w FROM texts), g AS (SELECT *, {S.grams("w")} AS g FROM w)
SELECT conv_id, n_turns, md5(rendered) AS text_md5, length(rendered) AS n_chars, round({S.repeat_fraction("g")}, 6) AS rep_frac
FROM g WHERE length({S.strip("rendered")}) >= 100"""


@query(_FLAGSHIP)
def training_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouping, system augmentation, rendering, least length and repeated-trigram share."""
    rows = nested(spark, sf_dir).withColumn("conversations", M.add_system_prompt(conv(), F.col("conv_id")))
    return (
        rows.select(
            "conv_id",
            F.size(conv()).cast("bigint").alias("n_turns"),
            keep_if(
                F.struct(render(conv()).alias("rendered")), lambda r: M.stripped_between(r["rendered"], 100)
            ),
        )
        .select(
            "conv_id",
            "n_turns",
            F.md5("rendered").alias("text_md5"),
            F.length("rendered").cast("bigint").alias("n_chars"),
            F.round(repeat_fraction(F.col("rendered")), 6).alias("rep_frac"),
        )
    )


_EMPTY = "'<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10)"


@query(f"""WITH {_RENDERED}, s AS (SELECT conv_id, CASE WHEN {S.draw(42, "empty_think", "conv_id")} > 0.2
 THEN replace(rendered, {_EMPTY}, '') ELSE rendered END AS t FROM rendered)
SELECT conv_id, instr(t, '<think>') > 0 AS has_block, md5(t) AS text_md5 FROM s""")
def think_strip_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = M.strip_empty_think(F.col("rendered"), F.col("conv_id"))
    rows = nested(spark, sf_dir).select("conv_id", render(conv()).alias("rendered")).select("conv_id", text.alias("t"))
    return rows.select("conv_id", F.contains("t", F.lit("<think>")).alias("has_block"), F.md5("t").alias("text_md5"))


@query(f"""SELECT DISTINCT conv_id, {S.draw(42, "thinking", "conv_id")} < 0.5 AS half,
 {S.draw(42, "thinking", "conv_id")} < 0.9 AS most, {S.draw(42, "thinking", "conv_id")} < 0.1 AS few FROM conversations""")
def thinking_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("conv_id")
    return table(spark, sf_dir, "conversations").select("conv_id").distinct().select(
        "conv_id",
        M.thinking_flag(key, 0.5).alias("half"),
        M.thinking_flag(key, 0.9).alias("most"),
        M.thinking_flag(key, 0.1).alias("few"),
    )


@query(f"""WITH lasts AS (SELECT conv_id, max(turn) AS last_turn FROM conversations GROUP BY conv_id),
p AS (SELECT c.conv_id, string_agg({_PIECE}, '' ORDER BY turn) FILTER (WHERE turn < last_turn) AS body
 FROM conversations c JOIN lasts l ON c.conv_id = l.conv_id GROUP BY c.conv_id)
SELECT conv_id, md5(coalesce(body, '') || '<|im_start|>assistant' || chr(10) || CASE WHEN {S.draw(42, "thinking", "conv_id")} < 0.5
 THEN '<think>' || chr(10) ELSE {_EMPTY} END) AS prompt_md5, '' AS answer FROM p""")
def conv_prompt_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = render(M.drop_last(conv()), prompt_thinking=M.thinking_flag(F.col("conv_id"), 0.5))
    return (
        nested(spark, sf_dir)
        .select("conv_id", *M.prompt_only(prompt))
        .select("conv_id", F.md5("prompt").alias("prompt_md5"), "answer")
    )


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations)
SELECT conv_id, string_agg(md5(text), ',' ORDER BY turn) FILTER (WHERE back <= 2) AS last_two, 0 AS cli_zero,
 string_agg(md5(text), ',' ORDER BY turn) FILTER (WHERE back <= 1) AS client_zero,
 string_agg(md5(text), ',' ORDER BY turn) FILTER (WHERE back <= 3) AS web_two FROM r GROUP BY conv_id""")
def conv_history_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(n: int, style: str):
        kept = M.history(conv(), n, style)
        return F.array_join(F.transform(kept, lambda m: F.md5(m["content"])), ",")

    recent = nest_turns(M.recent_turns(table(spark, sf_dir, "conversations"), 3))
    return recent.select(
        "conv_id",
        digest(2, "cli").alias("last_two"),
        F.size(M.history(conv(), 0, "cli")).alias("cli_zero"),
        digest(0, "client").alias("client_zero"),
        digest(2, "web").alias("web_two"),
    )


@query("""WITH t AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE length(text) > 0) AS t
 FROM conversations GROUP BY conv_id) SELECT conv_id, length(t) AS n_chars, md5(t) AS text_md5 FROM t WHERE t IS NOT NULL""")
def conv_corpus_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.struct(M.corpus_text(conv()).alias("t"))
    rows = nested(spark, sf_dir).select("conv_id", keep_if(text, lambda r: r["t"].isNotNull()))
    return rows.select("conv_id", F.length("t").cast("bigint").alias("n_chars"), F.md5("t").alias("text_md5"))


@query("""WITH s AS (SELECT conv_id, sum(length(text)) AS n, count(*) AS k, max_by(role, turn) AS lr, max(turn) AS lt
 FROM conversations GROUP BY conv_id)
SELECT c.conv_id, c.turn, c.role, CASE WHEN c.turn = s.lt THEN '' ELSE c.text END AS text
FROM conversations c JOIN s ON c.conv_id = s.conv_id WHERE s.n <= 3000 AND s.k <= 6 AND s.lr = 'assistant'""")
def rl_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.rl_subset_turns(table(spark, sf_dir, "conversations"), 3000, 6).select("conv_id", "turn", "role", "text")


@query("""SELECT conv_id, turn, role, lag(role) OVER w AS prev_role, lead(role) OVER w AS next_role FROM conversations
WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def role_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return M.role_neighbours(turns).select("conv_id", "turn", "role", "prev_role", "next_role")


@query("""SELECT conv_id, coalesce(max(turn) FILTER (WHERE role = 'user'), max(turn)) AS query_index
FROM conversations GROUP BY conv_id""")
def last_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.last_query_turn(table(spark, sf_dir, "conversations")).withColumnRenamed("query_turn", "query_index")


@query(f"""WITH {_RENDERED} SELECT c.conv_id, c.turn, c.role,
 md5({S.strip("CASE WHEN role = 'assistant' THEN '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || ltrim(text, chr(10)) ELSE text END")}) AS body_md5
FROM conversations c""")
def prompt_reparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered text taken apart again."""
    rows = nested(spark, sf_dir).select("conv_id", render(conv()).alias("rendered"))
    return rows.select("conv_id", F.posexplode(reparse(F.col("rendered"))).alias("turn", "m")).select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), "m.role", F.md5("m.content").alias("body_md5")
    )


@query(f"""WITH l AS (SELECT conv_id, max(turn) AS lt FROM conversations GROUP BY conv_id),
p AS (SELECT c.conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) FILTER (WHERE turn < lt) AS past,
 max(text) FILTER (WHERE turn = lt) AS question FROM conversations c JOIN l ON c.conv_id = l.conv_id GROUP BY c.conv_id)
SELECT conv_id, md5(CASE WHEN past IS NULL THEN question
 ELSE past || chr(10) || '{fixed.HISTORY_BRIDGE}' || chr(10) || question END) AS context_md5 FROM p""")
def judge_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested(spark, sf_dir).select("conv_id", F.md5(M.judge_context(conv())).alias("context_md5"))


# --- conversations with tools: built from the same turns ---------------------------------------

_TOOLS = (
    '[{"type": "function", "function": {"name": "lookup", "parameters": {"b": 1, "a": "x, y: z"}}}, '
    '{"type": "function", "function": {"name": "count"}}]'
)
_TOOL_LINES = _TOOLS[1:-1].replace("}}}, {", "}}}\n{")


def _sql(text: str) -> str:
    return " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in text.split("\n"))


# Rendering takes newlines off both ends of the reasoning.
_THINK = "trim('reason ' || left(text, 10), chr(10))"
_TOOL_PIECE = f"""CASE WHEN kind = 'call' THEN '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) || {_THINK} || chr(10)
 || '</think>' || chr(10) || chr(10) || CASE WHEN conv_id % 2 = 0 THEN 'look' || chr(10) ELSE '' END
 || '<tool_call>' || chr(10) || '{{"name": "lookup", "arguments": {{"n": ' || CAST(turn AS VARCHAR) || ', "s": "a:b"}}}}' || chr(10) || '</tool_call>'
 || chr(10) || '<tool_call>' || chr(10) || '{{"name": "count", "arguments": raw}}' || chr(10) || '</tool_call><|im_end|>' || chr(10)
 WHEN kind = 'results' THEN '<|im_start|>user' || chr(10) || '<tool_response>' || chr(10) || 'one' || chr(10) || '</tool_response>'
 || chr(10) || '<tool_response>' || chr(10) || 'two' || chr(10) || '</tool_response><|im_end|>' || chr(10)
 ELSE '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) END"""


def tool_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn followed by a reply with two calls and two tool results."""
    users = table(spark, sf_dir, "conversations").filter("role = 'user'")
    none = "cast(null as string)"
    call = (
        """concat('[{"name": "lookup", "arguments": {"n": ', turn, ', "s": "a:b"}}, """
        """{"type": "function", "function": {"name": "count", "arguments": "raw"}}]')"""
    )
    return users.selectExpr(
        "conv_id",
        "turn",
        f"""array(
          named_struct('role', 'system', 'content', 'Be brief.', 'reasoning_content', {none}, 'tools', '{_TOOLS}', 'tool_calls', {none}),
          named_struct('role', 'user', 'content', text, 'reasoning_content', {none}, 'tools', {none}, 'tool_calls', {none}),
          named_struct('role', 'assistant', 'content', if(conv_id % 2 = 0, 'look', ''),
            'reasoning_content', concat('reason ', left(text, 10)), 'tools', {none}, 'tool_calls', {call}),
          named_struct('role', 'tool', 'content', 'one', 'reasoning_content', {none}, 'tools', {none}, 'tool_calls', {none}),
          named_struct('role', 'tool', 'content', 'two', 'reasoning_content', {none}, 'tools', {none}, 'tool_calls', {none})
        ) AS conversations""",
    )


@query(f"""WITH u AS (SELECT conv_id, turn, text, k AS kind FROM conversations, (VALUES ('user'), ('call'), ('results')) v(k) WHERE role = 'user'),
p AS (SELECT conv_id, turn, string_agg({_TOOL_PIECE}, '' ORDER BY CASE kind WHEN 'user' THEN 1 WHEN 'call' THEN 2 ELSE 3 END) AS body
 FROM u GROUP BY conv_id, turn)
SELECT conv_id, turn, md5({_sql("<|im_start|>system" + chr(10) + "Be brief." + chr(10) * 2 + fixed.TOOLS_INTRO + chr(10) + _TOOL_LINES + fixed.TOOLS_OUTRO)}
 || body) AS text_md5 FROM p""")
def conv_render_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool preamble, calls given as objects and as strings, and merged tool results."""
    rows = tool_conversations(spark, sf_dir)
    return rows.select("conv_id", "turn", F.md5(render(conv(), M.tool_schema(conv()))).alias("text_md5"))


@query("""SELECT conv_id, turn, 'reason ' || left(text, 10) AS reasoning, 2 AS n_tools, 'lookup,count' AS names,
 '{"n":' || CAST(turn AS VARCHAR) || ',"s":"a:b"}|raw' AS arguments FROM conversations WHERE role = 'user'""")
def message_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded tool calls and tool lists."""
    rows = tool_conversations(spark, sf_dir).withColumn("reply", F.get(M.normalised(conv()), F.lit(2)))
    return rows.select(
        "conv_id",
        "turn",
        F.col("reply.reasoning_content").alias("reasoning"),
        F.size(M.tool_list(M.tool_schema(conv()))).alias("n_tools"),
        F.array_join(F.transform("reply.calls", lambda c: c["name"]), ",").alias("names"),
        F.array_join(F.transform("reply.calls", lambda c: c["arguments"]), "|").alias("arguments"),
    )


@query(f"""WITH l AS (SELECT conv_id, max(turn) AS lt FROM conversations GROUP BY conv_id),
b AS (SELECT c.conv_id, string_agg({_PIECE}, '' ORDER BY turn) AS chosen,
 string_agg(CASE WHEN turn = lt THEN '<|im_start|>assistant' || chr(10) || {_EMPTY} || 'no<|im_end|>' || chr(10) ELSE {_PIECE} END, '' ORDER BY turn) AS rejected,
 count(*) AS n FROM conversations c JOIN l ON c.conv_id = l.conv_id GROUP BY c.conv_id)
SELECT conv_id AS pair_id, 'chosen' AS side, n AS n_turns, md5(chosen) AS text_md5 FROM b
UNION ALL SELECT conv_id, 'rejected', n, md5(rejected) FROM b""")
def preference_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs (the second side ends in a short refusal), one row per side."""
    refusal = F.array(M.message("assistant", F.lit("no")))
    pairs = nested(spark, sf_dir).select(
        F.col("conv_id").alias("pair_id"),
        conv().alias("chosen"),
        F.concat(M.drop_last(conv()), refusal).alias("rejected"),
    )
    return M.pair_samples(pairs).select(
        "pair_id",
        "side",
        F.size(conv()).cast("bigint").alias("n_turns"),
        F.md5(render(conv())).alias("text_md5"),
    )
