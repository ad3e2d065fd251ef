"""Inputs derived from the given tables.

The tables hold no tagged responses, tool calls or token logs, so these are built from their
columns by fixed expressions. The expressions are plain SQL that Spark and other engines read
alike, which lets a query and its SQL equivalent share them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.sequences import number_positions
from corpusloom.plans.registry import table
from corpusloom.sources.readers import spread

NL = "chr(10)"

# --- responses: assistant turns with think blocks and tool calls -------------------------------

CITY = "CASE conv_id % 4 WHEN 0 THEN 'Tokyo' WHEN 1 THEN 'Paris' WHEN 2 THEN 'London' ELSE 'Atlantis' END"
TOOL_NAME = (
    "CASE (conv_id + turn) % 6 WHEN 0 THEN 'get_current_weather' WHEN 1 THEN 'get_exchange_rate' "
    "WHEN 2 THEN 'unit_converter' WHEN 3 THEN 'get_current_time' WHEN 4 THEN 'fly' ELSE 'translate_text' END"
)
TOOL_ARGS = f"""CASE (conv_id + turn) % 6
 WHEN 0 THEN '{{"location": "' || {CITY} || '"}}'
 WHEN 1 THEN CASE WHEN turn % 2 = 0 THEN '{{"from_currency": "USD", "to_currency": "CNY"}}'
                  ELSE '{{"from_currency": "USD"}}' END
 WHEN 2 THEN '{{"value": ' || CAST(conv_id % 10 AS VARCHAR(20)) || ', "from_unit": "KM", "to_unit": "miles"}}'
 WHEN 3 THEN '{{}}'
 WHEN 4 THEN '{{"height": 3}}'
 ELSE '{{"text": "Good morning", "target_language": "' || CASE WHEN turn % 4 = 1 THEN 'chinese' ELSE '' END || '"}}'
 END"""
CALL_JSON = f"""'{{"name": "' || {TOOL_NAME} || '", "arguments": ' || {TOOL_ARGS} || '}}'"""

THINK_PART = f"""CASE WHEN conv_id % 3 = 0 THEN '<think>' || {NL} || left(text, 60) || {NL} || '</think>' || {NL} || {NL}
 WHEN conv_id % 3 = 1 AND turn % 4 = 1 THEN left(text, 30) || '</think>' ELSE '' END"""
CALL_PART = f"""CASE WHEN conv_id % 5 = 0 THEN {NL} || '<tool_call>' || {NL} || {CALL_JSON} || {NL} || '</tool_call>'
 WHEN conv_id % 5 = 1 THEN '<tool_call>{{bad json</tool_call>' ELSE '' END"""
RESPONSE = f"""({THINK_PART}) || text || ({CALL_PART}) || CASE WHEN conv_id % 7 = 0 THEN ' <tool_call>' ELSE '' END
 || CASE WHEN conv_id % 5 = 0 AND turn % 3 = 0 THEN ' total 1,234 or -7.5 ok' ELSE '' END"""

RESPONSES_SQL = f"""SELECT conv_id, turn, text, {RESPONSE} AS response, {TOOL_NAME} AS tool, {TOOL_ARGS} AS args
 FROM conversations WHERE role = 'assistant'"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as raw model responses: (conv_id, turn, text, response, tool, args)."""
    return (
        spread(table(spark, sf_dir, "conversations"))
        .filter("role = 'assistant'")
        .selectExpr("conv_id", "turn", "text", f"{RESPONSE} AS response", f"{TOOL_NAME} AS tool", f"{TOOL_ARGS} AS args")
    )


# --- token logs: each user's events in time order are one sequence -----------------------------

TOKEN_COLUMNS = {
    "event_id": "event_id",
    "event_type": "event_type",
    "policy": "-value / 1e2",
    "ref": "-value / 1e2 + (event_id % 7 - 3) * 1e-2",
    "old": "-value / 1e2 + (event_id % 5 - 2) * 1e-1",
    "value": "ln(event_id % 11 + 2e0) / 1e1",
    "old_value": "ln(event_id % 11 + 2e0) / 1e1 + (event_id % 3 - 1) / 3e0",
    "advantage": "(event_id % 9 - 4) / 3e0",
    "returns": "(event_id % 13 - 6) / 9e0",
    "mask": "CASE WHEN event_type = 'error' THEN 0 ELSE 1 END",
    "label": "CASE WHEN event_id % 4 = 0 THEN -100 ELSE CAST(event_id % 6400 AS INT) END",
    "sequence_reward": "(user_id % 9 - 4) / 3e0",
    "side": "CASE WHEN event_id % 2 = 0 THEN 'chosen' ELSE 'rejected' END",
}
_COLUMNS_SQL = ", ".join(f"{v} AS {k}" for k, v in TOKEN_COLUMNS.items())
TOKENS_SQL = f"""SELECT user_id AS sample_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS BIGINT) AS pos,
 {_COLUMNS_SQL} FROM events"""


def loose_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token log without positions; enough for every order-free statistic."""
    return table(spark, sf_dir, "events").selectExpr(
        "user_id AS sample_id", "ts", *[f"{v} AS {k}" for k, v in TOKEN_COLUMNS.items()]
    )


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token log with zero-based positions."""
    rows = loose_tokens(spark, sf_dir)
    return number_positions(rows, "sample_id", "ts", F.date_trunc("day", F.col("ts"))).drop("ts")
