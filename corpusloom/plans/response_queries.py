"""Queries on responses: parsing, tool calls and rewards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.jsontext import any_flag
from corpusloom.functions.numbers import weighted_mix
from corpusloom.operators import responses as R
from corpusloom.operators import rewards as W
from corpusloom.operators import tools as T
from corpusloom.plans import sqltext as S
from corpusloom.plans.derived import RESPONSES_SQL, responses
from corpusloom.plans.registry import query, table
from corpusloom.sources.readers import spread
from corpusloom.sources.writers import response_json

_THINK = r"(?s)<think>(.*?)</think>"
_CALL = r"(?s)<tool_call>(.*?)</tool_call>"
_BASE = f"r AS ({RESPONSES_SQL})"
_JSON = "(CASE WHEN json_valid({0}) THEN {0} END)"

_PARSED = f"""{_BASE},
t AS (SELECT *, regexp_matches(response, '{_THINK}') AS full_block, instr(response, '</think>') > 0 AS has_close FROM r),
s AS (SELECT *, CASE WHEN full_block THEN {S.strip(f"regexp_extract(response, '{_THINK}', 1)")}
   WHEN has_close THEN {S.strip(S.before_first("response", "</think>"))} END AS reasoning,
  CASE WHEN full_block THEN regexp_replace(response, '(?s)<think>.*?</think>[{S.WS_CLASS}]*', '', 'g')
   WHEN has_close THEN {S.strip(S.after_first("response", "</think>"))} ELSE response END AS body FROM t),
p AS (SELECT *, list_filter(list_transform(regexp_extract_all(body, '{_CALL}', 1), lambda x: {S.strip("x")}), lambda x: json_valid(x)) AS calls FROM s)"""


@query(f"""WITH {_PARSED} SELECT conv_id, turn, reasoning, len(calls) AS n_calls,
 md5({S.strip("CASE WHEN len(calls) > 0 THEN regexp_replace(body, '(?s)<tool_call>.*?</tool_call>', '', 'g') ELSE body END")}) AS content_md5,
 CASE WHEN len(calls) > 0 THEN 'tool_calls' ELSE 'stop' END AS finish_reason FROM p""")
def response_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = responses(spark, sf_dir).select("conv_id", "turn", R.parse_response(F.col("response")).alias("p"))
    return rows.select(
        "conv_id",
        "turn",
        "p.reasoning",
        F.coalesce(F.size("p.calls"), F.lit(0)).cast("bigint").alias("n_calls"),
        F.md5("p.content").alias("content_md5"),
        "p.finish_reason",
    )


@query(f"""WITH {_PARSED} SELECT conv_id, turn, tool AS name, args AS arguments, 0 AS call_index FROM p WHERE len(calls) > 0""")
def toolcall_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed calls with their arguments written back as JSON."""
    rows = responses(spark, sf_dir).select("conv_id", "turn", R.parse_response(F.col("response")).alias("p"))
    return rows.select("conv_id", "turn", F.explode("p.calls").alias("c")).select(
        "conv_id", "turn", F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"),
        F.col("c.index").alias("call_index"),
    )


@query(f"""WITH {_PARSED} SELECT conv_id, turn, 'call_0' AS id, tool AS name FROM p WHERE len(calls) > 0""")
def braced_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = responses(spark, sf_dir).select("conv_id", "turn", F.explode(R.braced_calls(F.col("response"))).alias("c"))
    return rows.select("conv_id", "turn", "c.id", "c.name")


@query(f"""WITH {_BASE} SELECT conv_id, turn, tool, CASE tool
 WHEN 'get_current_weather' THEN true WHEN 'get_current_time' THEN true WHEN 'unit_converter' THEN true
 WHEN 'get_exchange_rate' THEN turn % 2 = 0 WHEN 'translate_text' THEN turn % 4 = 1 ELSE false END AS args_ok FROM r""")
def tool_arg_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses(spark, sf_dir).select(
        "conv_id", "turn", "tool", T.arguments_ok(F.col("tool"), F.col("args")).alias("args_ok")
    )


@query("""SELECT c_custkey, coalesce(n_name, 'unknown') AS nation, coalesce(w.workers, 0) AS workers, coalesce(s.balance, 0.0::DOUBLE) AS balance
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n_nationkey
LEFT JOIN (SELECT s_nationkey, count(*) AS workers FROM supplier GROUP BY s_nationkey) w ON c_nationkey = w.s_nationkey
LEFT JOIN (SELECT s_nationkey, s_suppkey % 7 AS desk, max(s_acctbal) AS balance FROM supplier GROUP BY 1, 2) s ON c_nationkey = s.s_nationkey AND c_custkey % 7 = s.desk""")
def tool_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arguments against one-key tables and a two-key table, with defaults for what they don't hold."""
    cases = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation_key"), (F.col("c_custkey") % 7).alias("desk"))
    names = table(spark, sf_dir, "nation").filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation_key"), (F.col("s_suppkey") % 7).alias("desk"), "s_acctbal")
    workers = suppliers.groupBy("nation_key").agg(F.count(F.lit(1)).alias("workers"))
    balances = suppliers.groupBy("nation_key", "desk").agg(F.max("s_acctbal").alias("balance"))
    found = T.lookup(cases, names, ["nation_key"], {"nation": F.lit("unknown")})
    found = T.lookup(found, workers, ["nation_key"], {"workers": F.lit(0).cast("bigint")})
    found = T.lookup(found, balances, ["nation_key", "desk"], {"balance": F.lit(0.0)})
    return found.select("c_custkey", "nation", "workers", "balance")


@query(f"""WITH {_BASE} SELECT conv_id, turn, tool AS name FROM r
WHERE (tool = 'fly') OR (tool = 'get_current_weather' AND conv_id % 2 = 0)""")
def tool_name_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of offered tools; the offers are a (prompt, tool) table."""
    calls = responses(spark, sf_dir).select("conv_id", "turn", F.col("tool").alias("name"))
    convs = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    names = F.when(F.col("conv_id") % 2 == 0, F.array(F.lit("fly"), F.lit("get_current_weather"))).otherwise(
        F.array(F.lit("fly"))
    )
    offers = convs.select("conv_id", F.explode(names).alias("name"))
    return T.offered_calls(calls, offers, ("conv_id", "name")).select("conv_id", "turn", "name")


_DEFINITIONS = {
    "get_current_weather": '{"name": "get_current_weather"}',
    "get_exchange_rate": '{"name": "get_exchange_rate"}',
    "unit_converter": '{"name": "unit_converter"}',
}


@query(f"""WITH {_BASE} SELECT conv_id, turn, concat_ws('|', CASE WHEN tool IN ('get_current_weather', 'get_exchange_rate', 'unit_converter')
 THEN '{{"name": "' || tool || '"}}' END, '{{"name": "unit_converter"}}') AS definitions FROM r""")
def tool_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(F.col("tool"), F.lit("unit_converter"))
    return responses(spark, sf_dir).select(
        "conv_id", "turn", F.array_join(T.definitions_of(names, _DEFINITIONS), "|").alias("definitions")
    )


@query(f"""WITH {_BASE} SELECT conv_id, turn, CASE WHEN tool IN ('get_current_weather', 'get_exchange_rate', 'unit_converter')
 THEN '{{"name": "' || tool || '"}}|' ELSE '' END || '{{"name": "unit_converter"}}' AS definitions FROM r""")
def tool_definitions_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The definitions as a table instead of a literal."""
    cases = responses(spark, sf_dir).select(
        F.struct("conv_id", "turn").alias("case"), F.array(F.col("tool"), F.lit("unit_converter")).alias("names")
    )
    definitions = spark.createDataFrame(list(_DEFINITIONS.items()), "name string, definition string")
    return T.definitions_join(cases, "case", "names", definitions).select(
        "case.conv_id", "case.turn", F.array_join("definitions", "|").alias("definitions")
    )


def _grams(x: str, name: str) -> str:
    return f"""{name}_w AS (SELECT *, {S.words(x)} AS w_{name} FROM {{0}}), {name} AS (SELECT *, {S.grams("w_" + name)} AS g_{name} FROM {name}_w)"""


@query(f"""WITH w AS (SELECT conv_id, turn, {S.words("text")} AS w FROM conversations), g AS (SELECT *, {S.grams("w")} AS g FROM w)
SELECT conv_id, turn, len(w) AS n_words, len(g) AS n_grams, round({S.repeat_fraction("g")}, 6) AS rep FROM g""")
def rep_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    return rows.select("conv_id", "turn", X.words(F.col("text")).alias("w")).select(
        "conv_id",
        "turn",
        F.size("w").cast("bigint").alias("n_words"),
        F.size(X.ngrams(F.col("w"), 3)).cast("bigint").alias("n_grams"),
        F.round(X.repeat_share(F.col("w")), 6).alias("rep"),
    )


@query(f"""WITH {_BASE} SELECT conv_id, CAST(sum(abs({S.count_of("response", "<tool_call>")} - {S.count_of("response", "</tool_call>")})) AS BIGINT) AS imbalance
FROM r GROUP BY conv_id""")
def tag_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call tags left open, per conversation; per-turn counts are summed, turns are not gathered."""
    one = W.tag_imbalance(F.array(F.col("response")))
    return responses(spark, sf_dir).groupBy("conv_id").agg(F.sum(one).alias("imbalance"))


_THINK_TERMS = f"""CASE WHEN instr(response, '</think>') > 0 THEN
  CASE WHEN length({S.strip(S.before_first("response", "</think>"))}) BETWEEN 20 AND 300 THEN 1.0 ELSE -0.5 END
  + CASE WHEN {S.count_of("response", "</think>")} = 1 THEN 0.25 ELSE -0.25 END ELSE 0.0 END"""
_SINGLE = f"""a AS (SELECT *, coalesce({S.strip(S.after_first("response", "</think>"))}, response) AS answer FROM r),
w AS (SELECT *, {S.words("answer")} AS w FROM a), g AS (SELECT *, {S.grams("w")} AS g FROM w),
k AS (SELECT conv_id, turn, CAST(CASE WHEN length({S.strip("response")}) BETWEEN 20 AND 800 THEN 0.5 ELSE -0.5 END + {_THINK_TERMS} AS DOUBLE)
  - {S.repeat_fraction("g")} AS rule FROM g)"""


@query(f"""WITH {_BASE}, {_SINGLE} SELECT conv_id, turn, round(rule, 6) AS rule_reward,
 round(rule + least(greatest((conv_id % 11 - 5)::DOUBLE, -3), 3), 6) AS reward,
 round(0.7::DOUBLE * (conv_id % 11 - 5) + 0.3::DOUBLE * rule, 6) AS mixed FROM k""")
def reward_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-turn rule reward, with a scorer value and as a weighted mix."""
    score = (F.col("conv_id") % 11 - 5).cast("double")
    rule = W.single_turn_reward(F.col("response"))
    rows = responses(spark, sf_dir).select("conv_id", "turn", rule.alias("rule"), score.alias("score"))
    return rows.select(
        "conv_id",
        "turn",
        F.round("rule", 6).alias("rule_reward"),
        F.round(F.col("rule") + F.greatest(F.least("score", F.lit(3.0)), F.lit(-3.0)), 6).alias("reward"),
        F.round(weighted_mix(F.col("score"), F.col("rule"), 0.7, 0.3), 6).alias("mixed"),
    )


def _expected() -> Column:
    turn = F.col("turn").cast("string")
    return F.array(
        F.left("text", F.lit(5)), F.lower(F.left("text", F.lit(5))), F.lit("1234"), F.lit(" -7.50 "), F.lit("99999"), turn, F.lit("1234")
    )


_EXPECTED = "[left(text, 5), lower(left(text, 5)), '1234', ' -7.50 ', '99999', CAST(turn AS VARCHAR), '1234']"
_NUM = r"[-+]?\p{Nd}+(?:\.\p{Nd}+)?"


def _verified(text: str, gt: str) -> str:
    nums = (
        rf"list_transform(list_filter(regexp_extract_all(replace({text}, ',', ''), '[-+]?[\p{{L}}\p{{N}}_.]+'), "
        rf"lambda x: regexp_full_match(x, '{_NUM}')), lambda x: CAST(x AS DOUBLE))"
    )
    plain = f"replace({S.strip('v')}, ',', '')"
    return f"""list_distinct(list_filter({gt}, lambda v: (length({S.strip("v")}) > 0 AND contains(lower({text}), lower({S.strip("v")})))
  OR (regexp_full_match({plain}, '{_NUM}') AND len(list_filter({nums}, lambda n: abs(try_cast({plain} AS DOUBLE) - n) < 1e-6)) > 0)))"""


@query(f"""WITH {_BASE} SELECT conv_id, turn, len({_verified("response", _EXPECTED)}) AS n_verified,
 round(len({_verified("response", _EXPECTED)}) / 7.0::DOUBLE, 6) AS share FROM r""")
def gt_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = responses(spark, sf_dir).withColumn("gt", _expected())
    return rows.select(
        "conv_id",
        "turn",
        F.size(W.verified_values(F.col("response"), F.col("gt"))).cast("bigint").alias("n_verified"),
        F.round(W.verified_share(F.col("response"), F.col("gt")), 6).alias("share"),
    )


_OFFERED = "('get_current_weather', 'get_exchange_rate', 'unit_converter', 'fly')"
_AGENT_GT = "CASE WHEN conv_id % 2 = 0 THEN ['1234'] ELSE [left(text, 5), '-7.5'] END"
_AGENT = f"""{_BASE},
a AS (SELECT *, {S.strip(f"coalesce({S.after_first('response', '</think>')}, response)")} AS answer, {_AGENT_GT} AS gt, conv_id % 13 = 0 AS unfinished FROM r),
c AS (SELECT *, list_filter(list_transform(regexp_extract_all(answer, '{_CALL}', 1), lambda x: {S.strip("x")}), lambda x: json_valid(x)) AS calls FROM a),
v AS (SELECT *, CASE WHEN len(calls) > 0 AND (tool = 'get_current_weather' OR tool = 'unit_converter' OR (tool = 'get_exchange_rate' AND turn % 2 = 0))
   THEN 1 ELSE 0 END AS valid, CASE WHEN unfinished THEN '' WHEN instr(answer, '</tool_call>') > 0 THEN split(answer, '</tool_call>')[-1] ELSE answer END AS final FROM c),
w AS (SELECT *, {S.words("CASE WHEN len(calls) = 0 THEN coalesce(" + S.strip(S.after_first("response", "</think>")) + ", answer) WHEN length(final) > 0 THEN final ELSE answer END")} AS w FROM v),
g AS (SELECT *, {S.grams("w")} AS g, abs(valid - len(gt)) + greatest(len(calls) - valid, 0) AS gap FROM w)"""


@query(f"""WITH {_AGENT} SELECT conv_id, turn, len(calls) AS n_calls, round(least(greatest(
 -0.5::DOUBLE * abs({S.count_of("answer", "<tool_call>")} - {S.count_of("answer", "</tool_call>")})
 + CASE WHEN len(calls) = 0 THEN CAST(CASE WHEN length({S.strip("response")}) BETWEEN 5 AND 800 THEN 0.5 ELSE -0.5 END + {_THINK_TERMS} AS DOUBLE)
   ELSE CASE WHEN gap = 0 THEN 0.5::DOUBLE ELSE -0.5::DOUBLE * gap END + 2.5::DOUBLE * len({_verified("final", "gt")}) / len(gt)
     - CASE WHEN unfinished THEN 0.5::DOUBLE ELSE 0 END END
 - {S.repeat_fraction("g")}, -3), 3), 6) AS reward FROM g""")
def reward_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-turn tool reward; each assistant turn is a one-turn trajectory here."""
    response = F.col("response")
    names = F.array(*[F.lit(n) for n in ("get_current_weather", "get_exchange_rate", "unit_converter", "fly")])
    gt = F.when(F.col("conv_id") % 2 == 0, F.array(F.lit("1234"))).otherwise(
        F.array(F.left("text", F.lit(5)), F.lit("-7.5"))
    )
    reward = W.agent_reward(response, F.array(response), F.col("conv_id") % 13 == 0, names, gt)
    calls = F.size(R.call_texts(R.answer_of(response)))
    return responses(spark, sf_dir).select(
        "conv_id", "turn", calls.cast("bigint").alias("n_calls"), F.round(reward, 6).alias("reward")
    )


@query(f"""WITH {_BASE} SELECT conv_id, turn, CASE WHEN instr(p, '</think>') > 0 THEN 'answered' WHEN instr(p, '<think>') > 0 THEN 'thinking' ELSE 'none' END AS status
FROM (SELECT conv_id, turn, left(response, 40 + CAST(conv_id % 60 AS INT)) AS p FROM r)""")
def reply_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of replies seen part-way."""
    partial = F.left("response", F.lit(40) + (F.col("conv_id") % 60).cast("int"))
    return responses(spark, sf_dir).select("conv_id", "turn", R.reply_status(partial).alias("status"))


@query(f"""WITH {_BASE} SELECT conv_id, turn, md5('{{"id":"chatcmpl-' || conv_id || '","object":"chat.completion","created":0,"model":"m","choices":[{{"index":0,"message":{{"role":"assistant","content":' || to_json(tool)
 || CASE WHEN conv_id % 3 = 0 THEN ',"reasoning_content":' || to_json(left(args, 8)) ELSE '' END
 || CASE WHEN conv_id % 5 = 0 THEN ',"tool_calls":[' || to_json(tool) || ']' ELSE '' END || '}},"finish_reason":"'
 || CASE WHEN conv_id % 5 = 0 THEN 'tool_calls' ELSE 'stop' END || '"}}]}}') AS json_md5 FROM r""")
def response_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured responses as JSON; absent parts are left out."""
    made = response_json(
        F.col("conv_id"),
        F.lit(0),
        F.lit("m"),
        F.col("tool"),
        F.when(F.col("conv_id") % 3 == 0, F.left("args", F.lit(8))).otherwise(F.lit("")),
        F.when(F.col("conv_id") % 5 == 0, F.array("tool")),
    )
    return responses(spark, sf_dir).select("conv_id", "turn", F.md5(made).alias("json_md5"))


@query(f"""WITH {_BASE} SELECT conv_id, turn, length(text) AS n_chars, len(list_filter(regexp_split_to_array(text, '[{S.WS_CLASS}]+'), lambda x: x <> '')) AS n_words,
 coalesce(turn % 2 = 0, false) OR coalesce(nullif(conv_id % 3, 1) = 0, false) AS flag,
 right(text, 20) AS tail, left(text, 20) AS head, replace(replace('2×' || turn || '−1', '×', '*'), '−', '-') AS math FROM r""")
def text_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters, words, cut ends, plain-ASCII formulas and a flag from optional fields."""
    third = F.nullif(F.col("conv_id") % 3, F.lit(1)) == 0
    return responses(spark, sf_dir).select(
        "conv_id",
        "turn",
        F.length("text").cast("bigint").alias("n_chars"),
        X.whitespace_words(F.col("text")).cast("bigint").alias("n_words"),
        any_flag(F.col("turn") % 2 == 0, third).alias("flag"),
        X.keep_tail(F.col("text"), 20).alias("tail"),
        X.keep_head(F.col("text"), 20).alias("head"),
        X.ascii_math(F.concat(F.lit("2×"), F.col("turn").cast("string"), F.lit("−1"))).alias("math"),
    )
