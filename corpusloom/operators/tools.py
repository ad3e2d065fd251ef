"""Tool definitions, argument checks and table lookups for tool calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import fixed
from corpusloom.functions.jsontext import not_null, python_truthy


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], defaults: dict[str, Column]) -> DataFrame:
    """Left join to a lookup table of any size; columns of absent keys take their default."""
    joined = rows.join(table, keys, "left")
    for column, default in defaults.items():
        joined = joined.withColumn(column, F.coalesce(F.col(column), default))
    return joined


def definitions_of(names: Column, definitions: dict[str, str]) -> Column:
    """Tool names to definitions, in order; unknown names are dropped. The map is a literal."""
    pairs = [F.lit(x) for item in definitions.items() for x in item]
    table = F.create_map(*pairs)
    found = F.transform(names, lambda n: F.try_element_at(table, n))
    return F.filter(found, lambda d: d.isNotNull())


def definitions_join(cases: DataFrame, key: str, names: str, definitions: DataFrame) -> DataFrame:
    """The same against a definition table of any size: (key, definitions in name order)."""
    listed = cases.select(key, F.posexplode(names).alias("_pos", "name"))
    return (
        listed.join(definitions, "name")
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("_pos", "definition"))).alias("_d"))
        .select(key, F.transform("_d", lambda d: d["definition"]).alias("definitions"))
    )


def arguments_ok(name: Column, arguments: Column) -> Column:
    """Required arguments are there: some must be truthy, some only not null. False for unknown tools."""
    result = F.lit(False)
    for tool, truthy, present in fixed.TOOL_RULES:
        passed = F.lit(True)
        for k in truthy:
            passed = passed & python_truthy(arguments, f"$.{k}")
        for k in present:
            passed = passed & not_null(arguments, f"$.{k}")
        result = F.when(name == tool, passed).otherwise(result)
    return F.coalesce(result, F.lit(False))


def offered(name: Column, names: Column) -> Column:
    return F.coalesce(F.array_contains(names, name), F.lit(False))


def offered_calls(calls: DataFrame, offers: DataFrame, keys: tuple[str, ...] = ("prompt_id", "name")) -> DataFrame:
    """Calls of tools that were offered, for offers kept as a (prompt, name) table."""
    return calls.join(offers, list(keys), "left_semi")


def fan_out(prompts: DataFrame, n: int) -> DataFrame:
    """One row per prompt and generation number."""
    return prompts.withColumn("gen_id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def attach_prompt(responses: DataFrame, prompts: DataFrame, num_gen: int, index: str = "idx") -> DataFrame:
    """Responses numbered prompt by prompt, joined to their prompt by ``idx // num_gen``."""
    return responses.withColumn("prompt_id", F.floor(F.col(index) / F.lit(num_gen)).cast("bigint")).join(
        prompts, "prompt_id"
    )
