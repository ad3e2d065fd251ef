"""Places where the caller plugs in a model: a scorer and a text generator.

No model ships with the library. The function is called once per Arrow batch inside the
tasks, so Spark spreads the work; anything expensive to load should be loaded by ``setup``,
which runs once per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.numbers import clamp
from corpusloom.operators.messages import judge_context


def score_responses(
    rows: DataFrame,
    messages: Column,
    response: Column,
    scorer: Callable[[Any, pd.Series, pd.Series], pd.Series],
    setup: Callable[[], Any] | None = None,
    limit: float = 3.0,
) -> DataFrame:
    """Add ``score``: ``scorer(state, context, response)`` clamped to ±``limit``.

    The context is the packed conversation (``judge_context``). Packing and clamping stay
    native; only two string columns travel to Python.
    """

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        state = setup() if setup else None
        for context, text in batches:
            yield scorer(state, context, text)

    return rows.withColumn("score", clamp(run(judge_context(messages), response), -limit, limit))


def generate(
    prompts: DataFrame,
    generator: Callable[[Any, pd.DataFrame], pd.DataFrame],
    output: str,
    setup: Callable[[], Any] | None = None,
) -> DataFrame:
    """Run a caller's generator over prompt batches.

    ``generator(state, batch)`` gets the prompt rows (fan them out first for several
    generations) and returns the columns named in ``output``, one row per completion.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = setup() if setup else None
        for batch in batches:
            yield generator(state, batch)

    return prompts.mapInPandas(run, schema=output)
