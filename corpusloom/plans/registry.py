"""The catalogue: query name to DataFrame builder, and to equivalent SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder under its function name."""

    def add(builder: Builder) -> Builder:
        QUERIES[builder.__name__] = builder
        if sql is not None:
            ORACLES[builder.__name__] = sql
        return builder

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
