"""Imports every query module, which fills the registry."""

from corpusloom.plans import (  # noqa: F401
    conversation_queries,
    corpus_queries,
    job_queries,
    report_queries,
    response_queries,
    sampling_queries,
    sequence_queries,
    source_queries,
    stream_queries,
)
from corpusloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
