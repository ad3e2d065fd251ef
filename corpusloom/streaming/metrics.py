"""Metric streams."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def every_kth(
    steps: DataFrame, every: int, lasts: DataFrame, run: str = "run", step: str = "step", last: str = "last_step"
) -> DataFrame:
    """Values at every ``every``-th step and at the last one of each run.

    ``lasts`` is a table of (run, last step), known before the runs begin. Joined to it the stream stays
    stateless and runs in append mode. Runs that the table doesn't name have no last step yet.
    """
    known = steps.join(lasts.select(run, last), run, "left")
    return known.filter((F.pmod(F.col(step), F.lit(every)) == 0) | (F.col(step) == F.col(last))).drop(last)


def every_kth_and_last(
    steps: DataFrame, every: int, metrics: list[str], at: str, idle_ms: int = 600_000, run: str = "run", step: str = "step"
) -> DataFrame:
    """(run, step, …metrics) at every ``every``-th step, and at the last step of each run, which nobody knows beforehand.

    Streaming only; ``at`` is the event time column under the watermark of ``steps``. The state of a run is its latest step. When the watermark
    is ``idle_ms`` past the run's last row, the run counts as over: a latest step not given out yet is, and the state goes. A run
    that goes on after that is taken for a new one. Rows without a step only move the watermark; of rows that repeat the latest step the first counts as last.
    """

    def update(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        latest, values, seen_ms, rows = None, None, 0, []
        if state.exists:
            latest, values, seen_ms = state.get
        if state.hasTimedOut:
            state.remove()
            rows = [(latest, *json.loads(values))] if latest % every else []
        else:
            for frame in frames:
                seen_ms = max(seen_ms, int(frame[at].max().timestamp() * 1000))
                frame = frame[frame[step].notna()]
                for n, *row in zip(frame[step].astype(int), *[frame[m] for m in metrics]):
                    row = [None if pd.isna(v) else float(v) for v in row]
                    if n % every == 0:
                        rows.append((n, *row))
                    if latest is None or n > latest:
                        latest, values = n, json.dumps(row)
            if latest is not None:
                state.update((latest, values, seen_ms))
                state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), seen_ms) + idle_ms)
        if rows:
            yield pd.DataFrame([(*group, *r) for r in rows], columns=[run, step, *metrics])

    kind = steps.schema[run].dataType.simpleString()
    schema = ", ".join([f"{run} {kind}", f"{step} bigint", *[f"{m} double" for m in metrics]])
    return steps.groupBy(run).applyInPandasWithState(
        update, schema, "latest bigint, row_values string, seen_ms bigint", "append", GroupStateTimeout.EventTimeTimeout
    )


def to_metric_log(steps: DataFrame, metrics: list[str]) -> DataFrame:
    """Wide step rows to (run, step, metric, value), also on a stream."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return steps.select("run", "step", F.inline(pairs)).filter(F.col("value").isNotNull())
