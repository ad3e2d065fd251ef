"""Time as text and as epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)
