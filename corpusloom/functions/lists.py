"""Arrow list columns in numpy: the helpers behind the functions on token arrays that run in Python."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_ITEMS = 1 << 18


def row_bounds(column: pa.ListArray) -> np.ndarray:
    """Where each row begins in ``column.flatten()``, and where the last one ends; null rows are empty."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def row_runs(column: pa.ListArray, items: int = RUN_ITEMS) -> Iterator[pa.ListArray]:
    """``column`` in runs of rows, without copies: at most ``items`` items each, or one row. A column without rows is one run."""
    bounds, low = row_bounds(column), 0
    while low < len(column) or not len(column):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + items, "right")) - 1)
        yield column.slice(low, high - low)
        if not len(column):
            return
        low = high
