"""Intermediate tables in the shared checkpoint folder, written and removed by the job that needs them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import ensure_checkpoint_dir, scope, scope_folder

__all__ = ["discard", "draw", "fresh", "keep", "new_folder", "pieces", "scope"]


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh path below the checkpoint folder (or the current ``scope`` of it); nothing is created."""
    return f"{scope_folder.get() or ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def keep(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``rows`` to ``folder`` and read them back: lineage ends and sizes are known. Runs a job."""
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def discard(spark: SparkSession, *folders: str) -> None:
    """Remove intermediate folders that nothing reads any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores put in front until no column has that name (in any case)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def draw(*parts) -> "F.Column":
    """A repeatable number in [0, 1) from the md5 of the parts; null parts count as empty."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, without copies, so that few texts of a batch are Python strings at once."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)
