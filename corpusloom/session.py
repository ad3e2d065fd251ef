"""Session settings and the checkpoint folder.

On a cluster the session is built by whoever submits the job; ``recommended_conf``
lists the SQL settings the operators were tuned with. Nothing here is required for
correct results.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins back to per-group statistics may meet a hot key on the row side: let AQE
    # split it even when that costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def recommended_conf(shuffle_partitions: int | None = None) -> dict[str, str]:
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return conf


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "corpusloom") -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in recommended_conf(shuffle_partitions).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder ``DataFrame.checkpoint`` writes to.

    Takes ``spark.checkpoint.dir`` from the session. Only a local-mode session may fall
    back to a folder of its own; on a cluster a machine-local folder would not survive
    the loss of an executor, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="corpusloom-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def written(rows: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Runs a job. The table as written to a new place in the checkpoint folder (or the one given), and that place."""
    spark = rows.sparkSession
    folder = folder or new_place(spark, "settled")
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder), folder


#: The folder of the ``scope`` that intermediate tables are written in.
scope_folder: ContextVar[str | None] = ContextVar("scope_folder", default=None)

_PLACES: list[tuple[str, str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made within are removed at its end. What is to stay must be written elsewhere before that."""
    folder = f"{scope_folder.get() or ensure_checkpoint_dir(spark)}/scope-{uuid.uuid4().hex}"
    token = scope_folder.set(folder)
    try:
        yield
    finally:
        scope_folder.reset(token)
        remove_folder(spark, folder)


def new_place(spark: SparkSession, kind: str) -> str:
    """A fresh path below the checkpoint folder (or the current ``scope`` of it), known to ``remove_intermediate``."""
    folder = f"{scope_folder.get() or ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    _PLACES.append((spark.sparkContext.applicationId, folder))
    return folder


def remove_intermediate(spark: SparkSession) -> int:
    """Remove the intermediate tables and stream folders that this application's operators have written so far.

    For a caller that has taken (written, collected) all results it wants: frames not yet run may read them. Returns how many there were.
    """
    mine = [place for place in _PLACES if place[0] == spark.sparkContext.applicationId]
    for place in mine:
        remove_folder(spark, place[1])
        _PLACES.remove(place)
    return len(mine)


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job run within go from the executors' disks at its end, not when the driver happens to collect its garbage.

    For loops of many jobs whose results are written: each would else leave its shuffles, of one file a task and more.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def lean(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For an operator that runs jobs on its first argument, a DataFrame: they drop their shuffles (see ``dropping_shuffles``)."""

    @wraps(operator)
    def run(rows: DataFrame, *more, **named) -> DataFrame:
        with dropping_shuffles(rows.sparkSession):
            return operator(rows, *more, **named)

    return run


def settled(rows: DataFrame) -> DataFrame:
    """Write a table to the checkpoint folder and read it back.

    The lineage ends there, and the planner sees the true size of what was an estimate. Use
    it for key sets that decide how a much larger table is joined: a small one is then broadcast
    before anything of the larger table is shuffled. Runs a job when called.
    """
    return written(rows)[0]


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate folder through Spark's file system layer, if it is there; nothing may read it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checked_in(rows: DataFrame, folder: str) -> DataFrame:
    """Runs a job. ``rows``, which read ``folder``, as a checkpoint of their own; the folder is removed."""
    ensure_checkpoint_dir(rows.sparkSession)
    kept = rows.checkpoint()
    remove_folder(rows.sparkSession, folder)
    return kept
